"""Substring dedup by content-defined chunking with a gear rolling hash.

A text's bytes run through a gear hash (each step doubles the hash and adds the byte's random number), and a chunk
ends where the low ``BITS`` bits are zero. These bits depend on the last ``BITS`` bytes only, so an insertion moves
the borders next to it and no others, and a passage is cut alike wherever it stands. A chunk above ``MAX_CHUNK`` bytes
(in repeated words or lines there may be no such place at all) is also cut where the hash is lowest among its
``NEAR`` neighbours on either side, which the bytes around that place decide, too. Chunks are compared by a 64-bit
digest. A chunk repeats if its digest stands in a lower id, or earlier in its own text. A run of neighbouring
repeated chunks with at least ``min_words`` words is removed; shorter runs are the coincidences of common phrases
and stay, so texts without a shared passage stay byte for byte.

Each text sends a digest once, with its id. The lowest id of a digest is found by partial aggregates, so a chunk that
a third of all texts share is one row per task before the shuffle. Only digests that occur twice go on; their
occurrences meet the lowest id in a join that may split hot digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from machpulse.llm.text import whole
from machpulse.sources.storage import stored

BITS = 5
#: A passage of over 50 words has far more than this between its first and last border.
MIN_WORDS = 24
MAX_CHUNK = 96
NEAR = 16
#: Texts are read in pieces of so many bytes; the gear hash is carried by overlapping them.
PIECE_BYTES = 1 << 20
#: Short texts are read together, so many bytes at a time.
GROUP_BYTES = 1 << 18


#: A byte that no UTF-8 text holds stands between texts that are read at once, more often than any hash looks back.
FILLER = 0xFF
GAP = 2 * NEAR


def _gear() -> "np.ndarray":
    import numpy as np

    from machpulse.llm.arrays import _ODD

    gear = (_ODD[:256] >> np.uint64(17)).astype(np.uint32)
    gear[FILLER] = 0
    return gear


def _rolled(data) -> "np.ndarray":
    """The gear hash after each byte; the bits beyond the mask's window are not carried."""
    import numpy as np

    values = _gear()[data]
    rolled = values.copy()
    for step in range(1, BITS):  # the bits beyond have been shifted out of the mask
        rolled[step:] += values[:-step] << np.uint32(step)
    return rolled


def _least_places(rolled, data) -> "np.ndarray":
    """Last bytes of characters at which the hash is lowest among its neighbours; ``data`` may go on one byte further."""
    import numpy as np

    values = rolled.copy()
    follow = data[1: len(values) + 1]
    values[: len(follow)][(follow & 0xC0) == 0x80] = 0xFFFFFFFF
    values[data[: len(values)] == FILLER] = 0xFFFFFFFF
    least = np.full(len(values) + 2 * NEAR, 0xFFFFFFFF, np.uint32)
    least[NEAR: NEAR + len(values)] = values
    width = 1
    while width < 2 * NEAR + 1:  # the minimum of width neighbours, from that of fewer
        step = min(width, 2 * NEAR + 1 - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return np.flatnonzero((values == least) & (values != 0xFFFFFFFF))


def borders(data) -> "np.ndarray":
    """Ends of the chunks of a byte array, the last one included; UTF-8 characters are not cut."""
    import numpy as np

    found = []
    for begin in range(0, len(data), PIECE_BYTES):
        before = max(0, begin - BITS + 1)
        rolled = _rolled(data[before: begin + PIECE_BYTES])
        ends = np.flatnonzero((rolled & np.uint32((1 << BITS) - 1)) == 0) + 1 + before
        found.append(ends[ends > begin])
    ends = np.concatenate(found) if found else np.zeros(0, np.int64)
    if len(ends):
        inside = ends[ends < len(data)]
        ends = inside[(data[inside] & 0xC0) != 0x80]
    if not len(data):
        return ends
    ends = np.append(ends, len(data))
    return np.union1d(ends, _lowest(data, ends)) if np.diff(ends, prepend=0).max() > MAX_CHUNK else ends


def _lowest(data, ends) -> "np.ndarray":
    """Ends of characters inside the chunks above ``MAX_CHUNK`` bytes where the hash is lowest among its neighbours.

    All places that share the lowest value count, so repeated words are cut at every repetition."""
    import numpy as np

    starts = np.append(0, ends[:-1])
    large = np.flatnonzero(ends - starts > MAX_CHUNK)
    found = [np.zeros(0, np.int64)]
    for begin in range(0, len(data), PIECE_BYTES):
        past = min(begin + PIECE_BYTES, len(data))
        chunks = large[np.searchsorted(ends[large], begin, "right"): np.searchsorted(starts[large], past, "left")]
        if not len(chunks):
            continue
        before, after = max(0, begin - NEAR - BITS + 1), min(past + NEAR, len(data))
        values = _rolled(data[before:after])
        places = _least_places(values, data[before: after + 1]) + before
        places = places[(places >= begin) & (places < past)]
        chunk = np.searchsorted(ends, places, "right")
        found.append(places[(ends - starts)[chunk] > MAX_CHUNK] + 1)
    return np.concatenate(found)


def chunk_digests(data):
    """Per chunk its end and its 64-bit digest."""
    import numpy as np

    from machpulse.llm.arrays import _FACTOR, _VALUE, mix

    ends = borders(data)
    found, at, index = [np.zeros(0, np.uint64)], 0, 0
    while index < len(ends):  # a bounded stretch of chunks at a time
        last = max(index + 1, int(np.searchsorted(ends, at + PIECE_BYTES, "right")))
        stretch = ends[index:last] - at
        part = data[at: ends[last - 1]]
        starts = np.append(0, stretch[:-1])
        lengths = stretch - starts
        place = np.arange(len(part)) - np.repeat(starts, lengths)
        powers = np.ones(int(lengths.max()), np.uint64)
        powers[1:] = _FACTOR[0]
        sums = np.add.reduceat(_VALUE[part] * np.cumprod(powers)[place], starts)
        found.append(mix(sums + lengths.astype(np.uint64) * _FACTOR[5]))
        at, index = int(ends[last - 1]), last
    return ends, np.concatenate(found).view(np.int64)


def _group_chunks(texts: list[bytes]):
    """``chunk_digests`` of several texts at once: ends within each text, digests, and the first chunk of each text.

    One more entry than texts, the number of chunks, closes the last list."""
    import numpy as np

    from machpulse.llm.arrays import _FACTOR, _VALUE, mix

    data = np.frombuffer((bytes([FILLER]) * GAP).join([b"", *texts, b""]), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = GAP + np.concatenate([[0], np.cumsum(lengths + GAP)[:-1]])
    rolled = _rolled(data)
    solid = data != FILLER
    found = np.flatnonzero(((rolled & np.uint32((1 << BITS) - 1)) == 0) & solid) + 1
    found = found[(data[found] & 0xC0) != 0x80]
    ends = np.union1d(found, (begins + lengths)[lengths > 0])

    def starts_of(ends):
        starts = np.concatenate([[0], ends[:-1]])
        first = np.searchsorted(ends, begins, "right")[lengths > 0]
        starts[first] = begins[lengths > 0]
        return starts

    starts = starts_of(ends)
    if len(ends) and (ends - starts).max() > MAX_CHUNK:
        places = _least_places(rolled, data)
        chunk = np.searchsorted(ends, places, "right")
        ends = np.union1d(ends, places[(ends - starts)[chunk] > MAX_CHUNK] + 1)
        starts = starts_of(ends)
    if not len(ends):
        return ends, np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    # Every chunk reaches to the next one for the sums: what lies between is filler and counts nothing.
    value = _VALUE.copy()
    value[FILLER] = 0
    reach = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, reach)
    powers = np.ones(int(reach.max()), np.uint64)
    powers[1:] = _FACTOR[0]
    sums = np.add.reduceat(value[data[starts[0]:]] * np.cumprod(powers)[place], starts - starts[0])
    digests = mix(sums + (ends - starts).astype(np.uint64) * _FACTOR[5]).view(np.int64)
    firsts = np.append(np.searchsorted(starts, begins), len(ends))
    row = np.repeat(np.arange(len(texts)), np.diff(firsts))
    return ends - begins[row], digests, firsts


def _groups(column):
    """(first row, ends, digests, first chunk of each text) of groups of texts; a long text is a group of its own."""
    import numpy as np

    held, size, first = [], 0, 0
    for row, text in enumerate(column):
        raw = text.as_buffer().to_pybytes() if text.is_valid else b""
        if held and size + len(raw) > GROUP_BYTES:
            yield (first, *_group_chunks(held))
            held, size, first = [], 0, row
        if len(raw) > GROUP_BYTES:
            ends, digests = chunk_digests(np.frombuffer(raw, np.uint8))
            yield row, ends, digests, np.array([0, len(ends)])
            first = row + 1
            continue
        held.append(raw)
        size += len(raw) + GAP
    if held:
        yield (first, *_group_chunks(held))


def _chunks(batches):
    """(_id, _mark, digest) of the distinct chunks of every text."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for first, ends, digests, firsts in _groups(batch.column("_text")):
            row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
            order = np.lexsort((digests, row))
            row, digests = row[order], digests[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (digests[1:] != digests[:-1])
            take = pa.array(row[new] + first)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(take), batch.column("_mark").take(take), pa.array(digests[new])], names=["_id", "_mark", "digest"]
            )


def _seen_before(digests, firsts) -> "np.ndarray":
    """Whether a chunk's digest stands earlier in its own text."""
    import numpy as np

    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    order = np.lexsort((digests, row))
    again = np.zeros(len(digests), bool)
    again[order[1:]] = (row[order[1:]] == row[order[:-1]]) & (digests[order[1:]] == digests[order[:-1]])
    return again


def _without(raw: bytes, ends, repeated, min_words: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without its long enough runs of repeated chunks, and their (first, past the last) byte."""
    import numpy as np

    edge = np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]]))
    spans, kept, at = [], [], 0
    for first, last in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
        begin, end = int(ends[first - 1]) if first else 0, int(ends[last - 1])
        if len(raw[begin:end].split()) >= min_words:
            spans.append((begin, end))
            kept.append(raw[at:begin])
            at = end
    kept.append(raw[at:])
    return (b"".join(kept) if spans else raw), spans


def cut(raw: bytes, elsewhere, min_words: int) -> tuple[bytes, list[tuple[int, int]], int]:
    """The text without its repeated runs, their (first, past the last) byte, and its number of chunks.

    ``elsewhere`` are the digests that a lower id has."""
    import numpy as np

    ends, digests = chunk_digests(np.frombuffer(raw, np.uint8))
    repeated = _seen_before(digests, np.array([0, len(digests)]))
    if len(elsewhere):
        repeated |= np.isin(digests, elsewhere)
    return (*_without(raw, ends, repeated, min_words), len(ends))


def remove_repeats(
    docs: DataFrame, id_col="doc_id", text_col="text", min_words: int = MIN_WORDS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: ``id, text, n_chunks, removed_spans, removed_bytes, first_ids``, then the columns of ``carry``.

    ``text`` keeps everything but the removed runs; ``removed_spans`` are their places in the UTF-8 bytes of the
    input; ``first_ids`` are the lowest ids of the repeated chunks, where something was removed. A null text stays
    null and an empty one empty. Rows with one id are one document: they do not repeat each other, and each is held
    against the lower ids. Null ids come after all others. Extra columns may have any name and only go along if named.
    """
    # Rows of one id are told apart by their texts, so no list of digests is longer than one text.
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("_raw"), F.xxhash64(whole(text_col)).alias("_mark"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    id_type = rows.schema["_id"].dataType
    schema = StructType([StructField("_id", id_type), StructField("_mark", LongType()), StructField("digest", LongType())])
    chunks = rows.select("_id", "_mark", whole("_raw").alias("_text")).mapInArrow(_chunks, schema)
    firsts = chunks.groupBy("digest").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("times")).filter(
        "times > 1 AND first IS NOT NULL"
    )
    again = (
        chunks.join(firsts.select("digest", "first").hint("shuffle_hash"), "digest")
        .filter("_id IS NULL OR _id > first")
        .groupBy("_id", "_mark").agg(F.collect_set("digest").alias("_again"), F.collect_set("first").alias("_firsts"))
    )
    again = stored(again.withColumnsRenamed({"_id": "_of", "_mark": "_of_mark"}), "passages-repeated")
    mine = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_of_mark"))
    joined = rows.join(again, mine, "left").drop("_of", "_of_mark", "_mark")
    out = StructType([
        StructField("_id", id_type), StructField("_text", StringType()),
        StructField("_spans", ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType())]))),
        StructField("_n", LongType()), StructField("_firsts", ArrayType(id_type)),
        *[StructField(f"_c{i}", rows.schema[f"_c{i}"].dataType) for i in range(len(carry))],
    ])

    def apply(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            raws, again = batch.column("_raw"), batch.column("_again")
            texts, spans, counts = raws.to_pylist(), [[]] * batch.num_rows, np.zeros(batch.num_rows, np.int64)
            for first, ends, digests, firsts in _groups(raws):
                repeated = _seen_before(digests, firsts)
                counts[first: first + len(firsts) - 1] = np.diff(firsts)
                own = np.concatenate([[0], np.cumsum(repeated)])
                for k in range(len(firsts) - 1):
                    row, part = first + k, slice(firsts[k], firsts[k + 1])
                    if not again[row].is_valid and own[firsts[k + 1]] == own[firsts[k]]:
                        continue
                    mine = repeated[part]
                    if again[row].is_valid:
                        mine = mine | np.isin(digests[part], again[row].values.to_numpy())
                    left, removed = _without(texts[row].encode(), ends[part], mine, min_words)
                    if removed:
                        texts[row], spans[row] = left.decode(), [{"begin": b, "end": e} for b, e in removed]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(texts, pa.string()), pa.array(spans, kind), pa.array(counts, pa.int64()),
                 batch.column("_firsts"), *[batch.column(f"_c{i}") for i in range(len(carry))]],
                names=out.names,
            )

    order = ["_id", "_raw", "_again", "_firsts", *[f"_c{i}" for i in range(len(carry))]]
    done = joined.select(*order).mapInArrow(apply, out)
    lost = F.aggregate("_spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["begin"])
    return done.select(
        F.col("_id").alias(id_col), F.col("_text").alias(text_col), F.col("_n").alias("n_chunks"),
        F.col("_spans").alias("removed_spans"), lost.alias("removed_bytes"),
        F.when(F.size("_spans") > 0, F.coalesce(F.array_sort("_firsts"), F.array().cast(ArrayType(id_type)))).otherwise(F.array().cast(ArrayType(id_type))).alias("first_ids"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
    )
