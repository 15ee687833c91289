"""Byte-level BPE: encoding whole texts by the ranks of a public tokenizer, and decoding ids.

Three steps run one after another in the task that reads the text; nothing is shuffled.

1. ``mapInArrow`` cuts the texts of a block (``BLOCK_BYTES`` of text, or one longer text) into pieces by the split
   pattern and numbers the distinct pieces. The numbers hold for the whole task, so a block only sends on the pieces
   that are new; after ``PIECES`` of them the numbering starts afresh, which bounds its memory. A piece is sent as its
   bytes, each with the rank of its pair with the next byte.
2. Spark's higher-order functions encode each of these distinct pieces once: a fold over its bytes joins the pair of
   lowest rank, leftmost first, until no pair has a rank. The pair ranks are a literal table, read by a scalar
   subquery; its size is that of the vocabulary.
3. ``mapInArrow`` puts the pieces' ids back in the order of each text.

The fold moves the rest of the piece at every join, so its cost is quadratic in the piece. Pieces above
``FOLD_BYTES`` bytes get the same merges from a heap in step 1 and pass step 2 unchanged.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections import defaultdict
from functools import lru_cache
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

BLOCK_BYTES = 4 << 20
PIECES = 500_000
FOLD_BYTES = 256
#: A part of a piece in one number: from the lowest bit its id, its place, and the rank of its pair with the next part.
PLACE, RANK = 1 << 17, 1 << 36
NO_RANK = PLACE - 1
IDS = 1 << 16
#: What a slot without a pair holds: bits above every rank, whatever the left id.
FREE = 1 << 60
#: Pieces of up to so many bytes go into the fold without a look at whether any of their pairs has a rank.
SHORT = 16


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def pair_ranks(ranks: dict[bytes, int]) -> dict[tuple[int, int], int]:
    """For every two tokens whose joined bytes are a token: its rank, which is also its id."""
    return {
        (ranks[token[:cut]], ranks[token[cut:]]): rank
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    }


def _displaced(ranks: dict[bytes, int]) -> tuple[list[int], list[int]]:
    """The ranks by left and right id as one array: the row of a left id is moved until its right ids find free slots."""
    import numpy as np

    if max(ranks.values(), default=0) >= IDS:
        raise ValueError(f"ids must be below {IDS}")
    rows = defaultdict(list)
    for (left, right), rank in pair_ranks(ranks).items():
        rows[left].append((right, rank))
    moves, slots = np.zeros(IDS, np.int64), np.full(2 * IDS, -(1 << 60))
    at, width = 0, 0
    for left, row in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
        rights, values = np.array(sorted(row)).T
        if len(row) != width:
            at, width = 0, len(row)  # rows of one width go on where the last one found its place
        while True:
            if len(slots) < at + 2 * IDS:
                slots = np.concatenate([slots, np.full(len(slots), -(1 << 60))])
            free = np.flatnonzero(slots[at: at + 4096] < 0) + at - rights[0]
            for right in rights[1:]:
                if not len(free):
                    break
                free = free[slots[free + right] < 0]
            if len(free):
                break
            at += 4096
        moves[left] = free[0]
        slots[free[0] + rights] = left * PLACE + values
    slots = slots[: np.flatnonzero(slots >= 0)[-1] + 1 if len(rows) else 0]
    return moves.tolist(), np.where(slots < 0, FREE, slots).tolist()


def _rank_table(spark: SparkSession, ranks: dict[bytes, int]) -> Column:
    """The pair ranks as one literal: ``moves`` by left id, and ``slots`` with left id and rank in one number."""
    import pyarrow as pa

    moves, slots = _displaced(ranks)
    longs = pa.list_(pa.int64())
    row = pa.array([{"moves": moves, "slots": slots}], pa.struct([("moves", longs), ("slots", longs)]))
    return spark.createDataFrame(pa.table({"t": row})).scalar()


def _rank(left: str, right: str) -> str:
    """The pair's rank, at most NO_RANK, also where ``right`` is null. Another left id in the slot leaves bits above a rank's."""
    return f"least(get(slots, get(moves, {left}) + {right}) ^ shiftleft({left}, 17), {NO_RANK}L)"


def _id(part: str) -> str:
    return f"({part} & {PLACE - 1}L)"


_NEW = "shiftright(x, 36)"
#: One join of part i with the next: the rank becomes the id, and the ranks with both neighbours are looked up. The
#: lowest number is that of the lowest rank, leftmost. As an argument of an inner fold, i is worked out once.
_JOIN = f"""
if(array_min(q) >= {IDS * RANK}L, q, aggregate(array(cast(array_position(q, array_min(q)) as int) - 1), q, (p, i) ->
  array_remove(transform(p, (x, j) -> if(abs(j - i) > 1, x,
    if(j = i, (x & {RANK - PLACE}L) | {_NEW} | shiftleft({_rank(_NEW, _id('get(p, i + 2)'))}, 36),
    if(j < i, (x & {RANK - 1}L) | shiftleft({_rank(_id('x'), 'shiftright(get(p, i), 36)')}, 36), -1L)))), -1L)))"""
#: The parts of a piece ``w`` after all joins, their ids in the lowest bits.
_FOLD = f"if(size(w) < 2 or size(w) > {SHORT} and array_min(w) >= {IDS * RANK}L, w, aggregate(sequence(2, size(w)), w, (q, _) -> {_JOIN}))"
#: The fold of all pieces. As arguments, the table's two arrays are taken out of it once, not at every lookup.
_FOLDS = f"""
get(transform(array(_table.moves), moves ->
  get(transform(array(_table.slots), slots -> transform(pieces, w -> {_FOLD})), 0)), 0)"""


def merge_long(parts: list[int], pairs: dict[tuple[int, int], int]) -> list[int]:
    """The merges of the fold with a heap of ranked pairs over a linked list; for pieces too long to fold."""
    size = len(parts)
    parts, after, before = list(parts), list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(pairs[pair], i, pair) for i, pair in enumerate(zip(parts, parts[1:])) if pair in pairs]
    heapq.heapify(heap)
    while heap:
        rank, i, (left, right) = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= size or parts[j] != right:
            continue  # one of the two was joined meanwhile
        parts[i], parts[j], after[i] = rank, -1, after[j]
        if after[i] < size:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] < size and (pair := (parts[a], parts[after[a]])) in pairs:
                heapq.heappush(heap, (pairs[pair], a, pair))
    return [part for part in parts if part >= 0]


def _segment(pattern: str, ranks: dict[bytes, int]):
    def blocks(batch):
        """(first row, one past the last) of runs of rows with about BLOCK_BYTES of text."""
        import pyarrow.compute as pc

        start, held = 0, 0
        for row, size in enumerate(pc.binary_length(batch.column("_text")).to_pylist()):
            if held and held + size > BLOCK_BYTES:
                yield start, row
                start, held = row, 0
            held += size + 1
        if start < batch.num_rows:
            yield start, batch.num_rows

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import regex

        find = regex.compile(pattern).findall
        single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        double = np.array([ranks.get(bytes([a, b]), NO_RANK) for a in range(256) for b in range(256)], dtype=np.int32)
        pairs, number = None, None

        def parts(held, sizes):
            """The pieces' bytes, each with its place and the rank of its pair with the next byte."""
            raw, sizes = np.frombuffer(bytes(held), np.uint8), np.array(sizes, np.int64)
            rank = np.full(len(raw), NO_RANK, np.int32)
            rank[:-1] = double[raw[:-1].astype(np.int32) * 256 + raw[1:]]
            ends = np.cumsum(sizes)
            rank[ends - 1] = NO_RANK
            found = rank.astype(np.int64)
            del rank
            found *= RANK // PLACE
            found += np.arange(len(raw))
            found -= np.repeat(ends - sizes, sizes)
            found *= PLACE
            found += single[raw]
            return found

        for whole in batches:
            for start, end in blocks(whole):
                batch = whole.slice(start, end - start)
                if number is None or len(number) > PIECES:
                    number = defaultdict()
                    number.default_factory = number.__len__
                known, places, counts = len(number), [], []
                for text in batch.column("_text").to_pylist():
                    pieces = find(text)
                    counts.append(len(pieces))
                    places.append(np.fromiter(map(number.__getitem__, pieces), np.int32, len(pieces)))
                # The new pieces as one stretch of bytes, those too long to fold apart: no object per piece is kept.
                words, sizes, held, done = [], array("i"), bytearray(), 0
                for piece in islice(number, known, None):
                    raw = piece.encode()
                    if len(raw) > FOLD_BYTES:
                        pairs = pairs or pair_ranks(ranks)
                        tokens = np.array(merge_long(single[np.frombuffer(raw, np.uint8)].tolist(), pairs), np.int64)
                        words += [parts(held, sizes[done:]), tokens + NO_RANK * RANK]
                        sizes.append(len(tokens))
                        held, done = bytearray(), len(sizes)
                    else:
                        held += raw
                        sizes.append(len(raw))
                words.append(parts(held, sizes[done:]))
                flat = np.concatenate(words)
                offsets = np.zeros(len(sizes) + 1, np.int32)
                np.cumsum(np.frombuffer(sizes, np.int32) if len(sizes) else np.zeros(0, np.int32), out=offsets[1:])
                every = np.concatenate(places) if places else np.zeros(0, np.int32)

                def one(values):
                    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

                pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                ids = batch.column("_id")
                yield pa.RecordBatch.from_arrays(
                    [one(ids), one(pa.array(counts, pa.int32())), one(pa.array(every)), one(pieces), pa.array([known], pa.int32())],
                    names=["ids", "counts", "places", "pieces", "known"],
                )

    return run


def _assemble(batches):
    import numpy as np
    import pyarrow as pa

    tokens, sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids").slice(row, 1).flatten()
            counts = batch.column("counts").slice(row, 1).flatten().to_numpy()
            places = batch.column("places").slice(row, 1).flatten().to_numpy()
            pieces = batch.column("pieces").slice(row, 1).flatten()
            if not batch.column("known")[row].as_py():
                tokens, sizes = tokens[:0], sizes[:0]
            tokens = np.concatenate([tokens, (pieces.flatten().to_numpy() & (PLACE - 1)).astype(np.int32)])
            sizes = np.concatenate([sizes, pieces.value_lengths().to_numpy().astype(np.int64)])
            starts = np.concatenate([[0], np.cumsum(sizes)])
            ends = np.concatenate([[0], np.cumsum(counts)])
            size = sizes[places]
            reached = np.concatenate([[0], np.cumsum(size)])
            flat = tokens[np.arange(reached[-1]) + np.repeat(starts[places] - reached[:-1], size)]
            offsets = reached[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["_id", "_ids"])


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col="doc_id", text_col="text", ids_col="ids") -> DataFrame:
    """One row per input row: ``id, ids array<int>``, without special tokens.

    A null text is empty and has no ids. Each match of ``pattern`` is encoded on its own; texts are never cut.
    Repeated rows are encoded each; other columns are ignored; an empty table gives none. ``rank_file`` is read on
    the driver, and its ranks travel with the tasks.
    """
    spark = docs.sparkSession
    ranks = read_ranks(rank_file)
    lean = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    id_type = lean.schema["_id"].dataType
    blocks = StructType([
        StructField("ids", ArrayType(id_type)), StructField("counts", ArrayType(IntegerType())),
        StructField("places", ArrayType(IntegerType())), StructField("pieces", ArrayType(ArrayType(LongType()))),
        StructField("known", IntegerType()),
    ])
    cut = lean.mapInArrow(_segment(pattern, ranks), blocks).withColumn("_table", _rank_table(spark, ranks))
    folded = cut.select("ids", "counts", "places", F.expr(_FOLDS).alias("pieces"), "known")
    out = StructType([StructField("_id", id_type), StructField("_ids", ArrayType(IntegerType()))])
    return folded.mapInArrow(_assemble, out).select(F.col("_id").alias(id_col), F.col("_ids").alias(ids_col))


def decode(ids, rank_file: str) -> Column:
    """The bytes of an array of ids: the ids' pieces, from a literal array in hex, joined. Empty for null or no ids."""
    ranks = read_ranks(rank_file)
    pieces = [""] * (max(ranks.values(), default=0) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    table = F.split(F.lit(",".join(pieces)), ",")  # folded to a literal array before the query runs
    joined = F.array_join(F.transform(ids, lambda i: table[i]), "")
    return F.unhex(F.coalesce(joined, F.lit("")))


def digests(docs: DataFrame, rank_file: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """Per input row: ``id, n_tokens, ids_sha256`` (of decimal ids joined by commas) and ``decoded_sha256``."""
    coded = encode(docs, rank_file, pattern, id_col, text_col)
    decoded = decode(F.col("ids"), rank_file)
    return coded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    )
