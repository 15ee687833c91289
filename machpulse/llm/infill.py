"""Fill-in-the-middle: a text is cut in three, and the middle is moved to its end.

Cuts are found in bytes or in code points and are needed in both. A text's exception index holds only its multibyte
characters: where each stands and how many bytes beyond one it and those before it take. A cut is converted by one
search among them; where there is none, code points and bytes are the same number.
"""

import hashlib
import re

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from machpulse.llm.text import whole

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes of output texts that are gathered before they are handed on.
GROUP_BYTES = 8 << 20


class ExceptionIndex:
    """Where the multibyte characters of a UTF-8 text stand, and the bytes beyond one of all before."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(excess)])
        self.length = len(data)

    def code_points(self, byte: int) -> int:
        """Code points before a byte offset that begins a character, or ends the text."""
        return byte - int(self.before[np.searchsorted(self.at, byte)]) if len(self.at) else byte

    def byte_offset(self, point: int) -> int:
        """Byte offset of a code point; the text's length for the one after its last."""
        return point + int(self.before[np.searchsorted(self.at - self.before[:-1], point)]) if len(self.at) else point

    def size(self) -> int:
        return self.length - int(self.before[-1])


def _cutter(unit: str, rate: int, spm_rate: int):
    """Batches of (_id, _text, _seed) to the transformed text, its form and the lengths of its parts."""
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def one(raw, seed):
        hexed = hashlib.sha256(seed).hexdigest()
        h1, h2, h3, h4 = (int(hexed[8 * k: 8 * k + 8], 16) for k in range(4))
        data = np.frombuffer(raw, np.uint8)
        index = None
        if unit == "line":
            ends = np.flatnonzero(data == 10) + 1
            if len(data) and data[-1] != 10:
                ends = np.append(ends, len(data))
            n = len(ends)
        else:
            index = ExceptionIndex(data)
            n = index.size()
        if not raw or any(m in raw for m in marks) or h3 % 100 >= rate:
            return raw, n, "plain", None, None
        first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
        if unit == "line":
            begin, end = (int(ends[k - 1]) if k else 0 for k in (first, last))
            index = ExceptionIndex(data[:end])
            first, last = index.code_points(begin), index.code_points(end)
        else:
            begin, end = index.byte_offset(first), index.byte_offset(last)
        head, middle, tail = raw[:begin], raw[begin:end], raw[end:]
        if h4 % 100 < spm_rate:
            return b"".join([marks[1], tail, marks[0], head, marks[2], middle]), n, "spm", first, last - first
        return b"".join([marks[0], head, marks[1], tail, marks[2], middle]), n, "psm", first, last - first

    def run(batches):
        import pyarrow as pa

        def out(batch, begin, rows):
            texts, *rest = zip(*rows)
            types = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("_id").slice(begin, len(rows)), pa.array(texts, pa.binary()).cast(pa.string()),
                 *[pa.array(column, kind) for column, kind in zip(rest, types)]],
                names=["_id", "output", "n", "form", "prefix_chars", "middle_chars"],
            )

        for batch in batches:
            rows, held, begin = [], 0, 0
            for text, seed in zip(batch.column("_text"), batch.column("_seed")):
                rows.append(one(text.as_buffer().to_pybytes(), seed.as_buffer().to_pybytes()))
                held += len(rows[-1][0])
                if held > GROUP_BYTES:
                    yield out(batch, begin, rows)
                    begin, rows, held = begin + len(rows), [], 0
            if rows:
                yield out(batch, begin, rows)

    return run


def infill(
    docs: DataFrame, id_col="doc_id", text_col="text", unit: str = "line", rate: int = 100, spm_rate: int = 50, seed: int = 7
) -> DataFrame:
    """One row per input row: ``id, n, form, prefix_chars, middle_chars, output``.

    The text is cut before two of its ``n`` units (``line``: with its line feed; ``char``: a code point), drawn from a hash
    of ``seed:id``; so a rerun, and every row of one id, draws the same, and a null id draws as an empty one. ``form`` is
    ``psm`` (prefix, suffix, middle), ``spm`` (suffix first, for ``spm_rate`` in 100) or ``plain``: the text as it is, where
    it is null (then empty), empty, holds a mark, or is not among the ``rate`` in 100 that are cut. Lengths count code
    points and are null if plain. Other columns are ignored; an empty table gives none.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit: {unit}")
    id_type = docs.schema[id_col].dataType
    drawn = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    lean = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text"), drawn.alias("_seed"))
    schema = StructType([
        StructField("_id", id_type), StructField("output", StringType()), StructField("n", LongType()),
        StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
    ])
    made = lean.mapInArrow(_cutter(unit, rate, spm_rate), schema)
    return made.select(F.col("_id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", "output")


def restored(output, form) -> Column:
    """The text from its transformed form. A text that is cut holds no mark, so the marks part it again."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(re.escape(m) for m in (PREFIX, SUFFIX, MIDDLE)), -1)
    psm = F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2)))
    spm = F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``infill`` by lines, with the digests of its output and of the text restored from it instead of the output."""
    made = infill(docs, id_col, text_col)
    return made.select(
        id_col, "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )
