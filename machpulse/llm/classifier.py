"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

A text is described by some statistics of its bytes, words and lines. Cosines of random projections of the standardised
statistics approximate a Gaussian kernel; a ridge regression on them is solved from normal equations that tasks sum
over their rows. The sums are kept apart for each fold of the labelled rows, so a row's score for the calibration comes
from a model that has not seen its fold (all sums less its own). The calibration is the monotone step function closest
to the labels over those scores, pooled on a fixed grid of scores and joined by straight lines.
"""

import numpy as np

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from machpulse.llm.linear import summed, symmetric, triangle, upper
from machpulse.llm.text import whole
from machpulse.sources.storage import stored

FEATURES = 128
RIDGE = 1e-4
SEED = 12
FOLDS = 5
THRESHOLD = 0.3
#: Scores are pooled on steps of 1/GRID between -1 and 2.
GRID = 1024
SYMBOLS = b"#*$%&<>@^~=+_\\{}[]/"
STATISTICS = (
    "log_words", "log_word_bytes", "upper", "digits", "stops", "shouts", "symbols", "pipes", "multibyte", "lines",
    "same_as_before", "distinct", "distinct_threes", "most_common",
)


def _classes() -> np.ndarray:
    """One bit per class of bytes."""
    table = np.zeros(256, np.uint8)
    groups = (
        range(ord("A"), ord("Z") + 1), [*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)], range(ord("0"), ord("9") + 1),
        b".,;:", b"!?", SYMBOLS, b"|", b"\n",
    )
    for bit, group in enumerate(groups):
        table[list(group)] |= 1 << bit
    return table


def text_statistics(texts) -> np.ndarray:
    """One row of statistics per text of an Arrow string array without nulls. Shares are square roots, which spread small ones."""
    from machpulse.llm.arrays import shingles, word_hashes

    table = _classes()
    out = np.zeros((len(texts), len(STATISTICS)))
    for row, (text, words) in enumerate(zip(texts, word_hashes(texts))):
        data = np.frombuffer(text.as_buffer(), np.uint8)
        seen = np.bincount(data, minlength=256) if len(data) else np.zeros(256, np.int64)
        upper_n, letters, digits, stops, shouts, symbols, pipes, feeds = (int(seen[(table >> bit) & 1 == 1].sum()) for bit in range(8))
        n = len(words)
        if not n:
            continue
        solid = len(data) - int(seen[[0x20, *range(0x09, 0x0E)]].sum())
        _, counts = np.unique(words, return_counts=True)
        shares = (
            upper_n / max(letters, 1), digits / solid, stops / n, shouts / n, symbols / n, pipes / n, int(seen[128:].sum()) / solid,
            feeds / n, int(np.sum(words[1:] == words[:-1])) / n, len(counts) / n, len(shingles(words, 3)) / max(n - 2, 1), int(counts.max()) / n,
        )
        out[row] = [np.log1p(n), np.log1p(solid / n), *np.sqrt(shares)]
    return out


def _describe(batches):
    import pyarrow as pa

    for batch in batches:
        rows = text_statistics(batch.column("_text"))
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)), pa.array(rows.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("_id"), flat], names=["_id", "x"])


def _matrix(batch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(STATISTICS))


class FourierMap:
    """Standardised statistics to cosines that approximate a Gaussian kernel, and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int, width: float):
        rng = np.random.Generator(np.random.PCG64(SEED))
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.weights = rng.standard_normal((len(mean), features)) / width
        self.phases = rng.uniform(0, 2 * np.pi, features)

    @property
    def size(self) -> int:
        return len(self.phases) + 1

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        # What lies far outside the labelled rows counts as lying at their edge.
        near = np.clip((rows - self.mean) / self.spread, -6, 6)
        waves = np.sqrt(2 / len(self.phases)) * np.cos(near @ self.weights + self.phases)
        return np.hstack([waves, np.ones((len(rows), 1))])


def pooled(values: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: mean value and level of each block, ``values`` ascending."""
    blocks: list[list[float]] = []
    for v, y, n in zip(values, labels, counts):
        blocks.append([v * n, y, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _solved(gram: np.ndarray, right: np.ndarray, n: float, ridge: float) -> np.ndarray:
    """Ridge weights; the constant, which comes last, is not held back."""
    held = np.full(len(right), ridge * max(n, 1.0))
    held[-1] = 1e-9
    return np.linalg.solve(gram + np.diag(held), right)


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, width: float | None = None) -> dict | None:
    """Map, weights and calibration from rows ``x, y, fold`` (statistics, label from 0 to 1, fold from 0); None without rows."""
    size = len(STATISTICS)
    first = labelled.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(size)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(size)],
    ).first()
    if not first["n"]:
        return None
    mean, spread = (np.array([first[f"{letter}{i}"] for i in range(size)]) for letter in "ms")
    waves = FourierMap(mean, spread, features, width or float(np.sqrt(size)))
    m = waves.size
    cells = triangle(m) + m + 1

    def partial(batches):
        total = None
        for batch in batches:
            made, y, fold = waves(_matrix(batch)), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            if total is None:
                total = np.zeros((FOLDS, cells))
            for k in np.unique(fold):
                part, right = made[fold == k], y[fold == k]
                total[k] += np.concatenate([upper(part.T @ part), part.T @ right, [len(right)]])
        return None if total is None else total.ravel()

    by_fold = summed(labelled, FOLDS * cells, partial).reshape(FOLDS, cells)

    def solve(flat):
        return _solved(symmetric(flat[: triangle(m)], m), flat[triangle(m): -1], flat[-1], ridge)

    everything = by_fold.sum(axis=0)
    apart = np.array([solve(everything - own if everything[-1] > own[-1] else everything) for own in by_fold])

    def cross_scored(batches):
        import pyarrow as pa

        for batch in batches:
            raw = np.sum(waves(_matrix(batch)) * apart[batch.column("fold").to_numpy()], axis=1)
            step = np.rint(np.clip(raw, -1, 2) * GRID).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("y")], names=["step", "y"])

    steps = (
        labelled.mapInArrow(cross_scored, "step int, y double").groupBy("step")
        .agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("step").collect()
    )
    at, level = pooled(*(np.array([row[c] for row in steps], float) for c in ("step", "y", "n")))
    return {"waves": waves, "weights": solve(everything), "at": at / GRID, "level": level}


def _scorer(model: dict | None):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                raw = model["waves"](_matrix(batch)) @ model["weights"]
                score = np.clip(np.interp(raw, model["at"], model["level"]), 0.0, 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(score)], names=["_id", "score"])

    return run


def _remainder(column, by: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % by


def classify(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", threshold: float = THRESHOLD,
    features: int = FEATURES, ridge: float = RIDGE,
) -> DataFrame:
    """One row per input row: ``id, held_out, score, predicted``.

    Rows whose ``crc32`` of the id as text is divisible by ``FOLDS`` are held out (a null id counts as the empty text, so
    it is); their labels are never read. Scores come from the text alone: null and empty texts have all statistics 0,
    equal texts equal scores. Null labels and labels without an id count as none, several labels of one id as their
    mean. Without any label every score is 0.5. Repeated rows are scored each and, if labelled, learned from each. Other
    columns are ignored; an empty table gives none.
    """
    id_type = docs.schema[id_col].dataType
    lean = docs.select(F.col(id_col).alias("_id"), whole(text_col).alias("_text"))
    described = stored(
        lean.mapInArrow(_describe, StructType([StructField("_id", id_type), StructField("x", ArrayType(DoubleType()))])), "classifier-statistics"
    )
    marks = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("y"))
        .filter(F.col("_id").isNotNull() & F.col("y").isNotNull() & (_remainder("_id") != 0))
        .groupBy("_id").agg(F.avg("y").alias("y"))
    )
    fold = _remainder("_id").cast("int").alias("fold")
    labelled = stored(described.join(marks, "_id").select("x", F.least(F.greatest("y", F.lit(0.0)), F.lit(1.0)).alias("y"), fold), "classifier-labelled")
    model = fit(labelled, features, ridge)
    scored = described.mapInArrow(_scorer(model), StructType([StructField("_id", id_type), StructField("score", DoubleType())]))
    return scored.select(
        F.col("_id").alias(id_col), (_remainder("_id") == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
