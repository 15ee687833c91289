"""Principal components and whitening of vectors by shifted CholeskyQR.

The centred rows X of the fit list are orthogonalised in passes. A pass sums the Gram matrix of the present rows
over all tasks; its Cholesky factor is taken on the driver (dimension x dimension), and the next pass solves its rows
against all factors so far. The first pass adds a shift to the diagonal, so ill-conditioned rows do not break the
factorisation; the passes end when the Gram matrix is the identity. The composed factor R has X = Q R with
orthonormal Q, so the singular values and right singular vectors of R are those of X, without the squared condition
of the covariance matrix.

Entries are compared and summed as integers, so the fit list, its sums and deviations are exact.
"""

from decimal import Decimal

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from machpulse.llm.linear import solve_rows, summed, symmetric, triangle, upper
from machpulse.sources.storage import stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
MAX_PASSES = 8
#: Entries of a block of rows that is worked on at once.
BLOCK = 1 << 20
_LIMIT = float(1 << 62)
_WIDTHS = (1, 2, 4, 8)


def _packer(scale: int):
    """Batches of (_id, _v) to (_id, dim, packed): floor(scale * v) in the fewest bytes that hold every entry.

    Equal vectors have equal bytes. Null vectors and those with a null, non-finite or too large entry are left out.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lists = batch.column("_v")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(invalid="ignore", over="ignore"):
                floored = np.floor(values * scale)
                bad = ~(np.abs(floored) < _LIMIT)
            if flat.null_count:
                bad |= flat.is_null().to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(bad)])
            good = (before[offsets[1:]] == before[offsets[:-1]]) & ~lists.is_null().to_numpy(zero_copy_only=False)
            numbers = np.where(bad, 0, floored).astype(np.int64)
            rows = np.flatnonzero(good)
            packed = []
            for row in rows:
                one = numbers[offsets[row]: offsets[row + 1]]
                most = max(int(one.max()), -int(one.min()) - 1) if len(one) else 0
                width = next(w for w in _WIDTHS if most < 1 << (8 * w - 1))
                packed.append(bytes([width]) + one.astype(f"<i{width}").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(rows)), pa.array((offsets[1:] - offsets[:-1])[rows].astype(np.int32)),
                 pa.array(packed, pa.binary())],
                names=["_id", "dim", "packed"],
            )

    return run


def _blocks(batches, dim: int):
    """(batch, first row, int64 rows) of the packed vectors, in blocks of bounded size."""
    step = max(1, BLOCK // max(dim, 1))
    for batch in batches:
        packed = batch.column("packed")
        for begin in range(0, batch.num_rows, step):
            part = [v.as_buffer() for v in packed.slice(begin, step)]
            rows = np.empty((len(part), dim), np.int64)
            for i, one in enumerate(part):
                raw = np.frombuffer(one, np.uint8)
                rows[i] = np.frombuffer(one, f"<i{raw[0]}", offset=1)
            yield batch, begin, rows


def _exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of every dimension, as whole numbers of any size."""

    def run(batches):
        import pyarrow as pa

        total, count = [0] * dim, 0
        for _, _, rows in _blocks(batches, dim):
            low, high = (rows & 0xFFFFFFFF).sum(axis=0), (rows >> 32).sum(axis=0)
            total = [t + int(a) + (int(b) << 32) for t, a, b in zip(total, low, high)]
            count += len(rows)
        if count:
            values = [Decimal(t) for t in [*total, count]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], names=["cell", "value"]
            )

    found = fit.mapInArrow(run, "cell int, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    sums = {row["cell"]: int(row["value"]) for row in found}
    return sums.get(dim, 0), [sums.get(i, 0) for i in range(dim)]


def _numerators(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S`` exactly; whole numbers of any size where 64 bits would not hold them."""
    most = max(abs(int(rows.max(initial=0))), abs(int(rows.min(initial=0))))
    if most * n + max(map(abs, sums), default=0) < 1 << 62:
        return rows * n - np.array(sums, np.int64)
    return rows.astype(object) * n - np.array(sums, object)


def _centred(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(rows, n, sums) / n).astype(np.float64)


def _gram(fit: DataFrame, dim: int, n: int, sums: list[int], factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows after a triangular solve against every factor."""

    def partial(batches):
        total = None
        for _, _, rows in _blocks(batches, dim):
            held = _centred(rows, n, sums)
            for factor in factors:
                held = solve_rows(held, factor)
            total = held.T @ held if total is None else total + held.T @ held
        return None if total is None else upper(total)

    return symmetric(summed(fit, triangle(dim), partial), dim)


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper triangular factor of a Gram matrix, shifted in the first pass and where it is singular."""
    dim = len(gram)
    values = np.linalg.eigvalsh(gram)
    shift = 0.0
    if first:
        shift = 11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps / 2 * values[-1]
    elif values[0] < 1e-10 * values[-1]:
        shift = 1e-10 * values[-1]
    return np.linalg.cholesky(gram + shift * np.eye(dim)).T


def shifted_cholesky_qr(gram_of, dim: int, n: int) -> tuple[np.ndarray, float]:
    """The composed R with ``X = Q R``, and the trace of ``X' X``; ``gram_of(factors)`` is one pass over the rows.

    Directions in which the rows do not vary have no part in Q; R is projected to leave them out.
    """
    factors, composed, trace = [], np.eye(dim), 0.0
    for turn in range(MAX_PASSES):
        gram = gram_of(factors)
        if not turn:
            trace = float(np.trace(gram))
            if not trace > 0:
                return np.zeros((dim, dim)), 0.0
        values, vectors = np.linalg.eigh(gram)
        null = values < 1e-4
        if turn and np.all(null | (np.abs(values - 1) < (1e-6 if null.any() else 1e-12))):
            break
        factor = _factor(gram, n, not turn)
        factors.append(factor)
        composed = factor @ composed
    last = np.sqrt(np.where(null, 0, values))[:, None] * vectors.T if null.any() else np.linalg.cholesky(gram).T
    return last @ composed, trace


def fit_whitening(fit: DataFrame, dim: int, components: int) -> dict:
    """Parameters of the components: ``n, sums, vectors (dim x k), values, explained, identity_error``."""
    n, sums = _exact_sums(fit, dim)
    composed, trace = shifted_cholesky_qr(lambda factors: _gram(fit, dim, n, sums, factors), dim, n) if n else (None, 0.0)
    if not trace:
        return {"n": n, "sums": sums, "vectors": np.zeros((dim, 0)), "values": np.zeros(0), "explained": np.zeros(0), "identity_error": None}
    _, singular, right = np.linalg.svd(composed)
    kept = min(components, int(np.sum(singular > 1e-10 * singular[0])))
    vectors = right[:kept].T
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)] < 0, -1.0, 1.0)
    values = singular[:kept] ** 2 / n
    found = {"n": n, "sums": sums, "vectors": vectors, "values": values, "explained": values / (trace / n)}

    def partial(batches):
        total = None
        for _, _, rows in _blocks(batches, dim):
            white = _centred(rows, n, sums) @ vectors / np.sqrt(values)
            part = np.concatenate([white.sum(axis=0), upper(white.T @ white)])
            total = part if total is None else total + part
        return total

    flat = summed(fit, kept + triangle(kept), partial)
    mean = flat[:kept] / n
    covariance = symmetric(flat[kept:], kept) / n - np.outer(mean, mean)
    return found | {"identity_error": float(np.abs(covariance - np.eye(kept)).max())}


def _projector(model: dict, dim: int):
    n, sums, vectors, values = model["n"], model["sums"], model["vectors"], model["values"]
    count = len(values)

    def run(batches):
        import pyarrow as pa

        for batch, begin, rows in _blocks(batches, dim):
            exact = _numerators(rows, n, sums)
            most = max(abs(int(exact.max(initial=0))), abs(int(exact.min(initial=0))))
            squares = (exact if dim * most * most < 1 << 63 else exact.astype(object)) ** 2
            deviation = [int(d) if d < 1 << 63 else None for d in squares.sum(axis=1)]
            white = (exact / n).astype(np.float64) @ vectors / np.sqrt(values)
            ids = batch.column("_id").slice(begin, len(rows)).take(pa.array(np.repeat(np.arange(len(rows)), count)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                 pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), count))),
                 pa.array(white.ravel()), pa.array(np.tile(model["explained"], len(rows)))],
                names=["_id", "component", "deviation", "whitened", "explained"],
            )

    return run


def whiten(
    vectors: DataFrame, id_col="vec_id", vector_col="embedding", components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """Per row and component: ``id, component, n, deviation, whitened, explained, identity_error``.

    Rows without a vector, or with a null or non-finite entry, go; so do those with an entry too large for a long, and
    vectors of another length than the one that the most distinct vectors have (the smallest of several). Entries become
    ``floor(scale * v)``; each distinct vector counts once in the fit. There are as many components as asked for, or as
    the rank allows: none where all vectors are equal, so no rows. ``deviation`` is null where it exceeds a long. Repeated
    rows and ids are worked out each; null ids stay. Other columns are ignored; an empty table gives none.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType
    lean = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
    packed = lean.mapInArrow(
        _packer(scale), StructType([StructField("_id", id_type)]).add("dim", IntegerType()).add("packed", BinaryType())
    )
    distinct = stored(packed.select("dim", "packed").distinct(), "whitening-fit")
    lengths = distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    schema = StructType([
        StructField("_id", id_type), StructField("component", IntegerType()), StructField("deviation", LongType()),
        StructField("whitened", DoubleType()), StructField("explained", DoubleType()),
    ])
    dim = lengths["dim"] if lengths else 0
    model = fit_whitening(distinct.filter(F.col("dim") == dim).select("packed"), dim, components)
    if len(model["values"]):
        rows = packed.filter(F.col("dim") == dim).select("_id", "packed").mapInArrow(_projector(model, dim), schema)
    else:
        rows = spark.createDataFrame([], schema)
    return rows.select(
        F.col("_id").alias(id_col), "component", F.lit(model["n"]).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(model["identity_error"]).cast("double").alias("identity_error"),
    )
