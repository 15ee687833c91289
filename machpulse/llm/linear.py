"""Sums over all rows of matrices that tasks add up first. Only one flat array per task is shuffled."""

import numpy as np

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summed(frame: DataFrame, cells: int, partial) -> np.ndarray:
    """Sum of the flat arrays of ``cells`` doubles that ``partial(batches)`` makes of each task's Arrow batches.

    The driver gets one number per cell, whatever the number of rows or tasks. ``partial`` may return None for no rows.
    """

    def run(batches):
        import pyarrow as pa

        flat = partial(batches)
        if flat is not None:
            for begin in range(0, cells, 1 << 14):
                part = flat[begin: begin + (1 << 14)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(begin, begin + len(part), dtype=np.int32)), pa.array(part)], names=["cell", "value"]
                )

    found = frame.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    total = np.zeros(cells)
    for row in found:
        total[row["cell"]] = row["value"]
    return total


def upper(matrix: np.ndarray) -> np.ndarray:
    return matrix[np.triu_indices(len(matrix))]


def symmetric(flat: np.ndarray, size: int) -> np.ndarray:
    """The symmetric matrix whose upper triangle is ``flat``."""
    made = np.zeros((size, size))
    made[np.triu_indices(size)] = flat
    return made + np.triu(made, 1).T


def triangle(size: int) -> int:
    return size * (size + 1) // 2


def solve_rows(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows @ inv(factor)`` for an upper triangular factor, by forward substitution over the columns."""
    out = np.array(rows, order="F")
    for j in range(len(factor)):
        if j:
            out[:, j] -= out[:, :j] @ factor[:j, j]
        out[:, j] /= factor[j, j]
    return out
