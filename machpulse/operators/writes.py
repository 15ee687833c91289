"""Idempotent write semantics as DataFrame computations: first-wins, insert-if-absent, upsert, keys."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY_BUCKETS = 256


def first_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns.

    An aggregate rather than a ranked window, so copies collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ranked = [c for c in (order or []) if c in rest] + [c for c in rest if c not in (order or [])]
    smallest = F.min(F.struct(*ranked)).alias("__first")
    return df.groupBy(*keys).agg(smallest).select(*[F.col(c) if c in keys else F.col(f"__first.{c}") for c in df.columns])


def absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing``."""
    return new.join(existing.select(*keys), keys, "left_anti")


def insert_if_absent(
    existing: DataFrame | None, new: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Rows of ``new`` to append: first per key, keys not yet in ``existing``."""
    candidates = first_per_key(new, keys, order)
    return candidates if existing is None else absent(existing, candidates, keys)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], mode: str = "update") -> DataFrame:
    """Whole table after the write.

    ``nothing`` keeps existing rows; ``update`` overwrites the columns that ``new`` carries, keeps the
    others. ``new`` must hold one row per key in ``update`` mode.
    """
    if mode == "nothing":
        return existing.unionByName(insert_if_absent(existing, new, keys), allowMissingColumns=True)
    if mode != "update":
        raise ValueError(f"unknown mode {mode!r}")
    incoming = new.withColumn("__new", F.lit(True)).alias("n")
    joined = existing.alias("e").join(incoming, keys, "full_outer")
    columns = []
    for name in existing.columns:
        if name in keys:
            columns.append(F.col(name))
        elif name in new.columns:
            value = F.when(F.col("__new"), F.col(f"n.{name}")).otherwise(F.col(f"e.{name}"))
            columns.append(value.alias(name))
        else:
            columns.append(F.col(f"e.{name}").alias(name))
    return joined.select(*columns)


def number_new_keys(df: DataFrame, keys: list[str], name: str, existing: DataFrame | None = None) -> DataFrame:
    """Fill NULL surrogates in ``name`` above the highest one of ``existing``; rows with one keep it.

    Numbers are unique, repeatable and may leave gaps, like a sequence. Keys are spread over hash
    buckets that interleave their numbers, so no task ever ranks the whole dimension.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS))
    start = F.lit(0)
    if existing is not None:
        start = F.coalesce(existing.agg(F.max(name)).scalar(), F.lit(0))
    number = start + (F.row_number().over(Window.partitionBy(bucket).orderBy(*keys)) - 1) * KEY_BUCKETS + bucket + 1
    if existing is None:
        return df.withColumn(name, number.cast("int"))
    # Only the new rows are ranked.
    fresh = df.filter(F.col(name).isNull()).withColumn(name, number.cast("int"))
    return df.filter(F.col(name).isNotNull()).unionByName(fresh)


def hash_key(keys: list[str]) -> Column:
    """64-bit surrogate of a fact row, computed from its natural key without any shuffle."""
    return F.xxhash64(*keys)
