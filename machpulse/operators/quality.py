"""Plausibility of readings, split into valid and quarantined, silent sensors, range profile."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from machpulse.functions.fixed_values import PLAUSIBLE_RANGES, SILENCE_THRESHOLD
from machpulse.functions.time_columns import interval


def _violates(name: str, low: float, high: float, nan_policy: str) -> Column:
    value = F.col(name)
    outside = (value < low) | (value > high)
    # Spark sorts NaN above every number, so NaN needs its own answer.
    return F.when(F.isnan(value), F.lit(nan_policy == "quarantine")).otherwise(outside)


def flag_out_of_range(df: DataFrame, ranges=PLAUSIBLE_RANGES, nan_policy: str = "pass") -> DataFrame:
    """Add ``motif``: the first implausible measure as ``<measure>_hors_plage``, else NULL.

    Bounds themselves are valid. NaN passes unless ``nan_policy`` is ``"quarantine"``.
    """
    if nan_policy not in ("pass", "quarantine"):
        raise ValueError(f"unknown nan_policy {nan_policy!r}")
    checks = [
        F.when(_violates(name, low, high, nan_policy), F.lit(f"{name}_hors_plage"))
        for name, (low, high) in ranges.items()
    ]
    return df.withColumn("motif", F.coalesce(*checks))


def split_valid(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without ``motif``, quarantined rows with it). Cache the input when both are used."""
    return flagged.filter(F.col("motif").isNull()).drop("motif"), flagged.filter(F.col("motif").isNotNull())


def profile_bounds(df: DataFrame, ranges=PLAUSIBLE_RANGES) -> DataFrame:
    """One row per measure: observed extremes, readings outside, distance to the configured bounds.

    NaN passes the range check by default, so it is neither an extreme nor outside; ``nan`` counts it.
    """
    wanted = []
    for name, (low, high) in ranges.items():
        number = F.when(~F.isnan(name), F.col(name))
        wanted += [
            F.min(number).alias(f"{name}_min"),
            F.max(number).alias(f"{name}_max"),
            F.count_if(number < low).alias(f"{name}_below"),
            F.count_if(number > high).alias(f"{name}_above"),
            F.count_if(F.isnan(name)).alias(f"{name}_nan"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("champ"),
            F.col(f"{name}_min").alias("min"),
            F.col(f"{name}_max").alias("max"),
            F.col(f"{name}_below").alias("below"),
            F.col(f"{name}_above").alias("above"),
            F.col(f"{name}_nan").alias("nan"),
            (F.col(f"{name}_min") - low).alias("margin_low"),
            (F.lit(high) - F.col(f"{name}_max")).alias("margin_high"),
        )
        for name, (low, high) in ranges.items()
    ]
    return df.agg(*wanted).select(F.inline(F.array(*rows)))


def last_seen(telemetry: DataFrame) -> DataFrame:
    """Time of the last message of each machine."""
    return telemetry.groupBy("machine_id").agg(F.max("datetime_mes").alias("last_seen"))


def known_machines(dim_machine: DataFrame) -> DataFrame:
    return dim_machine.select(F.col("machine_id_nat").alias("machine_id")).distinct()


def silent_sensors(
    known: DataFrame, telemetry: DataFrame, as_of: Column, threshold: str = SILENCE_THRESHOLD
) -> DataFrame:
    """Known machines that never sent a message, or none within ``threshold`` before ``as_of``.

    A machine last heard exactly ``threshold`` ago still counts as alive. Both join sides hold one
    row per machine, so no key can be hot.
    """
    # NULL (never heard) fails the comparison, which the first test catches.
    late = F.col("last_seen").isNull() | (as_of - F.col("last_seen") > interval(threshold))
    return known.join(last_seen(telemetry), "machine_id", "left").filter(late).select("machine_id", "last_seen")
