"""Dated landing zone of delivered CSV files, and typed reads from it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from machpulse import schemas
from machpulse.functions.fixed_values import STAGING_FILES
from machpulse.sources import storage


class MissingInput(FileNotFoundError):
    """An expected file was not delivered."""


def landed_path(root: str, run_date: str, filename: str) -> str:
    return f"{root}/{run_date}/{filename}"


def land(frames: dict[str, DataFrame], root: str, run_date: str) -> list[str]:
    """Write every expected file under the date; a rerun overwrites the same paths."""
    missing = [name for name in STAGING_FILES if name not in frames]
    if missing:
        raise MissingInput(", ".join(missing))
    paths = []
    for name in STAGING_FILES:
        path = landed_path(root, run_date, name)
        frames[name].write.mode("overwrite").option("header", True).csv(path)
        paths.append(path)
    return paths


def require_landed(spark: SparkSession, root: str, run_date: str) -> None:
    missing = [n for n in STAGING_FILES if not storage.exists(spark, landed_path(root, run_date, n))]
    if missing:
        raise MissingInput(f"{run_date}: {', '.join(missing)}")


def staging_target(filename: str) -> tuple[str, tuple[tuple[str, str], ...]]:
    if filename not in STAGING_FILES:
        raise ValueError(f"no staging table for {filename}")
    return STAGING_FILES[filename]


def read_raw_csv(spark: SparkSession, path: str, mapping) -> DataFrame:
    """Text columns renamed and ordered by ``mapping``; other columns drop, a missing one is an error."""
    raw = spark.read.option("header", True).csv(path)
    absent = [source for source, _ in mapping if source not in raw.columns]
    if absent and raw.columns:
        raise ValueError(f"{path}: missing columns {', '.join(absent)}")
    if not raw.columns:
        return spark.createDataFrame([], ", ".join(f"{target} STRING" for _, target in mapping))
    return raw.select(*[F.col(source).alias(target) for source, target in mapping])


def typed(df: DataFrame, table: str) -> DataFrame:
    """Cast text columns to the staging types; text that does not fit stops the load."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.STAGING[table].fields])


def read_landed(spark: SparkSession, root: str, run_date: str, filename: str) -> DataFrame:
    table, mapping = staging_target(filename)
    return typed(read_raw_csv(spark, landed_path(root, run_date, filename), mapping), table)
