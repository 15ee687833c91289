"""Parquet tables behind the stream: one folder per micro-batch, so a replayed batch replaces itself.

    <root>/<table>/batch_id=<n>/<time partition>/part-*.parquet
    <root>/<table>_tasses/tasse=<level>-<first>-<last>/<time partition>/part-*.parquet

The batch folder comes first: whatever partitions a replay touches, overwriting the folder removes
everything the first attempt left. Inside, rows are partitioned by event month (by ingest date in the
lake) and sorted by machine and time, which gives month pruning and narrow row-group statistics.

Finished batches are folded into segments, and ``RATIO`` neighbouring segments of one level into one of the next, so the
folders to read grow with the logarithm of the batches and each row is written again once per level. A folder
that a finished segment covers stays for a while, for readers that listed it before.
"""

import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructType

from machpulse import schemas
from machpulse.functions.fixed_values import MESSAGE_FIELDS
from machpulse.functions.time_columns import floor_second, month_of
from machpulse.operators.history import fleet_period
from machpulse.operators.quality import last_seen
from machpulse.operators.telemetry import compact_state, edge_windows, partial_windows, trend_of_state
from machpulse.sources import storage

#: Segments of one level that make one of the next.
RATIO = 8
#: How long a folder stays after a segment that covers it was finished.
KEEP_SECONDS = 3600.0


def raw_rows(valid: DataFrame, ingested_at: Column) -> DataFrame:
    """Rows of the raw table: whole-second times, ingest stamp, month key."""
    return valid.select(
        "machine_id",
        floor_second("datetime_mes").alias("datetime_mes"),
        *MESSAGE_FIELDS[2:],
        ingested_at.alias("horodatage_ingestion"),
        month_of("datetime_mes").alias("mois"),
    )


def quarantine_rows(quarantined: DataFrame, ingested_at: Column) -> DataFrame:
    return quarantined.select(
        "machine_id",
        floor_second("datetime_mes").alias("datetime_mes"),
        *MESSAGE_FIELDS[2:],
        "motif",
        ingested_at.alias("horodatage_quarantaine"),
        month_of("datetime_mes").alias("mois"),
    )


def lake_rows(valid: DataFrame, ingested_at: Column) -> DataFrame:
    return valid.select(*MESSAGE_FIELDS, F.to_date(ingested_at).alias("ingest_date"))


def seen_rows(valid: DataFrame) -> DataFrame:
    return last_seen(valid.select("machine_id", floor_second("datetime_mes").alias("datetime_mes")))


def _newest(seen: DataFrame) -> DataFrame:
    return seen.groupBy("machine_id").agg(F.max("last_seen").alias("last_seen"))


def state_rows(valid: DataFrame) -> DataFrame:
    return _with_month(partial_windows(valid))


def edge_rows(valid: DataFrame) -> DataFrame:
    return _with_month(edge_windows(partial_windows(valid)))


def _with_month(state: DataFrame) -> DataFrame:
    return state.withColumn("mois", month_of("fenetre"))


def newest_version(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Of all versions of a key the one with the highest ``version``."""
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("__row"))
    return newest.select(*keys, "__row.*").select(*rows.columns)


@dataclass(frozen=True)
class _Table:
    schema: StructType
    partition: str | None = None
    #: Time within the partition; rows are sorted by machine, where there is one, and this.
    time: str | None = None
    #: Of rows with these keys only the newest version counts.
    keys: tuple[str, ...] = ()
    #: Makes fewer rows of those of several batches.
    fold: Callable[[DataFrame], DataFrame] | None = None


_TABLES = {
    "telemetrie": _Table(schemas.TELEMETRY, "mois", "datetime_mes"),
    "quarantaine": _Table(schemas.QUARANTINE, "mois", "datetime_mes"),
    "rejets": _Table(schemas.DEAD_LETTER),
    "lac": _Table(schemas.LAKE, "ingest_date", "datetime_mes"),
    "etats": _Table(schemas.STATE, "mois", "fenetre", fold=lambda rows: _with_month(compact_state(rows))),
    "bords": _Table(schemas.STATE, "mois", "fenetre", fold=lambda rows: _with_month(edge_windows(compact_state(rows)))),
    "tendance": _Table(schemas.TREND, "mois", "fenetre", keys=("machine_id", "fenetre")),
    "maxima": _Table(schemas.MAXIMA, "mois", "fenetre", keys=("fenetre",)),
    "alertes": _Table(schemas.EPISODE, keys=("rule", "debut")),
    "lots": _Table(schemas.BATCH_COUNTS),
    "vus": _Table(schemas.LAST_SEEN, fold=_newest),
}
TABLES = tuple(_TABLES)


class Segment(NamedTuple):
    """Batches ``first`` to ``last`` in one folder."""

    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"tasse={self.level}-{self.first}-{self.last}"

    def covers(self, first: int, last: int) -> bool:
        return self.first <= first and last <= self.last


@dataclass(frozen=True)
class TelemetryStore:
    root: str

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def batch_folder(self, table: str, batch_id: int) -> str:
        return f"{self.folder(table)}/batch_id={batch_id}"

    def write_batch(self, table: str, batch_id: int, rows: DataFrame) -> None:
        """Replace the batch's folder. Rows of a versioned table get the batch as their version."""
        if _TABLES[table].keys:
            rows = rows.withColumn("version", F.lit(batch_id).cast("long"))
        self._write(table, rows, self.batch_folder(table, batch_id))

    def remove_batch(self, spark: SparkSession, table: str, batch_id: int) -> None:
        """Take back a batch without rows, and the folders above it if they hold nothing else."""
        storage.remove(spark, self.batch_folder(table, batch_id))
        storage.prune_empty(spark, self.folder(table), self.root)

    def _write(self, table: str, rows: DataFrame, folder: str, clustered: bool = False) -> None:
        """Rows are rebalanced on the partition column: few rows end in one file per partition, many
        are split by size. ``clustered`` splits them by ranges of machine and time instead, so a machine's rows lie in
        few files, each with a Bloom filter of its machines."""
        kind = _TABLES[table]
        by_machine = "machine_id" in rows.columns
        order = [c for c in (kind.partition, "machine_id" if by_machine else None, kind.time) if c]
        if kind.partition:
            if clustered and by_machine:
                rows = rows.repartitionByRange(*order)
            else:
                rows = rows.hint("rebalance", kind.partition)
            rows = rows.sortWithinPartitions(*order)
        writer = rows.write.mode("overwrite")
        if kind.partition:
            writer = writer.partitionBy(kind.partition)
        if clustered and by_machine:
            writer = writer.option("parquet.bloom.filter.enabled#machine_id", "true")
        writer.parquet(folder)

    def _schema(self, table: str) -> StructType:
        kind = _TABLES[table]
        full = StructType(list(kind.schema.fields))
        if kind.partition:
            full.add(kind.partition, IntegerType() if kind.partition == "mois" else DateType())
        return full

    def _folded(self, table: str) -> str:
        return f"{self.folder(table)}_tasses"

    def _finished_segments(self, spark: SparkSession, table: str) -> dict[Segment, float]:
        found = storage.finished(spark, self._folded(table), "tasse=")
        return {Segment(*map(int, name.removeprefix("tasse=").split("-"))): at for name, at in found.items()}

    def segments(self, spark: SparkSession, table: str) -> list[Segment]:
        """The segments to read, in order: the finished ones that no other covers."""
        live: list[Segment] = []
        for one in sorted(self._finished_segments(spark, table), key=lambda s: (s.first, -s.last)):
            if not live or one.last > live[-1].last:
                live.append(one)
        return live

    def _batches(self, spark: SparkSession, table: str, after: int = -1, upto: int | None = None) -> DataFrame:
        """Rows of the finished batch folders in a range, with their ``batch_id``."""
        schema, folder = self._schema(table).add("batch_id", LongType()), self.folder(table)
        wanted = [n for n in storage.numbered(spark, folder, "batch_id=") if n > after and (upto is None or n <= upto)]
        if not wanted:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", folder).parquet(*[f"{folder}/batch_id={n}" for n in wanted])

    def _read_segments(self, spark: SparkSession, table: str, segments: list[Segment]) -> DataFrame:
        folder, schema = self._folded(table), self._schema(table).add("tasse", StringType())
        paths = [f"{folder}/{s.name}" for s in segments]
        return spark.read.schema(schema).option("basePath", folder).parquet(*paths).drop("tasse")

    def read_batches(self, spark: SparkSession, table: str) -> DataFrame:
        """Rows still in batch folders, with their ``batch_id``."""
        return self._batches(spark, table)

    def read_batch(self, spark: SparkSession, table: str, batch_id: int) -> DataFrame:
        return spark.read.schema(self._schema(table)).parquet(self.batch_folder(table, batch_id))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """All rows, of versioned tables all versions: the segments, and the batches above them."""
        columns = self._schema(table).fieldNames()
        segments = self.segments(spark, table)
        newer = self._batches(spark, table, segments[-1].last if segments else -1).select(*columns)
        return self._read_segments(spark, table, segments).select(*columns).unionByName(newer) if segments else newer

    def has(self, spark: SparkSession, table: str) -> bool:
        return bool(storage.names(spark, self.folder(table)) or storage.names(spark, self._folded(table)))

    def read_newest(self, spark: SparkSession, table: str) -> DataFrame:
        """The newest version of every key, without the version."""
        return newest_version(self.read(spark, table), _TABLES[table].keys).drop("version")

    def read_state(self, spark: SparkSession) -> DataFrame:
        """All window partials."""
        return self.read(spark, "etats")

    def read_trend(self, spark: SparkSession) -> DataFrame:
        """The stored trend; worked out from the partials where the stream keeps none."""
        if not self.has(spark, "tendance"):
            return trend_of_state(self.read_state(spark))
        return self.read_newest(spark, "tendance").drop("mois")

    def last_seen(self, spark: SparkSession) -> DataFrame:
        """Time of the last valid message of each machine, from the small table that every batch adds to."""
        return _newest(self.read(spark, "vus"))

    def newest_batch(self, spark: SparkSession, table: str) -> int:
        """The last batch with a folder, whose query may still replay it; -1 without any."""
        return max(storage.numbered(spark, self.folder(table), "batch_id=", complete=False), default=-1)

    def period(self, spark: SparkSession, start: Column, end: Column) -> DataFrame:
        """Raw telemetry in [start, end), reading only its months."""
        return fleet_period(self.read(spark, "telemetrie"), start, end)

    def compact(self, spark: SparkSession, table: str, upto: int, levels: int | None = None) -> bool:
        """Fold the batches after the last segment, up to ``upto``, into a segment, then merge as ``merge`` does.

        Only the newest batch can be replayed, so ``upto`` must lie below it. Readers ignore a segment until it is
        complete and what it covers afterwards.
        """
        if upto >= self.newest_batch(spark, table):
            raise ValueError(f"batch {upto} of {table} may still be replayed")
        segments = self.segments(spark, table)
        after = segments[-1].last if segments else -1
        if upto <= after:
            return False
        self._fold(spark, table, self._batches(spark, table, after, upto).drop("batch_id"), Segment(0, after + 1, upto))
        self.merge(spark, table, levels)
        return True

    def merge(self, spark: SparkSession, table: str, levels: int | None = None) -> int:
        """Merge ``RATIO`` or more segments of one level into one of the next, as long as there are; returns how many it made.

        ``levels`` leaves higher levels to another call, for callers that must not wait for a large merge.
        """
        made, level = 0, 0
        while levels is None or level < levels:
            segments = self.segments(spark, table)
            if not any(s.level >= level for s in segments):
                break
            group = [s for s in segments if s.level == level]
            if len(group) >= RATIO:
                merged = Segment(level + 1, group[0].first, group[-1].last)
                self._fold(spark, table, self._read_segments(spark, table, group), merged)
                made += 1
            level += 1
        return made

    def _fold(self, spark: SparkSession, table: str, rows: DataFrame, into: Segment) -> None:
        kind = _TABLES[table]
        if kind.keys:
            rows = newest_version(rows, kind.keys)
        if kind.fold:
            rows = kind.fold(rows)
        self._write(table, rows, f"{self._folded(table)}/{into.name}", clustered=into.level > 0)

    def drop_folded(self, spark: SparkSession, table: str, keep_seconds: float = KEEP_SECONDS) -> int:
        """Remove the batch folders and segments that a segment finished ``keep_seconds`` ago or earlier covers.

        A reader that listed the table before then has had that long to finish. Returns the number of folders.
        """
        settled = [s for s, at in self._finished_segments(spark, table).items() if at <= time.time() - keep_seconds]
        folder, folded = self.folder(table), self._folded(table)
        batches = storage.numbered(spark, folder, "batch_id=", complete=False)
        gone = [f"{folder}/batch_id={n}" for n in batches if any(s.covers(n, n) for s in settled)]
        for one in self._finished_segments(spark, table):
            if any(s != one and s.covers(one.first, one.last) for s in settled):
                gone.append(f"{folded}/{one.name}")
        for path in gone:
            storage.remove(spark, path)
        return len(gone)
