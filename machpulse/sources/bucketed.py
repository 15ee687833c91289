"""Tables stored in buckets of their key: what is offered to them is dealt by the key, what they hold stays where it is."""

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from machpulse.operators.writes import insert_if_absent

BUCKETS = 64


@dataclass(frozen=True)
class BucketedTable:
    """Parquet files under ``path``, a bucket of ``keys`` each.

    The bucket layout is known to the session's catalogue under a name made from the path, so any session that opens the
    path with the same keys and number of buckets reads it alike. An append is one job: it is there whole or not at all.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    buckets: int = BUCKETS

    @property
    def name(self) -> str:
        layout = f"{self.path}|{','.join(self.keys)}|{self.buckets}"
        return f"bucketed_{hashlib.sha1(layout.encode()).hexdigest()[:20]}"

    def read(self, spark: SparkSession) -> DataFrame:
        if not spark.catalog.tableExists(self.name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
                f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
        return spark.table(self.name)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """By the key into as many partitions as buckets: an append then writes one file per bucket that gets rows."""
        return rows.select(*self.schema.names).repartition(self.buckets, *self.keys)

    def append(self, rows: DataFrame) -> None:
        self.read(rows.sparkSession)
        self._dealt(rows).write.insertInto(self.name)

    def absent(self, rows: DataFrame, order: list[str] | None = None) -> DataFrame:
        """First row per key of ``rows``, of keys that the table does not hold. Only ``rows`` are shuffled, and once."""
        return insert_if_absent(self.read(rows.sparkSession), self._dealt(rows), list(self.keys), order)

    def insert_if_absent(self, rows: DataFrame, order: list[str] | None = None) -> None:
        """Append what is absent; the same rows offered again add nothing."""
        self.append(self.absent(rows, order))

    def folded(self, spark: SparkSession, path: str) -> "BucketedTable":
        """The same rows under another path, with one file per bucket instead of one per bucket and append."""
        whole = BucketedTable(path, self.schema, self.keys, self.buckets)
        whole.append(self.read(spark))
        return whole
