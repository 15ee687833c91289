"""Small helpers on the cluster's file system, whatever its scheme."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle.getFileSystem(spark._jsc.hadoopConfiguration()), handle


def exists(spark: SparkSession, path: str) -> bool:
    fs, handle = _path(spark, path)
    return fs.exists(handle)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder; empty when it does not exist."""
    fs, handle = _path(spark, folder)
    if not fs.exists(handle):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(handle))


def numbered(spark: SparkSession, folder: str, prefix: str, complete: bool = True) -> list[int]:
    """Numbers N of the ``<prefix>N`` folders; only fully written ones when ``complete``."""
    found = finished(spark, folder, prefix) if complete else names(spark, folder)
    return sorted(int(n[len(prefix):]) for n in found if n.startswith(prefix) and n[len(prefix):].isdigit())


def finished(spark: SparkSession, folder: str, prefix: str) -> dict[str, float]:
    """Names of the fully written ``<prefix>...`` folders, with the time in seconds at which each was finished."""
    fs, handle = _path(spark, f"{folder}/{prefix}*/_SUCCESS")
    found = fs.globStatus(handle) or []
    return {status.getPath().getParent().getName(): status.getModificationTime() / 1000 for status in found}


def write_marker(spark: SparkSession, path: str) -> None:
    fs, handle = _path(spark, path)
    fs.mkdirs(handle.getParent())
    fs.create(handle, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, handle = _path(spark, path)
    fs.mkdirs(handle.getParent())
    stream = fs.create(handle, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def prune_empty(spark: SparkSession, folder: str, root: str) -> None:
    """Remove a folder if nothing is in it, then its parents up to ``root``."""
    fs, handle = _path(spark, folder)
    last = _path(spark, root)[1]
    while fs.exists(handle) and not fs.listStatus(handle):
        fs.delete(handle, False)
        if handle.equals(last):
            return
        handle = handle.getParent()


def remove(spark: SparkSession, path: str) -> None:
    fs, handle = _path(spark, path)
    fs.delete(handle, True)


def work_folder(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared folder that ``spark.checkpoint.dir`` names.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="machpulse-")
    return f"{root}/{name}-{uuid4().hex}"


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``stored`` writes inside are removed at the end, but for those written with ``keep``.

    For steps that are over by then: nothing that is still to be read may rest on the removed ones.
    """
    mark = _passing.set([])
    try:
        yield
    finally:
        made = _passing.get() or []
        _passing.reset(mark)
        for folder in made:
            remove(spark, folder)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The frame written to a fresh work folder and read back: lineage ends there, sizes are known."""
    spark = df.sparkSession
    folder = work_folder(spark, name)
    made = _passing.get()
    if made is not None and not keep:
        made.append(folder)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
