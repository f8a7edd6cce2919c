"""Tables in the folder that driver and executors share.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and reading it again, so a lost executor costs
a re-read and nothing is kept on one machine alone. What a returned frame reads can't go before it is read; clear() takes away
what the session has written so far, and the driver's JVM the rest when it ends.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode with the setting unset, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="rillflow-")
    return _own[app]


_written: dict[str, list[str]] = {}


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/rillflow/{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Deletes the tables that this application has written here. Frames that read them, results among them, can't be read again."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        drop(spark, path)


def table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like :func:`table`, with the path, for :func:`drop` once no later job reads it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def at_exit(spark: SparkSession, path: str) -> None:
    """Has the driver's JVM delete a folder when it ends."""
    fs, place = _place(spark, path)
    fs.deleteOnExit(place)


def drop(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)
    fs.cancelDeleteOnExit(place)
    mine = _written.get(spark.sparkContext.applicationId, [])
    if path in mine:
        mine.remove(path)


class Held:
    """Frames that several steps read, kept on the executors' disks until release(). What a lost executor held is computed again from
    its lineage, which reaches back to tables only."""

    def __init__(self) -> None:
        self._frames: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        self._frames.append(df.persist(StorageLevel.DISK_ONLY))
        return df

    def release(self) -> None:
        for df in self._frames:
            df.unpersist()
        self._frames.clear()


def free(spark: SparkSession) -> None:
    """Lets the driver drop what finished steps have left: plans, broadcasts and generated classes, which only a collection finds."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ROWS_AT_ONCE = 1000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on rows of an Arrow batch, as rows here hold whole texts; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_AT_ONCE:
        spark.conf.set(name, str(ROWS_AT_ONCE))
