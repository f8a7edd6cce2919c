"""Small files on any of Spark's file systems, written so that only one of several writers succeeds."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


class Exists(FileExistsError):
    pass


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a temporary one only in local mode with the setting unset, as in
    tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="rillflow-")
    return _own[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """A frame written to the shared folder and read back: its plan runs once, however often it is read."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a new folder below the shared one; the driver's JVM deletes it when it ends."""
    path = f"{shared_dir(spark)}/rillflow/{name}-{uuid.uuid4().hex}"
    fs, place = _fs(spark, path)
    fs.mkdirs(place)
    fs.deleteOnExit(place)
    return path


def _local(path: str) -> str | None:
    u = urlparse(path)
    return (u.path if u.scheme else path) if u.scheme in ("", "file") else None


def _fs(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def create(spark: SparkSession, path: str, text: str) -> None:
    """A new file; Exists is raised if there is one of that name, whoever wrote it."""
    if (local := _local(path)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{os.getpid()}.{os.urandom(4).hex()}"
        with open(part, "x", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(part, local)  # atomic, and readers never see half a file
        except FileExistsError:
            raise Exists(path) from None
        finally:
            os.unlink(part)
        return
    fs, place = _fs(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{os.urandom(8).hex()}.part")
    out = fs.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:  # a rename that fails where there is a file already, as on HDFS; readers never see half a file
        if fs.exists(place) or not fs.rename(part, place):
            raise Exists(path)
    finally:
        fs.delete(part, False)


def read(spark: SparkSession, path: str) -> str:
    if (local := _local(path)) is not None:
        with open(local, encoding="utf-8") as f:
            return f.read()
    fs, place = _fs(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """A folder or file, if it is there."""
    fs, place = _fs(spark, path)
    fs.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    if (local := _local(path)) is not None:
        return os.path.exists(local)
    fs, place = _fs(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """File names in a folder, sorted; none if there is no folder."""
    if (local := _local(path)) is not None:
        found = os.listdir(local) if os.path.isdir(local) else []
    else:
        fs, place = _fs(spark, path)
        found = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
    return sorted(x for x in found if x.endswith(suffix) and not x.startswith("."))
