"""Shared storage for intermediate tables and checkpoints."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/livegauge/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` as a table written to the shared folder: its rows and their order are then fixed, whatever
    executors are lost, and later reads take only the columns they need. The caller may name the path, to remove it later."""
    path = path or new_path(df.sparkSession, "frozen")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _store(spark: SparkSession, path: str):
    """The file system of a path, of any store Spark knows, and the path as that takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if there is none."""
    store, place = _store(spark, path)
    store.delete(place, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a glob pattern, sorted."""
    store, place = _store(spark, pattern)
    return sorted(status.getPath().toString() for status in store.globStatus(place) or [])


def put(spark: SparkSession, path: str, text: str = "") -> None:
    """Write a small file; it is there as a whole or not at all."""
    if not text:  # nothing that could be there by half
        store, place = _store(spark, path)
        store.create(place, True).close()
        return
    aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    store, place = _store(spark, aside)
    _write(store.create(place, True), text)
    rename(spark, aside, path)


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Write a small file if there is none yet; whether it was written. Of several callers one succeeds, on stores that create files
    exclusively (HDFS, local disks)."""
    store, place = _store(spark, path)
    try:
        stream = store.create(place, False)
    except Py4JJavaError as error:
        if store.exists(place):
            return False
        raise error
    _write(stream, text)
    return True


def _write(stream, text: str) -> None:
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a file another name."""
    store, place = _store(spark, path)
    if not store.rename(place, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} was not renamed to {to}")


def content(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    store, place = _store(spark, path)
    if not store.exists(place):
        return None
    stream = store.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def hours_old(spark: SparkSession, path: str) -> float:
    """Hours since a file or folder was last changed, by the clock of this machine."""
    store, place = _store(spark, path)
    return (time.time() - store.getFileStatus(place).getModificationTime() / 1000) / 3600


@contextmanager
def temporary(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh path that is removed at the end, for a table that nothing reads later."""
    path = new_path(spark, name)
    try:
        yield path
    finally:
        remove(spark, path)
