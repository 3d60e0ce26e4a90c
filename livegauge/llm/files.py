"""Files that tasks write to and read from the folder all executors share."""

from __future__ import annotations

from pyarrow.fs import FileSystem
from pyspark import TaskContext


def opened(path: str, mode: str):
    """A file of any store that Arrow knows (local or mounted, hdfs, s3, gs), by URI or absolute path."""
    store, inner = FileSystem.from_uri(path)
    if mode == "read":
        return store.open_input_file(inner)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    return store.open_output_stream(inner, compression=None)


def own_name(folder: str, number: int, suffix: str) -> str:
    """A name that no other task, nor another attempt at this one, uses. Files of lost or repeated attempts stay unread, since only
    what a task returns when it ends well names its files."""
    context = TaskContext.get()
    return f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}-{number}{suffix}"
