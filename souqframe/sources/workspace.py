"""Where intermediate tables go."""

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession


def workspace(spark: SparkSession) -> str:
    """A folder of its own in the shared folder that `spark.checkpoint.dir` names.

    Without that setting only a local session gets one, in the machine's temporary folder: on a
    cluster the executors would not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/souqframe-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="souqframe-")


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run in here leave no shuffle files: Spark deletes them as each one ends, not some time later."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED)
        else:
            spark.conf.set(_FREED, before)


def _hadoop_path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever storage the path names."""
    files, folder = _hadoop_path(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a file or folder."""
    files, folder = _hadoop_path(spark, path)
    files.delete(folder, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, hidden ones left out; none if there is no such folder."""
    files, folder = _hadoop_path(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return [name for name in names if name[0] not in "._"]


def make_folder(spark: SparkSession, path: str) -> None:
    """Makes a folder, unless there is one."""
    files, folder = _hadoop_path(spark, path)
    files.mkdirs(folder)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    files, file = _hadoop_path(spark, path)
    stream = files.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, unless there is one already: that is an error."""
    files, file = _hadoop_path(spark, path)
    stream = files.create(file, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, new: str) -> None:
    """Gives a folder another name; the folder it is to stand in is made."""
    files, folder = _hadoop_path(spark, path)
    _, goal = _hadoop_path(spark, new)
    files.mkdirs(goal.getParent())
    files.rename(folder, goal)
