"""Landing files out of the way once they are in bronze."""

from __future__ import annotations

from pyspark.sql import SparkSession


def archive_landed(spark: SparkSession, source: str, folder: str) -> str:
    """Move a landing file or folder into ``folder``, by renaming in its store; its new path.

    Both must be in one store.  What is there already is not replaced.
    """
    jvm = spark._jvm
    here, there = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(folder)
    store = here.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(here):
        raise FileNotFoundError(source)
    target = jvm.org.apache.hadoop.fs.Path(there, here.getName())
    store.mkdirs(there)
    if store.exists(target) or not store.rename(here, target):
        raise FileExistsError(target.toString())
    return target.toString()
