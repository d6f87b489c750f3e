"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings the operators count on.  Shuffle parallelism stays a deployment
# choice: on a cluster start high (a few thousand) and let adaptive execution
# merge small partitions.
SESSION_CONF = {
    # Recording the Python line of every column costs more than building the plan of a wide table.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app_name: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    A session without that setting takes a folder below its warehouse; on a cluster that must be a shared one too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    folder = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return os.path.join(scratch_root(spark), f"scratch-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return os.path.join(scratch_folder(spark), f"{name}-{uuid.uuid4().hex}")


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application put below the shared folder.

    The program that owns the session calls it at its end: frames that read
    intermediate copies are of no use afterwards.
    """
    remove_path(spark, scratch_folder(spark))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the shared folder, with all that is in it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
