"""Windowed job KPIs of a run log that keeps growing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strataflow.operators.runlog import windowed_kpis


def stream_files(spark: SparkSession, folder: str, schema: StructType, name_pattern: str = "*.parquet") -> DataFrame:
    """Parquet files of a folder as a stream, each file once."""
    return spark.readStream.schema(schema).option("pathGlobFilter", name_pattern).parquet(folder)


def _timed(log: DataFrame) -> DataFrame:
    return log.withColumn("event_ts", F.col("event_ts").cast("timestamp"))


def start_kpis(log: DataFrame, width: str, out: str, checkpoint: str, lateness: str = "1 hour") -> StreamingQuery:
    """Append the KPIs of each window to ``out`` once the window can get no more rows.

    A window's totals live in the state store until the watermark (``lateness``
    behind the latest event) has passed it, and are then written exactly once
    and forgotten, so the state stays small however long the log grows.  The
    query ends when the present input is used up; started again with the same
    checkpoint it goes on from there.
    """
    return (
        windowed_kpis(_timed(log).withWatermark("event_ts", lateness), width)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_kpis(spark: SparkSession, log: DataFrame, width: str, out: str) -> DataFrame:
    """All windows to this moment: the closed ones as stored, the open ones from the log's recent rows.

    Of the log only rows after the last closed window are aggregated; the
    bound is a scalar subquery, so the scan can skip older row groups.
    """
    live = _timed(log)
    closed = spark.read.schema(windowed_kpis(live, width).schema).parquet(out)
    last_closed = closed.select(F.max("window_end")).scalar()
    recent = last_closed.isNull() | (F.col("event_ts") >= last_closed)
    return closed.unionByName(windowed_kpis(live.where(recent), width))
