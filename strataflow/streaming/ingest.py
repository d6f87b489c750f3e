"""Landing files taken into by-day bronze as they arrive."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataflow.operators.calendar import add_ingestion_columns
from strataflow.plans.bronze import INGESTION_PARTS
from strataflow.sources.layers import overwrite_partitions, read_layer

BATCH = "ingestion_batch"


def first_day_of_batch(spark: SparkSession, path: str, batch_id: int) -> dt.date | None:
    """The day under which a batch has been written before; only folder names are read."""
    try:
        stored = read_layer(spark, path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    row = stored.where(F.col(BATCH) == batch_id).select(*INGESTION_PARTS).limit(1).collect()
    return dt.date(*row[0]) if row else None


def write_batch(batch: DataFrame, batch_id: int, path: str, day: dt.date) -> None:
    """Write a batch into a partition of its own, below its day.

    A batch that comes again, because the query was stopped between the write and the commit, replaces what it wrote:
    the partition is named by the batch's number, and it stays on the day of the first attempt.
    """
    day = first_day_of_batch(batch.sparkSession, path, batch_id) or day
    rows = add_ingestion_columns(batch, day).withColumn(BATCH, F.lit(batch_id).cast("long"))
    overwrite_partitions(rows, path, [*INGESTION_PARTS, BATCH])


def start_ingest(
    spark: SparkSession, landing: str, schema: str, path: str, checkpoint: str, day: dt.date, files_per_batch: int = 1000
) -> StreamingQuery:
    """Take in the delimited files of ``landing`` (a folder or pattern) that no earlier call with this checkpoint has taken.

    Ends when the present files are used up.  Batch numbers go on with the checkpoint; a new checkpoint starts at 0
    again and needs a new ``path``.
    """
    arriving = (
        spark.readStream.schema(schema)
        .option("header", "true")
        .option("nullValue", "")
        .option("mode", "PERMISSIVE")
        .option("maxFilesPerTrigger", str(files_per_batch))
        .csv(landing)
    )
    return (
        arriving.writeStream.foreachBatch(lambda batch, number: write_batch(batch, number, path, day))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
