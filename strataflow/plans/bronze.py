"""Landing files to typed Parquet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.contracts import BRONZE_DATASETS
from strataflow.operators.calendar import add_ingestion_columns
from strataflow.sources.delimited import REJECT_COLUMN, scan_by_header, scan_delimited
from strataflow.sources.layers import WriteAudit, audited_write, layer_path, read_day, read_layer

INGESTION_PARTS = ["ingestion_year", "ingestion_month", "ingestion_day"]


def ingest_bronze(
    spark: SparkSession,
    landing: str,
    base: str,
    datasets: Sequence[tuple[str, str, str]] = BRONZE_DATASETS,
    run_day: dt.date | None = None,
    quarantine: bool = False,
    log: list[WriteAudit] | None = None,
    by_header: bool = False,
    **scan,
) -> list[WriteAudit]:
    """Ingest every landing file; each is one Spark job that parses, writes and counts.

    Each run replaces the whole dataset.  With ``run_day`` it adds the
    ingestion columns and replaces that day's partition only.  With
    ``quarantine`` rows that do not fit the schema are kept apart, with their
    raw lines, in the layer ``rejects``; the file is then parsed for either.
    With ``by_header`` a dataset may be a folder of files whose columns stand
    in different orders; the names of files with other columns go to the layer
    ``rejects`` as ``<dataset>_files``.  Each audit, of a failed write too, goes
    to ``log`` as it is made.
    """
    log = [] if log is None else log
    first = len(log)
    for dataset, file, schema in datasets:
        apart = None
        try:
            path = f"{landing.rstrip('/')}/{file}"
            if by_header:
                rows, apart = scan_by_header(spark, path, schema, keep_rejects=quarantine)
            else:
                rows = scan_delimited(spark, path, schema, keep_rejects=quarantine, **scan)
        except Exception:
            log.append(WriteAudit("bronze", dataset, 0, 0.0, "FAILURE"))
            raise
        parts: list[str] = []
        if run_day is not None:
            rows, parts = add_ingestion_columns(rows, run_day), INGESTION_PARTS
        outputs = [("bronze", dataset, rows)]
        if quarantine:
            rejected = F.col(REJECT_COLUMN).isNotNull()
            lines = rows.where(rejected).withColumnRenamed(REJECT_COLUMN, "raw_line")
            outputs = [("bronze", dataset, rows.where(~rejected).drop(REJECT_COLUMN)), ("rejects", dataset, lines)]
        if apart is not None:
            stamped = add_ingestion_columns(apart, run_day) if run_day is not None else apart
            outputs.append(("rejects", f"{dataset}_files", stamped))
        for layer, name, frame in outputs:
            audited_write(frame, layer_path(base, layer, name), layer, name, replace_partitions=parts, log=log)
    return log[first:]


def read_bronze(spark: SparkSession, base: str, dataset: str, run_day: dt.date | None = None) -> DataFrame:
    """A bronze dataset; with ``run_day`` the partition of that day, without its ingestion columns."""
    path = layer_path(base, "bronze", dataset)
    if run_day is None:
        return read_layer(spark, path)
    return read_day(spark, path, run_day, INGESTION_PARTS).drop(*INGESTION_PARTS, "ingestion_timestamp")
