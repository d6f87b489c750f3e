"""Parquet layers: reading, partitioned and audited writing."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

FAILURE = "FAILURE"
DAY_PARTS = ["year", "month", "day"]
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def layer_path(base: str, layer: str, dataset: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{dataset}"


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_day(spark: SparkSession, path: str, day: dt.date, parts: Sequence[str] = DAY_PARTS) -> DataFrame:
    """Rows of one day of a table partitioned by year, month and day; other folders are not opened."""
    year, month, dom = parts
    return spark.read.parquet(path).where(
        (F.col(year) == day.year) & (F.col(month) == day.month) & (F.col(dom) == day.day)
    )


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Even out file sizes before a write.

    Adaptive execution merges small and splits large partitions to the
    advisory size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), from
    the sizes it measures in the shuffle.  With columns, rows that go to one
    folder come together first, and a folder too large for one file is split.
    """
    return df.hint("rebalance", *columns)


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Write a whole dataset; ``files`` bounds the file count and is meant for small marts only."""
    (df if files is None else df.coalesce(files)).write.mode(mode).parquet(path)


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Write into one folder per value of the partition columns, replacing the whole dataset on overwrite."""
    _partitioned(df, path, columns, mode, "static")


def overwrite_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace only those partitions that ``df`` has rows for."""
    _partitioned(df, path, columns, "overwrite", "dynamic")


def _partitioned(df: DataFrame, path: str, columns: Sequence[str], mode: str, overwrite: str) -> None:
    writer = rebalanced(df, *columns).write.mode(mode).option("partitionOverwriteMode", overwrite)
    writer.partitionBy(*columns).parquet(path)


@dataclass(frozen=True)
class WriteAudit:
    """What one write did: the row it adds to the run log."""

    layer: str
    dataset: str
    rows: int
    seconds: float
    status: str = "SUCCESS"


def audited_write(
    df: DataFrame,
    path: str,
    layer: str,
    dataset: str,
    mode: str = "overwrite",
    files: int | None = None,
    replace_partitions: Sequence[str] = (),
    log: list[WriteAudit] | None = None,
) -> WriteAudit:
    """Write and count in the same job, so that nothing is computed or read twice.

    The count sits in the final stage, next to the writer: a shuffle stage that
    runs again after an executor was lost cannot count its rows a second time.
    With ``replace_partitions`` only the folders the rows belong to are replaced.
    The shuffle files of the write are dropped at its end.  The audit is added to ``log``, that of a write that failed too.
    """
    with audited(layer, dataset, log) as audit, shuffles_dropped(df.sparkSession):
        seen = Observation(f"{layer}/{dataset}")
        out = df if files is None else df.coalesce(files)
        writer = out.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode(mode)
        if replace_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*replace_partitions)
        writer.parquet(path)
        audit["rows"] = int(seen.get["n_rows"])
    return WriteAudit(layer, dataset, audit["rows"], audit["seconds"])


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside are deleted when it ends, and not when the driver happens to collect
    garbage; else the writes of a long run have theirs on the executors' disks side by side."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


@contextmanager
def audited(layer: str, dataset: str, log: list[WriteAudit] | None = None) -> Iterator[dict]:
    """Times what happens inside and adds its audit to ``log``: SUCCESS with the rows noted, or FAILURE."""
    note, started, status = {"rows": 0}, time.monotonic(), FAILURE
    try:
        yield note
        status = "SUCCESS"
    except Exception as failure:
        failure.failed_write = f"{layer}/{dataset}"  # for error_class
        raise
    finally:
        note["seconds"] = time.monotonic() - started
        if log is not None:
            log.append(WriteAudit(layer, dataset, note["rows"], note["seconds"], status))


@contextmanager
def audited_input(layer: str, dataset: str, log: list[WriteAudit]) -> Iterator[None]:
    """Adds a FAILURE of the dataset to ``log`` when what it is made of cannot be read."""
    try:
        yield
    except Exception:
        log.append(WriteAudit(layer, dataset, 0, 0.0, FAILURE))
        raise


MISSING_INPUT, WRITE_FAILURE, OTHER_FAILURE = "missing_input", "write_failure", "other_failure"


def error_class(failure: BaseException) -> str:
    """What went wrong: an input that is not there, the write of a dataset (or what it computes), or something else."""
    if isinstance(failure, FileNotFoundError):
        return MISSING_INPUT
    if isinstance(failure, PySparkException) and failure.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
        return MISSING_INPUT
    return WRITE_FAILURE if getattr(failure, "failed_write", None) else OTHER_FAILURE


def set_target_file_size(spark: SparkSession, megabytes: int = 128) -> None:
    """The partition size :func:`rebalanced` aims at, for the writes of this session.

    Small partitions are then merged up to that size, even if fewer tasks than
    cores are left.
    """
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{megabytes}m")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")


def audit_frame(spark: SparkSession, audits: Sequence[WriteAudit]) -> DataFrame:
    """The audits as a table: one row per dataset written."""
    rows = [(a.layer, a.dataset, a.rows, a.seconds, a.status) for a in audits]
    return spark.createDataFrame(rows, "layer STRING, dataset STRING, n_rows LONG, seconds DOUBLE, status STRING")


def stored_bytes(spark: SparkSession, path: str, layer: str, pattern: str = "*") -> DataFrame:
    """Bytes and files per dataset below a layer folder, from file listings alone: no file is opened.

    Files of every type count, but for hidden ones (``_SUCCESS``, checksums); ``pattern`` names others to count.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length")
    )
    folder = path.split(":", 1)[-1].strip("/")
    below = F.regexp_extract("path", rf"/\Q{folder}\E/([^/]+)", 1)
    dataset = F.regexp_replace(below, r"\.parquet$", "")
    return files.groupBy(F.lit(layer).alias("layer"), dataset.alias("dataset")).agg(
        F.sum("length").alias("size_bytes"), F.count(F.lit(1)).alias("n_files")
    )
