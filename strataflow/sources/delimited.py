"""Delimited files read against a fixed schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REJECT_COLUMN = "_corrupt_record"
PACKED_ROWS = 500_000


def scan_delimited(
    spark: SparkSession, path: str | Sequence[str], schema: str, check_header: bool = False, keep_rejects: bool = False
) -> DataFrame:
    """CSV with a header line, typed by ``schema`` (DDL) and not by inference; empty cells are null.

    A cell that does not fit its type is null, the row stays.  Columns are
    bound by position; ``check_header`` raises when the header disagrees.
    ``keep_rejects`` adds a column with the raw line of every row that did not
    fit; all cells are parsed then, also those a query does not ask for.
    """
    reader = (
        spark.read.option("header", "true")
        .option("inferSchema", "false")
        .option("nullValue", "")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", str(not check_header).lower())
    )
    if keep_rejects:
        schema = f"{schema}, {REJECT_COLUMN} STRING"
        reader = reader.option("columnNameOfCorruptRecord", REJECT_COLUMN).option("columnPruning", "false")
    return reader.schema(schema).csv(path if isinstance(path, str) else list(path))


def write_delimited(df: DataFrame, path: str, packed: bool = False) -> None:
    """CSV with a header line.  ``packed`` files are gzip, a third of the bytes at about the same time; as no task reads a
    part of one, none has more than ``PACKED_ROWS`` rows."""
    writer = df.write.mode("overwrite").option("header", "true")
    if packed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=PACKED_ROWS, **{"zlib.compress.level": "BEST_SPEED"})
    writer.csv(path)


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their raw line.

    ``parsed`` is the landed (written) result of a scan with ``keep_rejects``,
    so the text is parsed once for both halves.
    """
    rejected = F.col(REJECT_COLUMN).isNotNull()
    return parsed.where(~rejected).drop(REJECT_COLUMN), parsed.where(rejected)


def header_orders(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """file, and its columns in the order of its header line; a file without a header of just these columns has null.

    The header is looked for in the first block of each file.
    """
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    lines = spark.read.text(path, recursiveFileLookup=True)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    cells = F.transform(F.split(F.regexp_replace("value", "^\ufeff", ""), ","), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))
    first = lines.where("at = 0").select("file", cells.alias("columns"))
    is_header = F.array_sort("columns") == F.array_sort(F.array(*map(F.lit, names)))
    return first.groupBy("file").agg(F.first(F.when(is_header, F.col("columns")), ignorenulls=True).alias("columns"))


def scan_by_header(
    spark: SparkSession, path: str, schema: str, keep_rejects: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All rows of the files of a folder whose header names just the schema's columns, in any order; and the other files.

    Each column is bound by its name in the file's own header.  There is one scan per order that occurs; the driver holds
    the names of the files, as for any scan.  The second frame has a row (file) per file set apart.
    """
    orders = header_orders(spark, path, schema)
    fields = spark.createDataFrame([], schema).schema
    groups = orders.where("columns IS NOT NULL").groupBy("columns").agg(F.collect_list("file").alias("files")).collect()
    names = [*fields.names, *([REJECT_COLUMN] if keep_rejects else [])]
    scans = [scan_delimited(spark, path, schema, keep_rejects=keep_rejects).limit(0)] if not groups else []
    for group in groups:
        own = ", ".join(f"`{n}` {fields[n].dataType.simpleString()}" for n in group.columns)
        files = [unquote(f) for f in sorted(group.files)]
        scans.append(scan_delimited(spark, files, own, keep_rejects=keep_rejects).select(*names))
    return reduce(DataFrame.unionByName, scans), orders.where("columns IS NULL").select("file")
