"""Databases, external partitioned Parquet tables and their partitions in Spark's catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from strataflow.functions.sqltext import quoted, text


def _path(*names: str) -> str:
    return ".".join(quoted(n) for n in names)


def _literal(value: object) -> str:
    return str(value) if isinstance(value, int) else text(str(value))


def create_database(spark: SparkSession, name: str, comment: str = "", location: str | None = None) -> None:
    """Create the database unless it exists."""
    where = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_path(name)} COMMENT {_literal(comment)}{where}")


def create_external_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    columns: Mapping[str, str],
    partition_columns: Mapping[str, str] | None = None,
) -> None:
    """Declare a Parquet table over files at ``location``; by default partitioned by integer year, month, day."""
    parts = dict(partition_columns or {"year": "INT", "month": "INT", "day": "INT"})
    fields = ", ".join(f"{_path(n)} {t}" for n, t in {**columns, **parts}.items())
    keys = ", ".join(_path(n) for n in parts)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_path(database, table)} ({fields}) "
        f"USING PARQUET PARTITIONED BY ({keys}) LOCATION {_literal(location)}"
    )


def add_partitions(spark: SparkSession, database: str, table: str, partitions: Sequence[Mapping[str, object]]) -> None:
    """Make partitions known to the catalog, many in one statement; known ones stay as they are."""
    specs = ["PARTITION (" + ", ".join(f"{_path(k)} = {_literal(v)}" for k, v in p.items()) + ")" for p in partitions]
    if specs:
        spark.sql(f"ALTER TABLE {_path(database, table)} ADD IF NOT EXISTS " + " ".join(specs))


def recover_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Register every partition folder found at the table's location."""
    spark.sql(f"ALTER TABLE {_path(database, table)} RECOVER PARTITIONS")


def analyze_columns(spark: SparkSession, database: str, table: str, columns: Sequence[str] = ()) -> None:
    """Count the table's rows and take the statistics of the columns (all of them by default) in one scan."""
    which = f"COLUMNS {', '.join(map(quoted, columns))}" if columns else "ALL COLUMNS"
    spark.sql(f"ANALYZE TABLE {_path(database, table)} COMPUTE STATISTICS FOR {which}")


def column_stats(spark: SparkSession, database: str, table: str, columns: Sequence[str]) -> DataFrame:
    """What the catalog knows of the columns, as text: least and greatest value, nulls, distinct values (estimated).

    Nulls where a column has not been analyzed.  Nothing but the catalog is read.
    """
    found = []
    for column in columns:
        described = spark.sql(f"DESCRIBE EXTENDED {_path(database, table)} {quoted(column)}").collect()
        known = {r.info_name: None if r.info_value == "NULL" else r.info_value for r in described}
        found.append((column, *[known.get(k) for k in ("min", "max", "num_nulls", "distinct_count")]))
    schema = "column_name STRING, min STRING, max STRING, num_nulls STRING, distinct_count STRING"
    return spark.createDataFrame(found, schema)


def use_statistics(spark: SparkSession, on: bool = True) -> None:
    """Let the planner of this session estimate sizes, and order joins, from the catalog's column statistics."""
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
        spark.conf.set(key, str(on).lower())
