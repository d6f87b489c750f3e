"""Whole-dataset overwrites that no reader sees half done: versioned folders behind a catalog table.

Each overwrite goes to a folder of its own.  The table is then pointed at it, in one catalog change.  A query that began
before keeps the files it has listed; one that begins after reads the new ones; one that fails leaves the table as it is.
Old folders stay until :func:`expire_versions`.
"""

from __future__ import annotations

import datetime as dt
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from strataflow.functions.sqltext import quoted, text
from strataflow.sources.layers import WriteAudit, audited_write


def _named(database: str, table: str) -> str:
    return f"{quoted(database)}.{quoted(table)}"


def _bare(path: str) -> str:
    """The path without scheme and with plain characters, so that two spellings of one folder are equal."""
    return unquote(path).split(":", 1)[-1].rstrip("/").replace("//", "/")


def current_version(spark: SparkSession, database: str, table: str) -> str | None:
    """The folder that the table points at; None if there is no such table."""
    if not spark.catalog.tableExists(f"{database}.{table}"):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_named(database, table)}")
    return described.where("col_name = 'Location'").first().data_type


def publish_version(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    table: str,
    root: str,
    log: list[WriteAudit] | None = None,
    layer: str = "versions",
    files: int | None = None,
) -> WriteAudit:
    """Write ``df`` to a new folder below ``root`` and make it what the table holds.

    The first version creates the table.  Later ones must have its columns.
    """
    before = current_version(spark, database, table)
    if before is not None:
        wanted = [(f.name, f.dataType) for f in spark.table(_named(database, table)).schema.fields]
        if wanted != [(f.name, f.dataType) for f in df.schema.fields]:
            raise ValueError(f"{database}.{table} has other columns")
    made = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    path = f"{root.rstrip('/')}/version-{made}-{uuid.uuid4().hex[:8]}"
    audit = audited_write(df, path, layer, table, mode="errorifexists", files=files, log=log)
    if before is None:
        spark.sql(f"CREATE TABLE {_named(database, table)} USING PARQUET LOCATION {text(path)}")
    else:
        spark.sql(f"ALTER TABLE {_named(database, table)} SET LOCATION {text(path)}")
        spark.catalog.refreshTable(_named(database, table))
    return audit


def stored_versions(spark: SparkSession, root: str) -> list[str]:
    """The version folders below ``root``, oldest first, those of failed writes too."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(top):
        return []
    found = [s.getPath().toString() for s in store.listStatus(top) if s.isDirectory()]
    return sorted((p for p in found if p.rsplit("/", 1)[-1].startswith("version-")), key=lambda p: p.rsplit("/", 1)[-1])


def expire_versions(spark: SparkSession, database: str, table: str, root: str, keep: int = 1) -> list[str]:
    """Delete all folders but the one the table points at and the ``keep`` newest before it; what was deleted.

    ``keep`` bounds how many overwrites a running reader survives.  Folders newer than the table's are a failed write's,
    or of one still under way, and are left to the next call.
    """
    now = current_version(spark, database, table)
    every = stored_versions(spark, root)
    if now is None or _bare(now) not in [_bare(p) for p in every]:
        return []
    older = every[: [_bare(p) for p in every].index(_bare(now))]
    gone = older[: len(older) - keep] if keep else older
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
