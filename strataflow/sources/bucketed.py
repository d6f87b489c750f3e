"""Two tables stored in buckets of one key, so that a daily join moves neither of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.functions.sqltext import quoted


def write_bucketed(df: DataFrame, database: str, table: str, key: str, buckets: int, path: str) -> None:
    """Store ``df`` as a table with ``buckets`` files' worth of buckets by ``key``, sorted by it inside each.

    The rows are shuffled once, here, into as many tasks as there are buckets, so that a bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{quoted(database)}.{quoted(table)}")


def heaviest_share(df: DataFrame, key: str) -> float:
    """Rows of the most frequent value of ``key``, as a share of all; counted before the shuffle."""
    counts = df.groupBy(key).count().agg({"count": "max"}).first()[0]
    return (counts or 0) / max(1, df.count())


def bucketed_join(spark: SparkSession, facts: str, lookup: str, key: str, how: str = "left") -> DataFrame:
    """Join two tables that are bucketed alike by ``key``: no exchange below the join, one task per bucket.

    A bucket is never split, so a key with a large share of the rows (:func:`heaviest_share`) makes one task long;
    such a table is joined by ``operators.joins.balanced_join`` instead.  The lookup must have one row per key.
    """
    left, right = spark.table(facts), spark.table(lookup)
    columns = [key, *[n for n in left.columns if n != key], *[n for n in right.columns if n != key]]
    return left.join(right.hint("merge"), key, how).select(*columns)
