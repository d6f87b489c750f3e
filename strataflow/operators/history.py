"""Change history of keyed snapshots: what a day inserted, changed or closed, and when each row was valid.

The history is a log of changes with a partition per day.  A day's snapshot is compared with what was valid before it by
key and row digest; only rows that differ are written, so a day without changes costs no storage and earlier days are
never rewritten.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.functions.sqltext import unused
from strataflow.operators.dedup import row_digest
from strataflow.sources.layers import overwrite_partitions, read_layer

INSERTED, CHANGED, CLOSED = "inserted", "changed", "closed"
DAY, KIND, DIGEST = "changed_on", "change", "row_digest"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equality of all keys; null keys are equal."""
    condition = F.lit(True)
    for key in keys:
        condition &= left[key].eqNullSafe(right[key])
    return condition


def valid_rows(history: DataFrame, keys: Sequence[str], before: dt.date | None = None) -> DataFrame:
    """Key and digest of what is valid at the end, or before the day ``before`` began: no other column is read."""
    narrow = history.select(*keys, DAY, KIND, DIGEST)
    if before is not None:
        narrow = narrow.where(F.col(DAY) < F.lit(before))
    name = unused("_last", keys)
    last = narrow.groupBy(*keys).agg(F.max_by(F.struct(KIND, DIGEST), DAY).alias(name))
    return last.where(F.col(f"{name}.{KIND}") != CLOSED).select(*keys, F.col(f"{name}.{DIGEST}").alias(DIGEST))


def day_changes(snapshot: DataFrame, valid: DataFrame, keys: Sequence[str], day: dt.date) -> DataFrame:
    """The changes that lead from ``valid`` (keys and digest) to ``snapshot`` (one row per key).

    A closed row has its key only.  The names of the log's own columns must not occur in the snapshot.
    """
    if taken := {DAY, KIND, DIGEST} & {n.lower() for n in snapshot.columns}:
        raise ValueError(f"columns of the history's own: {sorted(taken)}")
    old, known = unused("_was", snapshot.columns), unused("_known", snapshot.columns)
    now = snapshot.withColumn(DIGEST, row_digest(snapshot))
    was = valid.withColumnRenamed(DIGEST, old).withColumn(known, F.lit(True))
    differs = F.col(known).isNull() | (F.col(DIGEST) != F.col(old))
    kind = F.when(F.col(known).isNull(), INSERTED).otherwise(CHANGED)
    kept = now.join(was, _same(now, was, keys), "left").where(differs)
    written = kept.select(*[now[n] for n in snapshot.columns], DIGEST, kind.alias(KIND))
    gone = valid.join(snapshot.select(*keys), _same(valid, snapshot, keys), "left_anti")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in snapshot.schema.fields if f.name not in keys}
    closed = gone.select(*keys).withColumns({**missing, DIGEST: F.lit(None).cast("binary"), KIND: F.lit(CLOSED)})
    return written.unionByName(closed).withColumn(DAY, F.lit(day))


def record_day(spark: SparkSession, snapshot: DataFrame, path: str, keys: Sequence[str], day: dt.date) -> None:
    """Add the day's changes to the history at ``path``.

    A rerun of the last day replaces its changes.  Days must come in order; an earlier day than the last one is an
    error, because the changes after it would no longer be right.
    """
    try:
        history = read_layer(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = snapshot.limit(0).select(*keys).withColumn(DIGEST, F.lit(None).cast("binary"))
        overwrite_partitions(day_changes(snapshot, empty, keys, day), path, [DAY])
        return
    last = history.agg(F.max(DAY).alias("last")).first().last
    if last is not None and last > day:
        raise ValueError(f"the history has changes of {last} already")
    changes = day_changes(snapshot, valid_rows(history, keys, before=day), keys, day)
    if last == day:
        # Without a change left, nothing would replace what an earlier run of the day has written.
        marked = changes.isEmpty()
        if marked:
            drop_day(spark, path, day)
            return
    overwrite_partitions(changes, path, [DAY])


def drop_day(spark: SparkSession, path: str, day: dt.date) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{DAY}={day}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def validity_intervals(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each state of each key with the day from which and the day before which it held; null for one that still holds."""
    following = Window.partitionBy(*keys).orderBy(DAY)
    until = history.withColumn("valid_to", F.lead(DAY).over(following)).where(F.col(KIND) != CLOSED)
    return until.withColumnRenamed(DAY, "valid_from").drop(DIGEST)


def snapshot_of(history: DataFrame, keys: Sequence[str], day: dt.date) -> DataFrame:
    """The rows that held at the end of a day, as they were given."""
    states = validity_intervals(history.where(F.col(DAY) <= F.lit(day)), keys)
    return states.where("valid_to IS NULL").drop("valid_from", "valid_to", KIND)
