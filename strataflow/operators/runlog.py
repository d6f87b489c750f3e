"""Queries over the run log and the lineage log.

Run log: run_id, event_ts, job_name, status, duration_seconds, records_in,
records_out.  Lineage log: source, target, n_rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import mean_of, safe_divide
from strataflow.functions.sqltext import text

SUCCESS, FAILURE = "SUCCESS", "FAILURE"


def _succeeded() -> Column:
    return F.count_if(F.col("status") == SUCCESS)


def _kpis() -> list[Column]:
    runs = F.count(F.lit(1))
    return [
        runs.alias("n_runs"),
        mean_of(_succeeded(), runs).alias("success_rate"),
        mean_of(F.sum("duration_seconds"), F.count("duration_seconds")).alias("avg_duration_seconds"),
        F.sum("records_out").alias("total_records"),
    ]


def run_totals(log: DataFrame, labels: Sequence[str] = ("job_name", "status")) -> DataFrame:
    """Runs, records and seconds per label combination."""
    return log.groupBy(*labels).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.sum("records_out").alias("total_records"),
        F.sum("duration_seconds").alias("total_seconds"),
    )


def duration_histogram(log: DataFrame, bounds: Sequence[int], label: str = "job_name") -> DataFrame:
    """Runs at or below each bound, cumulative, with the open last bucket, the sum and the count."""
    seconds = F.col("duration_seconds")
    buckets = log.groupBy(label).agg(
        *[F.count_if(seconds <= b).alias(f"_le{b}") for b in bounds],
        F.count(seconds).alias("n_runs"),
        F.sum(seconds).alias("sum_seconds"),
    )
    rows = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_le{b}").alias("n_at_or_below")) for b in bounds]
    rows.append(F.struct(F.lit("+Inf").alias("le"), F.col("n_runs").alias("n_at_or_below")))
    return buckets.select(label, F.inline(F.array(*rows)), "n_runs", "sum_seconds")


def job_kpis(log: DataFrame) -> DataFrame:
    return log.groupBy("job_name").agg(*_kpis())


def windowed_kpis(log: DataFrame, width: str) -> DataFrame:
    """The job KPIs per tumbling window of event time, such as ``"5 minutes"``.

    The same plan runs on a stream; see :mod:`strataflow.streaming.kpis`.
    """
    return (
        log.groupBy(F.window("event_ts", width).alias("_w"), "job_name")
        .agg(*_kpis())
        .select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "*")
        .drop("_w")
    )


def events_by_job(log: DataFrame) -> DataFrame:
    return log.groupBy("job_name").agg(F.count(F.lit(1)).alias("event_count"))


def transform_efficiency(log: DataFrame) -> DataFrame:
    """Records out per hundred records in, for each run that had records to read."""
    share = safe_divide(F.col("records_out"), F.col("records_in")) * 100
    return log.where(F.col("records_in") > 0).select("run_id", "job_name", share.alias("transformation_efficiency"))


MAX_DEPTH = 50


def lineage_reach(edges: DataFrame, from_layer: str, to_layer: str = "", max_depth: int = MAX_DEPTH) -> DataFrame:
    """What each dataset of ``from_layer`` feeds, directly or through others, and over how many moves at least.

    One recursive query over the distinct edges.  A path never enters a dataset twice, so circles end; a path longer
    than ``max_depth`` moves is an error and not cut.  With ``to_layer`` only datasets of that layer are listed.  Lineage
    graphs are small (one node per dataset); their edges come from the log aggregated.
    """
    distinct = edges.where("source IS NOT NULL AND target IS NOT NULL").select("source", "target").distinct()
    query = f"""
    WITH RECURSIVE step AS (SELECT source, target FROM {{edges}}),
    walk (origin, reached, depth, path) MAX RECURSION LEVEL {max_depth} AS (
        SELECT source, target, 1, array(source, target) FROM step WHERE startswith(source, {text(from_layer + '/')})
        UNION ALL
        SELECT w.origin, s.target, w.depth + 1, array_append(w.path, s.target)
        FROM walk w JOIN step s ON s.source = w.reached WHERE NOT array_contains(w.path, s.target)
    )
    SELECT origin AS source, reached AS target, min(depth) AS depth FROM walk
    WHERE startswith(reached, {text(to_layer)}) AND origin <> reached GROUP BY origin, reached"""
    return edges.sparkSession.sql(query, edges=distinct)


def lineage_edges(log: DataFrame) -> DataFrame:
    """Moves and rows per source and target."""
    return log.groupBy("source", "target").agg(
        F.count(F.lit(1)).alias("n_moves"), F.sum("n_rows").alias("total_rows")
    )
