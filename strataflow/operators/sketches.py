"""Column profiles that can be merged: a day's profile is stored once, and any span of days is answered from them.

Counts, totals and extremes are exact.  Distinct counts come from HyperLogLog sketches (relative standard error 0.8 % with
``LG_K`` = 14), quantiles from KLL sketches (rank error below 0.5 % with ``K`` = 800), both of Spark's own aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from strataflow.functions.sqltext import quoted, text
from strataflow.functions.columns import MONEY

LG_K = 14
K = 800
QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def sliced_profiles(df: DataFrame, by: Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per slice (such as a day) and numeric column, from one scan.

    slice, column_name, n (not null), n_null, total (of finite amounts), min, max, and the two sketches.
    """
    aggregates, rows = [], []
    for i, name in enumerate(columns or numeric_columns(df)):
        c = quoted(name)
        parts = {
            "n": f"count({c})",
            "n_null": f"count_if({c} IS NULL)",
            "total": f"sum(try_cast({c} AS {MONEY}))",
            "min": f"CAST(min({c}) AS DOUBLE)",
            "max": f"CAST(max({c}) AS DOUBLE)",
            "distinct_sketch": f"hll_sketch_agg(CAST({c} AS STRING), {LG_K})",
            "quantile_sketch": f"kll_sketch_agg_double(CAST({c} AS DOUBLE), {K})",
        }
        aggregates += [F.expr(e).alias(f"_c{i}_{p}") for p, e in parts.items()]
        cells = ", ".join(f"'{p}', _c{i}_{p}" for p in parts)
        rows.append(f"named_struct('column_name', {text(name)}, {cells})")
    wide = df.groupBy(by.alias("slice")).agg(*aggregates)
    return wide.selectExpr("slice", f"inline(array({', '.join(rows)}))")


def merged_profiles(profiles: DataFrame, shares: Sequence[float] = QUARTILES) -> DataFrame:
    """One row per column over all slices given: exact counts, total and extremes, and the estimates."""
    merged = profiles.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        F.sum("total").cast("decimal(38,6)").alias("total"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("n_distinct"),
        F.expr("kll_merge_agg_double(quantile_sketch)").alias("_sketch"),
    )
    at = ", ".join(f"{s}D" for s in shares)
    quantiles = F.expr(f"CASE WHEN n > 0 THEN kll_sketch_get_quantile_double(_sketch, array({at})) END")
    return merged.withColumn("quantiles", quantiles).drop("_sketch")
