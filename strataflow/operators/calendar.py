"""Partition columns of the three layers, and period roll-ups."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.columns import calendar_date

# Aggregation level of a gold table and the unit its periods are cut by.
LEVELS = {"daily": "day", "weekly": "week", "monthly": "month", "yearly": "year"}


def _source_day(df: DataFrame, date_column: str | None, as_of: dt.date) -> Column:
    present = date_column is not None and date_column in df.columns
    return calendar_date(F.col(date_column)) if present else F.lit(as_of)


def _parts(day: Column, prefix: str = "") -> dict[str, Column]:
    return {f"{prefix}year": F.year(day), f"{prefix}month": F.month(day), f"{prefix}day": F.dayofmonth(day)}


def add_ingestion_columns(df: DataFrame, as_of: dt.date, date_column: str | None = None) -> DataFrame:
    """Bronze: year, month and day of the date column, or of the run without one, and the clock time."""
    parts = _parts(_source_day(df, date_column, as_of), "ingestion_")
    return df.withColumns({**parts, "ingestion_timestamp": F.current_timestamp()})


def add_transform_columns(df: DataFrame, as_of: dt.date, date_column: str | None = None) -> DataFrame:
    """Silver: as bronze, with a quality score that starts at 0."""
    parts = _parts(_source_day(df, date_column, as_of), "transform_")
    return df.withColumns(
        {**parts, "transform_timestamp": F.current_timestamp(), "data_quality_score": F.lit(0.0)}
    )


def add_gold_columns(df: DataFrame, as_of: dt.date, level: str = "daily") -> DataFrame:
    """Gold: the row's own ``date``, else its ``transaction_date``, else the run day, and its parts."""
    if level not in LEVELS:
        raise ValueError(f"unknown aggregation level: {level}")
    if "date" not in df.columns:
        date = F.col("transaction_date") if "transaction_date" in df.columns else F.lit(as_of)
        df = df.withColumn("date", date)
    return df.withColumns({**_parts(calendar_date(F.col("date"))), "aggregation_level": F.lit(level)})


def period_rollup(
    df: DataFrame, date_column: str, amount: str, levels: Sequence[str] = tuple(LEVELS)
) -> DataFrame:
    """Rows and amount per period for every level asked for.

    The table is read and shuffled once, to days; the coarser levels add up
    the few daily rows.
    """
    days = (
        df.groupBy(calendar_date(F.col(date_column)).alias("_day"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum(amount).alias("_amount"))
    )
    periods = [
        F.struct(
            F.lit(level).alias("aggregation_level"),
            (F.col("_day") if level == "daily" else F.trunc("_day", LEVELS[level])).alias("period_start"),
        )
        for level in levels
    ]
    return (
        days.select(F.inline(F.array(*periods)), "_rows", "_amount")
        .groupBy("aggregation_level", "period_start")
        .agg(F.sum("_rows").alias("n_rows"), F.sum("_amount").alias("total_amount"))
    )


def row_quality_score(rules: Sequence[Column]) -> Column:
    """Share of the rules a row meets, 0 to 1; a rule with an unknown outcome is not met."""
    met = sum((F.when(rule, 1).otherwise(0) for rule in rules), F.lit(0))
    return met.cast("double") / F.lit(float(max(len(rules), 1)))
