"""Mart aggregates, column statistics and business ratios."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DecimalType,
    LongType,
    MapType,
    NumericType,
    StringType,
    StructType,
    VariantType,
)

from strataflow.functions.columns import mean_of, money, safe_divide
from strataflow.functions.sqltext import quoted, text


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def contract_mart(df: DataFrame) -> DataFrame:
    """Contracts, clients, premiums, seniority and guarantees per vehicle type, largest first.

    Money is added up as decimals and every mean is one division of exact
    totals, so a rerun on other partitions gives the same digits.  A premium
    that is no finite number of the money type is neither summed nor counted;
    ``quality.amount_conformance`` reports how many there are.
    """
    amount = money(F.col("prmaco"))
    premium, n_rows = F.sum(amount), F.count(amount)
    return (
        df.groupBy("type_vehicule")
        .agg(
            F.count("nucon").alias("total_contracts"),
            F.count_distinct("nusoc").alias("unique_clients"),
            F.round(mean_of(premium, n_rows), 2).alias("avg_premium"),
            F.round(premium.cast("double"), 0).alias("total_premium"),
            F.round(mean_of(F.sum("anciennete_contrat"), F.count("anciennete_contrat")), 1).alias("avg_seniority"),
            F.round(mean_of(F.sum("nb_garanties"), F.count("nb_garanties")), 1).alias("avg_guarantees"),
        )
        .orderBy(F.desc("total_contracts"), "type_vehicule")
    )


def active_ratio(active_col: str = "contrat_actif") -> Column:
    """Share of rows whose flag is 1, in percent; 0 for no rows at all."""
    active = F.count_if(F.col(active_col) == 1)
    return safe_divide(active, F.count(F.lit(1))) * 100


def retention_rate(df: DataFrame, active_col: str = "contrat_actif") -> DataFrame:
    return df.agg(active_ratio(active_col).alias("retention_rate"))


def market_share(df: DataFrame, by: Sequence[str] = (), active_col: str = "contrat_actif") -> DataFrame:
    """The active ratio, overall or per group."""
    return df.groupBy(*by).agg(active_ratio(active_col).alias("market_share"))


# Statistic, the aggregate that holds its number, and the one that holds its text.
STATISTICS = [
    ("count", "n", None),
    ("mean", "mean", None),
    ("stddev", "stddev", None),
    ("min", "min_num", "min_text"),
    ("max", "max_num", "max_text"),
]


# A cell that the cast reads as a number begins so, after blanks and a sign: with a digit, a point, or as infinity or
# not-a-number.  Testing it first keeps other text from costing an exception per cell, and loses no number.
NUMBER_START = r"^[\\x00-\\x20]*[+-]?[0-9.iInN]"


def number_in_text(df: DataFrame, name: str) -> dict[str, str]:
    """The column that holds a text column's numbers, as SQL; nothing for other columns.

    It goes into a projection below the aggregation, so that a cell is tested
    and parsed once for the mean and the deviation together.
    """
    if not isinstance(df.schema[name].dataType, StringType):
        return {}
    column = quoted(name)
    return {f"_number_{name}": f"IF({column} RLIKE '{NUMBER_START}', try_cast({column} AS DOUBLE), NULL)"}


def statistic_aggregates(df: DataFrame, name: str, digits: int) -> dict[str, str]:
    """SQL aggregates of one column; text is also read as numbers, from :func:`number_in_text`.

    A column whose type has no order has a count only.
    """
    field, column = df.schema[name].dataType, quoted(name)
    is_number, is_text = isinstance(field, NumericType), isinstance(field, StringType)
    no_number, no_text = "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"
    number = quoted(f"_number_{name}") if is_text else column
    has_number = is_number or is_text
    in_words = not fits_a_double(field) if is_number else ordered(field)
    return {
        "n": f"count({column})",
        "mean": f"round(avg({number}), {digits})" if has_number else no_number,
        "stddev": f"round(stddev_samp({number}), {digits})" if has_number else no_number,
        "min_num": f"CAST(min({column}) AS DOUBLE)" if is_number else no_number,
        "max_num": f"CAST(max({column}) AS DOUBLE)" if is_number else no_number,
        "min_text": f"CAST(min({column}) AS STRING)" if in_words else no_text,
        "max_text": f"CAST(max({column}) AS STRING)" if in_words else no_text,
    }


def fits_a_double(kind: DataType) -> bool:
    """Whether a double holds every number of the type exactly; wider ones also have their extremes as text."""
    return not isinstance(kind, (LongType, DecimalType))


def ordered(kind: DataType) -> bool:
    """Whether the type has an order, and so a least and a greatest value; maps and variants have none."""
    if isinstance(kind, StructType):
        return all(ordered(f.dataType) for f in kind.fields)
    return ordered(kind.elementType) if isinstance(kind, ArrayType) else not isinstance(kind, (MapType, VariantType))


def with_columns_sql(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr("*", *[f"{e} AS {quoted(name)}" for name, e in columns.items()]) if columns else df


def apart_by_type(df: DataFrame) -> list[DataFrame]:
    """The table's text columns and its other columns, as frames to aggregate separately.

    The extremes of text cannot live in a hash aggregation's buffer, and would
    take the numeric aggregates of the same step down the slower path with
    them.  Of a stored table each column is still read just once.
    """
    text_columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    groups = [[n for n in df.columns if n not in text_columns], text_columns]
    return [df.select(*[quoted(n) for n in group]) for group in groups if group]


def _statistics_rows(df: DataFrame, digits: int) -> DataFrame:
    numbers, aggregates, rows = {}, [], []
    for i, name in enumerate(df.columns):
        numbers.update(number_in_text(df, name))
        measures = statistic_aggregates(df, name, digits)
        aggregates += [f"{e} AS _s{i}_{m}" for m, e in measures.items()]
        cells = ", ".join(f"'{m}', _s{i}_{m}" for m in measures)
        rows.append(f"named_struct('column_name', {text(name)}, {cells})")
    wide = with_columns_sql(df, numbers).selectExpr(*aggregates)
    return wide.selectExpr(f"inline(array({', '.join(rows)}))")


def column_statistics(df: DataFrame, digits: int = 4) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum: one row per column, each column read once.

    Means are rounded to ``digits``, because sums of doubles differ in the
    last places from run to run.  Meant for stored tables: a long plan would
    run for the text columns and for the others.
    """
    return reduce(DataFrame.union, [_statistics_rows(part, digits) for part in apart_by_type(df)])
