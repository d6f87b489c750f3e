"""Column expressions shared by the operators; all run inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,6)"


def decode(column: Column, labels: Mapping, other: str) -> Column:
    """``labels[column]``, or ``other`` for an unlisted or missing code."""
    branches = list(labels.items())
    first_code, first_label = branches[0]
    chain = F.when(column == first_code, first_label)
    for code, label in branches[1:]:
        chain = chain.when(column == code, label)
    return chain.otherwise(other)


def banded(column: Column, bands: Sequence[tuple[int, str]], last: str, missing: str | None = None) -> Column:
    """Label of the first band whose upper bound lies above the value.

    A missing value gets the last label, unless ``missing`` names another one.
    """
    chain = F.when(column.isNull(), missing if missing is not None else last)
    for upper, label in bands:
        chain = chain.when(column < upper, label)
    return chain.otherwise(last)


def try_cast(column: Column, type_name: str) -> Column:
    """Cast that gives null for a value that does not fit, under ANSI mode too."""
    return column.try_cast(type_name)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def years_since(year_column: Column, as_of: dt.date) -> Column:
    return F.lit(as_of.year) - year_column


def row_sum(columns: Sequence[Column]) -> Column:
    """Sum across columns of one row, a missing or malformed cell counting as 0."""
    cells = [F.coalesce(try_cast(c, "int"), F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, cells) if cells else F.lit(0)


def any_null(columns: Sequence[Column]) -> Column:
    """True where at least one of the columns is null; false for an empty list."""
    return reduce(lambda a, b: a | b, [c.isNull() for c in columns], F.lit(False))


def safe_divide(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Quotient as double; ``default`` where the denominator is 0 or a side is missing."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(quotient, F.lit(float(default)))


def as_percentage(ratio: Column, decimals: int = 2) -> Column:
    return F.round(ratio * 100, decimals)


def money(column: Column) -> Column:
    """Amount as an exact decimal, so that sums do not depend on the order of the rows.

    Null for what is no finite number or does not fit, under ANSI mode too.
    """
    return try_cast(column, MONEY)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from an exact total; null when there is nothing to average."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def calendar_date(column: Column) -> Column:
    """Day of a date, timestamp or ISO string column; a malformed string gives null."""
    return try_cast(column, "date")
