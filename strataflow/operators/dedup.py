"""Union and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from strataflow.functions.columns import money
from strataflow.functions.sqltext import unused


def union_sources(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, columns matched by name; a missing column is an error."""
    first, *rest = sources
    for other in rest:
        first = first.unionByName(other)
    return first


def ranked_sources(rank_column: str, *sources: DataFrame) -> DataFrame:
    """Union that also says from which source, counted from 0, a row comes."""
    return union_sources(*[s.withColumn(rank_column, F.lit(i)) for i, s in enumerate(sources)])


def total_order(df: DataFrame, first: Sequence[str], skip: Sequence[str] = ()) -> list[Column]:
    """Sort order over every column, nulls last: ``first``, then the others as they stand."""
    rest = [c for c in df.columns if c not in set(first) | set(skip)]
    return [F.col(c).asc_nulls_last() for c in [*first, *rest]]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys count as equal.

    Spark puts a group limit below the shuffle, so that each map task sends on
    at most one row per key.  A key that holds a third of all rows therefore
    costs the receiving task one row per map task, not a third of the table.
    """
    name = unused("_rank", df.columns)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, rank).where(F.col(name) == 1).drop(name)


def row_digest(df: DataFrame) -> Column:
    """128 bits that stand for all columns of a row, in their order; numbers with a point count by their first six digits
    behind it."""
    cells = []
    for field in df.schema.fields:
        cell = F.col(field.name)
        cell = money(cell) if isinstance(field.dataType, (DoubleType, FloatType)) else cell
        cells.append(F.coalesce(cell.cast("string"), F.lit("~")))
    return F.unhex(F.md5(F.concat_ws("|", *cells)))


def dedup_by_priority(keys: Sequence[str], *sources: DataFrame, first: Sequence[str] = ()) -> DataFrame:
    """Union of the sources with one row per key, an earlier source winning.

    Rows with one key inside a source are told apart by the columns ``first``
    and then by all others, so the survivor does not depend on the order of
    files or tasks.
    """
    name = unused("_source", *[s.columns for s in sources])
    ranked = ranked_sources(name, *sources)
    order = total_order(ranked, [name, *first], skip=keys)
    return keep_first(ranked, keys, order).drop(name)
