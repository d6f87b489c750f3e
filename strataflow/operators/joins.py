"""Equi-joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from strataflow.functions.sqltext import unused


def _wider(df: DataFrame, key: str) -> Column:
    """The key in another type with the same equality, so that no earlier shuffle on the key itself can serve."""
    kind = df.schema[key].dataType
    if isinstance(kind, LongType):
        return F.col(key).cast("decimal(20,0)")
    return F.col(key).cast("bigint") if isinstance(kind, IntegralType) else F.concat(F.col(key).cast("string"), F.lit(""))


def balanced_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``facts`` joined to ``lookup`` on ``key`` for ``how`` in left, inner, left_anti, left_semi.

    Adaptive execution splits the partition of a key with very many rows, by as many tasks as its measured size asks
    for, and repeats the lookup's side for each.  It can do so only where both sides come straight from a shuffle made
    for the join.  A lookup that was deduplicated on the key would be joined where it stands; the join is therefore on
    the key in a wider type, which shuffles it once more.  For a semi or anti join the lookup is reduced to its
    distinct keys first.  Null keys match nothing; in a left or anti join their partition is split like any other.
    """
    if how in ("left_anti", "left_semi"):
        lookup = lookup.select(key).distinct()
    name = unused("_join_key", facts.columns, lookup.columns)
    left = facts.withColumn(name, _wider(facts, key))
    right = lookup.withColumn(name, _wider(lookup, key))
    if how in ("left_anti", "left_semi"):
        return left.join(right, name, how).drop(name)
    columns = [key, *[n for n in facts.columns if n != key], *[n for n in lookup.columns if n != key]]
    return left.join(right.drop(key), name, how).select(*columns)
