"""Files laid out for filters on any of several columns: rows along an interleaved-bits key, bloom filters for look-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType

from strataflow.functions.sqltext import unused

BITS = 6


def as_number(df: DataFrame, name: str) -> Column:
    """A number, date or time as a double, in the same order."""
    kind = df.schema[name].dataType
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    return (F.col(name).cast("timestamp") if isinstance(kind, TimestampNTZType) else F.col(name)).cast("double")


def value_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[float]]:
    """For each column the values that cut its rows into ``2 ** bits`` parts of about one size: 63 numbers by default."""
    shares = F.array(*[F.lit(i / 2**bits) for i in range(1, 2**bits)])
    cuts = df.agg(*[F.percentile_approx(as_number(df, n), shares).alias(n) for n in columns]).first()
    return {n: sorted(set(cuts[n] or [])) for n in columns}


def interleaved_key(df: DataFrame, bounds: Mapping[str, Sequence[float]], bits: int = BITS) -> Column:
    """The numbers of a row's parts, one per column, with their bits taken in turn; nulls are in the first part.

    Rows near each other in this order have near values in every column.
    """
    if bits * len(bounds) > 62:
        raise ValueError("the key has more than 62 bits")
    taken = []
    for j, (name, cuts) in enumerate(bounds.items()):
        value = as_number(df, name)
        below = F.filter(F.array(*map(F.lit, cuts)), lambda b: b < value) if cuts else F.array()  # noqa: B023
        part = F.coalesce(F.size(below), F.lit(0)).cast("long")
        for i in range(bits):
            bit = F.shiftright(part, i).bitwiseAND(F.lit(1))
            taken.append(F.shiftleft(bit, i * len(bounds) + j))
    return reduce(lambda a, b: a.bitwiseOR(b), taken)


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    bloom: Mapping[str, int] | None = None,
    bits: int = BITS,
    mode: str = "overwrite",
    files: int | None = None,
) -> None:
    """Write ``df`` in the order of its interleaved key, so that row groups have narrow bounds in all ``columns``.

    ``bloom`` maps columns to the distinct values expected in a file; a look-up of one value then skips the row groups
    that do not have it, whatever the order.  ``files`` fixes the number of ranges; without it adaptive execution merges
    small ones.  The input is read twice: once for the bounds and the ranges, once to be written.
    """
    name = unused("_key", df.columns)
    keyed = df.withColumn(name, interleaved_key(df, value_bounds(df, columns, bits), bits))
    ranged = keyed.repartitionByRange(files, name) if files else keyed.repartitionByRange(name)
    writer = ranged.sortWithinPartitions(name, *columns).drop(name).write.mode(mode)
    for column, distinct in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    writer.parquet(path)
