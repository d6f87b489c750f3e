"""Row-wise operators of the silver and gold layers.

Each takes a DataFrame and returns it with the columns of one step added or
replaced, in one projection, so they chain with ``DataFrame.transform``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.functions.columns import banded, decode, flag, row_sum, try_cast, years_since


def cast_columns(df: DataFrame, types: Mapping[str, str] = c.CONTRACT_CASTS) -> DataFrame:
    """Force the given types; what cannot be read as its type becomes null."""
    return df.withColumns({name: try_cast(F.col(name), t) for name, t in types.items()})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] = c.CONTRACT_DEFAULTS) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})


def vehicle_type() -> Column:
    return decode(F.col("cateco"), c.VEHICLE_TYPES, c.VEHICLE_TYPE_OTHER)


def contract_state() -> Column:
    return decode(F.col("etatco"), c.CONTRACT_STATES, c.CONTRACT_STATE_OTHER)


def contract_active() -> Column:
    return flag(F.col("etatco") == c.CONTRACT_STATE_ACTIVE)


def vehicle_use() -> Column:
    return decode(F.col("usagco1"), c.VEHICLE_USES, c.VEHICLE_USE_OTHER)


def guarantee_count(available: Sequence[str]) -> Column:
    """Number of guarantees a contract carries, over those flag columns that exist."""
    return row_sum([F.col(name) for name in c.GUARANTEE_FLAGS if name in available])


def decode_contracts(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "type_vehicule": vehicle_type(),
            "etat_contrat_libelle": contract_state(),
            "contrat_actif": contract_active(),
            "usage_vehicule": vehicle_use(),
            "nb_garanties": guarantee_count(df.columns),
        }
    )


def client_age(as_of: dt.date) -> Column:
    return years_since(F.col("aadhso"), as_of)


def contract_seniority(as_of: dt.date) -> Column:
    return years_since(F.col("asaico"), as_of)


def young_client(age: Column) -> Column:
    """1 below the age limit, 0 above it and where the age is unknown."""
    return flag(age < c.YOUNG_CLIENT_BELOW)


def age_segment(age: Column, unknown_label: str | None = None) -> Column:
    """Age band; an unknown age falls into the last band unless it is given a label."""
    return banded(age, c.AGE_SEGMENTS, c.AGE_SEGMENT_LAST, unknown_label)


def derive_client_age(df: DataFrame, as_of: dt.date) -> DataFrame:
    age = client_age(as_of)
    return df.withColumns({"age_client": age, "client_jeune": young_client(age)})


def derive_seniority(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.withColumn("anciennete_contrat", contract_seniority(as_of))


def rows_matching(df: DataFrame, condition: str | Column) -> DataFrame:
    """Filter by a SQL predicate or a column; simple ones reach the Parquet scan."""
    return df.where(condition)


def sample_rows(df: DataFrame, order_by: Sequence[str], k: int = 5) -> DataFrame:
    """The first ``k`` rows in a stated order, so that every run shows the same ones."""
    return df.orderBy(*[F.col(name).asc_nulls_last() for name in order_by]).limit(k)
