"""Silver to gold: client profiles and the contract mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.operators.aggregates import contract_mart
from strataflow.operators.dedup import keep_first, total_order
from strataflow.operators.projections import age_segment, derive_client_age
from strataflow.plans.silver import client_numbers, mart_contracts, unique_clients


def with_segment(profile: DataFrame, unknown_label: str | None = None) -> DataFrame:
    return profile.withColumn("age_segment", age_segment(F.col("age_client"), unknown_label))


def client_profile(silver: DataFrame, unknown_label: str | None = None) -> DataFrame:
    """One row per client of the silver table, with the age band.

    Should the table carry conflicting client columns, the lowest age wins,
    then the other columns in order.
    """
    profile = silver.select(*c.PROFILE_COLUMNS)
    order = total_order(profile, ["age_client"], skip=[c.CLIENT_KEY])
    return with_segment(keep_first(profile, [c.CLIENT_KEY], order), unknown_label)


def client_profile_from_bronze(
    contrat2: DataFrame, contrat1: DataFrame, clients: DataFrame, as_of: dt.date
) -> DataFrame:
    """The same rows without a silver table at hand.

    Removing duplicate contracts leaves the set of client numbers as it is.
    So the distinct numbers of the bronze files (one column read) go into the
    client join: no contract row is moved, and no key is heavy any more.
    """
    numbers = client_numbers(contrat2, contrat1).distinct()
    profile = derive_client_age(numbers.join(unique_clients(clients), c.CLIENT_KEY, "left"), as_of)
    return with_segment(profile.select(*c.PROFILE_COLUMNS))


def contract_analysis(silver: DataFrame) -> DataFrame:
    return contract_mart(silver)


def contract_analysis_from_bronze(contrat2: DataFrame, contrat1: DataFrame, as_of: dt.date) -> DataFrame:
    """The contract mart without a silver table at hand.

    It needs no client column, and the client join neither adds nor drops
    contracts (one row per client), so the join is left out.  What is moved for
    the deduplication are seven columns, not all 43.
    """
    return contract_mart(mart_contracts(contrat2, contrat1, as_of=as_of))
