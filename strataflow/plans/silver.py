"""Bronze to silver: one clean, decoded row per contract, with its client."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strataflow import contracts as c
from strataflow.functions.columns import try_cast
from strataflow.functions.sqltext import unused
from strataflow.operators.dedup import dedup_by_priority, keep_first, row_digest, total_order, union_sources
from strataflow.operators.joins import balanced_join
from strataflow.operators.projections import (
    cast_columns,
    decode_contracts,
    derive_client_age,
    derive_seniority,
    fill_defaults,
    guarantee_count,
    vehicle_type,
)


def conform(contracts: DataFrame) -> DataFrame:
    """Typed columns, then defaults; a premium that is no finite number counts as missing."""
    typed = cast_columns(contracts)
    amounts = [f.name for f in typed.schema.fields if f.name in c.CONTRACT_DEFAULTS and f.dataType == DoubleType()]
    finite = {n: F.when(F.abs(F.col(n)) < F.lit(float("inf")), F.col(n)) for n in amounts}
    return fill_defaults(typed.withColumns(finite) if finite else typed)


def unique_contracts(*sources: DataFrame) -> DataFrame:
    """Conformed union with one row per contract key; the source named first wins, then the row with the least digest."""
    digested, name = with_digest(*sources)
    return dedup_by_priority(c.CONTRACT_KEY, *digested, first=[name]).drop(name)


def with_digest(*sources: DataFrame) -> tuple[list[DataFrame], str]:
    """The conformed sources with a column that stands for the whole row, and its name.

    It tells rows with one key apart where most of their columns are not
    wanted, so those need not be moved.
    """
    name = unused("_digest", *[s.columns for s in sources])
    conformed = [conform(s) for s in sources]
    return [s.withColumn(name, row_digest(s)) for s in conformed], name


def mart_contracts(*sources: DataFrame, as_of: dt.date) -> DataFrame:
    """The same contracts with the columns of the contract mart only: the rest is read, but not moved."""
    digested, name = with_digest(*sources)
    wanted = [*c.CONTRACT_KEY, "cateco", "prmaco", "asaico"]
    narrow = [s.select(*wanted, guarantee_count(s.columns).alias("nb_garanties"), name) for s in digested]
    unique = dedup_by_priority(c.CONTRACT_KEY, *narrow, first=[name])
    decoded = unique.withColumn("type_vehicule", vehicle_type()).transform(derive_seniority, as_of)
    return decoded.drop(name, "cateco", "asaico")


def clean_contracts(*sources: DataFrame, as_of: dt.date) -> DataFrame:
    """The contract half of silver: everything that needs no client."""
    return unique_contracts(*sources).transform(decode_contracts).transform(derive_seniority, as_of)


def client_columns(clients: DataFrame) -> DataFrame:
    key = try_cast(F.col(c.CLIENT_KEY), "int").alias(c.CLIENT_KEY)
    return clients.select(key, *c.CLIENT_ATTRIBUTES)


def unique_clients(clients: DataFrame) -> DataFrame:
    """The client columns silver takes, one row per client number."""
    slim = client_columns(clients)
    return keep_first(slim, [c.CLIENT_KEY], total_order(slim, [], skip=[c.CLIENT_KEY]))


def client_numbers(*sources: DataFrame) -> DataFrame:
    """Client number of every source row, typed as in silver: one column of the bronze files."""
    return union_sources(*[s.select(try_cast(F.col(c.CLIENT_KEY), "int").alias(c.CLIENT_KEY)) for s in sources])


def attach_clients(
    contracts: DataFrame,
    clients: DataFrame,
    as_of: dt.date,
    one_row_per_client: bool = True,
) -> DataFrame:
    """Left join to the client columns, and the client's age.

    A contract without client keeps nulls.  With ``one_row_per_client=False``
    a client listed twice doubles its contracts.
    """
    lookup = unique_clients(clients) if one_row_per_client else client_columns(clients)
    joined = balanced_join(contracts, lookup, c.CLIENT_KEY)
    return derive_client_age(joined, as_of)


# Columns of the result in order: 43 of the contract, 5 decoded, 6 of the client, 3 derived.
DECODED = ["type_vehicule", "etat_contrat_libelle", "contrat_actif", "usage_vehicule", "nb_garanties"]
DERIVED = ["age_client", "client_jeune", "anciennete_contrat"]


def silver_contracts(contrat2: DataFrame, contrat1: DataFrame, clients: DataFrame, as_of: dt.date) -> DataFrame:
    # Columns made of a contract's others come after the join, which then need not move them.
    joined = attach_clients(unique_contracts(contrat2, contrat1), clients, as_of)
    silver = joined.transform(decode_contracts).transform(derive_seniority, as_of)
    base = [n for n in contrat2.columns if n != c.CLIENT_KEY]
    return silver.select(c.CLIENT_KEY, *base, *DECODED, *c.CLIENT_ATTRIBUTES, *DERIVED)
