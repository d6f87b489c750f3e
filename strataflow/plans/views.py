"""Contract, client and log views over the test tables, as SQL both engines read.

Each view holds every row of its table.  Values are derived so that the views
have overlapping and conflicting sources, repeated and null keys, bad cells,
unlisted codes and contracts without client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.contracts import GUARANTEE_FLAGS


def _contract_sql(delta: int, nusoc: str, nucon: str) -> str:
    flags = ",\n       ".join(
        f"CASE o_orderkey % {i + 3} WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE 0 END AS {name}"
        for i, name in enumerate(GUARANTEE_FLAGS)
    )
    return f"""
SELECT {nusoc} AS nusoc, {nucon} AS nucon,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN 'M'
            WHEN '3-MEDIUM' THEN 'C' WHEN '4-NOT SPECIFIED' THEN 'X' END AS cateco,
       {flags},
       o_orderstatus AS clasco, 'T' || CAST(o_orderkey % 6 AS STRING) AS tar6co,
       CAST(50 + o_orderkey % 300 AS DOUBLE) / 100 AS bomaco,
       CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'M' ELSE 'T' END AS fracco,
       'F' || CAST(o_custkey % 12 AS STRING) AS famgta, o_orderpriority AS markli,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'P' || CAST(o_orderkey % 40 AS STRING) END AS apcoco,
       CAST(year(o_orderdate) - o_orderkey % 9 AS INT) AS acircu, CAST(month(o_orderdate) AS INT) AS mcircu,
       CAST(year(o_orderdate) AS INT) AS acreco, CAST(month(o_orderdate) AS INT) AS mcreco,
       CAST(day(o_orderdate) AS INT) AS jcreco,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'bad'
            ELSE CAST(CAST(o_totalprice + {delta} AS DECIMAL(18,2)) AS STRING) END AS prmaco,
       CASE WHEN o_orderkey % 11 = 10 THEN NULL ELSE CAST(o_orderkey % 11 AS STRING) END AS etatco,
       CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS asaico,
       CAST(month(o_orderdate) AS INT) AS msaico, CAST(day(o_orderdate) AS INT) AS jsaico,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'U' || CAST(o_orderkey % 8 AS STRING) END AS utimot,
       NULLIF(CAST(o_orderkey % 13 AS INT), 12) AS pfco, CAST(o_orderkey % 5 AS INT) AS usagco1
FROM orders"""


SQL = {
    # The newer source: one row per order.
    "contrat2": _contract_sql(0, "o_custkey", "o_orderkey"),
    # The older source, again one row per order: every second contract is also
    # in the newer one with another premium, the others are only here, and some
    # rows have no key at all.
    "contrat1": _contract_sql(
        1,
        "CASE WHEN o_orderkey % 31 = 1 THEN NULL ELSE o_custkey END",
        "CASE WHEN o_orderkey % 31 = 1 THEN NULL WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END",
    ),
    # One row per customer: some without number, some under another's number,
    # whose contracts then have no client.
    "client": """
SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 7 = 3 THEN c_custkey - 1 ELSE c_custkey END AS nusoc,
       CAST(c_nationkey AS STRING) AS cdepso, c_name AS cvilso, CAST(c_custkey % 3 + 1 AS STRING) AS sexsoc,
       CAST(c_custkey % 9 AS STRING) AS bgesso,
       CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE CAST(1940 + c_custkey % 70 AS INT) END AS aadhso,
       CAST(1990 + c_custkey % 30 AS INT) AS anaiso, CAST(1 + c_custkey % 12 AS INT) AS mnaiso,
       CAST(1 + c_custkey % 28 AS INT) AS jnaiso,
       c_mktsegment AS cspsoc, CASE WHEN c_custkey % 2 = 0 THEN 'N' ELSE 'O' END AS asaiso,
       CAST(1 + c_custkey % 12 AS INT) AS msaico, CAST(1 + c_custkey % 28 AS INT) AS jsaiso,
       CASE WHEN c_acctbal < 0 THEN 'N' ELSE 'O' END AS sitmat, CAST(c_custkey % 5 AS INT) AS nbenf,
       CAST(c_custkey % 4 AS STRING) AS accmai, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE '0' END AS accsms,
       CAST(c_nationkey AS STRING) AS sitpav1
FROM customer""",
    "run_log": """
SELECT event_id AS run_id, ts AS event_ts, 'job_' || CAST(user_id % 5 AS STRING) AS job_name, event_type,
       CASE WHEN event_type = 'error' THEN 'FAILURE' ELSE 'SUCCESS' END AS status,
       CAST(value AS DECIMAL(12,2)) AS duration_seconds, event_id % 1000 AS records_in,
       CASE WHEN event_id % 4 = 0 THEN event_id % 500 ELSE event_id % 1000 END AS records_out
FROM events""",
    "lineage_log": """
SELECT 'bronze/' || event_type AS source, 'silver/job_' || CAST(user_id % 5 AS STRING) AS target,
       event_id % 1000 AS n_rows
FROM events""",
    # The moves of a lake: landing files feed bronze, bronze silver and silver gold; some marts feed silver again.
    "lineage_moves": """
SELECT CASE event_id % 4 WHEN 0 THEN 'landing/' || event_type || '.csv' WHEN 1 THEN 'bronze/' || event_type
         WHEN 2 THEN 'silver/job_' || CAST(user_id % 5 AS STRING) ELSE 'gold/mart_' || CAST(user_id % 3 AS STRING) END AS source,
       CASE event_id % 4 WHEN 0 THEN 'bronze/' || event_type WHEN 1 THEN 'silver/job_' || CAST(user_id % 5 AS STRING)
         WHEN 2 THEN 'gold/mart_' || CAST(user_id % 3 AS STRING) ELSE 'silver/job_' || CAST(user_id % 2 AS STRING) END AS target,
       event_id % 1000 AS n_rows
FROM events WHERE event_id % 4 <> 3 OR user_id % 7 = 0""",
    # Line items with missing flags and missing, repeated keys.
    "quality_input": """
SELECT l_orderkey, NULLIF(l_linenumber, 7) AS l_linenumber, NULLIF(l_returnflag, 'A') AS l_returnflag,
       l_shipdate AS created_at
FROM lineitem""",
}

TABLE_OF = {
    "contrat2": "orders",
    "contrat1": "orders",
    "client": "customer",
    "run_log": "events",
    "lineage_log": "events",
    "lineage_moves": "events",
    "quality_input": "lineitem",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view_over(spark: SparkSession, name: str, source: DataFrame) -> DataFrame:
    """The view over a given frame of its table, a stream too; bound by reference, not by a catalog name."""
    return spark.sql(SQL[name].replace(f"FROM {TABLE_OF[name]}", "FROM {source}"), source=source)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return view_over(spark, name, table(spark, sf_dir, TABLE_OF[name]))


# Contracts with premiums that a mean must survive, of every order; the SQL runs in both engines.
EXTREMES = """SELECT CAST(o_orderkey AS INT) AS nucon, CAST(o_custkey AS INT) AS nusoc, o_orderpriority AS type_vehicule,
      CASE o_orderkey % 97 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
        WHEN 2 THEN CAST('1e30' AS DOUBLE) WHEN 3 THEN CAST(NULL AS DOUBLE)
        ELSE o_totalprice + CAST('0.005' AS DOUBLE) END AS prmaco,
      CAST(o_orderkey % 30 AS INT) AS anciennete_contrat, CAST(o_orderkey % 9 AS INT) AS nb_garanties
      FROM orders"""

# Numbers as people type them into text columns, of every order.
NUMBERS_IN_TEXT = """SELECT o_orderkey AS id, '  ' || CAST(o_orderkey % 1000 AS STRING) || ' ' AS padded,
      CASE o_orderkey % 5 WHEN 0 THEN '-' || CAST(o_orderkey % 100 AS STRING) WHEN 1 THEN '1e' || CAST(o_orderkey % 4 AS STRING)
        WHEN 2 THEN '.5' WHEN 3 THEN 'none' ELSE 'x1' END AS mixed,
      CASE WHEN o_orderkey % 1000 = 0 THEN 'NaN' ELSE '7' END AS not_a_number
      FROM orders"""
