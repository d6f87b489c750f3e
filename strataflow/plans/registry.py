"""Every operator as a named query over the test tables, with fixed parameters.

Queries that write use a fresh path below the shared scratch folder and
return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.functions.columns import as_percentage, calendar_date, money, safe_divide
from strataflow.operators import aggregates, calendar, history, quality, runlog, sketches
from strataflow.operators import projections as p
from strataflow.operators.dedup import keep_first, total_order, union_sources
from strataflow.operators.joins import balanced_join
from strataflow.plans import bronze, daily, gate, gold, manifest, silver
from strataflow.plans.views import EXTREMES, NUMBERS_IN_TEXT, table, view, view_over
from strataflow.session import remove_path, scratch_path
from strataflow.sources import bucketed, catalog, delimited, layers, layout, versions
from strataflow.streaming import ingest, kpis

AS_OF = dt.date(2026, 3, 8)
ONE_DAY = dt.date(2024, 1, 15)
RESTATED_FROM = dt.date(2024, 1, 20)
MAX_AGE_DAYS = 30

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


# ---- scans and sources ------------------------------------------------------


@_query
def csv_contract_scan(spark, sf_dir):
    path = scratch_path(spark, "landing")
    delimited.write_delimited(view(spark, sf_dir, "contrat2"), path)
    return delimited.scan_delimited(spark, path, c.CONTRACT_SCHEMA, check_header=True)


@_query
def csv_reject_rows(spark, sf_dir):
    landing, parsed = scratch_path(spark, "landing"), scratch_path(spark, "parsed")
    delimited.write_delimited(view(spark, sf_dir, "contrat2"), landing)
    layers.write_layer(delimited.scan_delimited(spark, landing, c.CONTRACT_SCHEMA, keep_rejects=True), parsed)
    _, rejected = delimited.split_rejects(layers.read_layer(spark, parsed))
    return rejected.select("nusoc", "nucon", "etatco", F.col(delimited.REJECT_COLUMN).alias("raw_line"))


@_query
def csv_mixed_headers(spark, sf_dir):
    """Files of one folder with their columns in two orders, and one whose header is another's."""
    folder, contracts = scratch_path(spark, "landing"), view(spark, sf_dir, "contrat2")
    delimited.write_delimited(contracts.where("nucon % 2 = 0"), f"{folder}/even")
    delimited.write_delimited(contracts.where("nucon % 2 <> 0").select(*reversed(contracts.columns)), f"{folder}/odd")
    delimited.write_delimited(view(spark, sf_dir, "client"), f"{folder}/other")
    good, _ = delimited.scan_by_header(spark, folder, c.CONTRACT_SCHEMA)
    return good


@_query
def parquet_scan(spark, sf_dir):
    return layers.read_layer(spark, f"{sf_dir}/lineitem.parquet")


def _daily_run_log(spark, sf_dir):
    day = calendar_date(F.col("event_ts"))
    parts = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    return view(spark, sf_dir, "run_log").withColumns(parts)


def _stored_run_log(spark, sf_dir):
    path = scratch_path(spark, "run_log")
    layers.write_partitioned(_daily_run_log(spark, sf_dir), path, layers.DAY_PARTS)
    return path


@_query
def partition_pruned_read(spark, sf_dir):
    return layers.read_day(spark, _stored_run_log(spark, sf_dir), ONE_DAY)


# ---- sinks ------------------------------------------------------------------


@_query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "orders")
    layers.write_layer(table(spark, sf_dir, "orders"), path)
    return layers.read_layer(spark, path)


@_query
def partitioned_write(spark, sf_dir):
    return layers.read_layer(spark, _stored_run_log(spark, sf_dir))


@_query
def dynamic_overwrite(spark, sf_dir):
    path = _stored_run_log(spark, sf_dir)
    late = _daily_run_log(spark, sf_dir).where(calendar_date(F.col("event_ts")) >= F.lit(RESTATED_FROM))
    layers.overwrite_partitions(late.withColumn("records_out", F.col("records_out") + 1), path, layers.DAY_PARTS)
    return layers.read_layer(spark, path)


def _landed(spark, sf_dir, names=("contrat2", "contrat1", "client"), packed=False):
    landing = scratch_path(spark, "landing")
    for (_, file, _), name in zip(c.BRONZE_DATASETS, names, strict=True):
        delimited.write_delimited(view(spark, sf_dir, name), f"{landing}/{file}", packed)
    return landing


@_query
def write_audit(spark, sf_dir):
    audits = bronze.ingest_bronze(spark, _landed(spark, sf_dir), scratch_path(spark, "lake"))
    return layers.audit_frame(spark, audits).drop("seconds")


@_query
def clustered_layout(spark, sf_dir):
    path = scratch_path(spark, "lineitem")
    lines = table(spark, sf_dir, "lineitem")
    layout.write_clustered(lines, path, ["l_orderkey", "l_shipdate"], bloom={"l_partkey": 100_000})
    return layers.read_layer(spark, path)


@_query
def versioned_overwrite(spark, sf_dir):
    """A reader that began before an overwrite and one that began after it, both read after it."""
    root, database = scratch_path(spark, "versions"), "strataflow_versions"
    name = "orders_" + root.rsplit("-", 1)[-1]
    catalog.create_database(spark, database, "versioned tables", scratch_path(spark, "database"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    versions.publish_version(spark, orders, database, name, root)
    before = spark.table(f"{database}.{name}")
    restated = orders.where("o_orderkey % 3 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    versions.publish_version(spark, restated, database, name, root)
    after = spark.table(f"{database}.{name}")
    return before.withColumn("began", F.lit("before")).unionByName(after.withColumn("began", F.lit("after")))


@_query
def rebalance_layout(spark, sf_dir):
    path = scratch_path(spark, "lineitem")
    layers.write_layer(layers.rebalanced(table(spark, sf_dir, "lineitem")), path)
    return layers.read_layer(spark, path)


# ---- projections ------------------------------------------------------------


@_query
def cast_contract_types(spark, sf_dir):
    return p.cast_columns(view(spark, sf_dir, "contrat2")).select(*c.CONTRACT_CASTS)


@_query
def null_defaults(spark, sf_dir):
    return silver.conform(view(spark, sf_dir, "contrat2")).select(*c.CONTRACT_KEY, *c.CONTRACT_DEFAULTS)


def _decoded(spark, sf_dir, **columns):
    contracts = silver.conform(view(spark, sf_dir, "contrat2"))
    return contracts.select(*c.CONTRACT_KEY, *[e.alias(name) for name, e in columns.items()])


@_query
def decode_vehicle_type(spark, sf_dir):
    return _decoded(spark, sf_dir, type_vehicule=p.vehicle_type())


@_query
def decode_contract_state(spark, sf_dir):
    return _decoded(spark, sf_dir, etat_contrat_libelle=p.contract_state())


@_query
def active_flag(spark, sf_dir):
    return _decoded(spark, sf_dir, contrat_actif=p.contract_active())


@_query
def decode_usage(spark, sf_dir):
    return _decoded(spark, sf_dir, usage_vehicule=p.vehicle_use())


@_query
def guarantee_count(spark, sf_dir):
    return _decoded(spark, sf_dir, nb_garanties=p.guarantee_count(c.GUARANTEE_FLAGS))


@_query
def client_age(spark, sf_dir):
    clients = p.derive_client_age(view(spark, sf_dir, "client"), AS_OF)
    return clients.select("nusoc", "cvilso", "age_client", "client_jeune")


@_query
def contract_seniority(spark, sf_dir):
    return p.derive_seniority(view(spark, sf_dir, "contrat2"), AS_OF).select(*c.CONTRACT_KEY, "anciennete_contrat")


@_query
def age_segment(spark, sf_dir):
    clients = p.derive_client_age(view(spark, sf_dir, "client"), AS_OF)
    age = F.col("age_client")
    return clients.select(
        "nusoc", "cvilso", p.age_segment(age).alias("age_segment"), p.age_segment(age, "?").alias("known_age_segment")
    )


@_query
def bronze_partition_cols(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return calendar.add_ingestion_columns(orders, AS_OF, "o_orderdate").drop("ingestion_timestamp")


@_query
def silver_partition_cols(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return calendar.add_transform_columns(orders, AS_OF).drop("transform_timestamp")


@_query
def gold_partition_cols(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    orders = orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("transaction_date"))
    return calendar.add_gold_columns(orders, AS_OF, "monthly")


@_query
def period_rollup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("amount", money(F.col("o_totalprice")))
    return calendar.period_rollup(orders, "o_orderdate", "amount")


@_query
def row_quality_score(spark, sf_dir):
    contracts = p.cast_columns(view(spark, sf_dir, "contrat2"))
    rules = [
        F.col("prmaco") > 0,
        F.col("etatco").isin(*c.CONTRACT_STATES),
        F.col("cateco").isin(*c.VEHICLE_TYPES),
        F.col("asaico").isNotNull(),
    ]
    return contracts.select(*c.CONTRACT_KEY, calendar.row_quality_score(rules).alias("row_quality_score"))


@_query
def safe_ratio_pct(spark, sf_dir):
    ratio = safe_divide(F.col("records_out"), F.col("records_in"))
    return view(spark, sf_dir, "run_log").select("run_id", as_percentage(ratio, 1).alias("ratio_pct"))


# ---- filters, joins, deduplication ------------------------------------------


@_query
def filter_not_null(spark, sf_dir):
    return p.rows_matching(view(spark, sf_dir, "quality_input"), "l_returnflag IS NOT NULL")


@_query
def contract_client_join(spark, sf_dir):
    contracts = silver.conform(view(spark, sf_dir, "contrat1")).select(*c.CONTRACT_KEY, "prmaco")
    joined = silver.attach_clients(contracts, view(spark, sf_dir, "client"), AS_OF)
    return joined.select(*c.CONTRACT_KEY, "prmaco", *c.CLIENT_ATTRIBUTES)


@_query
def orphan_contracts(spark, sf_dir):
    contracts = silver.conform(view(spark, sf_dir, "contrat1")).select(*c.CONTRACT_KEY)
    known = silver.client_columns(view(spark, sf_dir, "client")).select(c.CLIENT_KEY)
    return balanced_join(contracts, known, c.CLIENT_KEY, "left_anti")


@_query
def union_contracts(spark, sf_dir):
    return union_sources(view(spark, sf_dir, "contrat2"), view(spark, sf_dir, "contrat1"))


@_query
def dedup_contracts(spark, sf_dir):
    return silver.unique_contracts(view(spark, sf_dir, "contrat2"), view(spark, sf_dir, "contrat1"))


@_query
def dedup_clients(spark, sf_dir):
    profile = p.derive_client_age(view(spark, sf_dir, "client"), AS_OF).select(*c.PROFILE_COLUMNS)
    return keep_first(profile, [c.CLIENT_KEY], total_order(profile, ["age_client"], skip=[c.CLIENT_KEY]))


@_query
def sample_rows(spark, sf_dir):
    return p.sample_rows(table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 5)


# ---- aggregates and business metrics ----------------------------------------


@_query
def contract_analysis(spark, sf_dir):
    return gold.contract_analysis_from_bronze(view(spark, sf_dir, "contrat2"), view(spark, sf_dir, "contrat1"), AS_OF)


@_query
def row_count(spark, sf_dir):
    return aggregates.row_count(table(spark, sf_dir, "lineitem"))


@_query
def column_statistics(spark, sf_dir):
    return aggregates.column_statistics(table(spark, sf_dir, "lineitem"))


def _over_orders(spark, sf_dir, sql):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(sql)


@_query
def contract_mart_extremes(spark, sf_dir):
    return aggregates.contract_mart(_over_orders(spark, sf_dir, EXTREMES))


@_query
def text_statistics(spark, sf_dir):
    return aggregates.column_statistics(_over_orders(spark, sf_dir, NUMBERS_IN_TEXT))


@_query
def retention_rate(spark, sf_dir):
    return aggregates.retention_rate(_decoded(spark, sf_dir, contrat_actif=p.contract_active()))


@_query
def active_share_by_type(spark, sf_dir):
    decoded = _decoded(spark, sf_dir, type_vehicule=p.vehicle_type(), contrat_actif=p.contract_active())
    return aggregates.market_share(decoded, ["type_vehicule"])


# ---- data quality -----------------------------------------------------------

CRITICAL = ["nusoc", "nucon", "prmaco", "etatco"]
LINE_KEY = ["l_orderkey", "l_linenumber"]


@_query
def dq_row_count(spark, sf_dir):
    return quality.run_checks(view(spark, sf_dir, "contrat2"), "Contrat2", [quality.non_empty()])


@_query
def dq_null_profile(spark, sf_dir):
    contracts = view(spark, sf_dir, "contrat2")
    return quality.run_checks(contracts, "Contrat2", [quality.null_profile(contracts.columns)])


@_query
def dq_critical_nulls(spark, sf_dir):
    return quality.run_checks(view(spark, sf_dir, "contrat2"), "Contrat2", [quality.critical_nulls(CRITICAL)])


@_query
def dq_row_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return quality.row_duplicates(union_sources(lines, lines.where("l_linenumber = 7")), "lines")


@_query
def dq_amount_conformance(spark, sf_dir):
    amounts = _over_orders(spark, sf_dir, EXTREMES)
    return quality.run_checks(amounts, "extremes", [quality.amount_conformance(["prmaco"])])


@_query
def dq_check_suite(spark, sf_dir):
    """Two checks of each kind in one scan."""
    lines = view(spark, sf_dir, "quality_input")
    checks = [quality.critical_nulls(["l_linenumber"]), quality.critical_nulls(["l_returnflag"])]
    checks += [quality.freshness(lines, ["created_at"]), quality.freshness(lines, ["created_at"])]
    checks += [quality.type_conformance(lines, {"l_returnflag": kind}) for kind in ("int", "date")]
    return quality.run_checks(lines, "lines", checks)


@_query
def dq_key_duplicates(spark, sf_dir):
    return quality.key_duplicates(view(spark, sf_dir, "quality_input"), LINE_KEY, "lines")


@_query
def dq_freshness(spark, sf_dir):
    lines = view(spark, sf_dir, "quality_input")
    return quality.run_checks(
        lines, "lines", [quality.freshness(lines, as_of=AS_OF, max_age_days=MAX_AGE_DAYS)]
    )


@_query
def dq_type_conformance(spark, sf_dir):
    contracts = view(spark, sf_dir, "contrat2")
    expected = {**c.schema_types(c.CONTRACT_SCHEMA), "absent": "int"}
    return quality.run_checks(contracts, "Contrat2", [quality.type_conformance(contracts, expected)])


@_query
def dq_silver_profile(spark, sf_dir):
    path = scratch_path(spark, "silver")
    layers.write_layer(silver_contracts(spark, sf_dir), path)
    return quality.validate_silver(layers.read_layer(spark, path), c.SILVER_DATASET)


@_query
def merged_profile(spark, sf_dir):
    """Profiles stored per month and merged without the data; the estimates are held against the data itself."""
    path, lines = scratch_path(spark, "profiles"), table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]
    layers.write_layer(sketches.sliced_profiles(lines, F.trunc(calendar_date(F.col("l_shipdate")), "month"), columns), path)
    merged = sketches.merged_profiles(layers.read_layer(spark, path))
    # Four rows, one for each of the columns named above.
    found = {r.column_name: r for r in merged.collect()}
    middle = {n: F.lit(found[n].quantiles[1]) for n in columns}
    exact = lines.agg(
        *[F.count_distinct(n).alias(f"d_{n}") for n in columns],
        *[F.avg((F.col(n) < middle[n]).cast("int")).alias(f"b_{n}") for n in columns],
        *[F.avg((F.col(n) <= middle[n]).cast("int")).alias(f"a_{n}") for n in columns],
    ).first()
    held = [
        (n, abs(found[n].n_distinct / exact[f"d_{n}"] - 1) < 0.04, exact[f"b_{n}"] < 0.51 and exact[f"a_{n}"] > 0.49)
        for n in columns
    ]
    bounds = spark.createDataFrame(held, "column_name STRING, distinct_within_bound BOOLEAN, median_within_bound BOOLEAN")
    return merged.join(bounds, "column_name").drop("n_distinct", "quantiles")


@_query
def dq_bronze_validation(spark, sf_dir):
    return quality.validate_bronze(view(spark, sf_dir, "quality_input"), "lines")


@_query
def dq_gold_shape(spark, sf_dir):
    path = scratch_path(spark, "mart")
    layers.write_layer(contract_analysis(spark, sf_dir), path)
    mart = layers.read_layer(spark, path)
    shown = ["type_vehicule", "total_contracts", "unique_clients"]
    return quality.gold_shape(mart, "contract_analysis", ["type_vehicule"], shown)


@_query
def dq_table_report(spark, sf_dir):
    return quality.table_report(view(spark, sf_dir, "client"), "Client")


@_query
def dq_pass_rate(spark, sf_dir):
    keys = {"contrat2": c.CONTRACT_KEY, "contrat1": c.CONTRACT_KEY, "client": [c.CLIENT_KEY], "run_log": ["run_id"]}
    results = []
    for name, key in keys.items():
        data = view(spark, sf_dir, name)
        checks = [quality.non_empty(), quality.critical_nulls(key)]
        results += [quality.run_checks(data, name, checks), quality.key_unique(data, key, name)]
    return quality.pass_rate(union_sources(*results))


@_query
def dq_expectations(spark, sf_dir):
    clients = view(spark, sf_dir, "client")
    suite = quality.expectation_suite(clients, list(c.schema_types(c.CLIENT_SCHEMA)))
    return quality.run_checks(clients, "Client", suite)


@_query
def dq_check_totals(spark, sf_dir):
    return quality.check_totals(dq_null_profile(spark, sf_dir).unionByName(dq_table_report(spark, sf_dir)))


@_query
def dq_key_unique(spark, sf_dir):
    return quality.key_unique(view(spark, sf_dir, "client"), [c.CLIENT_KEY], "Client")


@_query
def dq_layer_growth(spark, sf_dir):
    bronze_rows = union_sources(view(spark, sf_dir, "contrat2"), view(spark, sf_dir, "contrat1"))
    # Silver has one row per contract key, so its rows are counted as distinct keys: two columns are moved, not 43.
    keys = silver.conform(bronze_rows).select(*c.CONTRACT_KEY).distinct()
    return quality.layer_growth(bronze_rows, keys, c.SILVER_DATASET, names=("bronze", "silver"))


@_query
def dq_gold_dimensions(spark, sf_dir):
    dimensions = ["nusoc", "sexsoc", "cspsoc"]
    check = quality.critical_nulls(dimensions, quality.FAIL, "null_dimensions")
    return quality.run_checks(client_profile(spark, sf_dir), "client_profile_analysis", [check])


@_query
def dq_partition_conformance(spark, sf_dir):
    lines = view(spark, sf_dir, "quality_input")
    day = calendar_date(F.col("created_at"))
    stored = lines.withColumns(
        {
            "year": F.when(F.col("l_returnflag") == "R", F.year(day) + 1).otherwise(F.year(day)),
            "month": F.month(day),
            "day": F.when(F.col("l_linenumber").isNotNull(), F.dayofmonth(day)),
        }
    )
    parts = {unit: unit for unit in layers.DAY_PARTS}
    return quality.run_checks(stored, "lines", [quality.partition_conformance(stored, "created_at", parts)])


@_query
def dq_kpis(spark, sf_dir):
    lines = view(spark, sf_dir, "quality_input")
    month = F.trunc(calendar_date(F.col("created_at")), "month")
    history = quality.sliced_results(lines, month, "lines", LINE_KEY, ["l_linenumber", "l_returnflag"])
    return quality.quality_kpis(history, F.trunc("run_at", "year"))


# ---- run log, lineage, catalog ----------------------------------------------


@_query
def run_totals(spark, sf_dir):
    return runlog.run_totals(view(spark, sf_dir, "run_log"))


@_query
def failure_totals(spark, sf_dir):
    log = view(spark, sf_dir, "run_log")
    return runlog.run_totals(log.where(F.col("status") == runlog.FAILURE), ["job_name", "event_type"])


@_query
def duration_histogram(spark, sf_dir):
    return runlog.duration_histogram(view(spark, sf_dir, "run_log"), c.JOB_DURATION_BOUNDS)


@_query
def storage_duration_histogram(spark, sf_dir):
    return runlog.duration_histogram(view(spark, sf_dir, "run_log"), c.STORAGE_DURATION_BOUNDS, "event_type")


@_query
def job_kpis(spark, sf_dir):
    return runlog.job_kpis(view(spark, sf_dir, "run_log"))


@_query
def kpi_window_5m(spark, sf_dir):
    return runlog.windowed_kpis(view(spark, sf_dir, "run_log"), "5 minutes")


@_query
def kpi_window_1h(spark, sf_dir):
    return runlog.windowed_kpis(view(spark, sf_dir, "run_log"), "1 hour")


@_query
def kpi_window_1d(spark, sf_dir):
    return runlog.windowed_kpis(view(spark, sf_dir, "run_log"), "1 day")


@_query
def kpi_stream_1d(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    arriving = view_over(spark, "run_log", kpis.stream_files(spark, sf_dir, schema, "events.parquet"))
    out = scratch_path(spark, "kpis")
    kpis.start_kpis(arriving, "1 day", out, scratch_path(spark, "kpis-state")).awaitTermination()
    bounds = {n: F.col(n).cast("timestamp_ntz") for n in ("window_start", "window_end")}
    return kpis.current_kpis(spark, view(spark, sf_dir, "run_log"), "1 day", out).withColumns(bounds)


@_query
def events_by_job(spark, sf_dir):
    return runlog.events_by_job(view(spark, sf_dir, "run_log"))


@_query
def transform_efficiency(spark, sf_dir):
    return runlog.transform_efficiency(view(spark, sf_dir, "run_log"))


@_query
def lineage_edges(spark, sf_dir):
    return runlog.lineage_edges(view(spark, sf_dir, "lineage_log"))


@_query
def lineage_reach(spark, sf_dir):
    """What every landing file feeds, down to the marts, circles included."""
    return runlog.lineage_reach(view(spark, sf_dir, "lineage_moves"), "landing")


@_query
def data_volume(spark, sf_dir):
    return layers.stored_bytes(spark, sf_dir, "raw")


@_query
def data_volume_of_text(spark, sf_dir):
    """Bytes of layers whose size is known: lines of 13 and of 21 bytes, one for each order and line item."""
    base = scratch_path(spark, "volumes")
    for name, source, key, width in (("orders", "orders", "o_orderkey", 12), ("lines", "lineitem", "l_orderkey", 20)):
        fixed = table(spark, sf_dir, source).select(F.lpad(F.col(key).cast("string"), width, "0"))
        fixed.write.text(layers.layer_path(base, "landing", name))
    return layers.stored_bytes(spark, f"{base}/landing", "landing").drop("n_files")


@_query
def daily_run_checks(spark, sf_dir):
    """The check results that the run of a day leaves in its log."""
    base = scratch_path(spark, "lake")
    daily.run_day(spark, _landed(spark, sf_dir), base, AS_OF)
    results = layers.read_layer(spark, layers.layer_path(base, "logs", "check_results"))
    return results.select(*quality.RESULT_COLUMNS, "run_date")


@_query
def catalog_table_query(spark, sf_dir):
    path = _stored_run_log(spark, sf_dir)
    stored = layers.read_layer(spark, path)
    fields = {f.name: f.dataType.simpleString() for f in stored.schema.fields if f.name not in layers.DAY_PARTS}
    database, name = "strataflow_gold", "run_log_" + path.rsplit("-", 1)[-1]
    catalog.create_database(spark, database, "registered layers", scratch_path(spark, "database"))
    catalog.create_external_table(spark, database, name, path, fields)
    catalog.recover_partitions(spark, database, name)
    days = spark.table(f"{database}.{name}").groupBy(*layers.DAY_PARTS)
    return days.agg(F.count(F.lit(1)).alias("n_runs"), F.sum("records_out").alias("total_records"))


@_query
def catalog_column_stats(spark, sf_dir):
    path = scratch_path(spark, "lines")
    database, name = "strataflow_gold", "lines_" + path.rsplit("-", 1)[-1]
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.expr("nullif(l_linenumber, 7)"))
    catalog.create_database(spark, database, "registered layers", scratch_path(spark, "database"))
    lines.write.option("path", path).saveAsTable(f"{database}.{name}")
    catalog.analyze_columns(spark, database, name, columns)
    return catalog.column_stats(spark, database, name, columns).drop("distinct_count")


# ---- whole layers -----------------------------------------------------------


@_query
def bronze_ingest(spark, sf_dir):
    base = scratch_path(spark, "lake")
    bronze.ingest_bronze(spark, _landed(spark, sf_dir), base)
    contracts = [bronze.read_bronze(spark, base, d).withColumn("dataset", F.lit(d)) for d in ("Contrat2", "Contrat1")]
    return union_sources(*contracts)


@_query
def bronze_stream_ingest(spark, sf_dir):
    """Files that arrive in two instalments, the last batch delivered once more."""
    folder, path, state = (scratch_path(spark, n) for n in ("landing", "bronze", "state"))
    contracts = view(spark, sf_dir, "contrat2")
    for part in (0, 1):
        delimited.write_delimited(contracts.where(f"nucon % 2 = {part}"), f"{folder}/{part}")
        ingest.start_ingest(spark, f"{folder}/*", c.CONTRACT_SCHEMA, path, state, AS_OF).awaitTermination()
    again = delimited.scan_delimited(spark, f"{folder}/1", c.CONTRACT_SCHEMA)
    ingest.write_batch(again, 1, path, AS_OF + dt.timedelta(days=1))
    return layers.read_layer(spark, path).drop("ingestion_timestamp")


@_query
def bronze_ingest_client(spark, sf_dir):
    base = scratch_path(spark, "lake")
    bronze.ingest_bronze(spark, _landed(spark, sf_dir), base)
    return bronze.read_bronze(spark, base, "Client")


@_query
def bronze_ingest_rejects(spark, sf_dir):
    """Rows taken in and rows set apart, for the file whose premiums do not all fit their type."""
    base, dataset = scratch_path(spark, "lake"), c.BRONZE_DATASETS[0]
    bronze.ingest_bronze(spark, _landed(spark, sf_dir), base, [dataset], quarantine=True)
    good = bronze.read_bronze(spark, base, dataset[0]).select("nusoc", "nucon", F.lit("good").alias("kept_as"))
    lines = layers.read_layer(spark, layers.layer_path(base, "rejects", dataset[0]))
    rejected = lines.select("nusoc", "nucon", F.lit("rejected").alias("kept_as"))
    return good.unionByName(rejected)


@_query
def silver_by_day(spark, sf_dir):
    """Two days loaded, the second one twice, the last time from fewer files: each day keeps its own snapshot."""
    base, parts = scratch_path(spark, "lake"), daily.SILVER_PARTS
    second = AS_OF + dt.timedelta(days=1)
    # Landing files are packed, and kept as long as a load reads them: as plain text they take more than all layers.
    for names, days in ((("contrat2", "contrat1", "client"), (AS_OF, second)), (("contrat2", "contrat2", "client"), (second,))):
        landing = _landed(spark, sf_dir, names, packed=True)
        for day in days:
            bronze.ingest_bronze(spark, landing, base, run_day=day)
            daily.run_silver(spark, base, day, by_day=True)
        remove_path(spark, landing)
    stored = layers.read_layer(spark, layers.layer_path(base, "silver", c.SILVER_DATASET))
    return stored.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("n_contracts"), F.sum(money(F.col("prmaco"))).alias("total_premium")
    )


@_query
def daily_run(spark, sf_dir):
    """A run that fails for want of one landing file, and its resumption: rows and attempts of every dataset."""
    base, landing = scratch_path(spark, "lake"), scratch_path(spark, "landing")
    late = c.BRONZE_DATASETS[-1][1]
    for (_, file, _), name in zip(c.BRONZE_DATASETS, ["contrat2", "contrat1", "client"], strict=True):
        if file != late:
            delimited.write_delimited(view(spark, sf_dir, name), f"{landing}/{file}")
    try:
        daily.run_day(spark, landing, base, AS_OF)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    delimited.write_delimited(view(spark, sf_dir, "client"), f"{landing}/{late}")
    daily.run_day(spark, landing, base, AS_OF, resume=True)
    writes = layers.read_layer(spark, layers.layer_path(base, "logs", "write_log"))
    tried = F.col("status") != manifest.SKIPPED
    return writes.groupBy("layer", "dataset").agg(
        F.max("n_rows").alias("n_rows"),
        F.count_if(tried).alias("attempts"),
        F.count_if(F.col("status") == layers.FAILURE).alias("failures"),
        F.count_if(~tried).alias("skipped"),
    )


@_query
def silver_changes(spark, sf_dir):
    """Three days of contracts, from the older source, both, and the newer one: each state with its validity."""
    path = scratch_path(spark, "history")
    newer, older = view(spark, sf_dir, "contrat2"), view(spark, sf_dir, "contrat1")
    for i, sources in enumerate([[older], [newer, older], [newer]]):
        snapshot = silver.unique_contracts(*sources)
        history.record_day(spark, snapshot, path, c.CONTRACT_KEY, AS_OF + dt.timedelta(days=i))
    states = history.validity_intervals(layers.read_layer(spark, path), c.CONTRACT_KEY)
    return states.select(*c.CONTRACT_KEY, "change", "valid_from", "valid_to", "prmaco", "etatco", "usagco1")


@_query
def bucketed_contract_client_join(spark, sf_dir):
    """Contracts and clients stored by client number, then joined without moving either."""
    database, name = "strataflow_buckets", scratch_path(spark, "t").rsplit("-", 1)[-1]
    catalog.create_database(spark, database, "bucketed tables", scratch_path(spark, "database"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    contracts = silver.unique_contracts(view(spark, sf_dir, "contrat2"), view(spark, sf_dir, "contrat1"))
    clients = silver.unique_clients(view(spark, sf_dir, "client"))
    for side, frame in (("contracts", contracts), ("clients", clients)):
        path = scratch_path(spark, side)
        bucketed.write_bucketed(frame, database, f"{side}_{name}", c.CLIENT_KEY, n, path)
    joined = bucketed.bucketed_join(
        spark, f"{database}.contracts_{name}", f"{database}.clients_{name}", c.CLIENT_KEY
    )
    return joined.select(*c.CONTRACT_KEY, "prmaco", *c.CLIENT_ATTRIBUTES)


@_query
def silver_contracts(spark, sf_dir):
    return silver.silver_contracts(*[view(spark, sf_dir, n) for n in ("contrat2", "contrat1", "client")], as_of=AS_OF)


@_query
def client_profile(spark, sf_dir):
    return gold.client_profile_from_bronze(
        *[view(spark, sf_dir, n) for n in ("contrat2", "contrat1", "client")], as_of=AS_OF
    )


@_query
def bronze_to_silver_gate(spark, sf_dir):
    lines = view(spark, sf_dir, "quality_input")
    promoted, _ = gate.bronze_to_silver_gate(lines, "lines", ["l_linenumber", "l_returnflag"], AS_OF, "created_at")
    return promoted.drop("ingestion_timestamp", "transform_timestamp")


@_query
def bronze_to_silver_gate_results(spark, sf_dir):
    lines = view(spark, sf_dir, "quality_input")
    _, results = gate.bronze_to_silver_gate(lines, "lines", ["l_linenumber", "l_returnflag"], AS_OF, "created_at")
    return results
