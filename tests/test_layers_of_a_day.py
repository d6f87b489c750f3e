import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.operators import quality, runlog
from strataflow.plans import bronze, daily, gold, silver
from strataflow.plans.views import view
from strataflow.sources import delimited, layers
from strataflow.streaming import kpis
from tests.conftest import AS_OF, SF, plan_of, rows

NAMES = ["contrat2", "contrat1", "client"]


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    for (_, file, _), name in zip(c.BRONZE_DATASETS, NAMES, strict=True):
        delimited.write_delimited(view(spark, SF, name), f"{folder}/{file}")
    return folder


@pytest.fixture(scope="module")
def sources(spark):
    return [view(spark, SF, name) for name in NAMES]


@pytest.mark.parametrize("by_day", [False, True])
def test_run_equals_the_direct_plans(spark, landing, sources, base, by_day):
    audits = daily.run_day(spark, landing, base, AS_OF, by_day)
    assert [(a.layer, a.dataset) for a in audits] == [
        ("bronze", "Contrat2"),
        ("bronze", "Contrat1"),
        ("bronze", "Client"),
        ("silver", "Client_contrat_silver"),
        ("gold", "client_profile_analysis"),
        ("gold", "contract_analysis"),
    ]
    stored = daily.read_silver(spark, base, AS_OF if by_day else None)
    direct = silver.silver_contracts(*sources, as_of=AS_OF)
    assert stored.columns == direct.columns and len(stored.columns) == 57
    assert stored.exceptAll(direct).isEmpty() and direct.exceptAll(stored).isEmpty()
    assert audits[3].rows == direct.count()
    mart = layers.read_layer(spark, layers.layer_path(base, "gold", "contract_analysis"))
    added = ["date", *daily.GOLD_PARTS, "aggregation_level"] if by_day else []
    assert rows(mart.drop(*added)) == rows(gold.contract_analysis_from_bronze(*sources[:2], AS_OF))
    profile = layers.read_layer(spark, layers.layer_path(base, "gold", "client_profile_analysis"))
    assert rows(profile.drop(*added)) == rows(gold.client_profile_from_bronze(*sources, AS_OF))


def test_logs_answer_the_run_log_queries(spark, landing, base):
    for _ in range(2):
        daily.run_day(spark, landing, base, AS_OF)
    daily.run_day(spark, landing, base, AS_OF + dt.timedelta(days=1))
    log = layers.read_layer(spark, layers.layer_path(base, "logs", "run_log"))
    assert rows(runlog.run_totals(log), "job_name", "status", "n_runs") == [
        ("bronze_ingest", "SUCCESS", 3),
        ("gold_transform", "SUCCESS", 3),
        ("silver_transform", "SUCCESS", 3),
    ]
    assert runlog.transform_efficiency(log).count() == 6
    history = layers.read_layer(spark, layers.layer_path(base, "logs", "check_results"))
    assert rows(history.groupBy("check_name").count()) == [
        ("amount_conformance", 3),
        ("critical_nulls", 3),
        ("key_duplicates", 3),
        ("row_count", 3),
    ]
    passed = history.where("status = 'PASS'").count() / 12 * 100
    kpis_of = quality.quality_kpis(history, F.trunc("run_at", "year")).collect()
    assert [(r.duplicate_record_count, r.validation_pass_rate) for r in kpis_of] == [(0, round(passed, 4))]
    volume = layers.read_layer(spark, layers.layer_path(base, "logs", "data_volume")).where("size_bytes > 0")
    assert rows(volume.groupBy("layer").count()) == [("bronze", 9), ("gold", 6), ("silver", 3)]
    edges = layers.read_layer(spark, layers.layer_path(base, "logs", "lineage"))
    assert len(rows(runlog.lineage_edges(edges))) == 3 + 3 + 2


def test_days_stand_side_by_side_and_a_rerun_replaces_its_own(spark, landing, base, tmp_path):
    """The second day brings other contracts; the first day's silver and marts stay."""
    other, next_day = str(tmp_path / "other"), AS_OF + dt.timedelta(days=1)
    for (_, file, _), name in zip(c.BRONZE_DATASETS, ["contrat1", "contrat1", "client"], strict=True):
        delimited.write_delimited(view(spark, SF, name), f"{other}/{file}")
    first = daily.run_day(spark, landing, base, AS_OF, by_day=True)
    for _ in range(2):
        later = daily.run_day(spark, other, base, next_day, by_day=True)
    for layer, dataset, day in [
        ("bronze", "Client", "ingestion_day"),
        ("silver", c.SILVER_DATASET, "transform_day"),
        ("gold", "client_profile_analysis", "day"),
        ("gold", "contract_analysis", "day"),
    ]:
        stored = layers.read_layer(spark, layers.layer_path(base, layer, dataset)).groupBy(day).count()
        written = {a.dataset: a.rows for a in first}[dataset], {a.dataset: a.rows for a in later}[dataset]
        assert rows(stored) == [(8, written[0]), (9, written[1])]
    assert first[3].rows != later[3].rows


def test_first_failure_stops_and_is_logged(spark, base):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_day(spark, f"{base}/nowhere", base, AS_OF)
    log = layers.read_layer(spark, layers.layer_path(base, "logs", "run_log"))
    assert rows(log, "job_name", "status", "error") == [("bronze_ingest", "FAILURE", "AnalysisException")]


def test_writes_before_a_failure_stay_in_the_log(spark, base, tmp_path):
    landing = str(tmp_path / "partial")
    delimited.write_delimited(view(spark, SF, "contrat2"), f"{landing}/Contrat2.csv")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_day(spark, landing, base, AS_OF)
    writes = layers.read_layer(spark, layers.layer_path(base, "logs", "write_log"))
    n = view(spark, SF, "contrat2").count()
    assert rows(writes, "dataset", "n_rows", "status") == [("Contrat1", 0, "FAILURE"), ("Contrat2", n, "SUCCESS")]
    runs = layers.read_layer(spark, layers.layer_path(base, "logs", "run_log"))
    assert rows(runs, "status", "records_out") == [("FAILURE", n)]


def test_a_write_that_breaks_is_timed_and_logged(spark, base):
    log = []
    with pytest.raises(Exception, match="broken"):
        layers.audited_write(spark.range(3).selectExpr("raise_error('broken') AS x"), f"{base}/x", "gold", "x", log=log)
    assert [(a.layer, a.dataset, a.rows, a.status) for a in log] == [("gold", "x", 0, "FAILURE")] and log[0].seconds > 0


def test_rejected_rows_are_kept_apart(spark, base, tmp_path):
    landing = str(tmp_path / "dirty")
    delimited.write_delimited(view(spark, SF, "contrat2"), f"{landing}/Contrat2.csv")
    audits = bronze.ingest_bronze(spark, landing, base, c.BRONZE_DATASETS[:1], quarantine=True)
    assert [(a.layer, a.status) for a in audits] == [("bronze", "SUCCESS"), ("rejects", "SUCCESS")]
    assert sum(a.rows for a in audits) == view(spark, SF, "contrat2").count() and audits[1].rows > 0
    stored = bronze.read_bronze(spark, base, "Contrat2")
    assert stored.columns == list(c.schema_types(c.CONTRACT_SCHEMA))


def test_silver_keeps_unmatched_contracts_and_one_client_each(spark):
    contract = "nusoc INT, nucon INT, cateco STRING, prmaco DOUBLE, etatco STRING, asaico INT, pfco INT, usagco1 INT"
    new = spark.createDataFrame([(1, 1, "A", 10.0, "1", 2000, 5, 0), (9, 1, "M", None, None, None, None, 1)], contract)
    old = spark.createDataFrame([(1, 1, "C", 99.0, "0", 1990, 1, 1), (1, 2, "C", 5.0, "2", 2020, 1, 3)], contract)
    client = spark.createDataFrame(
        [(1, "1", 1990, "p", "O", "1", 2), (1, "2", 1980, "p", "O", "1", 2)],
        "nusoc INT, sexsoc STRING, aadhso INT, cspsoc STRING, sitmat STRING, sitpav1 STRING, nbenf INT",
    )
    out = silver.silver_contracts(new, old, client, AS_OF)
    assert rows(out, "nusoc", "nucon", "type_vehicule", "prmaco", "age_client", "anciennete_contrat", "client_jeune") == [
        (1, 1, "Auto", 10.0, 36, 26, 0),
        (1, 2, "Cyclo", 5.0, 36, 6, 0),
        (9, 1, "Moto", 0.0, None, None, 0),
    ]
    fanned = silver.attach_clients(silver.clean_contracts(new, old, as_of=AS_OF), client, AS_OF, one_row_per_client=False)
    assert fanned.count() == 5


def test_profile_from_silver_and_from_bronze(spark, sources):
    stored = gold.client_profile(silver.silver_contracts(*sources, as_of=AS_OF))
    assert rows(stored) == rows(gold.client_profile_from_bronze(*sources, AS_OF))
    labelled = gold.client_profile(silver.silver_contracts(*sources, as_of=AS_OF), "unknown")
    assert labelled.where("age_segment = 'unknown'").count() == labelled.where("age_client IS NULL").count() > 0


def test_key_count_reads_key_columns_only(spark, sources):
    plan = plan_of(silver.client_numbers(*sources[:2]).distinct())
    assert "o_totalprice" not in plan and "o_custkey" in plan


def test_no_python_in_the_main_plans(spark, sources):
    for df in (silver.silver_contracts(*sources, as_of=AS_OF), gold.contract_analysis_from_bronze(*sources[:2], AS_OF)):
        plan = plan_of(df)
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


LOG = "run_id LONG, event_ts TIMESTAMP, job_name STRING, status STRING, duration_seconds DECIMAL(12,2), records_in LONG, records_out LONG"


def test_histogram_is_cumulative(spark):
    at = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([(i, at, "j", "SUCCESS", s, 0, 0) for i, s in enumerate([1, 30, 31, 4000])], LOG.replace("DECIMAL(12,2)", "INT"))
    out = runlog.duration_histogram(log, c.JOB_DURATION_BOUNDS)
    counts = {r.le: r.n_at_or_below for r in out.collect()}
    assert (counts["30"], counts["60"], counts["3600"], counts["+Inf"]) == (2, 3, 3, 4)
    assert out.first().sum_seconds == 4062
    assert runlog.transform_efficiency(log).count() == 0


def test_stream_over_two_arrivals_equals_the_batch(spark, base):
    log = view(spark, SF, "run_log").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    folder, out, state = f"{base}/in", f"{base}/out", f"{base}/state"
    closed = []
    for part in (log.where("event_ts < '2024-01-15'"), log.where("event_ts >= '2024-01-15'")):
        part.coalesce(1).write.mode("append").parquet(folder)
        kpis.start_kpis(kpis.stream_files(spark, folder, log.schema), "1 day", out, state).awaitTermination()
        arrived = spark.read.parquet(folder)
        batch = rows(runlog.windowed_kpis(arrived, "1 day"))
        assert rows(kpis.current_kpis(spark, arrived, "1 day", out)) == batch
        closed.append(spark.read.parquet(out).count())
        assert 0 < closed[-1] < len(batch)
    assert closed[0] < closed[1]


def test_kpis_before_any_window_has_closed(spark, base):
    log = view(spark, SF, "run_log").withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    # as early as a log may start: nothing is cut off before some date
    early = log.where("event_ts < '2024-01-01 12:00:00'").withColumn("event_ts", F.expr("event_ts - INTERVAL 80 YEARS"))
    early.write.parquet(f"{base}/in")
    stream = kpis.stream_files(spark, f"{base}/in", log.schema)
    kpis.start_kpis(stream, "1 day", f"{base}/out", f"{base}/state").awaitTermination()
    arrived = spark.read.parquet(f"{base}/in")
    assert rows(kpis.current_kpis(spark, arrived, "1 day", f"{base}/out")) == rows(runlog.windowed_kpis(arrived, "1 day"))
