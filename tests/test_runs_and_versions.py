import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.operators import history, runlog
from strataflow.operators.dedup import row_digest
from strataflow.plans import bronze, daily, manifest
from strataflow.plans.views import view
from strataflow.sources import bucketed, catalog, delimited, layers, versions
from strataflow.sources.archive import archive_landed
from tests.conftest import AS_OF, SF, plan_of, rows

NAMES = ["contrat2", "contrat1", "client"]


def land(spark, folder, names=tuple(NAMES), only=tuple(NAMES)):
    for (_, file, _), name, own in zip(c.BRONZE_DATASETS, names, NAMES, strict=True):
        if own in only:
            delimited.write_delimited(view(spark, SF, name), f"{folder}/{file}")


def states(audits):
    return {a.dataset: a.status for a in audits}


# ---- resuming ----


def test_a_run_goes_on_after_the_last_finished_write(spark, base, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing, only=("contrat2", "contrat1"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_day(spark, landing, base, AS_OF)
    land(spark, landing, only=("client",))
    second = daily.run_day(spark, landing, base, AS_OF, resume=True)
    assert states(second) == {
        "Contrat2": "SKIPPED", "Contrat1": "SKIPPED", "Client": "SUCCESS", c.SILVER_DATASET: "SUCCESS",
        "client_profile_analysis": "SUCCESS", "contract_analysis": "SUCCESS",
    }
    third = daily.run_day(spark, landing, base, AS_OF, resume=True)
    assert set(states(third).values()) == {"SKIPPED"}
    assert {a.dataset: a.rows for a in third} == {a.dataset: a.rows for a in second}
    # New contents of one file: it and all that is made of it are done again.
    land(spark, landing, names=("contrat2", "contrat1", "client"), only=("contrat1",))
    fourth = states(daily.run_day(spark, landing, base, AS_OF, resume=True))
    assert [n for n, s in fourth.items() if s == "SKIPPED"] == ["Contrat2", "Client"]
    runs = layers.read_layer(spark, layers.layer_path(base, "logs", "run_log"))
    assert rows(runs.where("status = 'FAILURE'"), "job_name", "error_class") == [("bronze_ingest", "missing_input")]


def test_another_date_or_a_write_cut_off_is_done_again(spark, base, tmp_path, monkeypatch):
    landing, next_day = str(tmp_path / "landing"), AS_OF + dt.timedelta(days=1)
    land(spark, landing)
    daily.run_day(spark, landing, base, AS_OF)
    daily.run_day(spark, landing, base, next_day)
    assert "SKIPPED" not in states(daily.run_day(spark, landing, base, AS_OF, resume=True)).values()

    def broken(*_):
        raise RuntimeError("disk full")

    with monkeypatch.context() as patched:
        patched.setitem(daily.GOLD_MARTS, "contract_analysis", (broken, 1))
        with pytest.raises(RuntimeError):
            daily.run_day(spark, landing, base, AS_OF)
    again = states(daily.run_day(spark, landing, base, AS_OF, resume=True))
    assert [n for n, s in again.items() if s != "SKIPPED"] == ["contract_analysis"]
    by_day = states(daily.run_day(spark, landing, f"{base}/days", AS_OF, by_day=True))
    daily.run_day(spark, landing, f"{base}/days", next_day, by_day=True)
    assert set(by_day.values()) == {"SUCCESS"}
    assert set(states(daily.run_day(spark, landing, f"{base}/days", AS_OF, True, resume=True)).values()) == {"SKIPPED"}


def test_attempts_after_a_failure_resume(spark, base, tmp_path, monkeypatch):
    landing, tries = str(tmp_path / "landing"), []
    land(spark, landing)
    plan, files = daily.GOLD_MARTS["contract_analysis"]

    def once_broken(silver):
        tries.append(1)
        return plan(silver) if len(tries) > 1 else silver.selectExpr("raise_error('full') AS type_vehicule")

    monkeypatch.setitem(daily.GOLD_MARTS, "contract_analysis", (once_broken, files))
    audits = daily.run_with_retries(spark, landing, base, AS_OF, retries=1, wait=dt.timedelta(0))
    assert [a.dataset for a in audits if a.status == "SUCCESS"] == ["contract_analysis"]
    runs = layers.read_layer(spark, layers.layer_path(base, "logs", "run_log"))
    assert rows(runs.where("status = 'FAILURE'"), "job_name", "error_class") == [("gold_transform", "write_failure")]
    book = manifest.manifest_rows(spark, base)
    assert book.where("state = 'STARTED'").count() == book.where("state = 'FINISHED'").count() + 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        daily.run_with_retries(spark, f"{base}/nowhere", base, AS_OF, retries=1, wait=dt.timedelta(0))


def test_single_jobs_dates_and_exit_codes(spark, base, tmp_path, monkeypatch, capsys):
    landing = str(tmp_path / "landing")
    land(spark, landing)
    for job in daily.JOBS:
        assert daily.main(["--landing", landing, "--base", base, "--execution-date", "2026-03-08", "--job", job]) == 0
    assert layers.read_layer(spark, layers.layer_path(base, "gold", "contract_analysis")).count() > 0
    assert daily.main(["--landing", f"{base}/none", "--base", base]) == 1
    assert "missing_input: AnalysisException" in capsys.readouterr().err
    monkeypatch.setenv("EXECUTION_DATE", "2026-02-30")
    assert daily.main(["--landing", landing, "--base", base]) == 1
    assert "must be YYYY-MM-DD" in capsys.readouterr().err
    monkeypatch.setenv("EXECUTION_DATE", "2026-02-28")
    assert daily.execution_date(None) == dt.date(2026, 2, 28) and daily.execution_date("2025-01-01").year == 2025
    with pytest.raises(ValueError, match="no such job"):
        daily.run_day(spark, landing, base, AS_OF, jobs=["gold"])


def test_ingested_files_are_archived_and_headers_bound(spark, base, tmp_path):
    landing, archive = str(tmp_path / "landing"), str(tmp_path / "archive")
    land(spark, landing, only=("contrat1", "client"))
    newer = view(spark, SF, "contrat2")
    delimited.write_delimited(newer.where("nucon % 2 = 0"), f"{landing}/Contrat2.csv/a")
    delimited.write_delimited(newer.where("nucon % 2 <> 0").select(*reversed(newer.columns)), f"{landing}/Contrat2.csv/b")
    (tmp_path / "landing" / "Contrat2.csv" / "other.csv").write_text("no,header,of,ours\n1,2,3,4\n")
    audits = daily.run_day(spark, landing, base, AS_OF, by_header=True, archive=archive)
    by_name = {(a.layer, a.dataset): a.rows for a in audits}
    assert by_name["bronze", "Contrat2"] == newer.count() and by_name["rejects", "Contrat2_files"] == 1
    stored = bronze.read_bronze(spark, base, "Contrat2")
    typed = stored.select([F.col(n).cast(t) for n, t in newer.drop("prmaco").dtypes])
    assert typed.exceptAll(newer.drop("prmaco").select(typed.columns)).isEmpty()
    assert list((tmp_path / "landing").iterdir()) == []
    runs = list((tmp_path / "archive" / str(AS_OF)).iterdir())
    assert len(runs) == 1 and sorted(p.name for p in runs[0].iterdir() if p.is_dir()) == sorted(f for _, f, _ in c.BRONZE_DATASETS)
    with pytest.raises(FileNotFoundError):
        archive_landed(spark, f"{landing}/Contrat2.csv", archive)


# ---- versions ----


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    catalog.create_database(spark, "tests_of_versions", "", str(tmp_path_factory.mktemp("db")))
    return "tests_of_versions"


def test_readers_keep_the_version_they_began_with(spark, base, database):
    root = f"{base}/it's a root"
    versions.publish_version(spark, spark.range(3), database, "t1", root)
    old = spark.table(f"{database}.t1")
    first = versions.current_version(spark, database, "t1")
    versions.publish_version(spark, spark.range(5), database, "t1", root)
    assert (old.count(), spark.table(f"{database}.t1").count()) == (3, 5)
    log = []
    with pytest.raises(Exception, match="broken"):
        versions.publish_version(spark, spark.range(2).selectExpr("IF(id < 9, raise_error('broken'), id) AS id"), database, "t1", root, log)
    assert spark.table(f"{database}.t1").count() == 5 and [a.status for a in log] == ["FAILURE"]
    with pytest.raises(ValueError, match="other columns"):
        versions.publish_version(spark, spark.range(2).selectExpr("id AS other"), database, "t1", root)
    assert versions.expire_versions(spark, database, "t1", root, keep=1) == []
    versions.publish_version(spark, spark.range(7), database, "t1", root)
    gone = versions.expire_versions(spark, database, "t1", root, keep=1)
    assert versions._bare(first) in [versions._bare(p) for p in gone] and spark.table(f"{database}.t1").count() == 7
    assert versions.expire_versions(spark, database, "none", root) == []
    assert versions.expire_versions(spark, database, "t1", f"{base}/elsewhere") == []


def test_a_run_swaps_its_tables(spark, base, database, tmp_path):
    landing = str(tmp_path / "landing")
    land(spark, landing)
    first = daily.run_day(spark, landing, base, AS_OF, database=database)
    mart = spark.table(f"{database}.contract_analysis")
    silver = spark.table(f"{database}.{c.SILVER_DATASET}")
    n = silver.count()
    land(spark, landing, names=("contrat1", "contrat1", "client"), only=("contrat2",))
    second = daily.run_day(spark, landing, base, AS_OF, resume=True, database=database)
    assert {a.dataset for a in second if a.status == "SUCCESS"} == {a.dataset for a in first} - {"Contrat1", "Client"}
    # The readers that began before still see the first run.
    assert silver.count() == n == first[3].rows != second[3].rows == spark.table(f"{database}.{c.SILVER_DATASET}").count()
    assert sorted(mart.columns) == sorted(spark.table(f"{database}.contract_analysis").columns)
    daily.run_day(spark, landing, base, AS_OF, database=database)
    assert len(versions.stored_versions(spark, layers.layer_path(base, "gold", "contract_analysis"))) == 2


# ---- history ----



def snapshot(spark, **states):
    made = [(None if k == "none" else int(k[1:]), "x", v) for k, v in states.items()]
    return spark.createDataFrame(made, "k INT, j STRING, v DOUBLE")


def test_changes_over_days(spark, base):
    keys, path = ["k", "j"], f"{base}/history"
    days = [dt.date(2024, 1, 30) + dt.timedelta(days=i) for i in range(5)]
    given = [
        dict(k1=1.0, k2=2.0, none=9.0),
        dict(k1=1.0, k2=2.5, k3=3.0, none=9.0),
        dict(k1=1.0, k2=2.5, k3=3.0, none=9.0),
        dict(k3=3.0, none=None),
        dict(k1=1.0, k3=3.0, none=None),
    ]
    for day, states_ in zip(days, given, strict=True):
        history.record_day(spark, snapshot(spark, **states_), path, keys, day)
    log = layers.read_layer(spark, path)
    # The third day changed nothing and has no partition.
    assert rows(log.groupBy("changed_on").count()) == [(days[0], 3), (days[1], 2), (days[3], 3), (days[4], 1)]
    intervals = history.validity_intervals(log, keys).drop("j")
    assert rows(intervals, "k", "v", "change", "valid_from", "valid_to") == sorted([
        (1, 1.0, "inserted", days[0], days[3]), (1, 1.0, "inserted", days[4], None),
        (2, 2.0, "inserted", days[0], days[1]), (2, 2.5, "changed", days[1], days[3]),
        (3, 3.0, "inserted", days[1], None),
        (None, 9.0, "inserted", days[0], days[3]), (None, None, "changed", days[3], None),
    ], key=repr)
    for day, states_ in zip(days, given, strict=True):
        assert rows(history.snapshot_of(log, keys, day)) == rows(snapshot(spark, **states_)), day


def test_a_rerun_replaces_its_day_and_order_is_kept(spark, base):
    keys, path, day = ["k", "j"], f"{base}/history", dt.date(2024, 1, 1)
    later = day + dt.timedelta(days=1)
    history.record_day(spark, snapshot(spark, k1=1.0), path, keys, day)
    history.record_day(spark, snapshot(spark, k1=5.0, k2=1.0), path, keys, later)
    history.record_day(spark, snapshot(spark, k1=6.0), path, keys, later)
    assert rows(layers.read_layer(spark, path).where(F.col("changed_on") == later), "k", "v", "change") == [(1, 6.0, "changed")]
    history.record_day(spark, snapshot(spark, k1=1.0), path, keys, later)
    assert rows(layers.read_layer(spark, path), "k", "change") == [(1, "inserted")]
    history.record_day(spark, snapshot(spark, k1=2.0), path, keys, later)
    with pytest.raises(ValueError, match="already"):
        history.record_day(spark, snapshot(spark, k1=1.0), path, keys, day)


def test_columns_named_like_the_helpers_are_kept(spark, base):
    df = spark.createDataFrame([(1, 2, 3)], "k INT, _was INT, _known INT")
    for day, value in ((AS_OF, 3), (AS_OF + dt.timedelta(days=1), 4)):
        history.record_day(spark, df.withColumn("_known", F.lit(value)), f"{base}/h", ["k"], day)
    log = layers.read_layer(spark, f"{base}/h")
    assert rows(history.snapshot_of(log, ["k"], AS_OF + dt.timedelta(days=1))) == [(1, 2, 4)] and log.count() == 2
    with pytest.raises(ValueError, match="history's own"):
        history.record_day(spark, df.withColumn("Change", F.lit(1)), f"{base}/other", ["k"], AS_OF)


def test_what_is_valid_is_read_without_the_other_columns(spark, base):
    history.record_day(spark, snapshot(spark, k1=1.0), f"{base}/h", ["k", "j"], AS_OF)
    plan = plan_of(history.valid_rows(layers.read_layer(spark, f"{base}/h"), ["k", "j"], AS_OF))
    assert "v:double" not in plan and "PartitionFilters: [isnotnull(changed_on" in plan


def test_digest_tells_nulls_and_places_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a|~", ""), ("a", "~"), ("", ""), (None, None)], "x STRING, y STRING")
    assert df.select(row_digest(df)).distinct().count() >= 5


# ---- buckets ----


def test_bucketed_join_has_no_exchange(spark, base, database):
    facts = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(200)], "k INT, f INT")
    lookup = spark.createDataFrame([(k, f"c{k}") for k in range(5)], "k INT, name STRING")
    bucketed.write_bucketed(facts, database, "facts", "k", 4, f"{base}/facts")
    bucketed.write_bucketed(lookup, database, "names", "k", 4, f"{base}/names")
    for how in ("left", "inner"):
        joined = bucketed.bucketed_join(spark, f"{database}.facts", f"{database}.names", "k", how)
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert rows(joined) == rows(facts.join(lookup, "k", how).select("k", "f", "name"))
    assert bucketed.heaviest_share(facts, "k") == pytest.approx(40 / 200)
    assert bucketed.heaviest_share(facts.limit(0), "k") == 0.0


# ---- lineage ----


def test_reach_ends_in_circles_and_names_the_shortest_way(spark):
    edges = [("landing/a", "bronze/a"), ("bronze/a", "silver/x"), ("silver/x", "gold/m"), ("gold/m", "silver/x"),
             ("gold/m", "silver/y"), ("bronze/a", "silver/y"), ("silver/y", "gold/n"), ("landing/b", "landing/b"),
             ("landing/a", "bronze/a"), (None, "gold/m"), ("landing/a", None)]
    log = spark.createDataFrame([(*e, 1) for e in edges], "source STRING, target STRING, n_rows LONG")
    got = rows(runlog.lineage_reach(log, "landing"))
    assert got == [("landing/a", t, d) for t, d in sorted({"bronze/a": 1, "gold/m": 3, "gold/n": 3, "silver/x": 2, "silver/y": 2}.items())]
    assert rows(runlog.lineage_reach(log, "landing", "gold/"), "target") == [("gold/m",), ("gold/n",)]
    assert runlog.lineage_reach(log.limit(0), "landing").count() == 0
    chain = spark.createDataFrame([(f"landing/{i}", f"landing/{i + 1}", 1) for i in range(30)], log.schema)
    assert runlog.lineage_reach(chain, "landing").agg(F.max("depth")).first()[0] == 30
    with pytest.raises(Exception, match="RECURSION"):
        runlog.lineage_reach(chain, "landing", max_depth=10).collect()
