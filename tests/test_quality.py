import datetime as dt
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.operators import quality as q
from strataflow.operators.aggregates import (
    column_statistics,
    contract_mart,
    market_share,
    number_in_text,
    retention_rate,
)
from strataflow.plans.gate import bronze_to_silver_gate
from tests.conftest import AS_OF, plan_of, rows

CLAIMS = "claim INT, opened DATE, state STRING, paid DECIMAL(9,2)"
OPENED = dt.date(2025, 11, 30)


def values(results, check):
    picked = results.where(F.col("check_name") == check).collect()
    return {r.column_name: (r.value, r.status) for r in picked}


def claims(spark, *changed):
    """Five claims of one day, some of them with other values."""
    whole = [(i, OPENED, "open" if i % 2 else "paid", Decimal(i)) for i in range(5)]
    return spark.createDataFrame([dict(changed).get(i, row) for i, row in enumerate(whole)], CLAIMS)


def test_clean_rows_pass(spark):
    results = q.validate_bronze(claims(spark), "claims").cache()
    assert values(results, "row_count") == {None: (5.0, "PASS")}
    assert set(values(results, "null_count").values()) == {(0.0, "PASS")}
    assert values(results, "row_duplicates") == {None: (0.0, "PASS")}
    assert values(results, "data_freshness") == {}
    assert q.dataset_outcomes(results).first().passed is True


def test_nulls_warn_but_do_not_fail(spark):
    gaps = claims(spark, (1, (1, None, None, None)), (4, (None, OPENED, None, Decimal(4))))
    results = q.validate_bronze(gaps, "gaps").cache()
    found = {"claim": (1.0, "WARN"), "opened": (1.0, "WARN"), "state": (2.0, "WARN"), "paid": (1.0, "WARN")}
    assert values(results, "null_count") == found
    outcome = q.dataset_outcomes(results).first()
    assert outcome.passed is True and outcome.n_warnings == 4


def test_rows_that_repeat_with_nulls_in_them(spark):
    copy = (0, None, "open", None)
    repeated = claims(spark, (0, copy), (2, copy), (3, copy))
    assert values(q.validate_bronze(repeated, "copies"), "row_duplicates") == {None: (2.0, "WARN")}
    assert values(q.row_duplicates(repeated, "copies", q.FAIL), "row_duplicates") == {None: (2.0, "FAIL")}


def test_two_checks_of_a_kind_in_one_run(spark):
    df = spark.createDataFrame(
        [(None, None, "1", dt.date(2026, 3, 1), dt.date(2026, 3, 7)), (1, None, "x", None, None)],
        "a INT, b INT, t STRING, created_at DATE, ingestion_date DATE",
    )
    checks = [q.critical_nulls(["a"]), q.critical_nulls(["b"])]
    checks += [q.freshness(df, [n], as_of=AS_OF) for n in ("created_at", "ingestion_date")]
    checks += [q.type_conformance(df, {"t": kind}) for kind in ("int", "double", "date")]
    parts = {"year": "a"}
    checks += [q.partition_conformance(df, n, parts) for n in ("created_at", "ingestion_date")]
    found = q.run_checks(df, "t", checks).select("check_name", "detail", "value").collect()
    assert [(r.check_name, r.value) for r in found] == [
        ("critical_nulls", 1.0),
        ("critical_nulls", 2.0),
        ("data_freshness", 7.0),
        ("data_freshness", 1.0),
        ("type_conformance", 1.0),
        ("type_conformance", 1.0),
        ("type_conformance", 2.0),
        ("partition_conformance", 2.0),
        ("partition_conformance", 2.0),
    ]


def test_amounts_a_mart_leaves_out_are_counted(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, None, float("nan"), float("-inf"), 1e30, 10.005)], "v DOUBLE")
    assert values(q.run_checks(df, "t", [q.amount_conformance(["v"])]), "amount_conformance") == {"v": (3.0, "WARN")}


@pytest.mark.parametrize(
    ("premiums", "mean", "total"),
    [
        ((float("nan"), 10.005), 10.01, 10.0),
        ((float("inf"), 4.0, None), 4.0, 4.0),
        ((1e30, 2.0), 2.0, 2.0),
        ((10.005, 10.005), 10.01, 20.0),
        ((float("nan"),), None, None),
    ],
)
def test_mart_means_count_what_they_sum(spark, premiums, mean, total):
    df = spark.createDataFrame(
        [("Auto", i, 1, p, 3, 2) for i, p in enumerate(premiums)],
        "type_vehicule STRING, nucon INT, nusoc INT, prmaco DOUBLE, anciennete_contrat INT, nb_garanties INT",
    )
    row = contract_mart(df).first()
    assert (row.total_contracts, row.avg_premium, row.total_premium) == (len(premiums), mean, total)


def test_empty_table_fails_without_an_exception(spark):
    empty = spark.createDataFrame([], CLAIMS)
    for results in (q.validate_bronze(empty, "empty"), q.validate_silver(empty, "empty")):
        assert values(results, "row_count") == {None: (0.0, "FAIL")}
        assert q.dataset_outcomes(results).first().passed is False
    assert values(q.table_report(empty, "empty"), "null_percentage")["claim"] == (0.0, "PASS")
    assert values(q.key_duplicates(empty, ["claim"], "empty"), "key_duplicates") == {None: (0.0, "PASS")}


def test_percentages_round_to_two_places(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id INT, v STRING")
    assert values(q.run_checks(df, "t", [q.null_profile(["v"])]), "null_percentage") == {"v": (66.67, "WARN")}


def test_odd_names_and_quotes(spark):
    df = spark.createDataFrame([(1, None)], "`a b` INT, `it's ``x``.y` STRING")
    results = q.validate_bronze(df, "o'clock\\")
    assert values(results, "null_count") == {"a b": (0.0, "PASS"), "it's `x`.y": (1.0, "WARN")}
    assert results.first().dataset == "o'clock\\"
    assert q.validate_silver(df, "x").count() == 1 + 2 * 2 + 2 * 5


def test_critical_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a INT, b INT")
    check = q.critical_nulls
    assert values(q.run_checks(df, "t", [check(["a", "b"])]), "critical_nulls") == {None: (2.0, "WARN")}
    assert values(q.run_checks(df, "t", [check([])]), "critical_nulls") == {None: (0.0, "PASS")}
    named = check(["a"], q.FAIL, "null_dimensions")
    assert values(q.run_checks(df, "t", [named]), "null_dimensions") == {None: (1.0, "FAIL")}


def test_key_duplicates_count_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (2, 1)], "a INT, b INT")
    assert values(q.key_duplicates(df, ["a", "b"], "t"), "key_duplicates") == {None: (2.0, "WARN")}
    assert values(q.key_unique(df, ["a"], "t"), "key_unique") == {None: (2.0, "FAIL")}


@pytest.mark.parametrize(("limit", "status"), [(30, "PASS"), (2, "FAIL"), (None, "PASS")])
def test_freshness(spark, limit, status):
    df = spark.createDataFrame([(dt.date(2026, 3, 1),), (dt.date(2026, 3, 5),)], "ingestion_date DATE")
    result = q.run_checks(df, "t", [q.freshness(df, as_of=AS_OF, max_age_days=limit)]).first()
    assert (result.value, result.status, result.detail) == (3.0, status, "2026-03-05 00:00:00")
    empty = q.run_checks(df.limit(0), "t", [q.freshness(df, as_of=AS_OF, max_age_days=limit)]).first()
    assert empty.status == ("PASS" if limit is None else "FAIL")


def test_types(spark):
    df = spark.createDataFrame([("1", "x", 2.0), ("y", None, 1.0)], "a STRING, b STRING, c DOUBLE")
    checks = [q.type_conformance(df, {"a": "int", "b": "string", "c": "int", "d": "int"})]
    assert values(q.run_checks(df, "t", checks), "type_conformance") == {
        "a": (1.0, "FAIL"),
        "b": (0.0, "PASS"),
        "c": (0.0, "FAIL"),
        "d": (None, "FAIL"),
    }
    assert q.types_match(df, {"a": "string", "c": "double"}) is True
    assert q.types_match(df, {"a": "integer"}) is False and q.types_match(df, {"z": "string"}) is False


def test_expectations(spark):
    df = spark.createDataFrame([(1, 2)], "a INT, b INT")
    results = q.run_checks(df, "t", q.expectation_suite(df, ["a", "b"], 1, 5))
    assert {r.status for r in results.collect()} == {"PASS"}
    results = q.run_checks(df, "t", q.expectation_suite(df, ["b", "a"], 2))
    assert {r.status for r in results.collect()} == {"FAIL"}


def test_layer_growth(spark):
    assert values(q.layer_growth(spark.range(10), spark.range(11), "t"), "layer_growth") == {None: (10.0, "PASS")}
    assert values(q.layer_growth(spark.range(10), spark.range(12), "t"), "layer_growth") == {None: (20.0, "FAIL")}
    assert values(q.layer_growth(spark.range(0), spark.range(1), "t"), "layer_growth") == {None: (0.0, "FAIL")}


def test_partition_conformance(spark):
    df = spark.createDataFrame(
        [("2026-03-08", 2026, 3, 8), ("2026-03-09", 2026, 3, 8), ("junk", None, None, None)],
        "d STRING, year INT, month INT, day INT",
    )
    parts = {"year": "year", "month": "month", "day": "day"}
    results = q.run_checks(df, "t", [q.partition_conformance(df, "d", parts)])
    assert values(results, "partition_conformance") == {"year": (1.0, "FAIL"), "month": (1.0, "FAIL"), "day": (2.0, "FAIL")}
    missing = q.run_checks(df, "t", [q.partition_conformance(df, "d", {"year": "y"})])
    assert values(missing, "partition_conformance") == {"y": (None, "FAIL")}


def test_pass_rate(spark):
    results = q.run_checks(spark.range(1), "a", [q.non_empty()]).union(q.run_checks(spark.range(0), "b", [q.non_empty()]))
    assert q.pass_rate(results).first() == (2, 1, 1, 50.0)
    assert q.pass_rate(results.limit(0)).first() == (0, 0, 0, 0.0)
    assert rows(q.check_totals(results)) == [("a", "row_count", "PASS", 1), ("b", "row_count", "FAIL", 1)]


def test_statistics_read_numbers_in_text(spark):
    df = spark.createDataFrame([("10", 1.0), (" 30 ", 2.0), ("x", None), ("1d", 4.5)], "t STRING, v DOUBLE")
    stats = {r.column_name: r for r in column_statistics(df).collect()}
    assert (stats["t"].n, stats["t"].mean, stats["t"].min_text, stats["t"].max_text) == (4, 13.6667, " 30 ", "x")
    assert (stats["v"].n, stats["v"].mean, stats["v"].stddev, stats["v"].max_num) == (3, 2.5, 1.8028, 4.5)


pieces = st.sampled_from([*"0123456789.+-eEdDfFxX _", "nan", "NaN", "inf", "Infinity", "\t", "\u00a0", "a", "é"])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells=st.lists(st.lists(pieces, max_size=5).map("".join), min_size=40, max_size=80))
def test_the_test_for_numbers_loses_none(spark, cells):
    df = spark.createDataFrame([(c,) for c in cells], "t STRING")
    tested = number_in_text(df, "t")["_number_t"]
    odd = df.selectExpr("t", f"{tested} AS a", "try_cast(t AS DOUBLE) AS b").where("NOT (a <=> b)")
    assert odd.collect() == []


def test_any_number_of_checks_is_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    checks = [q.non_empty(), q.null_profile(df.columns), q.critical_nulls(df.columns), q.freshness(df, ["l_shipdate"])]
    for results in (q.run_checks(df, "t", checks), q.table_report(df, "t")):
        assert plan_of(results).count("FileScan") == 1
        assert "Python" not in plan_of(results)


def test_statistics_read_each_column_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for results in (q.validate_silver(df, "t"), column_statistics(df)):
        plan = plan_of(results)
        read = [re.findall(r"(\w+)#", part) for part in re.findall(r"FileScan parquet \[([^]]*)\]", plan)]
        assert len(read) == 2 and sorted(sum(read, [])) == sorted(df.columns)
        # numbers stay in the hash aggregation
        assert "HashAggregate" in plan and "SortAggregate" in plan


def test_business_ratios(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), ("b", None)], "g STRING, contrat_actif INT")
    assert retention_rate(df).first()[0] == 50.0
    assert retention_rate(df.limit(0)).first()[0] == 0.0
    assert market_share(df).first()[0] == 50.0
    assert rows(market_share(df.withColumnRenamed("contrat_actif", "on"), ["g"], "on")) == [("a", 50.0), ("b", 50.0)]


def test_gate_keeps_complete_rows(spark):
    gaps = claims(spark, (0, (0, OPENED, None, Decimal(1))), (3, (3, OPENED, "open", None)))
    promoted, results = bronze_to_silver_gate(gaps, "claims", ["state", "paid"], AS_OF)
    assert rows(promoted, "claim") == [(1,), (2,), (4,)]
    assert values(results, "null_count")["paid"] == values(results, "null_count")["state"] == (1.0, "WARN")
    assert values(results, "row_count") == {None: (5.0, "PASS")}
    assert {"ingestion_year", "transform_timestamp"} < set(promoted.columns)
