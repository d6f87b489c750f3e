import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow.operators import calendar, quality
from tests.conftest import AS_OF, rows


def test_ingestion_columns_from_the_run_day(spark):
    df = spark.createDataFrame([(4, None), (None, 2.5), (4, None)], "policy INT, premium DOUBLE")
    out = calendar.add_ingestion_columns(df, AS_OF)
    added = ["ingestion_year", "ingestion_month", "ingestion_day"]
    assert out.columns == [*df.columns, *added, "ingestion_timestamp"]
    assert rows(out, *df.columns, *added) == sorted([tuple(r) + (2026, 3, 8) for r in df.collect()], key=repr)
    assert calendar.add_ingestion_columns(df.limit(0), AS_OF).count() == 0


def test_ingestion_columns_from_a_text_date(spark):
    df = spark.createDataFrame([("2025-12-31",), ("not a date",), (None,)], "d STRING")
    out = calendar.add_ingestion_columns(df, AS_OF, "d")
    assert rows(out, "ingestion_year", "ingestion_day") == sorted([(2025, 31), (None, None), (None, None)], key=repr)
    # a column that is not there is no error: the run day counts
    assert {r[0] for r in calendar.add_ingestion_columns(df, AS_OF, "absent").select("ingestion_day").collect()} == {8}


def test_transform_columns(spark):
    out = calendar.add_transform_columns(spark.range(4).selectExpr("id", "nullif(id, 2) AS maybe"), AS_OF)
    assert rows(out, "transform_year", "transform_month", "transform_day") == [(2026, 3, 8)] * 4
    assert out.columns[:2] == ["id", "maybe"] and "transform_timestamp" in out.columns
    assert {r[0] for r in out.select("data_quality_score").collect()} == {0.0}


@pytest.mark.parametrize(
    ("schema", "row", "day"),
    [
        ("date DATE, transaction_date DATE", (dt.date(2024, 5, 6), dt.date(2023, 1, 1)), 6),
        ("transaction_date DATE", (dt.date(2023, 1, 2),), 2),
        ("v INT", (1,), 8),
    ],
)
def test_gold_columns_pick_their_date(spark, schema, row, day):
    out = calendar.add_gold_columns(spark.createDataFrame([row], schema), AS_OF, "weekly").first()
    assert (out.day, out.aggregation_level) == (day, "weekly")


def test_unknown_level_is_refused(spark):
    with pytest.raises(ValueError, match="hourly"):
        calendar.add_gold_columns(spark.range(1), AS_OF, "hourly")


def test_rollup_levels_add_up(spark):
    days = [dt.date(2024, 12, 29), dt.date(2024, 12, 30), dt.date(2025, 1, 1), dt.date(2025, 1, 1)]
    df = spark.createDataFrame([(d, 10) for d in days], "d DATE, amount INT")
    out = calendar.period_rollup(df, "d", "amount")
    assert {r[0] for r in out.groupBy("aggregation_level").agg(F.sum("n_rows").alias("n")).select("n").collect()} == {4}
    weeks = out.where("aggregation_level = 'weekly'")
    assert rows(weeks, "period_start", "total_amount") == [(dt.date(2024, 12, 23), 10), (dt.date(2024, 12, 30), 30)]


@pytest.mark.parametrize(
    ("columns", "present"),
    [("day INT, policy INT, month INT, year INT", True), ("year INT, month INT, policy INT", False), ("policy INT", False)],
)
def test_partition_columns_present(spark, columns, present):
    table = spark.createDataFrame([], columns)
    assert quality.has_partition_columns(table, ["year", "month", "day"]) is present
    assert quality.has_partition_columns(table, []) is True
