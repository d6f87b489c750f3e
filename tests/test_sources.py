import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataflow import session as session_module
from strataflow.sources import catalog, delimited, layers
from tests.conftest import plan_of, rows

SCHEMA = "id INT, name STRING, amount DOUBLE"


@pytest.fixture
def messy(base):
    path = f"{base}/messy.csv"
    Path(path).write_text("id,name,amount\n1,a,1.5\nx,b,2.5\n3,,oops\n4,d\n5,e,5.5,extra\n6,f,\n")
    return path


def test_bad_cells_are_null_and_rows_stay(spark, messy):
    out = delimited.scan_delimited(spark, messy, SCHEMA)
    assert rows(out) == sorted(
        [(1, "a", 1.5), (None, "b", 2.5), (3, None, None), (4, "d", None), (5, "e", 5.5), (6, "f", None)], key=repr
    )


def test_good_and_rejected_add_up(spark, messy, base):
    parsed = f"{base}/parsed"
    layers.write_layer(delimited.scan_delimited(spark, messy, SCHEMA, keep_rejects=True), parsed)
    good, rejected = delimited.split_rejects(layers.read_layer(spark, parsed))
    assert rows(good) == [(1, "a", 1.5), (6, "f", None)]
    assert rows(rejected, delimited.REJECT_COLUMN) == [("3,,oops",), ("4,d",), ("5,e,5.5,extra",), ("x,b,2.5",)]


def test_header_is_bound_by_position_unless_checked(spark, base):
    Path(f"{base}/swapped.csv").write_text("name,id,amount\n1,a,1.5\n")
    path = f"{base}/swapped.csv"
    assert rows(delimited.scan_delimited(spark, path, SCHEMA)) == [(1, "a", 1.5)]
    with pytest.raises(Exception, match="header|Header|does not conform"):
        delimited.scan_delimited(spark, path, SCHEMA, check_header=True).collect()


def days(spark, *pairs):
    return spark.createDataFrame(
        [(v, d.year, d.month, d.day) for v, d in pairs], "v STRING, year INT, month INT, day INT"
    )


D1, D2 = dt.date(2026, 3, 7), dt.date(2026, 3, 8)


def test_day_read_prunes_partitions(spark, base):
    layers.write_partitioned(days(spark, ("a", D1), ("b", D2)), base, layers.DAY_PARTS)
    one = layers.read_day(spark, base, D2)
    assert rows(one, "v") == [("b",)]
    assert "PartitionFilters: [isnotnull(year" in plan_of(one)
    assert Path(f"{base}/year=2026/month=3/day=8").is_dir()


def test_overwrite_replaces_all_or_only_touched_days(spark, base):
    layers.write_partitioned(days(spark, ("a", D1), ("b", D2)), base, layers.DAY_PARTS)
    layers.overwrite_partitions(days(spark, ("B", D2)), base, layers.DAY_PARTS)
    assert rows(layers.read_layer(spark, base), "v") == [("B",), ("a",)]
    layers.write_partitioned(days(spark, ("c", D1)), base, layers.DAY_PARTS)
    assert rows(layers.read_layer(spark, base), "v") == [("c",)]


def test_write_modes(spark, base):
    path = f"{base}/t"
    df = days(spark, ("a", D1))
    layers.write_partitioned(df, path, layers.DAY_PARTS, "error")
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        layers.write_partitioned(df, path, layers.DAY_PARTS, "error")
    layers.write_partitioned(df, path, layers.DAY_PARTS, "ignore")
    assert layers.read_layer(spark, path).count() == 1
    layers.write_partitioned(df, path, layers.DAY_PARTS, "append")
    assert layers.read_layer(spark, path).count() == 2


def test_audit_counts_without_reading_back(spark, base):
    audit = layers.audited_write(spark.range(50).repartition(5), f"{base}/t", "bronze", "t")
    assert (audit.rows, audit.status) == (50, "SUCCESS") and audit.seconds > 0
    assert layers.audited_write(spark.range(0), f"{base}/e", "bronze", "e").rows == 0
    assert layers.audit_frame(spark, [audit]).first()[:3] == ("bronze", "t", 50)


def test_target_size_sets_the_number_of_files(spark, base):
    df = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))

    def files(name, megabytes):
        layers.set_target_file_size(spark, megabytes)
        layers.write_layer(layers.rebalanced(df), f"{base}/{name}")
        return len(list(Path(f"{base}/{name}").glob("*.parquet")))

    try:
        assert files("large", 256) == 1
        assert files("small", 4) > 3
    finally:
        layers.set_target_file_size(spark)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    assert layers.read_layer(spark, f"{base}/small").count() == 400_000


def test_a_hot_partition_is_split_over_files(spark, base):
    df = spark.range(400_000).select(
        F.when(F.col("id") < 390_000, 1).otherwise(2).alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("h")
    )
    try:
        layers.set_target_file_size(spark, 2)
        layers.write_partitioned(df, base, ["day"])
    finally:
        layers.set_target_file_size(spark)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    assert len(list(Path(f"{base}/day=1").glob("*.parquet"))) > 1
    assert len(list(Path(f"{base}/day=2").glob("*.parquet"))) == 1


def test_stored_bytes_equal_the_files(spark, base):
    layers.write_partitioned(days(spark, ("a", D1), ("b", D2)), f"{base}/gold/one", layers.DAY_PARTS)
    layers.write_layer(spark.range(10), f"{base}/gold/two")
    got = {r.dataset: (r.size_bytes, r.n_files) for r in layers.stored_bytes(spark, f"{base}/gold", "gold").collect()}
    for name in ("one", "two"):
        sizes = [f.stat().st_size for f in Path(f"{base}/gold/{name}").rglob("*.parquet")]
        assert got[name] == (sum(sizes), len(sizes))


def test_catalog(spark, base):
    layers.write_partitioned(days(spark, ("a", D1), ("b", D2)), f"{base}/t", layers.DAY_PARTS)
    for _ in range(2):
        catalog.create_database(spark, "lake_test", "it's a test", f"{base}/db")
        catalog.create_external_table(spark, "lake_test", "t", f"{base}/t", {"v": "STRING"})
    assert spark.table("lake_test.t").count() == 0
    one = [{"year": 2026, "month": 3, "day": 8}]
    for _ in range(2):
        catalog.add_partitions(spark, "lake_test", "t", one)
    assert rows(spark.table("lake_test.t"), "v", "day") == [("b", 8)]
    catalog.recover_partitions(spark, "lake_test", "t")
    assert rows(spark.table("lake_test.t"), "v") == [("a",), ("b",)]
    spark.sql("DROP TABLE lake_test.t")
    assert layers.read_layer(spark, f"{base}/t").count() == 2


def test_scratch_folder_is_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session_module.scratch_path(spark, "x"), session_module.scratch_path(spark, "x")
    assert first.startswith(root) and first != second
