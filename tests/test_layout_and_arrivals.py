import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strataflow.operators import sketches
from strataflow.sources import catalog, delimited, layers, layout
from strataflow.streaming import ingest
from tests.conftest import AS_OF, plan_of, rows

# ---- layout ----


def bounds_of(path, column):
    found = []
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            found.append((s.min, s.max))
    return found


def share_read(path, column, values):
    groups = bounds_of(path, column)
    return sum(a <= v <= b for a, b in groups for v in values) / (len(groups) * len(values))


def test_groups_are_skipped_for_either_column(spark, base):
    df = spark.range(40_000).select(
        (F.xxhash64("id") % 1000).alias("a"), (F.pow(F.rand(1), 3) * 1e6).alias("b"), F.col("id"), F.lit("x").alias("_key")
    )
    df.write.parquet(f"{base}/source")
    source = spark.read.parquet(f"{base}/source")
    layout.write_clustered(source, f"{base}/near", ["a", "b"], files=16)
    source.repartition(16).write.parquet(f"{base}/plain")
    assert rows(spark.read.parquet(f"{base}/near")) == rows(source)
    some = source.sample(0.01, 1).collect()
    for column in ("a", "b"):
        values = [r[column] for r in some]
        assert share_read(f"{base}/plain", column, values) > 0.95
        assert share_read(f"{base}/near", column, values) < 0.45


def test_a_look_up_skips_groups_by_bloom_filter(spark, base):
    df = spark.range(30_000).select((F.col("id") * 7919 % 1_000_003).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    for name, bloom in (("with", {"key": 30_000}), ("without", None)):
        layout.write_clustered(df, f"{base}/{name}", ["key"], bloom=bloom, bits=1, files=1)
    sizes = {n: sum(f.stat().st_size for f in Path(f"{base}/{n}").glob("*.parquet")) for n in ("with", "without")}
    assert sizes["with"] > sizes["without"] + 20_000
    present = df.first().key
    absent = present + 1
    read = spark.read.parquet(f"{base}/with")
    assert read.where(F.col("key") == present).count() == 1
    assert read.where(F.col("key") == absent).count() == df.where(F.col("key") == absent).count()
    assert f"EqualTo(key,{absent})" in plan_of(read.where(F.col("key") == absent))


def test_keys_of_dates_nulls_and_constants(spark, base):
    df = spark.sql(
        "SELECT DATE '2024-01-01' + CAST(id AS INT) AS d, IF(id % 3 = 0, NULL, id) AS n, 5 AS c, CAST('2024-01-01' AS TIMESTAMP_NTZ) AS t "
        "FROM range(50)"
    )
    layout.write_clustered(df, f"{base}/k", ["d", "n", "c", "t"], bits=3)
    assert rows(spark.read.parquet(f"{base}/k")) == rows(df)
    layout.write_clustered(df.limit(0), f"{base}/none", ["d", "n"])
    assert spark.read.parquet(f"{base}/none").count() == 0
    with pytest.raises(ValueError, match="62 bits"):
        layout.interleaved_key(df, {"d": [], "n": []}, bits=40)


# ---- sketches ----


def test_merged_days_equal_the_whole(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 17).alias("day"), (F.xxhash64("id") % 5_000).alias("x"), F.when(F.col("id") % 3 > 0, F.rand(2) * 100).alias("y"),
        F.lit(None).cast("int").alias("z"), F.lit("text").alias("w"),
    )
    days = sketches.sliced_profiles(df, F.col("day"))
    assert days.count() == 17 * 4
    merged = {r.column_name: r for r in sketches.merged_profiles(days).collect()}
    whole = {r.column_name: r for r in sketches.merged_profiles(sketches.sliced_profiles(df, F.lit(0))).collect()}
    exact = df.agg(F.count_distinct("x").alias("x"), F.count_distinct("y").alias("y")).first()
    for name in ("x", "y", "z"):
        assert tuple(merged[name])[:6] == tuple(whole[name])[:6]
    for name in ("x", "y"):
        assert merged[name].n_distinct == pytest.approx(exact[name], rel=0.04)
        for share, value in zip(sketches.QUARTILES, merged[name].quantiles, strict=True):
            below = df.where(F.col(name) <= value).count() / merged[name].n
            assert below == pytest.approx(share, abs=0.01)
    assert (merged["z"].n, merged["z"].n_null, merged["z"].quantiles, merged["z"].n_distinct) == (0, 20_000, None, 0)
    some = sketches.merged_profiles(days.where("slice < 5")).where("column_name = 'x'").first()
    assert some.n == df.where("day < 5").count()
    assert sketches.merged_profiles(sketches.sliced_profiles(df.limit(0), F.col("day"))).count() == 0


# ---- arrivals ----

SCHEMA = "id INT, name STRING"


def test_batches_that_come_again_add_nothing(spark, base):
    landing, path, state = Path(f"{base}/landing"), f"{base}/bronze", f"{base}/state"
    landing.mkdir()
    for day in range(3):
        (landing / f"f{day}.csv").write_text(f"id,name\n{day},a\n{day}0,\n")
        query = ingest.start_ingest(spark, str(landing), SCHEMA, path, state, AS_OF + dt.timedelta(days=day))
        query.awaitTermination()
    stored = layers.read_layer(spark, path)
    parts = ["id", "name", "ingestion_day", "ingestion_batch"]
    once = rows(stored, *parts)
    assert once == sorted([(d * m, n, 8 + d, d) for d in range(3) for m, n in ((1, "a"), (10, None))], key=repr)
    # Stopped between the write and the commit: the commit of the last batch is gone, and it comes again a day later.
    for name in Path(state, "commits").glob("*2*"):
        name.unlink()
    ingest.start_ingest(spark, str(landing), SCHEMA, path, state, AS_OF + dt.timedelta(days=9)).awaitTermination()
    assert rows(layers.read_layer(spark, path), *parts) == once
    ingest.start_ingest(spark, str(landing), SCHEMA, path, state, AS_OF).awaitTermination()
    assert rows(layers.read_layer(spark, path), *parts) == once


# ---- headers ----


def test_files_are_bound_by_their_own_header(spark, base):
    folder = Path(f"{base}/with blank")
    (folder / "deep").mkdir(parents=True)
    (folder / "a.csv").write_text("id,name,amount\n1,a,1.5\n")
    (folder / "b b.csv").write_text('﻿name, "amount",id\nb,2.5,2\n')
    (folder / "deep" / "c.csv").write_text("amount,id,name\n3.5,3,c\n4.5,4,\n")
    (folder / "short.csv").write_text("id,name\n9,z\n")
    (folder / "none.csv").write_text("7,seven,7.5\n")
    schema = "id INT, name STRING, amount DOUBLE"
    good, apart = delimited.scan_by_header(spark, str(folder), schema)
    assert good.columns == ["id", "name", "amount"]
    assert rows(good) == [(1, "a", 1.5), (2, "b", 2.5), (3, "c", 3.5), (4, None, 4.5)]
    assert sorted(r.file.rsplit("/", 1)[-1] for r in apart.collect()) == ["none.csv", "short.csv"]
    bad, apart = delimited.scan_by_header(spark, str(folder / "short.csv"), schema)
    assert bad.count() == 0 and bad.columns == good.columns and apart.count() == 1


# ---- column statistics ----


def test_statistics_change_the_join(spark, base):
    catalog.create_database(spark, "tests_of_stats", "", f"{base}/db")
    big = spark.range(20_000).selectExpr("id", "id % 5000 AS k", "sha2(CAST(id AS STRING), 256) AS v")
    big.write.option("path", f"{base}/big").saveAsTable("tests_of_stats.big")
    other = spark.range(20_000).selectExpr("id AS k", "sha2(CAST(id AS STRING), 512) AS w")
    other.write.option("path", f"{base}/other").saveAsTable("tests_of_stats.other")

    def plan():
        return plan_of(spark.sql("SELECT * FROM tests_of_stats.other o JOIN tests_of_stats.big b ON o.k = b.k WHERE b.id = 77"))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        assert "SortMergeJoin" in plan()
        empty = catalog.column_stats(spark, "tests_of_stats", "big", ["id"])
        assert rows(empty) == [("id", None, None, None, None)]
        catalog.analyze_columns(spark, "tests_of_stats", "big")
        catalog.analyze_columns(spark, "tests_of_stats", "other", ["k"])
        catalog.use_statistics(spark)
        assert "BroadcastHashJoin" in plan()
        known = catalog.column_stats(spark, "tests_of_stats", "big", ["id", "v"]).collect()
        assert tuple(known[0])[:4] == ("id", "0", "19999", "0") and known[1].num_nulls == "0"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        catalog.use_statistics(spark, False)
