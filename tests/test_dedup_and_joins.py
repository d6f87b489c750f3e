import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.operators import aggregates
from strataflow.operators.dedup import dedup_by_priority, union_sources
from strataflow.operators.joins import balanced_join
from strataflow.plans import gold, silver
from strataflow.plans.views import view
from tests.conftest import AS_OF, SF, plan_of, rows


def test_union_matches_by_name_and_rejects_missing(spark):
    a, b = spark.createDataFrame([(1, "a")], "k INT, v STRING"), spark.createDataFrame([("b", 2)], "v STRING, k INT")
    assert rows(union_sources(a, b)) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN|cannot resolve|Cannot resolve"):
        union_sources(a, b.drop("v")).collect()


def test_first_source_wins_and_null_keys_meet(spark):
    newer = spark.createDataFrame([(1, 1, "n"), (2, 1, "n2"), (2, 1, "n1")], "k INT, j INT, v STRING")
    older = spark.createDataFrame([(1, 1, "a"), (3, 1, "a"), (None, None, "z"), (None, None, "y")], newer.schema)
    assert rows(dedup_by_priority(["k", "j"], newer, older)) == sorted(
        [(1, 1, "n"), (2, 1, "n1"), (3, 1, "a"), (None, None, "y")], key=repr
    )


def test_survivor_does_not_depend_on_layout(spark):
    data = [(i % 7, random.Random(i).random(), str(i % 3)) for i in range(500)]
    df = spark.createDataFrame(data, "k INT, v DOUBLE, w STRING")
    once = rows(dedup_by_priority(["k"], df.repartition(1)))
    assert once == rows(dedup_by_priority(["k"], df.repartition(9)))


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    assert plan_of(dedup_by_priority(["k"], df)).count("WindowGroupLimit") == 2


keys = st.one_of(st.none(), st.integers(0, 4))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=st.lists(keys, min_size=1, max_size=40), lookup=st.lists(keys, max_size=8))
@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
def test_balanced_join_is_the_plain_join(spark, how, facts, lookup):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(facts)], "k INT, f INT")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(lookup)], "k INT, r INT")
    got = balanced_join(left, right, "k", how)
    plain = left.join(right, "k", how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
}


@pytest.fixture
def splitting(spark):
    """Sizes from which adaptive execution splits a partition, brought down to those of the test."""
    before = {key: spark.conf.get(key, None) for key in SPLITTING}
    for key, value in SPLITTING.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("hot", ["7", "CAST(NULL AS INT)"])
@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_a_hot_key_is_split_even_after_a_dedup_of_the_lookup(spark, splitting, how, hot):
    facts = spark.range(60_000, numPartitions=8).select(
        F.expr(f"IF(id % 3 > 0, {hot}, CAST(id AS INT))").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    numbers = spark.range(60_000).where("id <> 7").select(F.col("id").cast("int").alias("k"), "id")
    joined = balanced_join(facts, dedup_by_priority(["k"], numbers), "k", how)
    assert len(joined.collect()) == (60_000 if how == "left" else 40_000)
    assert "SortMergeJoin(skew=true)" in plan_of(joined)


def test_an_anti_join_moves_each_lookup_key_once(spark):
    facts, lookup = spark.range(10).selectExpr("id AS k"), spark.range(1000).selectExpr("id % 3 AS k", "id AS r")
    joined = balanced_join(facts, lookup, "k", "left_anti")
    assert rows(joined) == [(i,) for i in range(3, 10)] and "HashAggregate" in plan_of(joined)


def test_columns_named_like_the_helpers_survive(spark):
    rows_ = [(1, 10, 20, 30), (1, 11, 21, 31), (2, None, 5, 6)]
    df = spark.createDataFrame(rows_, "k INT, _rank INT, _source INT, _JOIN_KEY INT")
    kept = dedup_by_priority(["k"], df)
    assert kept.columns == df.columns
    assert rows(kept) == [(1, 10, 20, 30), (2, None, 5, 6)]
    lookup = spark.createDataFrame([(1, "a")], "k INT, _join_key_ STRING")
    assert rows(balanced_join(df, lookup, "k", "left_semi")) == rows_[:2]
    assert rows(balanced_join(df, lookup, "k")) == sorted([(*rows_[0], "a"), (*rows_[1], "a"), (*rows_[2], None)], key=repr)


def test_the_contract_mart_moves_only_its_columns(spark):
    contrat2, contrat1 = view(spark, SF, "contrat2"), view(spark, SF, "contrat1")
    mart = gold.contract_analysis_from_bronze(contrat2, contrat1, AS_OF)
    whole = aggregates.contract_mart(silver.clean_contracts(contrat2, contrat1, as_of=AS_OF))
    assert rows(mart) == rows(whole)
    # Sorted on the way: the key, the source, the digest and what the mart takes.
    plan = plan_of(mart)
    orders = [re.findall(r"(\w+)#\d+L? (?:ASC|DESC)", x) for x in plan.splitlines() if " Sort [" in x and "_source" in x]
    assert orders and all(len(o) <= 8 for o in orders)
