"""What a run leaves on disk while it goes on."""

import gzip
import time
from pathlib import Path

from strataflow.plans import registry, silver
from strataflow.plans.views import view
from strataflow.session import scratch_folder
from strataflow.sources import delimited, layers
from tests.conftest import AS_OF, SF, rows


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}


def children(plan):
    return [plan.children().apply(i) for i in range(plan.children().size())]


def nodes(plan):
    return [plan, *(below for child in children(plan) for below in nodes(child))]


def test_shuffle_files_of_a_write_do_not_outlast_it(spark, base):
    before, setting = shuffle_files(spark), spark.conf.get(layers.DROP_SHUFFLES, None)
    audit = layers.audited_write(spark.range(1000).repartition(3, "id").distinct(), f"{base}/t", "silver", "t")
    assert audit.rows == 1000
    end = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < end:  # they are dropped in the background
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(layers.DROP_SHUFFLES, None) == setting


def test_packed_landing_files_hold_the_same_rows_in_bounded_files(spark, base, monkeypatch):
    monkeypatch.setattr(delimited, "PACKED_ROWS", 40)
    contracts = view(spark, SF, "contrat2")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contracts.schema)
    for name, packed in (("plain", False), ("packed", True)):
        delimited.write_delimited(contracts, f"{base}/{name}", packed)
    assert rows(delimited.scan_delimited(spark, f"{base}/packed", schema)) == rows(
        delimited.scan_delimited(spark, f"{base}/plain", schema)
    )
    files = list(Path(f"{base}/packed").glob("*.csv.gz"))
    assert len(files) > 1 and not list(Path(f"{base}/packed").glob("*.csv"))
    assert all(len(gzip.open(f).read().splitlines()) <= 41 for f in files)


def test_columns_made_of_others_are_not_moved_to_the_join(spark):
    contrat2, contrat1, client = (view(spark, SF, n) for n in ("contrat2", "contrat1", "client"))
    plan = silver.silver_contracts(contrat2, contrat1, client, AS_OF)._jdf.queryExecution().optimizedPlan()
    joins = [node for node in nodes(plan) if node.nodeName() == "Join"]
    moved = {side.output().apply(i).name() for side in children(joins[0]) for i in range(side.output().size())}
    assert len(joins) == 1 and {"prmaco", "cateco", "asaico"} <= moved
    assert not moved & {*silver.DECODED, "anciennete_contrat"}


def test_landing_files_go_with_the_last_load_that_reads_them(spark):
    folder = Path(scratch_folder(spark).removeprefix("file:"))
    before = set(folder.glob("landing-*"))
    assert registry.QUERIES["silver_by_day"](spark, SF).count() == 2
    assert set(folder.glob("landing-*")) == before
