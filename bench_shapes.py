"""Time three of this package's operators against ordinary Spark code for the same rows: ``python bench_shapes.py``.

The join is timed on even keys and on keys of which one holds a third of the rows.  Medians of three after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow import contracts as c
from strataflow.operators import aggregates
from strataflow.operators.joins import balanced_join
from strataflow.plans.silver import conform, unique_clients, unique_contracts
from strataflow.plans.views import view
from strataflow.session import build_session


def seconds(make: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = build_session("shapes", f"local[{cpus}]", **quiet, **{"spark.sql.shuffle.partitions": cpus})
    spark.sparkContext.setLogLevel("ERROR")
    newer, older, clients = (view(spark, sf_dir, n) for n in ("contrat2", "contrat1", "client"))
    contracts, lookup = conform(newer), unique_clients(clients)
    hot = contracts.withColumn(c.CLIENT_KEY, F.expr("IF(nucon % 3 = 0, 7, nusoc)"))
    both = conform(newer).unionByName(conform(older))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    pairs = {
        "join, even keys": (lambda: balanced_join(contracts, lookup, c.CLIENT_KEY), lambda: contracts.join(lookup, c.CLIENT_KEY, "left")),
        "join, one hot key": (lambda: balanced_join(hot, lookup, c.CLIENT_KEY), lambda: hot.join(lookup, c.CLIENT_KEY, "left")),
        "one row per key": (lambda: unique_contracts(newer, older), lambda: both.dropDuplicates(c.CONTRACT_KEY)),
        "column statistics": (lambda: aggregates.column_statistics(lines), lambda: lines.summary("count", "mean", "stddev", "min", "max")),
    }
    report = {}
    for name, forms in pairs.items():
        timed = []
        for form in forms:
            seconds(form)
            timed.append(round(statistics.median(seconds(form) for _ in range(3)), 2))
        report[name] = dict(zip(("package", "ordinary"), timed, strict=True))
    spark.stop()
    print(json.dumps({"sf": os.path.basename(sf_dir), "cpus": cpus, "seconds": report}))


if __name__ == "__main__":
    main()
