"""Which writes of a run are finished, so that a repeated run goes on where the last one stopped."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.sources.layers import WriteAudit, layer_path, read_layer

MANIFEST = (
    "run_date DATE, by_day BOOLEAN, run_id STRING, layer STRING, dataset STRING, state STRING, n_rows LONG, "
    "inputs STRING, at TIMESTAMP"
)
STARTED, FINISHED, SKIPPED = "STARTED", "FINISHED", "SKIPPED"


def manifest_rows(spark: SparkSession, base: str) -> DataFrame:
    """The whole manifest; two rows for each write: when it was started and when it was finished."""
    try:
        return read_layer(spark, layer_path(base, "logs", "manifest"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def fingerprint(spark: SparkSession, path: str) -> str:
    """Changes when a file below ``path`` does: from names, sizes and times, without opening one."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    seen = files.agg(F.count(F.lit(1)).alias("n"), F.sum(each).alias("s")).first()
    return f"{seen.n}-{seen.s}"


def combined(*inputs: object) -> str:
    return hashlib.md5("|".join(map(str, inputs)).encode()).hexdigest()


class Manifest:
    """The finished writes of a date, and the book in which this run enters its own.

    A write is left out by a resumed run if the last entry of its dataset says
    finished, for this date and from the same inputs.  Entries of other dates
    count as well where a dataset is not kept by day, because they replaced it;
    so does a write that was started and not finished.
    """

    def __init__(self, spark: SparkSession, base: str, as_of: dt.date, by_day: bool, run_id: str, resume: bool):
        self.spark, self.path = spark, layer_path(base, "logs", "manifest")
        self.head = (as_of, by_day, run_id)
        self.known: dict[tuple[str, str], tuple[str, int]] = {}
        if resume:
            book = manifest_rows(spark, base)
            if by_day:
                book = book.where(F.col("run_date") == F.lit(as_of))
            entry = F.struct("at", "state", "run_date", "by_day", "inputs", "n_rows")
            # Two entries of one write may bear one time; the finished one comes first in the alphabet.
            last = book.groupBy("layer", "dataset").agg(F.max_by(entry, F.struct("at", F.col("state") == FINISHED)).alias("e"))
            mine = last.where(
                (F.col("e.state") == FINISHED) & (F.col("e.run_date") == F.lit(as_of)) & (F.col("e.by_day") == F.lit(by_day))
            )
            self.known = {(r.layer, r.dataset): (r.e.inputs, r.e.n_rows) for r in mine.collect()}  # a row per dataset

    def _enter(self, layer: str, dataset: str, state: str, rows: int, inputs: str) -> None:
        row = (*self.head, layer, dataset, state, rows, inputs, dt.datetime.now(dt.timezone.utc))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").partitionBy("run_date").parquet(self.path)

    def step(self, log: list[WriteAudit], layer: str, dataset: str, inputs: str, write: Callable[[], object]) -> None:
        """``write``, which adds its audit to ``log``; or an audit that says it was finished before."""
        finished = self.known.get((layer, dataset))
        if finished and finished[0] == inputs:
            log.append(WriteAudit(layer, dataset, finished[1], 0.0, SKIPPED))
            return
        self._enter(layer, dataset, STARTED, 0, inputs)
        first = len(log)
        write()
        rows = next(a.rows for a in log[first:] if (a.layer, a.dataset) == (layer, dataset))
        self._enter(layer, dataset, FINISHED, rows, inputs)
