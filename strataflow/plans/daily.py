"""One run for a date: bronze, silver, then both gold tables.

    python -m strataflow.plans.daily --landing DIR --base DIR [--execution-date YYYY-MM-DD] [--job NAME] [--resume]
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys
import time
import uuid
from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.contracts import BRONZE_DATASETS, CONTRACT_KEY, SILVER_DATASET
from strataflow.functions.sqltext import quoted
from strataflow.operators import quality
from strataflow.operators.calendar import add_gold_columns, add_transform_columns
from strataflow.operators.dedup import union_sources
from strataflow.plans.bronze import ingest_bronze, read_bronze
from strataflow.plans.gold import client_profile, contract_analysis
from strataflow.plans.manifest import Manifest, combined, fingerprint
from strataflow.plans.silver import silver_contracts
from strataflow.session import build_session
from strataflow.sources.archive import archive_landed
from strataflow.sources.catalog import create_database
from strataflow.sources.layers import (
    WriteAudit,
    audited_input,
    audited_write,
    error_class,
    layer_path,
    read_day,
    read_layer,
    set_target_file_size,
    stored_bytes,
)
from strataflow.sources.versions import expire_versions, publish_version

RUN_LOG = (
    "run_date DATE, run_id STRING, event_ts TIMESTAMP, job_name STRING, status STRING, error STRING, "
    "error_class STRING, duration_seconds DECIMAL(12,2), records_in LONG, records_out LONG"
)
WRITE_LOG = "run_date DATE, run_id STRING, layer STRING, dataset STRING, n_rows LONG, seconds DOUBLE, status STRING"
LINEAGE_LOG = "run_date DATE, run_id STRING, source STRING, target STRING, n_rows LONG"


SILVER_PARTS = ["transform_year", "transform_month", "transform_day"]
GOLD_PARTS = ["year", "month", "day"]


def replace_dataset(
    df: DataFrame,
    base: str,
    layer: str,
    dataset: str,
    parts: Sequence[str] = (),
    files: int | None = None,
    log: list[WriteAudit] | None = None,
    database: str | None = None,
) -> WriteAudit:
    """Write a dataset of a layer: the partitions its rows belong to, or the whole of it.

    With ``database`` a whole dataset is a table there, which is swapped: its readers see the old or the new rows.
    """
    path = layer_path(base, layer, dataset)
    if database and not parts:
        return publish_version(df.sparkSession, df, database, dataset, path, log, layer, files)
    return audited_write(df, path, layer, dataset, files=files, replace_partitions=parts, log=log)


def run_silver(
    spark: SparkSession,
    base: str,
    as_of: dt.date,
    by_day: bool = False,
    log: list[WriteAudit] | None = None,
    database: str | None = None,
) -> list[WriteAudit]:
    """The write follows the last shuffle of the plan, whose partitions adaptive execution has sized already.

    With ``by_day`` the landing files are a day's snapshot: silver has a partition for each day, made of that day's
    bronze, and a rerun replaces its own day only.
    """
    day = as_of if by_day else None
    bronze = [read_bronze(spark, base, name, day) for name in ("Contrat2", "Contrat1", "Client")]
    silver, parts = silver_contracts(*bronze, as_of=as_of), []
    if by_day:
        silver, parts = add_transform_columns(silver, as_of), SILVER_PARTS
    return [replace_dataset(silver, base, "silver", SILVER_DATASET, parts, log=log, database=database)]


def read_silver(spark: SparkSession, base: str, day: dt.date | None = None, database: str | None = None) -> DataFrame:
    """Silver, or the snapshot of a day without its partition columns; from its table where it is one."""
    if database and day is None:
        return spark.table(f"{quoted(database)}.{quoted(SILVER_DATASET)}")
    path = layer_path(base, "silver", SILVER_DATASET)
    if day is None:
        return read_layer(spark, path)
    return read_day(spark, path, day, SILVER_PARTS).drop(*SILVER_PARTS, "transform_timestamp", "data_quality_score")


# Each mart, and the number of its files where it has few rows.
GOLD_MARTS: dict[str, tuple[Callable[[DataFrame], DataFrame], int | None]] = {
    "client_profile_analysis": (client_profile, None),
    "contract_analysis": (contract_analysis, 1),
}


def run_gold(
    spark: SparkSession,
    base: str,
    as_of: dt.date,
    by_day: bool = False,
    log: list[WriteAudit] | None = None,
    marts: Sequence[str] = tuple(GOLD_MARTS),
    database: str | None = None,
) -> list[WriteAudit]:
    """Each mart reads only its own columns of silver, so silver is not cached.  With ``by_day`` each day keeps its marts."""
    silver = read_silver(spark, base, as_of if by_day else None, database)
    audits = []
    for name in marts:
        plan, files = GOLD_MARTS[name]
        mart = plan(silver)
        parts = GOLD_PARTS if by_day else []
        frame = add_gold_columns(mart, as_of) if by_day else mart
        audits.append(replace_dataset(frame, base, "gold", name, parts, files, log, database))
    return audits


class RunJournal:
    """Collects what the jobs of one run did; a handful of rows, added to the logs once at the end.

    The logs are partitioned by run date and keep every run, failed ones and
    reruns too, told apart by run id.
    """

    def __init__(self, as_of: dt.date):
        self.as_of, self.run_id = as_of, uuid.uuid4().hex
        self.runs: list[tuple] = []
        self.writes: list[tuple] = []
        self.edges: list[tuple] = []

    def job(
        self, name: str, sources: list[str], rows_in: int | None, work: Callable[[list[WriteAudit]], list[WriteAudit]]
    ) -> list[WriteAudit]:
        """Runs ``work``, which adds an audit to the list it is given for each write as it ends, well or not."""
        at, started = dt.datetime.now(dt.timezone.utc), time.monotonic()
        audits: list[WriteAudit] = []
        status, error, kind = "SUCCESS", None, None
        try:
            work(audits)
        except Exception as failure:
            status, error, kind = "FAILURE", type(failure).__name__, error_class(failure)
            raise
        finally:
            seconds = Decimal(str(round(time.monotonic() - started, 2)))
            head = (self.as_of, self.run_id)
            self.runs.append((*head, at, name, status, error, kind, seconds, rows_in, sum(a.rows for a in audits)))
            self.writes += [(*head, a.layer, a.dataset, a.rows, a.seconds, a.status) for a in audits]
            for a in (a for a in audits if a.status == "SUCCESS"):
                # A landing file feeds the bronze dataset of its own name only.
                feeding = [s for s in sources if a.layer != "bronze" or s.split("/")[-1] == f"{a.dataset}.csv"]
                self.edges += [(*head, source, f"{a.layer}/{a.dataset}", a.rows) for source in feeding]
        return audits

    def save(self, spark: SparkSession, base: str) -> None:
        for name, schema, rows in [
            ("run_log", RUN_LOG, self.runs),
            ("write_log", WRITE_LOG, self.writes),
            ("lineage", LINEAGE_LOG, self.edges),
        ]:
            if rows:
                log = spark.createDataFrame(rows, schema).coalesce(1)
                log.write.mode("append").partitionBy("run_date").parquet(layer_path(base, "logs", name))


def log_state(
    spark: SparkSession, base: str, as_of: dt.date, run_id: str, by_day: bool = False, database: str | None = None
) -> None:
    """Adds the silver checks of this run, and the bytes that each layer now takes, to the logs.

    ``check_results`` is the history that ``quality.quality_kpis`` reads; ``data_volume`` has a row per dataset and run.
    """
    at = dt.datetime.now(dt.timezone.utc)
    marks = {"run_date": F.lit(as_of), "run_id": F.lit(run_id), "run_at": F.lit(at)}
    silver = read_silver(spark, base, as_of if by_day else None, database)
    checks = [
        quality.non_empty(),
        quality.critical_nulls(CONTRACT_KEY),
        quality.amount_conformance(["prmaco"]),
    ]
    results = quality.run_checks(silver, SILVER_DATASET, checks)
    results = results.unionByName(quality.key_duplicates(silver, CONTRACT_KEY, SILVER_DATASET))
    volumes = []
    for layer in ("bronze", "silver", "gold"):
        try:
            volumes.append(stored_bytes(spark, f"{base.rstrip('/')}/{layer}", layer))
        except AnalysisException as error:  # a layer that no job has written yet
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    for name, rows in (("check_results", results), ("data_volume", union_sources(*volumes))):
        # A row per check, and per dataset.
        log = rows.withColumns(marks).coalesce(1)
        log.write.mode("append").partitionBy("run_date").parquet(layer_path(base, "logs", name))


JOBS = ("bronze_ingest", "silver_transform", "gold_transform")


def run_day(
    spark: SparkSession,
    landing: str,
    base: str,
    as_of: dt.date,
    by_day: bool = False,
    resume: bool = False,
    jobs: Sequence[str] = JOBS,
    database: str | None = None,
    archive: str | None = None,
    **scan,
) -> list[WriteAudit]:
    """The layers in order; the first failure ends the run, and is in the log like the jobs before it.

    With ``by_day`` all layers keep earlier days beside the one loaded.  With ``resume`` writes that an earlier run of
    the date has finished from the same landing files are left out; their audits say SKIPPED.  ``jobs`` names the
    layers to run; one that is run alone works on what the layer below holds.  With ``database`` silver and the marts,
    where they are replaced whole, are tables of that database, each swapped when its new rows are complete; the
    versions before the last are deleted at the end of a run without failure.  With ``archive`` the landing files that
    such a run has ingested are moved below that folder, to one of the date and the run.
    """
    if unknown := set(jobs) - set(JOBS):
        raise ValueError(f"no such job: {sorted(unknown)}; there are {list(JOBS)}")
    journal = RunJournal(as_of)
    manifest = Manifest(spark, base, as_of, by_day, journal.run_id, resume)
    names = [dataset for dataset, _, _ in BRONZE_DATASETS]
    day = as_of if by_day else None
    landed, stored = [f"landing/{n}.csv" for n in names], [f"bronze/{n}" for n in names]
    # What each layer is made of; without the layers below it in this run, of something that no other run can know.
    inputs = {"bronze": journal.run_id}
    done: dict[str, list[WriteAudit]] = {}

    def bronze(log: list[WriteAudit]) -> None:
        seen = []
        for spec in BRONZE_DATASETS:
            with audited_input("bronze", spec[0], log):
                seen.append(fingerprint(spark, f"{landing.rstrip('/')}/{spec[1]}"))
            manifest.step(
                log, "bronze", spec[0], combined(seen[-1], sorted(scan.items())),
                lambda spec=spec: ingest_bronze(spark, landing, base, [spec], run_day=day, log=log, **scan),
            )
        inputs["bronze"] = combined(*seen, sorted(scan.items()))

    def silver(log: list[WriteAudit]) -> None:
        made_of = combined(inputs["bronze"], as_of)
        manifest.step(log, "silver", SILVER_DATASET, made_of, lambda: run_silver(spark, base, as_of, by_day, log, database))

    def gold(log: list[WriteAudit]) -> None:
        # Gold follows silver, which follows bronze: what silver was made of stands for silver.
        made_of = combined(inputs["bronze"] if "silver_transform" in done else journal.run_id, as_of)
        for mart in GOLD_MARTS:
            write = partial(run_gold, spark, base, as_of, by_day, log, [mart], database)
            manifest.step(log, "gold", mart, made_of, write)

    sources = {"bronze_ingest": landed, "silver_transform": stored, "gold_transform": [f"silver/{SILVER_DATASET}"]}
    work = {"bronze_ingest": bronze, "silver_transform": silver, "gold_transform": gold}
    try:
        rows_in = None
        for job in (j for j in JOBS if j in jobs):
            done[job] = journal.job(job, sources[job], rows_in, work[job])
            rows_in = sum(a.rows for a in done[job] if a.layer != "rejects")
    except Exception as failure:
        try:
            journal.save(spark, base)
        except Exception as second:  # noqa: BLE001  the first failure is the one to raise
            failure.add_note(f"the logs of this run were not saved: {second}")
        raise
    journal.save(spark, base)
    if "silver_transform" in done:
        log_state(spark, base, as_of, journal.run_id, by_day, database)
    if database and not by_day:
        for layer, dataset in [("silver", SILVER_DATASET), *(("gold", mart) for mart in GOLD_MARTS)]:
            expire_versions(spark, database, dataset, layer_path(base, layer, dataset))
    if archive and "bronze_ingest" in done:
        for _, file, _ in BRONZE_DATASETS:
            archive_landed(spark, f"{landing.rstrip('/')}/{file}", f"{archive.rstrip('/')}/{as_of}/{journal.run_id}")
    return [a for audits in done.values() for a in audits]


def run_with_retries(
    spark: SparkSession,
    *args,
    retries: int = 1,
    wait: dt.timedelta = dt.timedelta(hours=1),
    resume: bool = False,
    **kwargs,
) -> list[WriteAudit]:
    """:func:`run_day`, tried again after ``wait`` when it fails; each further attempt resumes the one before."""
    for attempt in range(retries + 1):
        try:
            return run_day(spark, *args, resume=resume or attempt > 0, **kwargs)
        except Exception:
            if attempt == retries:
                raise
            time.sleep(wait.total_seconds())
    raise ValueError("retries must not be negative")


def execution_date(given: str | None) -> dt.date:
    """The date given, else that of the environment variable EXECUTION_DATE, else today; anything but a date is an error."""
    value = given or os.environ.get("EXECUTION_DATE")
    if not value:
        return dt.date.today()
    try:
        return dt.date.fromisoformat(value)
    except ValueError as error:
        raise ValueError(f"the execution date must be YYYY-MM-DD, not {value!r}") from error


def main(argv: list[str] | None = None) -> int:
    """0 after a whole run; 1 after a failure, whose class and message go to the error output."""
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--landing", required=True, help="folder with the delimited files")
    parser.add_argument("--base", required=True, help="folder of the bronze, silver, gold and logs layers")
    parser.add_argument("--execution-date", help="YYYY-MM-DD; by default EXECUTION_DATE of the environment, then today")
    parser.add_argument("--by-day", action="store_true", help="replace only this date in each layer")
    parser.add_argument("--database", help="make silver and the marts tables of this database, swapped whole")
    parser.add_argument("--archive", help="folder that ingested landing files are moved to")
    parser.add_argument("--job", choices=JOBS, action="append", help="run this layer only; may be given again")
    parser.add_argument("--resume", action="store_true", help="leave out what an earlier run of the date has finished")
    parser.add_argument("--retries", type=int, default=0, help="further attempts after a failure")
    parser.add_argument("--retry-minutes", type=float, default=60.0, help="how long to wait before one")
    parser.add_argument("--file-size-mb", type=int, default=128, help="size of the files to aim at")
    args = parser.parse_args(argv)
    try:
        as_of = execution_date(args.execution_date)
        spark = build_session("strataflow-daily")
        set_target_file_size(spark, args.file_size_mb)
        if args.database:
            create_database(spark, args.database)
        audits = run_with_retries(
            spark, args.landing, args.base, as_of, args.by_day, resume=args.resume, jobs=args.job or JOBS,
            database=args.database, archive=args.archive, retries=args.retries, wait=dt.timedelta(minutes=args.retry_minutes),
        )
    except Exception as failure:  # noqa: BLE001  the exit code and one line tell it
        print(f"{error_class(failure)}: {type(failure).__name__}: {str(failure).splitlines()[0]}", file=sys.stderr)
        return 1
    for audit in audits:
        print(f"{audit.layer}/{audit.dataset}: {audit.rows} rows in {audit.seconds:.1f} s ({audit.status})")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
