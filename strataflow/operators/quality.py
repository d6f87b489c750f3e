"""Data-quality checks as result tables.

A check contributes aggregates and the result rows made of them.  All checks
given to :func:`run_checks` share one aggregation, so a table of any width is
read once for all of them.  Duplicates need a shuffle of their own.

Aggregates and rows are SQL text: a profile of 57 columns has some 900
expressions, and one ``selectExpr`` builds them in a fraction of the time that
as many calls into the JVM take.

Result rows: dataset, check_name, column_name (null for the whole table),
value, detail, status (PASS, WARN or FAIL).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strataflow.functions.columns import MONEY, any_null, safe_divide
from strataflow.functions.sqltext import quoted, text
from strataflow.operators.aggregates import (
    STATISTICS,
    apart_by_type,
    number_in_text,
    statistic_aggregates,
    with_columns_sql,
)
from strataflow.operators.projections import sample_rows

PASS, WARN, FAIL = "PASS", "WARN", "FAIL"
RESULT_COLUMNS = ["dataset", "check_name", "column_name", "value", "detail", "status"]


def _row(check: str, value: str, status: str, column: str | None = None, detail: str = "") -> str:
    name = text(column) if column is not None else "CAST(NULL AS STRING)"
    detail = f"CAST({detail} AS STRING)" if detail else "CAST(NULL AS STRING)"
    return f"struct({text(check)}, {name}, CAST({value} AS DOUBLE), {detail}, {status})"


def _long(wide: DataFrame, dataset: str, rows: Sequence[str], *kept: str) -> DataFrame:
    fields = ", ".join(RESULT_COLUMNS[1:])
    return wide.selectExpr(*kept, f"{text(dataset)} AS dataset", f"inline(array({', '.join(rows)})) AS ({fields})")


def unless(bad: str, severity: str) -> str:
    """PASS, or the severity where the condition holds."""
    return f"IF({bad}, {text(severity)}, {text(PASS)})"


def _percentage(part: str, whole: str) -> str:
    return f"round(coalesce(try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE)), 0D) * 100, 2)"


@dataclass
class Check:
    aggregates: dict[str, str] = field(default_factory=dict)
    rows: list[str] = field(default_factory=list)
    columns: dict[str, str] = field(default_factory=dict)  # computed per row, below the aggregation

    def measure(self, kind: str, expression: str) -> str:
        """Adds an aggregate and gives its quoted name, which depends on the expression: two checks of one kind in a
        run share an aggregate if it is the same, and never otherwise."""
        name = f"_{kind}_{hashlib.md5(expression.encode()).hexdigest()}"
        self.aggregates[name] = expression
        return quoted(name)


def run_checks(df: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    aggregates, columns = {"_total": "count(1)"}, {}
    for check in checks:
        aggregates.update(check.aggregates)
        columns.update(check.columns)
    wide = with_columns_sql(df, columns).selectExpr(*[f"{e} AS {quoted(name)}" for name, e in aggregates.items()])
    return _long(wide, dataset, [row for check in checks for row in check.rows])


# ---- checks that share one scan --------------------------------------------


def non_empty() -> Check:
    return Check(rows=[_row("row_count", "_total", unless("_total = 0", FAIL))])


def schema_snapshot(df: DataFrame) -> Check:
    return Check(rows=[_row("schema", str(len(df.columns)), text(PASS), detail=text(",".join(df.columns)))])


def null_profile(columns: Sequence[str], severity: str = WARN, percentages: bool = True) -> Check:
    """Nulls per column, and their share of the rows in percent (0 for an empty table)."""
    check = Check()
    for name in columns:
        nulls = quoted(f"null_{name}")
        check.aggregates[f"null_{name}"] = f"count_if({quoted(name)} IS NULL)"
        status = unless(f"{nulls} > 0", severity)
        check.rows.append(_row("null_count", nulls, status, name))
        if percentages:
            check.rows.append(_row("null_percentage", _percentage(nulls, "_total"), status, name))
    return check


def critical_nulls(columns: Sequence[str], severity: str = WARN, name: str = "critical_nulls") -> Check:
    """Rows with a null in at least one of the columns; none of them for an empty list."""
    missing = " OR ".join(f"{quoted(n)} IS NULL" for n in columns) or "false"
    check = Check()
    rows = check.measure("missing", f"count_if({missing})")
    check.rows.append(_row(name, rows, unless(f"{rows} > 0", severity), detail=text(",".join(columns))))
    return check


def freshness(
    df: DataFrame,
    candidates: Sequence[str] = ("created_at", "ingestion_date"),
    as_of: dt.date | None = None,
    max_age_days: int | None = None,
) -> Check:
    """Latest value of the first candidate column the table has; no row without one.

    With ``as_of`` the value is the age in days; with ``max_age_days`` too, an
    older or empty table fails.
    """
    present = [name for name in candidates if name in df.columns]
    if not present:
        return Check()
    check = Check()
    latest = check.measure("latest", f"max({quoted(present[0])})")
    age = f"date_diff(DATE '{as_of}', try_cast({latest} AS DATE))" if as_of else "NULL"
    stale = f"coalesce({age} > {max_age_days}, true)" if as_of and max_age_days is not None else "false"
    detail = f"date_format(try_cast({latest} AS TIMESTAMP), 'yyyy-MM-dd HH:mm:ss')"
    check.rows.append(_row("data_freshness", age, unless(stale, FAIL), present[0], detail))
    return check


def type_conformance(df: DataFrame, expected: Mapping[str, str]) -> Check:
    """Per column: FAIL if it is absent, has another type, or is text some of which does not fit the type.

    ``value`` counts the text cells that do not fit.
    """
    check = Check()
    for name, wanted in expected.items():
        if name not in df.columns:
            check.rows.append(_row("type_conformance", "NULL", text(FAIL), name, text(f"{wanted}: missing")))
            continue
        actual = df.schema[name].dataType
        detail = text(f"{wanted}: {actual.simpleString()}")
        if actual.simpleString() == wanted:
            check.rows.append(_row("type_conformance", "0", text(PASS), name, detail))
        elif isinstance(actual, StringType):
            cell = quoted(name)
            cells = check.measure("unfit", f"count_if({cell} IS NOT NULL AND try_cast({cell} AS {wanted}) IS NULL)")
            check.rows.append(_row("type_conformance", cells, unless(f"{cells} > 0", FAIL), name, detail))
        else:
            check.rows.append(_row("type_conformance", "0", text(FAIL), name, detail))
    return check


def amount_conformance(columns: Sequence[str], severity: str = WARN) -> Check:
    """Per column, the amounts that are there but are no finite number of the money type: what the marts leave out."""
    check = Check()
    for name in columns:
        cell = quoted(name)
        bad = check.measure("amount", f"count_if({cell} IS NOT NULL AND try_cast({cell} AS {MONEY}) IS NULL)")
        check.rows.append(_row("amount_conformance", bad, unless(f"{bad} > 0", severity), name, text(MONEY)))
    return check


def types_match(df: DataFrame, expected: Mapping[str, str]) -> bool:
    """Whether the schema alone has the expected types; no data is read."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    return all(n in actual and t in (actual[n].typeName(), actual[n].simpleString()) for n, t in expected.items())


def row_count_between(minimum: int | None, maximum: int | None) -> Check:
    low = f"_total < {minimum}" if minimum is not None else "false"
    high = f"_total > {maximum}" if maximum is not None else "false"
    status = unless(f"{low} OR {high}", FAIL)
    return Check(rows=[_row("row_count_between", "_total", status, detail=text(f"{minimum}..{maximum}"))])


def columns_in_order(df: DataFrame, expected: Sequence[str]) -> Check:
    status = text(PASS if list(expected) == df.columns else FAIL)
    return Check(rows=[_row("columns_in_order", str(len(df.columns)), status, detail=text(",".join(expected)))])


def expectation_suite(df: DataFrame, columns: Sequence[str], minimum: int = 1, maximum: int | None = None) -> list[Check]:
    return [row_count_between(minimum, maximum), columns_in_order(df, columns)]


def partition_conformance(df: DataFrame, date_column: str, parts: Mapping[str, str]) -> Check:
    """``parts`` maps year, month and day to the partition columns that should hold them.

    Fails on an absent column, and on rows where a part is null or is not that
    of the date.
    """
    check = Check()
    for unit, name in parts.items():
        if name not in df.columns:
            check.rows.append(_row("partition_conformance", "NULL", text(FAIL), name, text("missing")))
            continue
        right = f"try_cast({quoted(name)} AS INT) = {unit}(try_cast({quoted(date_column)} AS DATE))"
        rows = check.measure("part", f"count_if(NOT coalesce({right}, false))")
        check.rows.append(_row("partition_conformance", rows, unless(f"{rows} > 0", FAIL), name, text(unit)))
    return check


def has_partition_columns(df: DataFrame, expected: Sequence[str]) -> bool:
    return set(expected) <= set(df.columns)


def statistics(df: DataFrame, digits: int = 4) -> Check:
    """Count, mean, deviation, minimum and maximum of every column; text extremes stand in ``detail``."""
    check = Check()
    for i, name in enumerate(df.columns):
        check.columns.update(number_in_text(df, name))
        measures = statistic_aggregates(df, name, digits)
        check.aggregates.update({f"_s{i}_{m}": e for m, e in measures.items()})
        for label, number, words in STATISTICS:
            detail = f"_s{i}_{words}" if words else ""
            check.rows.append(_row(label, f"_s{i}_{number}", text(PASS), name, detail))
    return check


# ---- checks with a shuffle of their own ------------------------------------


def _duplicates(df: DataFrame, keys: Sequence[str], dataset: str, name: str, severity: str, detail: str) -> DataFrame:
    # Counted per key before the shuffle, so a key with a third of the rows
    # crosses it as one row per map task.
    extra = (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("_copies"))
        .selectExpr("coalesce(sum(_copies - 1), 0) AS _extra")
    )
    return _long(extra, dataset, [_row(name, "_extra", unless("_extra > 0", severity), detail=text(detail))])


def key_duplicates(df: DataFrame, keys: Sequence[str], dataset: str, severity: str = WARN) -> DataFrame:
    """Rows beyond the first of each key; null keys count as equal."""
    return _duplicates(df, keys, dataset, "key_duplicates", severity, ",".join(keys))


def key_unique(df: DataFrame, keys: Sequence[str], dataset: str) -> DataFrame:
    return _duplicates(df, keys, dataset, "key_unique", FAIL, ",".join(keys))


def row_duplicates(df: DataFrame, dataset: str, severity: str = WARN) -> DataFrame:
    """Rows that repeat another row in every column."""
    return _duplicates(df, df.columns, dataset, "row_duplicates", severity, "all columns")


def layer_growth(
    before: DataFrame, after: DataFrame, dataset: str, limit_percent: float = 10.0, names: Sequence[str] = ("before", "after")
) -> DataFrame:
    """Growth of the row count from one layer to the next in percent; above the limit it fails."""
    sides = before.select(F.lit(0).alias("_side")).union(after.select(F.lit(1)))
    counts = sides.selectExpr("count_if(_side = 0) AS _b", "count_if(_side = 1) AS _a")
    grew = unless(f"(_a - _b) * 100 > _b * {float(limit_percent)}D", FAIL)
    detail = f"concat({text(names[0] + '=')}, _b, {text(' ' + names[1] + '=')}, _a)"
    return _long(counts, dataset, [_row("layer_growth", _percentage("_a - _b", "_b"), grew, detail=detail)])


# ---- whole-layer validations -----------------------------------------------


def validate_bronze(df: DataFrame, dataset: str, **fresh) -> DataFrame:
    """Row count, schema, nulls per column, freshness in one scan; duplicate rows in a second."""
    one_scan = [
        non_empty(),
        schema_snapshot(df),
        null_profile(df.columns, percentages=False),
        freshness(df, **fresh),
    ]
    return run_checks(df, dataset, one_scan).unionByName(row_duplicates(df, dataset))


def validate_silver(df: DataFrame, dataset: str, digits: int = 4) -> DataFrame:
    """Row count, statistics and null analysis of every column.  An empty table fails.

    Meant for a stored table, of which each column is read once: text columns
    and the others are aggregated apart.
    """
    results = []
    for part in apart_by_type(df):
        checks = [null_profile(part.columns), statistics(part, digits)]
        results.append(run_checks(part, dataset, checks if results else [non_empty(), *checks]))
    return reduce(DataFrame.union, results)


def gold_shape(df: DataFrame, dataset: str, order_by: Sequence[str], shown: Sequence[str], k: int = 5) -> DataFrame:
    """Row count, column count and ``k`` sample rows of a stored mart, which is read for either."""
    check = Check(rows=[_row("rows", "_total", text(PASS)), _row("columns", str(len(df.columns)), text(PASS))])
    cells = [f"coalesce(CAST({quoted(n)} AS STRING), '')" for n in shown]
    line = f"concat_ws('|', {', '.join(cells)})"
    sample = _long(sample_rows(df, order_by, k), dataset, [_row("sample", "NULL", text(PASS), detail=line)])
    return run_checks(df, dataset, [check]).unionByName(sample)


def table_report(df: DataFrame, dataset: str) -> DataFrame:
    """Rows, columns and nulls per column with percentages, in one scan."""
    names = text(",".join(df.columns))
    table = Check(
        rows=[
            _row("total_rows", "_total", text(PASS)),
            _row("columns", str(len(df.columns)), text(PASS), detail=names),
        ]
    )
    return run_checks(df, dataset, [table, null_profile(df.columns)])


# ---- roll-ups of results ---------------------------------------------------


def check_totals(results: DataFrame) -> DataFrame:
    """How often each check of a dataset came out as PASS, WARN or FAIL."""
    return results.groupBy("dataset", "check_name", "status").agg(F.count(F.lit(1)).alias("n_checks"))


def dataset_outcomes(results: DataFrame) -> DataFrame:
    """One row per dataset: it passes if no check of it failed (a warning does not fail it)."""
    return results.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_checks"),
        F.count_if(F.col("status") == WARN).alias("n_warnings"),
        (F.count_if(F.col("status") == FAIL) == 0).alias("passed"),
    )


def pass_rate(results: DataFrame) -> DataFrame:
    """Datasets in all, passed, failed and the pass rate in percent; 0 without datasets."""
    passed, total = F.count_if("passed"), F.count(F.lit(1))
    return dataset_outcomes(results).agg(
        total.alias("total_datasets"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        (safe_divide(passed, total) * 100).alias("pass_rate"),
    )


def sliced_results(df: DataFrame, run_at: Column, dataset: str, keys: Sequence[str], critical: Sequence[str]) -> DataFrame:
    """The row-count, null and key-duplicate results of each slice of a table, one slice per ``run_at``.

    Rows are counted per slice and key before the shuffle.
    """
    per_key = df.groupBy(run_at.alias("run_at"), *[quoted(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(any_null([F.col(quoted(n)) for n in critical])).alias("_nulls"),
    )
    per_slice = per_key.groupBy("run_at").agg(
        F.sum("_rows").alias("_total"),
        F.sum("_nulls").alias("_nulls"),
        F.sum(F.col("_rows") - 1).alias("_extra"),
    )
    rows = [
        _row("row_count", "_total", unless("_total = 0", FAIL)),
        _row("critical_nulls", "_nulls", unless("_nulls > 0", WARN)),
        _row("key_duplicates", "_extra", unless("_extra > 0", WARN)),
    ]
    return _long(per_slice, dataset, rows, "run_at")


def quality_kpis(history: DataFrame, period: Column) -> DataFrame:
    """Null and duplicate counts, mean score and mean pass rate per period and dataset.

    Score: share of clean rows in a run.  Pass rate: share of its checks with status PASS.
    """
    value = lambda check: F.sum(F.when(F.col("check_name") == check, F.col("value")))
    runs = history.groupBy("dataset", "run_at").agg(
        value("row_count").alias("_rows"),
        F.coalesce(value("critical_nulls"), F.lit(0.0)).alias("_nulls"),
        F.coalesce(value("key_duplicates"), F.lit(0.0)).alias("_dups"),
        (safe_divide(F.count_if(F.col("status") == PASS), F.count(F.lit(1))) * 100).alias("_rate"),
    )
    score = F.greatest(F.lit(0.0), 1 - safe_divide(F.col("_nulls") + F.col("_dups"), F.col("_rows"), 1.0)) * 100
    return runs.groupBy(period.alias("period_start"), "dataset").agg(
        F.round(F.avg(score), 4).alias("data_quality_score"),
        F.sum("_nulls").cast("long").alias("null_record_count"),
        F.sum("_dups").cast("long").alias("duplicate_record_count"),
        F.round(F.avg("_rate"), 4).alias("validation_pass_rate"),
    )
