"""The same results in plain SQL, for a second engine to compare with.

Only the view texts are shared with the Spark side; rules, labels and shapes
are written out again here.
"""

from __future__ import annotations

from strataflow.contracts import CLIENT_SCHEMA, CONTRACT_SCHEMA, GUARANTEE_FLAGS, schema_types
from strataflow.plans.views import EXTREMES, NUMBERS_IN_TEXT, SQL

CONTRACT_TYPES = schema_types(CONTRACT_SCHEMA)
CLIENT_TYPES = schema_types(CLIENT_SCHEMA)
CONTRACT_NAMES = list(CONTRACT_TYPES)

VEHICLE_TYPE = "CASE cateco WHEN 'A' THEN 'Auto' WHEN 'M' THEN 'Moto' WHEN 'C' THEN 'Cyclo' ELSE 'Inconnu' END"
STATE = """CASE etatco WHEN '0' THEN 'Annule' WHEN '1' THEN 'En cours' WHEN '2' THEN 'Suspendu'
  WHEN '3' THEN 'Resilie societaire' WHEN '4' THEN 'Resilie impaye' WHEN '7' THEN 'Resilie article 25'
  WHEN '9' THEN 'Resilie Mutuelle' ELSE 'Autre' END"""
ACTIVE = "CASE WHEN etatco = '1' THEN 1 ELSE 0 END"
USE = "CASE usagco1 WHEN 0 THEN 'Domicile-Travail' WHEN 1 THEN 'Promenade' WHEN 3 THEN 'Professionnel' ELSE 'Autre' END"
GUARANTEES = " + ".join(f"COALESCE({g}, 0)" for g in GUARANTEE_FLAGS)
SENIORITY = "2026 - asaico"
AGE = "2026 - aadhso"
YOUNG = f"CASE WHEN {AGE} < 30 THEN 1 ELSE 0 END"


def _segment(age: str, unknown: str) -> str:
    return f"""CASE WHEN {age} IS NULL THEN '{unknown}' WHEN {age} < 25 THEN '18-24' WHEN {age} < 35 THEN '25-34'
  WHEN {age} < 45 THEN '35-44' WHEN {age} < 55 THEN '45-54' WHEN {age} < 65 THEN '55-64' ELSE '65+' END"""


def _conformed(source: str) -> str:
    fixed = {
        "nusoc": "TRY_CAST(nusoc AS INT)",
        "nucon": "TRY_CAST(nucon AS INT)",
        "prmaco": "COALESCE(TRY_CAST(prmaco AS DOUBLE), 0.0)",
        "etatco": "COALESCE(etatco, 'UNKNOWN')",
        "pfco": "COALESCE(pfco, 0)",
    }
    return f"SELECT {', '.join(f'{fixed.get(n, n)} AS {n}' for n in CONTRACT_NAMES)} FROM {source}"


def _nulls_last(names) -> str:
    return ", ".join(f"{n} ASC NULLS LAST" for n in names)


def _digest() -> str:
    def cell(name: str) -> str:
        return f"TRY_CAST({name} AS DECIMAL(28,6))" if CONTRACT_TYPES[name] == "double" else name

    return f"md5(concat_ws('|', {', '.join(f"coalesce(CAST({cell(n)} AS STRING), '~')" for n in CONTRACT_NAMES)}))"


_PAYLOAD = [n for n in CONTRACT_NAMES if n not in ("nusoc", "nucon")]
_CLIENT_PART = ["sexsoc", "aadhso", "cspsoc", "sitmat", "sitpav1", "nbenf"]

# Named steps; each may use the ones above it.
STEPS = {
    **SQL,
    "conformed": _conformed("contrat2"),
    "conformed1": _conformed("contrat1"),
    "unique_contracts": f"""SELECT {', '.join(CONTRACT_NAMES)} FROM (
      SELECT *, row_number() OVER (PARTITION BY nusoc, nucon ORDER BY src, {_digest()}, {_nulls_last(_PAYLOAD)}) AS rn FROM (
        SELECT 0 AS src, * FROM conformed UNION ALL SELECT 1 AS src, * FROM conformed1)) WHERE rn = 1""",
    "clients1": f"""SELECT nusoc, {', '.join(_CLIENT_PART)} FROM (
      SELECT *, row_number() OVER (PARTITION BY nusoc ORDER BY {_nulls_last(_CLIENT_PART)}) AS rn FROM (
        SELECT CAST(nusoc AS INT) AS nusoc, {', '.join(_CLIENT_PART)} FROM client)) WHERE rn = 1""",
    "silver": f"""SELECT u.nusoc, {', '.join('u.' + n for n in CONTRACT_NAMES if n != 'nusoc')},
      {VEHICLE_TYPE} AS type_vehicule, {STATE} AS etat_contrat_libelle, {ACTIVE} AS contrat_actif,
      {USE} AS usage_vehicule, {GUARANTEES} AS nb_garanties, {', '.join('k.' + n for n in _CLIENT_PART)},
      {AGE} AS age_client, {YOUNG} AS client_jeune, {SENIORITY} AS anciennete_contrat
      FROM unique_contracts u LEFT JOIN clients1 k ON u.nusoc = k.nusoc""",
    "profile": f"""SELECT DISTINCT nusoc, age_client, client_jeune, sexsoc, cspsoc, sitmat, sitpav1,
      {_segment('age_client', '65+')} AS age_segment FROM silver""",
    "mart": """SELECT type_vehicule, count(nucon) AS total_contracts, count(DISTINCT nusoc) AS unique_clients,
      round(CAST(sum(TRY_CAST(prmaco AS DECIMAL(28,6))) AS DOUBLE) / count(TRY_CAST(prmaco AS DECIMAL(28,6))), 2)
        AS avg_premium,
      round(CAST(sum(TRY_CAST(prmaco AS DECIMAL(28,6))) AS DOUBLE), 0) AS total_premium,
      round(CAST(sum(anciennete_contrat) AS DOUBLE) / count(anciennete_contrat), 1) AS avg_seniority,
      round(CAST(sum(nb_garanties) AS DOUBLE) / count(nb_garanties), 1) AS avg_guarantees
      FROM silver GROUP BY type_vehicule""",
    "daily_log": """SELECT *, CAST(year(event_ts) AS INT) AS year, CAST(month(event_ts) AS INT) AS month,
      CAST(day(event_ts) AS INT) AS day FROM run_log""",
}
_USES = {
    "conformed": ["contrat2"],
    "conformed1": ["contrat1"],
    "unique_contracts": ["conformed", "conformed1"],
    "clients1": ["client"],
    "silver": ["unique_contracts", "clients1"],
    "profile": ["silver"],
    "mart": ["silver"],
    "daily_log": ["run_log"],
}


def _with(steps, body: str) -> str:
    """``body`` after the WITH clause of the steps and of all they build on."""
    needed, todo = set(), list(steps)
    while todo:
        step = todo.pop()
        needed.add(step)
        todo += _USES.get(step, [])
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in STEPS.items() if name in needed)
    return f"WITH {parts}\n{body}"


def _result(dataset, check, value, status, column="NULL", detail="NULL") -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{check}' AS check_name, CAST({column} AS STRING) AS column_name, "
        f"CAST({value} AS DOUBLE) AS value, CAST({detail} AS STRING) AS detail, {status} AS status"
    )


def _unless(bad: str, severity: str) -> str:
    return f"CASE WHEN {bad} THEN '{severity}' ELSE 'PASS' END"


def _counted(source: str, columns) -> str:
    nulls = ", ".join(f"count(*) FILTER ({n} IS NULL) AS n_{n}" for n in columns)
    return f"(SELECT count(*) AS total, {nulls} FROM {source})"


def _row_count(dataset, source) -> str:
    return _result(dataset, "row_count", "n", _unless("n = 0", "FAIL")) + f" FROM (SELECT count(*) AS n FROM {source})"


def _null_rows(dataset, source, columns, percentages=True) -> list[str]:
    rows = []
    for n in columns:
        status = _unless(f"n_{n} > 0", "WARN")
        rows.append(_result(dataset, "null_count", f"n_{n}", status, f"'{n}'") + " FROM counted")
        if percentages:
            pct = f"round(CAST(n_{n} AS DOUBLE) / total * 100, 2)"
            rows.append(_result(dataset, "null_percentage", pct, status, f"'{n}'") + " FROM counted")
    return rows


def _all(rows) -> str:
    return "\nUNION ALL ".join(rows)


def _duplicates(dataset, check, source, keys, severity, detail) -> str:
    inner = f"(SELECT COALESCE(sum(c - 1), 0) AS n FROM (SELECT count(*) AS c FROM {source} GROUP BY {', '.join(keys)}))"
    return _result(dataset, check, "n", _unless("n > 0", severity), detail=f"'{detail}'") + f" FROM {inner}"


def _critical(dataset, source, columns, severity="WARN", check="critical_nulls") -> str:
    bad = " OR ".join(f"{n} IS NULL" for n in columns)
    inner = f"(SELECT count(*) FILTER ({bad}) AS n FROM {source})"
    return _result(dataset, check, "n", _unless("n > 0", severity), detail=f"'{','.join(columns)}'") + f" FROM {inner}"


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_returnflag", "created_at"]
KPIS = """count(*) AS n_runs, CAST(count(*) FILTER (status = 'SUCCESS') AS DOUBLE) / count(*) AS success_rate,
  CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds) AS avg_duration_seconds,
  CAST(sum(records_out) AS BIGINT) AS total_records"""
TOTALS = """count(*) AS n_runs, CAST(sum(records_out) AS BIGINT) AS total_records,
  CAST(sum(duration_seconds) AS DECIMAL(22,2)) AS total_seconds"""


def _window(width: str) -> str:
    return _with(
        ["run_log"],
        f"""SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start,
  time_bucket(INTERVAL '{width}', event_ts) + INTERVAL '{width}' AS window_end, job_name, {KPIS}
FROM run_log GROUP BY 1, 2, 3""",
    )


def _histogram(label: str, bounds) -> str:
    rows = [
        f"""SELECT {label}, '{b}' AS le, count(*) FILTER (duration_seconds <= {b}) AS n_at_or_below,
  count(duration_seconds) AS n_runs, CAST(sum(duration_seconds) AS DECIMAL(22,2)) AS sum_seconds
  FROM run_log GROUP BY {label}"""
        for b in bounds
    ]
    rows.append(
        f"""SELECT {label}, '+Inf' AS le, count(duration_seconds) AS n_at_or_below, count(duration_seconds) AS n_runs,
  CAST(sum(duration_seconds) AS DECIMAL(22,2)) AS sum_seconds FROM run_log GROUP BY {label}"""
    )
    return _with(["run_log"], _all(rows))


def _statistics(source: str, types: dict[str, str]) -> dict[str, str]:
    """Per column: its statistics as one SELECT."""
    out = {}
    for n, t in types.items():
        number = n if t in ("int", "bigint", "double") else f"TRY_CAST({n} AS DOUBLE)" if t == "string" else None
        is_number = t in ("int", "bigint", "double")
        mean = f"round(avg({number}), 4)" if number else "CAST(NULL AS DOUBLE)"
        dev = f"round(stddev_samp({number}), 4)" if number else "CAST(NULL AS DOUBLE)"
        ends = (
            f"CAST(min({n}) AS DOUBLE) AS min_num, CAST(max({n}) AS DOUBLE) AS max_num, "
            + ", ".join(f"CAST({f'{m}({n})' if t == 'bigint' else 'NULL'} AS STRING) AS {m}_text" for m in ("min", "max"))
            if is_number
            else "CAST(NULL AS DOUBLE) AS min_num, CAST(NULL AS DOUBLE) AS max_num, "
            f"CAST(min({n}) AS STRING) AS min_text, CAST(max({n}) AS STRING) AS max_text"
        )
        out[n] = f"SELECT '{n}' AS column_name, count({n}) AS n, {mean} AS mean, {dev} AS stddev, {ends} FROM {source}"
    return out


def _changes() -> str:
    """States of the contracts over three days, each day's snapshot against the one before."""

    def snapshot(day: int, sources: list[str]) -> str:
        rows = " UNION ALL ".join(f"SELECT {i} AS src, * FROM {s}" for i, s in enumerate(sources))
        return f"""SELECT {day} AS d, nusoc, nucon, prmaco, etatco, usagco1, h FROM (
          SELECT *, {_digest()} AS h,
            row_number() OVER (PARTITION BY nusoc, nucon ORDER BY src, {_digest()}, {_nulls_last(_PAYLOAD)}) AS rn
          FROM ({rows})) WHERE rn = 1"""

    days = " UNION ALL ".join(
        snapshot(i, s) for i, s in enumerate([["conformed1"], ["conformed", "conformed1"], ["conformed"]])
    )
    return _with(
        ["conformed", "conformed1"],
        f"""SELECT nusoc, nucon, CASE WHEN is_new THEN 'inserted' ELSE 'changed' END AS change,
      CAST(DATE '2026-03-08' + CAST(d AS INT) AS DATE) AS valid_from,
      CASE WHEN until < 3 THEN CAST(DATE '2026-03-08' + CAST(until AS INT) AS DATE) END AS valid_to, prmaco, etatco, usagco1
      FROM (SELECT *, coalesce(lead(d) OVER (PARTITION BY nusoc, nucon ORDER BY d), last_day + 1) AS until
        FROM (SELECT *, lag(d) OVER k IS NULL OR lag(d) OVER k < d - 1 AS is_new, lag(h) OVER k AS was,
                max(d) OVER (PARTITION BY nusoc, nucon) AS last_day
              FROM ({days}) WINDOW k AS (PARTITION BY nusoc, nucon ORDER BY d))
        WHERE is_new OR was <> h)""",
    )


LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp",
}
SILVER_TYPES = {
    **CONTRACT_TYPES,
    "type_vehicule": "string", "etat_contrat_libelle": "string", "contrat_actif": "int",
    "usage_vehicule": "string", "nb_garanties": "int",
    **{n: CLIENT_TYPES[n] for n in _CLIENT_PART},
    "age_client": "int", "client_jeune": "int", "anciennete_contrat": "int",
}


NUMBER_TYPES = {"id": "bigint", "padded": "string", "mixed": "string", "not_a_number": "string"}


def _silver_profile() -> str:
    dataset = "Client_contrat_silver"
    rows = [_row_count(dataset, "silver"), *_null_rows(dataset, "silver", SILVER_TYPES)]
    for label, number, text in [
        ("count", "n", "NULL"),
        ("mean", "mean", "NULL"),
        ("stddev", "stddev", "NULL"),
        ("min", "min_num", "min_text"),
        ("max", "max_num", "max_text"),
    ]:
        rows.append(_result(dataset, label, number, "'PASS'", "column_name", text) + " FROM stats")
    stats = _all(_statistics("silver", SILVER_TYPES).values())
    return _with(["silver"], "SELECT * FROM (WITH counted AS " + _counted("silver", SILVER_TYPES) + f", stats AS ({stats})\n{_all(rows)})")


def _types() -> str:
    actual = {**CONTRACT_TYPES, "nusoc": "bigint", "nucon": "bigint", "prmaco": "string"}
    rows = [_result("Contrat2", "type_conformance", "NULL", "'FAIL'", "'absent'", "'int: missing'")]
    for n, wanted in CONTRACT_TYPES.items():
        value, status = "0", "'PASS'" if actual[n] == wanted else "'FAIL'"
        if n == "prmaco":
            value = "(SELECT count(*) FROM contrat2 WHERE prmaco IS NOT NULL AND TRY_CAST(prmaco AS DOUBLE) IS NULL)"
            status = _unless(value + " > 0", "FAIL")
        rows.append(_result("Contrat2", "type_conformance", value, status, f"'{n}'", f"'{wanted}: {actual[n]}'"))
    return _with(["contrat2"], _all(rows))


def _lines_validation(extra_columns=(), extra_rows="") -> str:
    names = [*LINE_COLUMNS, *extra_columns]
    rows = [
        _row_count("lines", "quality_input"),
        _result("lines", "schema", str(len(names)), "'PASS'", detail=f"'{','.join(names)}'"),
        *_null_rows("lines", "quality_input", LINE_COLUMNS, percentages=False),
        *[_result("lines", "null_count", "0", "'PASS'", f"'{n}'") for n in extra_columns],
        _result("lines", "data_freshness", "NULL", "'PASS'", "'created_at'", "strftime(latest, '%Y-%m-%d %H:%M:%S')")
        + " FROM (SELECT max(created_at) AS latest FROM quality_input)",
        _duplicates("lines", "row_duplicates", "quality_input", LINE_COLUMNS, "WARN", "all columns"),
    ]
    counted = _counted("quality_input", LINE_COLUMNS)
    return _with(["quality_input"], f"SELECT * FROM (WITH counted AS {counted}\n{_all(rows)})")


_CONTRACT_KEY = "nusoc, nucon"
_LANDED = ", ".join(f"{'TRY_CAST(prmaco AS DOUBLE)' if n == 'prmaco' else f'CAST({n} AS {t})'} AS {n}" for n, t in CONTRACT_TYPES.items())


def _table_report() -> str:
    rows = [
        _result("Client", "total_rows", "total", "'PASS'") + " FROM counted",
        _result("Client", "columns", "18", "'PASS'", detail=f"'{','.join(CLIENT_TYPES)}'"),
        *_null_rows("Client", "client", CLIENT_TYPES),
    ]
    return f"SELECT * FROM (WITH counted AS {_counted('client', CLIENT_TYPES)}\n{_all(rows)})"


def _contract_nulls() -> str:
    rows = _null_rows("Contrat2", "contrat2", CONTRACT_NAMES)
    return f"SELECT * FROM (WITH counted AS {_counted('contrat2', CONTRACT_NAMES)}\n{_all(rows)})"


def _check_totals() -> str:
    return _with(
        ["contrat2", "client"],
        f"""SELECT dataset, check_name, status, count(*) AS n_checks
  FROM ({_contract_nulls()} UNION ALL {_table_report()}) GROUP BY 1, 2, 3""",
    )


def _pass_rate() -> str:
    keys = {"contrat2": ["nusoc", "nucon"], "contrat1": ["nusoc", "nucon"], "client": ["nusoc"], "run_log": ["run_id"]}
    rows = []
    for name, key in keys.items():
        rows += [_row_count(name, name), _critical(name, name, key)]
        rows.append(_duplicates(name, "key_unique", name, key, "FAIL", ",".join(key)))
    outcomes = f"SELECT dataset, count(*) FILTER (status = 'FAIL') = 0 AS ok FROM ({_all(rows)}) GROUP BY dataset"
    return _with(
        keys,
        f"""SELECT count(*) AS total_datasets, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed,
  CAST(count(*) FILTER (ok) AS DOUBLE) / count(*) * 100 AS pass_rate FROM ({outcomes})""",
    )


def _partition_conformance() -> str:
    stored = """(SELECT created_at, CAST(year(created_at) AS INT) + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS year,
  month(created_at) AS month, CASE WHEN l_linenumber IS NOT NULL THEN day(created_at) END AS day FROM quality_input)"""
    rows = [
        _result("lines", "partition_conformance", "n", _unless("n > 0", "FAIL"), f"'{u}'", f"'{u}'")
        + f" FROM (SELECT count(*) FILTER ({u} IS NULL OR {u} <> {u}(created_at)) AS n FROM {stored})"
        for u in ("year", "month", "day")
    ]
    return _with(["quality_input"], _all(rows))


ORACLE: dict[str, str] = {
    # scans, sinks
    "csv_mixed_headers": _with(["contrat2"], f"SELECT {_LANDED} FROM contrat2"),
    "clustered_layout": "SELECT * FROM lineitem",
    "merged_profile": " UNION ALL ".join(
        f"""SELECT '{n}' AS column_name, count({n}) AS n, count(*) FILTER ({n} IS NULL) AS n_null,
      sum(CAST({n} AS DECIMAL(28,6))) AS total, CAST(min({n}) AS DOUBLE) AS min, CAST(max({n}) AS DOUBLE) AS max,
      true AS distinct_within_bound, true AS median_within_bound FROM lineitem"""
        for n in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    ),
    "bronze_stream_ingest": _with(
        ["contrat2"],
        f"""SELECT {_LANDED}, 2026 AS ingestion_year, 3 AS ingestion_month, 8 AS ingestion_day,
      CAST(nucon % 2 AS INT) AS ingestion_batch FROM contrat2""",
    ),
    "catalog_column_stats": " UNION ALL ".join(
        f"""SELECT '{n}' AS column_name, CAST(min({v}) AS STRING) AS min, CAST(max({v}) AS STRING) AS max,
      CAST(count(*) FILTER ({v} IS NULL) AS STRING) AS num_nulls FROM lineitem"""
        for n, v in [
            ("l_orderkey", "l_orderkey"), ("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey"),
            ("l_linenumber", "nullif(l_linenumber, 7)"),
        ]
    ),
    "csv_contract_scan": _with(["contrat2"], f"SELECT {_LANDED} FROM contrat2"),
    "parquet_scan": "SELECT * FROM lineitem",
    "partition_pruned_read": _with(["daily_log"], "SELECT * FROM daily_log WHERE CAST(event_ts AS DATE) = DATE '2024-01-15'"),
    "parquet_roundtrip": "SELECT * FROM orders",
    "partitioned_write": _with(["daily_log"], "SELECT * FROM daily_log"),
    "dynamic_overwrite": _with(
        ["daily_log"],
        """SELECT * REPLACE (records_out + CASE WHEN CAST(event_ts AS DATE) >= DATE '2024-01-20' THEN 1 ELSE 0 END
  AS records_out) FROM daily_log""",
    ),
    "write_audit": _with(
        ["contrat2", "contrat1", "client"],
        _all(
            f"SELECT 'bronze' AS layer, '{d}' AS dataset, count(*) AS n_rows, 'SUCCESS' AS status FROM {d.lower()}"
            for d in ("Contrat2", "Contrat1", "Client")
        ),
    ),
    "rebalance_layout": "SELECT * FROM lineitem",
    # projections
    "cast_contract_types": _with(
        ["contrat2"],
        """SELECT TRY_CAST(nusoc AS INT) AS nusoc, TRY_CAST(nucon AS INT) AS nucon,
  TRY_CAST(prmaco AS DOUBLE) AS prmaco, pfco, asaico FROM contrat2""",
    ),
    "null_defaults": _with(["conformed"], f"SELECT {_CONTRACT_KEY}, pfco, etatco, prmaco FROM conformed"),
    "decode_vehicle_type": _with(["conformed"], f"SELECT {_CONTRACT_KEY}, {VEHICLE_TYPE} AS type_vehicule FROM conformed"),
    "decode_contract_state": _with(["conformed"], f"SELECT {_CONTRACT_KEY}, {STATE} AS etat_contrat_libelle FROM conformed"),
    "active_flag": _with(["conformed"], f"SELECT {_CONTRACT_KEY}, {ACTIVE} AS contrat_actif FROM conformed"),
    "decode_usage": _with(["conformed"], f"SELECT {_CONTRACT_KEY}, {USE} AS usage_vehicule FROM conformed"),
    "guarantee_count": _with(["conformed"], f"SELECT {_CONTRACT_KEY}, {GUARANTEES} AS nb_garanties FROM conformed"),
    "client_age": _with(["client"], f"SELECT nusoc, cvilso, {AGE} AS age_client, {YOUNG} AS client_jeune FROM client"),
    "contract_seniority": _with(["contrat2"], f"SELECT {_CONTRACT_KEY}, {SENIORITY} AS anciennete_contrat FROM contrat2"),
    "age_segment": _with(
        ["client"],
        f"""SELECT nusoc, cvilso, {_segment(AGE, '65+')} AS age_segment, {_segment(AGE, '?')} AS known_age_segment
  FROM client""",
    ),
    "bronze_partition_cols": """SELECT o_orderkey, o_orderdate, CAST(year(o_orderdate) AS INT) AS ingestion_year,
  CAST(month(o_orderdate) AS INT) AS ingestion_month, CAST(day(o_orderdate) AS INT) AS ingestion_day FROM orders""",
    "silver_partition_cols": """SELECT o_orderkey, o_orderdate, 2026 AS transform_year, 3 AS transform_month,
  8 AS transform_day, CAST(0.0 AS DOUBLE) AS data_quality_score FROM orders""",
    "gold_partition_cols": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS transaction_date,
  CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(day(o_orderdate) AS INT) AS day, 'monthly' AS aggregation_level FROM orders""",
    "period_rollup": _all(
        f"""SELECT '{level}' AS aggregation_level, CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS period_start,
  count(*) AS n_rows, CAST(sum(TRY_CAST(o_totalprice AS DECIMAL(28,6))) AS DECIMAL(38,6)) AS total_amount
  FROM orders GROUP BY 2"""
        for level, unit in [("daily", "day"), ("weekly", "week"), ("monthly", "month"), ("yearly", "year")]
    ),
    "row_quality_score": _with(
        ["contrat2"],
        """SELECT CAST(nusoc AS INT) AS nusoc, CAST(nucon AS INT) AS nucon, CAST(
  CASE WHEN TRY_CAST(prmaco AS DOUBLE) > 0 THEN 1 ELSE 0 END
  + CASE WHEN etatco IN ('0', '1', '2', '3', '4', '7', '9') THEN 1 ELSE 0 END
  + CASE WHEN cateco IN ('A', 'M', 'C') THEN 1 ELSE 0 END
  + CASE WHEN asaico IS NOT NULL THEN 1 ELSE 0 END AS DOUBLE) / 4.0 AS row_quality_score FROM contrat2""",
    ),
    "safe_ratio_pct": _with(
        ["run_log"],
        """SELECT run_id, CASE WHEN records_in = 0 THEN 0.0
  ELSE round(CAST(records_out AS DOUBLE) / CAST(records_in AS DOUBLE) * 100, 1) END AS ratio_pct FROM run_log""",
    ),
    # filters, joins, deduplication
    "filter_not_null": _with(["quality_input"], "SELECT * FROM quality_input WHERE l_returnflag IS NOT NULL"),
    "contract_client_join": _with(
        ["conformed1", "clients1"],
        f"""SELECT c.nusoc, c.nucon, c.prmaco, {', '.join('k.' + n for n in _CLIENT_PART)}
  FROM conformed1 c LEFT JOIN clients1 k ON c.nusoc = k.nusoc""",
    ),
    "orphan_contracts": _with(
        ["conformed1", "client"],
        """SELECT nusoc, nucon FROM conformed1 c
  WHERE NOT EXISTS (SELECT 1 FROM client k WHERE k.nusoc = c.nusoc)""",
    ),
    "union_contracts": _with(["contrat2", "contrat1"], "SELECT * FROM contrat2 UNION ALL SELECT * FROM contrat1"),
    "versioned_overwrite": """SELECT 'before' AS began, o_orderkey, o_orderstatus, o_totalprice FROM orders
      UNION ALL SELECT 'after', o_orderkey, o_orderstatus, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0""",
    "daily_run": _with(
        ["contrat2", "contrat1", "client", "silver", "profile", "mart"],
        " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, '{dataset}' AS dataset, (SELECT count(*) FROM {rows}) AS n_rows, "
            f"CAST({tried} AS BIGINT) AS attempts, CAST({tried} - 1 AS BIGINT) AS failures, CAST({skipped} AS BIGINT) AS skipped"
            for layer, dataset, rows, tried, skipped in [
                ("bronze", "Contrat2", "contrat2", 1, 1), ("bronze", "Contrat1", "contrat1", 1, 1),
                ("bronze", "Client", "client", 2, 0), ("silver", "Client_contrat_silver", "silver", 1, 0),
                ("gold", "client_profile_analysis", "profile", 1, 0), ("gold", "contract_analysis", "mart", 1, 0),
            ]
        ),
    ),
    "silver_changes": _changes(),
    "lineage_reach": _with(
        ["lineage_moves"],
        """SELECT source, target, min(depth) AS depth FROM (
      WITH RECURSIVE step AS (SELECT DISTINCT source, target FROM lineage_moves),
      walk(source, target, depth, path) AS (
        SELECT source, target, 1, [source, target] FROM step WHERE source LIKE 'landing/%'
        UNION ALL
        SELECT w.source, s.target, w.depth + 1, list_append(w.path, s.target) FROM walk w JOIN step s ON s.source = w.target
        WHERE NOT list_contains(w.path, s.target))
      SELECT * FROM walk) GROUP BY source, target""",
    ),
    "bucketed_contract_client_join": _with(
        ["unique_contracts", "clients1"],
        f"""SELECT u.nusoc, u.nucon, u.prmaco, {', '.join('k.' + n for n in _CLIENT_PART)}
      FROM unique_contracts u LEFT JOIN clients1 k ON u.nusoc = k.nusoc""",
    ),
    "dedup_contracts": _with(["unique_contracts"], "SELECT * FROM unique_contracts"),
    "dedup_clients": _with(
        ["client"],
        f"""SELECT nusoc, age_client, client_jeune, sexsoc, cspsoc, sitmat, sitpav1 FROM (
  SELECT *, row_number() OVER (PARTITION BY nusoc
    ORDER BY {_nulls_last(['age_client', 'client_jeune', 'sexsoc', 'cspsoc', 'sitmat', 'sitpav1'])}) AS rn
  FROM (SELECT nusoc, {AGE} AS age_client, {YOUNG} AS client_jeune, sexsoc, cspsoc, sitmat, sitpav1 FROM client))
  WHERE rn = 1""",
    ),
    "sample_rows": "SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5",
    # aggregates
    "contract_analysis": _with(["mart"], "SELECT * FROM mart ORDER BY total_contracts DESC, type_vehicule"),
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    "column_statistics": _all(_statistics("lineitem", LINEITEM_TYPES).values()),
    "retention_rate": _with(
        ["conformed"],
        f"SELECT CAST(sum({ACTIVE}) AS DOUBLE) / count(*) * 100 AS retention_rate FROM conformed",
    ),
    "active_share_by_type": _with(
        ["conformed"],
        f"""SELECT {VEHICLE_TYPE} AS type_vehicule, CAST(sum({ACTIVE}) AS DOUBLE) / count(*) * 100 AS market_share
  FROM conformed GROUP BY 1""",
    ),
    # data quality
    "dq_row_count": _with(["contrat2"], _row_count("Contrat2", "contrat2")),
    "dq_null_profile": _with(["contrat2"], _contract_nulls()),
    "contract_mart_extremes": f"WITH silver AS ({EXTREMES})\n{STEPS['mart']}",
    "text_statistics": f"WITH numbers AS ({NUMBERS_IN_TEXT})\n" + _all(_statistics("numbers", NUMBER_TYPES).values()),
    "data_volume_of_text": """SELECT 'landing' AS layer, 'orders' AS dataset, 13 * count(*) AS size_bytes FROM orders
      UNION ALL SELECT 'landing', 'lines', 21 * count(*) FROM lineitem""",
    "daily_run_checks": _with(
        ["silver"],
        "SELECT *, DATE '2026-03-08' AS run_date FROM ("
        + _all(
            [
                _row_count("Client_contrat_silver", "silver"),
                _critical("Client_contrat_silver", "silver", ["nusoc", "nucon"]),
                _result("Client_contrat_silver", "amount_conformance", "n", _unless("n > 0", "WARN"), "'prmaco'", "'decimal(28,6)'")
                + " FROM (SELECT count(*) FILTER (prmaco IS NOT NULL AND TRY_CAST(prmaco AS DECIMAL(28,6)) IS NULL) AS n FROM silver)",
                _duplicates("Client_contrat_silver", "key_duplicates", "silver", ["nusoc", "nucon"], "WARN", "nusoc,nucon"),
            ]
        )
        + ")",
    ),
    "dq_amount_conformance": f"WITH extremes AS ({EXTREMES})\n"
    + _result(
        "extremes",
        "amount_conformance",
        "n",
        _unless("n > 0", "WARN"),
        "'prmaco'",
        "'decimal(28,6)'",
    )
    + " FROM (SELECT count(*) FILTER (prmaco IS NOT NULL AND TRY_CAST(prmaco AS DECIMAL(28,6)) IS NULL) AS n FROM extremes)",
    "dq_check_suite": _with(
        ["quality_input"],
        _all(
            [
                _critical("lines", "quality_input", ["l_linenumber"]),
                _critical("lines", "quality_input", ["l_returnflag"]),
                *[
                    _result(
                        "lines",
                        "data_freshness",
                        "NULL",
                        "'PASS'",
                        f"'{n}'",
                        f"strftime(latest_{n}, '%Y-%m-%d %H:%M:%S')",
                    )
                    + f" FROM (SELECT max({n}) AS latest_{n} FROM quality_input)"
                    for n in ("created_at", "created_at")
                ],
                *[
                    _result("lines", "type_conformance", "n", _unless("n > 0", "FAIL"), "'l_returnflag'", f"'{t}: string'")
                    + f" FROM (SELECT count(*) FILTER (l_returnflag IS NOT NULL AND TRY_CAST(l_returnflag AS {t}) IS NULL) "
                    "AS n FROM quality_input)"
                    for t in ("int", "date")
                ],
            ]
        ),
    ),
    "dq_critical_nulls": _with(["contrat2"], _critical("Contrat2", "contrat2", ["nusoc", "nucon", "prmaco", "etatco"])),
    "dq_row_duplicates": "WITH copied AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 7)\n"
    + _duplicates("lines", "row_duplicates", "copied", LINEITEM_TYPES, "WARN", "all columns"),
    "dq_key_duplicates": _with(
        ["quality_input"],
        _duplicates("lines", "key_duplicates", "quality_input", LINE_COLUMNS[:2], "WARN", "l_orderkey,l_linenumber"),
    ),
    "dq_freshness": _with(
        ["quality_input"],
        _result(
            "lines",
            "data_freshness",
            "date_diff('day', CAST(latest AS DATE), DATE '2026-03-08')",
            _unless("date_diff('day', CAST(latest AS DATE), DATE '2026-03-08') > 30", "FAIL"),
            "'created_at'",
            "strftime(latest, '%Y-%m-%d %H:%M:%S')",
        )
        + " FROM (SELECT max(created_at) AS latest FROM quality_input)",
    ),
    "dq_type_conformance": _types(),
    "dq_silver_profile": _silver_profile(),
    "dq_bronze_validation": _lines_validation(),
    "dq_gold_shape": _with(
        ["mart"],
        _all(
            [
                _result("contract_analysis", "rows", "n", "'PASS'") + " FROM (SELECT count(*) AS n FROM mart)",
                _result("contract_analysis", "columns", "7", "'PASS'"),
                _result(
                    "contract_analysis",
                    "sample",
                    "NULL",
                    "'PASS'",
                    detail="type_vehicule || '|' || total_contracts || '|' || unique_clients",
                )
                + " FROM (SELECT * FROM mart ORDER BY type_vehicule LIMIT 5)",
            ]
        ),
    ),
    "dq_table_report": _with(["client"], _table_report()),
    "dq_check_totals": _check_totals(),
    "dq_pass_rate": _pass_rate(),
    "dq_expectations": _with(
        ["client"],
        _all(
            [
                _result("Client", "row_count_between", "n", _unless("n < 1", "FAIL"), detail="'1..None'")
                + " FROM (SELECT count(*) AS n FROM client)",
                # the view lists nbenf before accmai as the schema does, so the order matches
                _result("Client", "columns_in_order", "18", "'PASS'", detail=f"'{','.join(CLIENT_TYPES)}'"),
            ]
        ),
    ),
    "dq_key_unique": _with(["client"], _duplicates("Client", "key_unique", "client", ["nusoc"], "FAIL", "nusoc")),
    "dq_layer_growth": _with(
        ["contrat2", "contrat1", "unique_contracts"],
        _result(
            "Client_contrat_silver",
            "layer_growth",
            "round(CAST(a - b AS DOUBLE) / b * 100, 2)",
            _unless("(a - b) * 100 > b * 10.0", "FAIL"),
            detail="'bronze=' || b || ' silver=' || a",
        )
        + " FROM (SELECT (SELECT count(*) FROM contrat2) + (SELECT count(*) FROM contrat1) AS b, "
        "(SELECT count(*) FROM unique_contracts) AS a)",
    ),
    "dq_gold_dimensions": _with(
        ["profile"],
        _critical("client_profile_analysis", "profile", ["nusoc", "sexsoc", "cspsoc"], "FAIL", "null_dimensions"),
    ),
    "dq_partition_conformance": _partition_conformance(),
    "dq_kpis": _with(
        ["quality_input"],
        """SELECT CAST(date_trunc('year', m) AS DATE) AS period_start, 'lines' AS dataset,
  round(avg(greatest(0.0, 1 - CAST(bad + extra AS DOUBLE) / n) * 100), 4) AS data_quality_score,
  CAST(sum(bad) AS BIGINT) AS null_record_count, CAST(sum(extra) AS BIGINT) AS duplicate_record_count,
  round(avg(CAST(1 + CASE WHEN bad = 0 THEN 1 ELSE 0 END + CASE WHEN extra = 0 THEN 1 ELSE 0 END AS DOUBLE) / 3 * 100), 4)
    AS validation_pass_rate
FROM (SELECT m, sum(c) AS n, sum(bad) AS bad, sum(c - 1) AS extra FROM (
    SELECT date_trunc('month', created_at) AS m, l_orderkey, l_linenumber, count(*) AS c,
      count(*) FILTER (l_linenumber IS NULL OR l_returnflag IS NULL) AS bad
    FROM quality_input GROUP BY 1, 2, 3) GROUP BY m)
GROUP BY 1""",
    ),
    # run log, lineage, catalog
    "run_totals": _with(["run_log"], f"SELECT job_name, status, {TOTALS} FROM run_log GROUP BY 1, 2"),
    "failure_totals": _with(
        ["run_log"], f"SELECT job_name, event_type, {TOTALS} FROM run_log WHERE status = 'FAILURE' GROUP BY 1, 2"
    ),
    "duration_histogram": _histogram("job_name", [30, 60, 120, 300, 600, 1800, 3600]),
    "storage_duration_histogram": _histogram("event_type", [1, 5, 10, 30, 60, 300]),
    "job_kpis": _with(["run_log"], f"SELECT job_name, {KPIS} FROM run_log GROUP BY 1"),
    "kpi_window_5m": _window("5 minutes"),
    "kpi_window_1h": _window("1 hour"),
    "kpi_window_1d": _window("1 day"),
    "kpi_stream_1d": _window("1 day"),
    "events_by_job": _with(["run_log"], "SELECT job_name, count(*) AS event_count FROM run_log GROUP BY 1"),
    "transform_efficiency": _with(
        ["run_log"],
        """SELECT run_id, job_name, CAST(records_out AS DOUBLE) / CAST(records_in AS DOUBLE) * 100
  AS transformation_efficiency FROM run_log WHERE records_in > 0""",
    ),
    "lineage_edges": _with(
        ["lineage_log"],
        """SELECT source, target, count(*) AS n_moves, CAST(sum(n_rows) AS BIGINT) AS total_rows
  FROM lineage_log GROUP BY 1, 2""",
    ),
    "catalog_table_query": _with(
        ["daily_log"],
        """SELECT year, month, day, count(*) AS n_runs, CAST(sum(records_out) AS BIGINT) AS total_records
  FROM daily_log GROUP BY 1, 2, 3""",
    ),
    # whole layers
    "bronze_ingest": _with(
        ["contrat2", "contrat1"],
        f"""SELECT {_LANDED}, 'Contrat2' AS dataset FROM contrat2
  UNION ALL SELECT {_LANDED}, 'Contrat1' AS dataset FROM contrat1""",
    ),
    "bronze_ingest_rejects": _with(
        ["contrat2"],
        """SELECT CAST(nusoc AS INT) AS nusoc, CAST(nucon AS INT) AS nucon,
  CASE WHEN prmaco IS NOT NULL AND TRY_CAST(prmaco AS DOUBLE) IS NULL THEN 'rejected' ELSE 'good' END AS kept_as
  FROM contrat2""",
    ),
    "silver_by_day": _with(
        ["silver", "conformed"],
        """SELECT 2026 AS transform_year, 3 AS transform_month, 8 AS transform_day, count(*) AS n_contracts,
  sum(TRY_CAST(prmaco AS DECIMAL(28,6))) AS total_premium FROM silver
  UNION ALL
  SELECT 2026, 3, 9, count(*), sum(TRY_CAST(prmaco AS DECIMAL(28,6))) FROM (
    SELECT prmaco, row_number() OVER (PARTITION BY nusoc, nucon ORDER BY """
        + _nulls_last([n for n in CONTRACT_NAMES if n not in ("nusoc", "nucon")])
        + """) AS rn FROM conformed) WHERE rn = 1""",
    ),
    "bronze_ingest_client": _with(
        ["client"], f"SELECT {', '.join(f'CAST({n} AS {t}) AS {n}' for n, t in CLIENT_TYPES.items())} FROM client"
    ),
    "silver_contracts": _with(["silver"], "SELECT * FROM silver"),
    "client_profile": _with(["profile"], "SELECT * FROM profile"),
    "bronze_to_silver_gate": _with(
        ["quality_input"],
        """SELECT *, CAST(year(created_at) AS INT) AS ingestion_year, CAST(month(created_at) AS INT) AS ingestion_month,
  CAST(day(created_at) AS INT) AS ingestion_day, CAST(year(created_at) AS INT) AS transform_year,
  CAST(month(created_at) AS INT) AS transform_month, CAST(day(created_at) AS INT) AS transform_day,
  CAST(0.0 AS DOUBLE) AS data_quality_score
FROM quality_input WHERE l_linenumber IS NOT NULL AND l_returnflag IS NOT NULL""",
    ),
    "bronze_to_silver_gate_results": _lines_validation(
        ["ingestion_year", "ingestion_month", "ingestion_day", "ingestion_timestamp"]
    ),
    "csv_reject_rows": _with(
        ["contrat2"],
        "SELECT CAST(nusoc AS INT) AS nusoc, CAST(nucon AS INT) AS nucon, etatco, concat_ws(',', "
        + ", ".join(f"COALESCE(CAST({n} AS STRING), '')" for n in CONTRACT_NAMES)
        + ") AS raw_line FROM contrat2 WHERE prmaco = 'bad'",
    ),
}
