"""Quality rules whose cutoffs are certified on labelled rows: how many good documents they reject is under control.

Each rule compares one signal of a text with a cutoff.  For every stratum (language) and rule the cutoffs of a fixed
grid are tested on the labelled documents that pass the base rules.  A cutoff is certified if the exact binomial bound
shows that it rejects at most ``risk / rules`` of the good documents: with ``k`` of ``n`` good ones rejected,
``P(Binomial(n, risk / rules) <= k) <= delta / tests``.  ``tests`` counts all strata, rules and cutoffs together
(Bonferroni), so with probability ``1 - delta`` every certified cutoff keeps its promise at once, and so do all rules
of a stratum together.  Among certified cutoffs the one that rejects the most bad documents is taken, a good one
weighing ten; where none is certified or useful, the rule rejects nothing there.

All of it is DataFrame and SQL expressions.  Signals are ratios in thousandths, as whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stored

STRATA = ("en", "de", "fr", "es")  # other languages and null are one stratum, "other"
RISK = 0.02
DELTA = 0.05
GOOD_WEIGHT = 10
# Signal and the cutoffs tried; a document is rejected if the signal lies above the cutoff.
GRID = {
    "symbols": (1000, 700, 500, 400, 300, 200, 100),
    "dup_lines": (900, 800, 700, 600, 500, 400, 350),
    "repeats": (900, 800, 700, 600, 500, 400, 300),
    "word_length": (9000, 8500, 8000, 7500, 7000, 6500),
}
SPACES = r" \t\n\u000B\u000C\r"  # in an SQL literal
BETWEEN = r"[\\x20\\x09-\\x0D]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Risk:
    """How often good documents may be rejected, and how sure that must be."""

    risk: float = RISK
    delta: float = DELTA
    good_weight: int = GOOD_WEIGHT


def with_signals(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``_q``, a struct of the base counts, ``base_failed``, the stratum and the rules' signals.

    A null text counts as empty.  Windows of three words are told apart by a 64-bit hash of their words.  The struct
    also holds the task's number, which is not deterministic: so a filter on the struct stays above it, instead of
    being pushed down and computing every signal again inside its condition.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    step = docs.withColumns({"_text": text, "_body": F.expr(f"trim(BOTH '{SPACES}' FROM coalesce(text, ''))")})
    step = step.withColumns(
        {
            "_words": F.expr(f"IF(_body = '', CAST(array() AS array<string>), split(_body, '{BETWEEN}'))"),
            "_lines": F.expr("filter(split(_text, '\\n'), l -> l RLIKE '[^\\\\x20\\\\x09-\\\\x0D]')"),
        }
    )
    step = step.withColumn(
        "_h", F.expr("slice(transform(_words, (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2))), 1, "
                     "greatest(size(_words) - 2, 0))")
    )
    # Most texts repeat no window; only the others are sorted to find which windows are repeated.
    repeated = """
        CASE WHEN size(array_distinct(_h)) = size(_h) THEN 0 ELSE
          aggregate(array(sort_array(transform(_h, (h, i) -> struct(h, i)))), 0, (acc, s) -> size(array_distinct(flatten(
            transform(
              filter(s, (x, i) -> (i > 0 AND get(s, i - 1).h = x.h) OR (i + 1 < size(s) AND get(s, i + 1).h = x.h)),
              x -> array(x.i, x.i + 1, x.i + 2))))))
        END"""
    step = step.withColumns(
        {
            "_n": F.expr("CAST(size(_words) AS LONG)"),
            "_chars": F.expr("CAST(length(array_join(_words, '')) AS LONG)"),
            "_symbols": F.expr("CAST(length(_text) - length(translate(_text, '#*$%&|<>', '')) AS LONG)"),
            "_dups": F.expr("CAST(size(_lines) - size(array_distinct(_lines)) AS LONG)"),
            "_repeats": F.expr(f"CAST({repeated} AS LONG)"),
            "_n_lines": F.expr("CAST(size(_lines) AS LONG)"),
        }
    )
    strata = ", ".join(f"'{s}'" for s in STRATA)
    lang = "lang" if "lang" in docs.columns else "CAST(NULL AS STRING)"
    packed = f"""named_struct(
        'task', spark_partition_id(), 'n_words', _n, 'word_chars', _chars, 'n_symbols', _symbols, 'n_dup_lines', _dups, 'n_repeat_words', _repeats,
        'base_failed', _n < 50 OR 100 * _repeats > 50 * _n,
        'stratum', CASE WHEN {lang} IN ({strata}) THEN {lang} ELSE 'other' END,
        'symbols', 1000 * _symbols DIV greatest(_n, 1), 'dup_lines', 1000 * _dups DIV greatest(_n_lines, 1),
        'repeats', 1000 * _repeats DIV greatest(_n, 1), 'word_length', 1000 * _chars DIV greatest(_n, 1))"""
    return step.select(*docs.columns, F.expr(packed).alias("_q"))


def log_gamma(x: str) -> str:
    """SQL for ln Γ(x), x >= 1: Stirling's series eight places up, and back; good to about 1e-12."""
    up = f"(({x}) + 8D)"
    series = f"1 / (12 * {up}) - 1 / (360 * pow({up}, 3)) + 1 / (1260 * pow({up}, 5)) - 1 / (1680 * pow({up}, 7))"
    product = " * ".join(f"(({x}) + {i}D)" for i in range(8))
    return f"(({up} - 0.5) * ln({up}) - {up} + 0.5 * ln(2 * pi()) + {series} - ln({product}))"


def binomial_tail(n: str, k: str, p: float) -> str:
    """SQL for P(Binomial(n, p) <= k); 1 where k is not below the mean, which certifies nothing anyway."""
    q = 1 - p
    log_top = (
        f"{log_gamma(f'{n} + 1')} - {log_gamma(f'{k} + 1')} - {log_gamma(f'{n} - {k} + 1')} "
        f"+ {k} * ln({p!r}D) + ({n} - {k}) * ln({q!r}D)"
    )
    # The sum below the top term, in units of the top term.
    ratio = f"({k} - i) / ({n} - {k} + i + 1D) * {q / p!r}D"
    below = (
        f"aggregate(sequence(0L, {k}), named_struct('s', 0D, 't', 1D), "
        f"(acc, i) -> named_struct('s', acc.s + acc.t, 't', acc.t * {ratio}), acc -> acc.s)"
    )
    return f"CASE WHEN {k} >= {n} * {p!r}D THEN 1D ELSE exp({log_top}) * {below} END"


def certified_cutoffs(labelled: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """stratum and one cutoff per rule (null: the rule rejects nothing), from rows (_q, quality).

    Rows that fail the base rules are left out: the rules do not decide them.  At most one row per stratum.
    """
    tries = ", ".join(
        f"named_struct('rule', '{rule}', 'cutoff', {cutoff}L, 'hit', _q.{rule} > {cutoff})"
        for rule, cutoffs in GRID.items()
        for cutoff in cutoffs
    )
    counted = (
        labelled.selectExpr(
            "_q.stratum AS stratum", "IF(_q.base_failed, NULL, quality > 0) AS good", f"inline(array({tries}))"
        )
        .groupBy("stratum", "rule", "cutoff")
        .agg(
            F.count_if("good").alias("n"),
            F.count_if(F.expr("good AND hit")).alias("k"),
            F.count_if(F.expr("NOT good AND hit")).alias("bad"),
        )
    )
    # One window over all groups: there are at most strata times rules times cutoffs of them.
    tested = counted.withColumns(
        {"tests": F.expr("count(*) OVER ()"), "p": F.expr(binomial_tail("n", "k", risk.risk / len(GRID)))}
    )
    best = (
        tested.where(f"p <= {risk.delta!r}D / tests AND bad > {risk.good_weight} * k")
        .groupBy("stratum", "rule")
        .agg(F.max(F.struct(F.expr(f"bad - {risk.good_weight} * k"), "cutoff")).getField("cutoff").alias("cutoff"))
    )
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(rule) for rule in GRID]
    )


def stored_signals(docs: DataFrame) -> DataFrame:
    """doc_id and ``_q`` of every row, kept in the shared folder: no text moves, and none is read twice for them."""
    names = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    return stored(with_signals(docs.select(*names)).select("doc_id", "_q"), "quality-signals")


def labelled_rows(signals: DataFrame, labels: DataFrame) -> DataFrame:
    """Signals and quality of the labelled documents; one label per document, bad if any row says so."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return signals.join(marks, "doc_id").select("_q", "quality")


def with_verdict(signals: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Rows with ``_q`` plus ``_kept``; ``cutoffs`` has one row per stratum, five at most, so it is broadcast."""
    named = cutoffs.select(F.struct("*").alias("_cut"))
    joined = signals.join(F.broadcast(named), F.expr("_q.stratum = _cut.stratum"), "left")
    rejected = " OR ".join(f"coalesce(_q.{rule} > _cut.{rule}, false)" for rule in GRID)
    return joined.withColumn("_kept", F.expr(f"NOT _q.base_failed AND NOT ({rejected})")).drop("_cut")


def quality_verdicts(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """doc_id, ``_q`` and ``_kept`` of every row."""
    signals = stored_signals(docs)
    return with_verdict(signals, certified_cutoffs(labelled_rows(signals, labels), risk))


def kept_documents(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """The rows of ``docs`` that base rules and certified rules keep, all columns as they are.

    The signals are computed once for the labels and once more beside the texts, which therefore never move.
    """
    cutoffs = stored(certified_cutoffs(labelled_rows(stored_signals(docs), labels), risk), "quality-cutoffs")
    # The rows travel as one column, so that their names meet none of ours.
    names = [c for c in ("text", "lang") if c in docs.columns]
    rows = with_signals(docs.select(F.struct("*").alias("_row"), *names))
    return with_verdict(rows, cutoffs).where("_kept").select("_row.*")


def oracle_sql(risk: Risk = Risk()) -> str:
    """The same in DuckDB."""
    tries = ", ".join(f"('{rule}', {cutoff})" for rule, cutoffs in GRID.items() for cutoff in cutoffs)
    strata = ", ".join(f"'{s}'" for s in STRATA)
    p = risk.risk / len(GRID)
    value = "CASE rule " + " ".join(f"WHEN '{r}' THEN {r}" for r in GRID) + " END"
    hit = " OR ".join(f"coalesce(s.{r} > c.{r}, false)" for r in GRID)
    pivot = ", ".join(f"max(CASE WHEN rule = '{r}' THEN cutoff END) AS {r}" for r in GRID)
    white = r"[\x20\x09-\x0D]"
    return rf"""
    WITH texts AS (
      SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
    parts AS (
      SELECT *, list_filter(regexp_split_to_array(text, '{white}+'), lambda w: w <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM texts),
    windows AS (
      SELECT rid, i, words[i:i + 2] AS w FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM parts)),
    twice AS (
      SELECT rid, unnest(range(i, i + 3)) AS place
      FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1),
    repeats AS (SELECT rid, count(DISTINCT place) AS n_repeat_words FROM twice GROUP BY rid),
    base AS (
      SELECT p.rid, doc_id, CASE WHEN lang IN ({strata}) THEN lang ELSE 'other' END AS stratum,
             CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
      FROM parts p LEFT JOIN repeats r ON p.rid = r.rid),
    signals AS (
      SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
             1000 * n_repeat_words // greatest(n_words, 1) AS repeats,
             1000 * word_chars // greatest(n_words, 1) AS word_length FROM base),
    marks AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
    counted AS (
      SELECT stratum, rule, cutoff, count(*) FILTER (NOT base_failed AND quality > 0) AS n,
             count(*) FILTER (NOT base_failed AND quality > 0 AND {value} > cutoff) AS k,
             count(*) FILTER (NOT base_failed AND quality <= 0 AND {value} > cutoff) AS bad
      FROM signals JOIN marks USING (doc_id), (VALUES {tries}) AS t(rule, cutoff) GROUP BY ALL),
    tails AS (
      SELECT stratum, rule, cutoff, n, k, bad,
             CASE WHEN k >= n * {p!r} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda j: exp(
               lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({p!r}) + (n - j) * ln({1 - p!r})))) END AS p,
             (SELECT count(*) FROM counted) AS tests FROM counted),
    best AS (
      SELECT stratum, rule, max((bad - {risk.good_weight} * k, cutoff))[2] AS cutoff FROM tails
      WHERE p <= {risk.delta!r} / tests AND bad > {risk.good_weight} * k GROUP BY ALL),
    cuts AS (SELECT stratum, {pivot} FROM best GROUP BY stratum)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND NOT ({hit}) AS kept
    FROM signals s LEFT JOIN cuts c ON s.stratum = c.stratum"""
