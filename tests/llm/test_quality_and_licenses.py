import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from math import comb

from check_oracle import connect, differences
from strataflow.llm import license_scan, quality_rules
from strataflow.llm.queries import ORACLE
from tests.conftest import SF, rows

COUNTS = ["_q." + c for c in (*quality_rules.BASE, "base_failed")]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    assert differences(spark, duck, name, SF) == []


def plain_counts(text):
    text = text or ""
    for c in "\t\n\v\f\r":
        spaced = text.replace(c, " ") if c == "\t" else spaced.replace(c, " ")
    words = [w for w in spaced.split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    n = len(words)
    counts = (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))
    return (*counts, n < 50 or 100 * len(covered) > 50 * n)


pieces = st.sampled_from(["a", "b", "é", "#", " ", "\n", "\t", "\r", "\v", "\f", " ", "word ", "a b c ", "<|>"])


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.lists(pieces, max_size=60).map("".join), min_size=20, max_size=30))
def test_counts_equal_plain_python(spark, texts):
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id LONG, text STRING")
    found = {r[0]: tuple(r)[1:] for r in quality_rules.with_signals(df).select("doc_id", *COUNTS).collect()}
    assert found == {i: plain_counts(t) for i, t in enumerate([*texts, None, ""])}


@pytest.mark.parametrize(("n", "k", "p"), [(10, 0, 0.3), (400, 3, 0.02), (5000, 9, 0.005), (50_000, 180, 0.005), (7, 7, 0.5)])
def test_binomial_tail_is_exact(spark, n, k, p):
    got = spark.sql(f"SELECT {quality_rules.binomial_tail('n', 'k', p)} AS p FROM VALUES ({n}L, {k}L) AS t(n, k)").first().p
    exact = float(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))) if n < 1000 else None
    if k >= n * p:
        assert got == 1.0
    elif exact is not None:
        assert got == pytest.approx(exact, rel=1e-9)
    else:
        from decimal import Decimal, getcontext

        getcontext().prec = 60
        q = Decimal(p)
        exact = sum(Decimal(comb(n, i)) * q**i * (1 - q) ** (n - i) for i in range(k + 1))
        assert got == pytest.approx(float(exact), rel=1e-8)


def test_cutoffs_hold_their_promise_and_reject_junk(spark):
    draw = random.Random(5)
    texts, labels = [], []
    for i in range(900):
        good = i % 3 > 0
        words = ["w%d" % draw.randrange(10_000) + ("" if good else "###") for _ in range(60)]
        texts.append((i, " ".join(words), "en" if i % 2 else "xx"))
        labels.append((i, int(good), 0))
    docs = spark.createDataFrame(texts, "doc_id LONG, text STRING, lang STRING")
    marks = spark.createDataFrame([*labels, (0, None, None), (None, 1, 1)], "doc_id LONG, quality INT, toxic INT")
    verdicts = quality_rules.quality_verdicts(docs, marks, quality_rules.Risk(0.4)).select("doc_id", "_kept").collect()
    assert {r.doc_id: r._kept for r in verdicts} == {i: i % 3 > 0 for i in range(900)}
    # too few labels certify nothing, so nothing but the base rules rejects
    few = quality_rules.quality_verdicts(docs, marks.limit(20)).where("NOT _kept")
    assert few.isEmpty()


def test_kept_rows_keep_their_columns(spark, documents):
    long = " ".join("w%d" % i for i in range(60))
    docs = documents((1, long), (2, "short"), (None, long), (1, long), (4, None))
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    kept = quality_rules.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    assert rows(kept, "doc_id") == sorted([(1,), (1,), (None,)], key=repr)
    assert quality_rules.kept_documents(docs.limit(0), labels).count() == 0


def filler(n, seed):
    draw = random.Random(seed)
    return " ".join("z%d" % draw.randrange(10**6) for _ in range(n))


def test_every_template_is_found_anywhere(documents):
    texts, expected = [], set()
    for i, (name, notice) in enumerate(license_scan.TEMPLATES.items()):
        for j, before in enumerate((0, 1, 5, 17, 100)):
            texts.append((10 * i + j, f"{filler(before, j)}\n\n{notice.upper()} -- {filler(30, i)}"))
            expected.add((10 * i + j, name))
    found = set(rows(license_scan.licenses_found(documents(*texts)), "doc_id", "license"))
    assert expected <= found
    assert {(d, n) for d, n in found - expected if not n.startswith(("Apache", "CC", "GPL", "MIT"))} == set()


def test_changed_notices_and_edge_texts(documents):
    grant = license_scan.TEMPLATES["MIT grant"].split()
    changed = " ".join([*grant[:20], "altered", *grant[21:]])
    torn = " ".join(grant[: len(grant) // 2])
    docs = documents((1, changed), (2, torn), (3, None), (4, ""), (5, "\n \t"), (6, " ".join(grant)), (6, " ".join(grant)))
    found = {(r.doc_id, r.license): r.containment for r in license_scan.licenses_found(docs).collect()}
    assert found[1, "MIT grant"] == pytest.approx(1 - 5 / (len(license_scan.words(" ".join(grant))) - 4), abs=0.02)
    assert found[6, "MIT grant"] == 1.0 and {d for d, _ in found} == {1, 6}
    assert license_scan.licenses_found(docs.limit(0)).count() == 0
    assert license_scan.licenses_found(docs, {}).count() == 0


def test_notices_at_the_very_end_are_found_at_every_length(documents):
    of = {name: n for n, names in license_scan.size_classes(license_scan.TEMPLATES).items() for name in names}
    texts, expected = [], set()
    for i, (name, notice) in enumerate(license_scan.TEMPLATES.items()):
        n = len(license_scan.words(notice))
        for j in range(max(1, of[name] // 2)):
            texts.append((1000 * i + j, f"{filler(2 * of[name] + j - n, j)} {notice}"))
    runs = lambda words: {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}
    known = {name: runs(license_scan.words(t)) for name, t in license_scan.TEMPLATES.items()}
    for d, text in texts:
        words = license_scan.words(text)
        expected |= {(d, name) for name, own in known.items() if len(own & runs(words)) >= 0.8 * len(own)}
    assert {d for d, _ in texts} == {d for d, _ in expected}
    assert set(rows(license_scan.licenses_found(documents(*texts)), "doc_id", "license")) == expected


def test_same_rows_as_sql_where_cutoffs_are_certified(spark):
    """With the query's risk so few labels certify nothing; with a larger one they do, and rules reject rows."""
    folder = SF.replace("sf0.001", "sf0.01")
    risk = quality_rules.Risk(0.8)
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    verdicts = quality_rules.quality_verdicts(docs, labels, risk).selectExpr("doc_id", *COUNTS, "_kept")
    got = rows(verdicts)
    expected = connect(folder).sql(quality_rules.oracle_sql(risk)).fetchall()
    assert got == sorted(map(tuple, expected), key=repr)
    by_rule = [r for r in got if not r[-1] and not r[-2]]
    assert len(by_rule) > 5
