import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataflow.llm import periodic_runs as pr
from strataflow.llm.queries import QUERIES
from tests.conftest import SF


def plain_runs(words, shortest=12):
    """Every lag over the whole text; a stretch belongs to its least lag."""
    found = {}
    for q in range(1, len(words)):
        i = q
        while i < len(words):
            n = 0
            while i + n < len(words) and words[i + n] == words[i + n - q]:
                n += 1
            if n and n + q >= max(shortest, 2 * q):
                found.setdefault((i - q, n + q), q)
            i += n + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def with_repeats(draw, n, letters):
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(3):
        a = draw.randrange(n)
        p = draw.randrange(1, 1 + max(1, (n - a) // 2))
        end = min(n, a + draw.randrange(1, 6) * p + draw.randrange(3))
        for i in range(a, end):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 50])
def test_runs_equal_all_lags(letters):
    draw = random.Random(letters)
    for _ in range(250):
        words = with_repeats(draw, draw.randrange(1, 120), letters)
        assert pr.runs_of(np.array(words, np.int64)) == plain_runs(words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(2, 16))
def test_runs_equal_all_lags_for_any_least_length(words, shortest):
    assert pr.runs_of(np.array(words, np.int64), shortest) == plain_runs(words, shortest)


def test_periods_inside_periods():
    inner = ([1, 2] * 8 + [3]) * 4
    assert pr.runs_of(np.array(inner)) == plain_runs(inner)
    fibonacci, before = [0, 1], [0]
    for _ in range(7):
        fibonacci, before = fibonacci + before, fibonacci
    assert pr.runs_of(np.array(fibonacci)) == plain_runs(fibonacci)


@pytest.mark.parametrize(("line", "times"), [(1, 300_000), (7, 60_000), (997, 400)])
def test_a_long_text_of_repeated_words_stays_cheap(line, times):
    words = np.array([i % line for i in range(line * times)], np.int64)
    assert pr.runs_of(words) == [(0, line * times, line)]


def test_frequent_lines_between_other_words_stay_cheap():
    words = np.array([w for i in range(20_000) for w in (1, 2, 3, 4, 5, 6, 7, 8, 9, 100 + i)], np.int64)
    assert pr.runs_of(words) == []


def test_words_without_repeats():
    words = list(b"a b c".split()) * 5 + [b"d"]
    runs = pr.runs_of(pr.numbered(words))
    assert runs == [(0, 15, 3)]
    assert b" ".join(pr.without_repeats(words, runs)) == b"a b c d"


def tail_repeated(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    words = tail_repeated(doc_id, (text or "").encode().split()) if doc_id is not None else (text or "").encode().split()
    runs = plain_runs(pr.numbered(words).tolist())
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    sums = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), kept)]
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *sums)


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(spark, documents):
    texts = [None, "", " \n\t", "x", "a b c " * 30, "é ü\x85ß " * 40, "w " * 5_000]
    pairs = [(i, t) for i in [*range(12), None] for t in texts]
    docs = documents(*pairs, *pairs[:3])
    got = pr.digests(pr.periodic_runs(pr.with_repeated_tails(docs)))
    quick = {"w " * 5_000}
    want = [plain_row(*p) for p in [*pairs, *pairs[:3]] if p[1] not in quick]
    # A text of one word stays one under any repetition.
    lines = hashlib.sha256(b"0,5000,1\n").hexdigest()
    want += [(p[0], 1, 0, 5000, 1, 5_000_000, lines, hashlib.sha256(b"w").hexdigest()) for p in pairs if p[1] in quick]
    assert results(got) == sorted(want, key=repr)
    assert pr.digests(pr.periodic_runs(docs.limit(0))).count() == 0


def test_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = [tuple(r) for r in docs if len((r.text or "").split()) < 700]
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(docs)
    assert len(short) > 100
    for doc_id, text in short:
        assert got[doc_id] == plain_row(doc_id, text)
    for doc_id, text in {tuple(r) for r in docs} - set(short):
        words = tail_repeated(doc_id, text.encode().split())
        runs = pr.runs_of(pr.numbered(words))
        assert got[doc_id][1] == len(runs)
