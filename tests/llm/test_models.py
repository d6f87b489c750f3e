import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import interpolation, toxicity
from strataflow.llm.queries import QUERIES
from tests.conftest import SF, rows

INSULTS = ["blockhead", "nitwit", "dunderpate"]


def sentences(draw, n):
    syllables = ["ka", "lo", "mi", "ter", "sun", "vel", "dro", "pe", "an", "is"]
    return ["".join(draw.choice(syllables) for _ in range(draw.randrange(1, 5))) for _ in range(n)]


def corpus(n=400, change=lambda w, draw: w, seed=1):
    draw, out = random.Random(seed), []
    for i in range(n):
        words = sentences(draw, 40)
        if i % 4 == 0:
            for _ in range(2):
                words.insert(draw.randrange(40), change(draw.choice(INSULTS), draw))
        out.append((i, " ".join(words[:20]) + ". " + " ".join(words[20:]), int(i % 4 == 0)))
    return out


@pytest.fixture(scope="module")
def machine(spark):
    data = corpus()
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (3, None)], "doc_id LONG, toxic INT")
    return toxicity.train(docs, labels)


def insert(word, draw):
    k = draw.randrange(2, len(word) - 1)
    return word[:k] + draw.choice("*.-_1") + word[k:]


@pytest.mark.parametrize(("change", "least"), [(lambda w, d: w, 0.98), (insert, 0.9), (lambda w, d: " ".join(w), 0.98)])
def test_plain_inserted_and_spaced_insults_are_found(spark, machine, change, least):
    data = corpus(200, change, seed=7)
    docs = spark.createDataFrame([d[:2] for d in data], "doc_id LONG, text STRING")
    found = {r.doc_id: r.predicted for r in toxicity.scored(docs, machine).collect()}
    right = [found[i] == y for i, _, y in data]
    assert np.mean([r for r, d in zip(right, data) if d[2]]) >= least
    assert np.mean([r for r, d in zip(right, data) if not d[2]]) >= 0.98


def test_kernel_of_the_table_is_the_sum_over_landmarks():
    landmarks = toxicity.Landmarks(["blockhead", "nitwit", "kalo"])
    weights = np.array([1.0, -2.0, 0.5])
    table = landmarks.table(weights)
    fragments = ["nitwit", "ni.twit", "xy", "head"]
    through = landmarks.project(fragments, np.eye(3))[:, :-1] @ weights
    straight = toxicity.Machine(table, 0.0, 1, 0).margins(fragments)
    assert straight == pytest.approx(through, abs=1e-5)
    # the plain sum over all triples of positions
    def feature(u):
        places, weight = toxicity.subsequences(len(u))
        out = Counter()
        for (i, j, k), w in zip(places.tolist(), weight.tolist(), strict=True):
            out[tuple(map(toxicity.char_class, (u[i], u[j], u[k])))] += w
        return out
    a, b = feature("ni.twit"), feature("nitwit")
    assert landmarks.project(["ni.twit"], np.eye(3))[0, 1] == pytest.approx(sum(v * b[k] for k, v in a.items()), abs=1e-5)


def test_edge_texts_and_missing_labels(spark, machine, documents):
    docs = documents((1, None), (2, ""), (2, ""), (None, "nitwit you"), (5, "a" * 200_000), (6, "ß.  !? ..."))
    out = toxicity.scored(docs, machine)
    assert out.columns == ["doc_id", "score", "predicted", "worst"] and out.count() == 6
    assert all(0 <= r.score <= 1 for r in out.collect())
    kept = toxicity.kept_documents(docs, machine)
    assert kept.columns == docs.columns and (None,) not in rows(kept, "doc_id") and kept.count() == 5
    short = toxicity.scored(docs.withColumn("doc_id", docs.doc_id.cast("int")), machine)
    assert rows(short) == rows(out)
    none = spark.createDataFrame([], "doc_id LONG, toxic INT")
    assert toxicity.train(docs, none) == 0.0
    assert toxicity.train(docs, spark.createDataFrame([(1, 1)], none.schema)) == 1.0
    assert {r.score for r in toxicity.scored(docs, 0.25).collect()} == {0.25}
    assert toxicity.scored(docs.limit(0), machine).count() == 0


def test_held_out_documents_do_not_teach(spark):
    out = {r.doc_id: r.held_out for r in QUERIES["op1_toxicity"](spark, SF).collect()}
    assert out == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in out}


def plain_base(texts, fold):
    tokens = {i: [*(t or "").encode().lower().split(), 0] for i, t in texts.items()}
    c = Counter(w for i, ws in tokens.items() if fold[i] for w in ws)
    n, v = sum(c.values()), len(c)
    score = {i: sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws) for i, ws in tokens.items()}
    return {i: (len(ws), sum(c[w] > 0 for w in ws), n, score[i]) for i, ws in tokens.items()}


def test_base_score_and_counts_equal_plain_python(spark):
    draw = random.Random(2)
    texts = {i: " ".join(sentences(draw, draw.randrange(30))) for i in range(120)}
    texts |= {200: None, 201: "", 202: "\x00end Ka KA ka\tkA", 203: "ka " * 3000}
    df = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    expected = plain_base(texts, {i: zlib.crc32(str(i).encode()) % 10 for i in texts})
    for r in interpolation.interpolated_scores(df).collect():
        n, known, total, base = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_model_score_equals_the_formula(spark, monkeypatch):
    texts = {i: t for i, t in enumerate(["a b a b", "b a b", "a b c", "a a", "b c b", "q a", "a b a", "c c", "b", "a b b c"] * 3)}
    df = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    kept = {}
    plain = interpolation.mixture_weights
    monkeypatch.setattr(interpolation, "mixture_weights", lambda *a: kept.setdefault("w", plain(*a)))
    got = {r.doc_id: r.score for r in interpolation.interpolated_scores(df).collect()}
    train = [["<", *t.split(), ">"] for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    single, pair = Counter(w for t in train for w in t), Counter(p for t in train for p in zip(t, t[1:]))
    n, v = sum(single.values()) - single["<"], len(single) - 1
    for i, t in texts.items():
        words, total = ["<", *t.split(), ">"], 0.0
        for h, w in zip(words, words[1:]):
            a = kept["w"][interpolation.frequency_bucket(np.array([single[h]]))[0]]
            total += math.log10(a[0] * pair[h, w] / max(single[h], 1) + a[1] * single[w] / n + a[2] / (v + 1))
        assert got[i] == pytest.approx(total)
    assert kept["w"].sum(axis=1) == pytest.approx(np.ones(interpolation.BUCKETS))


def test_the_mixture_beats_the_base_on_unseen_text(spark):
    held = QUERIES["op4_interpolation"](spark, SF).where("held_out").selectExpr("sum(score) AS m", "sum(base_score) AS b").first()
    assert held.m > 0.85 * held.b
    nothing = spark.createDataFrame([], "doc_id LONG, text STRING")
    assert interpolation.interpolated_scores(nothing).count() == 0
    untaught = spark.createDataFrame([(None, "a b"), (None, None)], nothing.schema)
    assert [(r.n_tokens, r.train_tokens, r.score) for r in interpolation.interpolated_scores(untaught).collect()] == [
        (3, 0, 0.0),
        (1, 0, 0.0),
    ]
