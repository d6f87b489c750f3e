import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from strataflow.llm import decontamination, simhash
from strataflow.llm.graph import components
from tests.conftest import rows


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAÉ \t\n\x0b ", max_size=40), st.integers(1, 5))
def test_fingerprint_equals_its_definition(text, k):
    assert simhash.fingerprint(text, k) == plain_fingerprint(text, k)


def plain_groups(values, radius, second, second_radius):
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            near = (values[i] ^ values[j]).bit_count() <= radius
            if near and (second[i] ^ second[j]).bit_count() <= second_radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def flipped(value, draw, bits):
    for _ in range(bits):
        value ^= 1 << draw.randrange(64)
    return value


@pytest.mark.parametrize(
    ("radius", "second_radius", "bucket", "free"),
    [(3, 64, 2048, 64), (3, 64, 8, 64), (3, 64, 4, 20), (7, 14, 2048, 64), (7, 10, 16, 64)],
)
def test_groups_equal_all_pairs(spark, radius, second_radius, bucket, free):
    draw = random.Random(radius + bucket)
    values, second = [], []
    for _ in range(25):
        base, other = draw.getrandbits(min(free, 64)), draw.getrandbits(64)
        for _ in range(draw.choice([1, 3, 20])):
            values.append(flipped(base, draw, draw.randrange(2 * radius)))
            second.append(flipped(other, draw, draw.randrange(12)) if second_radius < 64 else 0)
    ids = list(range(100, 100 + len(values)))
    prints = [(i, simhash.signed(v), simhash.signed(w)) for i, v, w in zip(ids, values, second, strict=True)]
    df = spark.createDataFrame([*prints, prints[3]], "doc_id LONG, fingerprint LONG, second LONG").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(df, radius, second_radius, bucket).collect()}
    roots = plain_groups(values, radius, second, second_radius)
    assert got == {i: 100 + r for i, r in zip(ids, roots, strict=True)}


def test_pivots_never_drop_a_link():
    draw = random.Random(1)
    pivots = simhash.pivot_fingerprints()
    for _ in range(300):
        a = draw.getrandbits(64)
        b = flipped(a, draw, 3)
        table = simhash.pivot_table(np.array([a, b], np.uint64), pivots)
        assert np.abs(table[0] - table[1]).max() <= (a ^ b).bit_count()


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    random.Random(3).shuffle(edges)
    found = rows(components(spark.createDataFrame(edges, "a LONG, b LONG")))
    assert sorted(found) == sorted([(i, 0) for i in range(41)] + [(i, 100) for i in range(100, 160)])
    assert components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_copies_go_and_texts_with_nothing_in_common_stay(documents):
    draw = random.Random(9)
    words = ["w%d" % i for i in range(5000)]
    base = [" ".join(draw.choice(words) for _ in range(300)) for _ in range(30)]
    near = [t.replace(t.split()[150], "changed", 1) for t in base[:10]]
    pairs = list(enumerate(base)) + [(100 + i, t) for i, t in enumerate(near)] + [(200 + i, t.upper()) for i, t in enumerate(base)]
    docs = documents(*pairs, (0, base[0]), (None, base[5]), (None, base[5]), (None, None), (900, None), (901, ""))
    prints = simhash.fingerprints(docs, second=5)
    kept = simhash.first_of_groups(docs, prints, radius=7, second_radius=14)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    named = sorted(i for i in ids if i is not None)
    assert set(named) >= set(range(30)) and len([i for i in named if 100 <= i < 110]) <= 1
    assert [i for i in named if i >= 200] == [900] and ids.count(None) == 2
    empty = docs.limit(0)
    assert simhash.first_of_groups(empty, simhash.fingerprints(empty)).count() == 0


# ---- benchmark passages ----


def item(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(n))


def plain_passages(texts, items, similarity=0.8):
    """Document and item of every pair with a window that is similar enough, all windows against all items."""
    import math

    def runs(words, k):
        return [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]

    split = {i: (t or "").lower().split() for i, t in items.items() if (t or "").split()}
    of = {i: set(runs(w, min(5, len(w)))) for i, w in split.items()}
    df = {}
    for s in of.values():
        for x in s:
            df[x] = df.get(x, 0) + 1
    weigh = lambda s: sum(math.log(1 + len(of) / df.get(x, 1)) for x in s)
    found = set()
    for d, t in texts.items():
        words = (t or "").lower().split()
        for i, own in of.items():
            k = min(5, len(split[i]), len(words) or 1)
            all_runs = runs(words, k)
            size = min(len(split[i]) - min(5, len(split[i])) + 1, len(all_runs))
            for s in range(len(all_runs) - size + 1):
                window = set(all_runs[s : s + size])
                if window and weigh(window & own) >= similarity * weigh(window | own) - 1e-9:
                    found.add((d, i))
    return found


def test_passages_equal_all_windows_against_all_items(spark, documents):
    draw = random.Random(4)
    items = {i: item(draw, draw.choice([3, 5, 12, 30, 60])) for i in range(25)}
    items[25], items[26] = items[3], items[20] + " and some more words here"
    texts = {}
    for d in range(120):
        words = item(draw, 80).split()
        at = draw.randrange(80)
        passage = items[draw.randrange(27)].split()
        for _ in range(draw.choice([0, 0, 1, 2])):
            passage[draw.randrange(len(passage))] = "zzzz"
        texts[d] = " ".join(words[:at] + passage + words[at:]) if d % 3 else " ".join(words)
    texts |= {500: items[4], 501: " ".join(items[4].split()[:-1]), 502: "", 503: None, 504: items[0].upper()}
    bench = spark.createDataFrame([*items.items(), (None, "a b c"), (77, None), (78, " ")], "item_id LONG, text STRING")
    docs = documents(*texts.items())
    expected = plain_passages(texts, items)
    assert len(expected) > 30
    # a wide radius leaves nothing to chance in this comparison
    wide = decontamination.passages(docs, bench, radius=31)
    assert set(rows(wide, "doc_id", "item_id")) == expected
    found = decontamination.passages(docs, bench)
    close = set(rows(found, "doc_id", "item_id"))
    assert close <= expected and len(close) >= 0.97 * len(expected)
    clean = decontamination.without_passages(docs, bench, radius=31)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(texts) - {d for d, _ in expected}
    assert decontamination.passages(docs.limit(0), bench).count() == 0
    assert decontamination.without_passages(docs, bench.limit(0)).count() == len(texts)


def test_passages_do_not_depend_on_the_blocks_of_items(spark, documents):
    draw = random.Random(11)
    opening = item(draw, 9)  # words that many items begin with weigh little, in whatever block the items lie
    items = {i: (opening + " " if i % 3 else "") + item(draw, draw.choice([4, 14, 30])) for i in range(40)}
    items |= {40: opening, 41: items[1]}
    texts = {}
    for d in range(80):
        passage = items[d % 42].split()
        for _ in range(draw.choice([0, 1, 2, 3])):
            passage[draw.randrange(len(passage))] = draw.choice([*opening.split(), "zzzz"])
        texts[d] = " ".join([item(draw, 20), *passage, opening, item(draw, 5)])
    bench = spark.createDataFrame([*items.items(), (41, items[1])], "item_id LONG, text STRING")
    docs = documents(*texts.items())
    expected = plain_passages(texts, items)

    def found(at_once):
        got = decontamination.passages(docs, bench, at_once=at_once, radius=31)
        return sorted((r.doc_id, r.item_id, r.start, r.n_words, round(r.similarity, 9), r.distance) for r in got.collect())

    whole = found(10**6)
    assert {(d, i) for d, i, *_ in whole} == expected and len(list(decontamination.item_blocks(bench, 200))) > 3
    assert found(200) == whole
    some = decontamination.without_passages(docs, bench, at_once=200, radius=31)
    assert {r.doc_id for r in some.collect()} == set(texts) - {d for d, _ in expected}


def test_a_benchmark_of_too_many_common_shingles_is_refused(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g")], "item_id LONG, text STRING")
    assert decontamination.frequencies(bench, most=3).count.tolist() == [2, 2, 2]
    with pytest.raises(ValueError, match="several items"):
        decontamination.frequencies(bench, most=2)
