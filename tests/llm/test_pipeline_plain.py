"""The stages of the pipeline against plain versions, over the whole smallest tables."""

import math

import corpus_pipeline
from strataflow.llm import toxicity
from strataflow.llm.common import table
from tests.conftest import SF
from tests.llm.test_quality_and_licenses import plain_counts
from tests.llm.test_verified_copies import plain_groups


def with_passage(text, items, of, weight, rare, similarity=0.8):
    """Whether a window of some item's size is similar enough; items without a shingle in the text are left out first."""
    words = (text or "").lower().split()
    runs = {k: [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] for k in {5, len(words) or 1}}
    sets = {k: set(r) for k, r in runs.items()}
    weigh = lambda s: sum(weight.get(x, rare) for x in s)
    for i, own in of.items():
        k = min(5, len(items[i]), len(words) or 1)
        if k not in runs:
            runs[k] = [" ".join(words[j : j + k]) for j in range(len(words) - k + 1)]
            sets[k] = set(runs[k])
        if weigh(own & sets[k]) < similarity * weigh(own) - 1e-9:
            continue
        size = min(len(items[i]) - min(5, len(items[i])) + 1, len(runs[k]))
        for s in range(len(runs[k]) - size + 1):
            window = set(runs[k][s : s + size])
            if window and weigh(window & own) >= similarity * weigh(window | own) - 1e-9:
                return True
    return False


def test_stages_equal_plain_versions(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(texts) == docs.count()
    # So few labels certify no cutoff: the base rules decide alone.
    good = {i: t for i, t in texts.items() if not plain_counts(t)[-1]}
    assert 0 < len(good) < len(texts)
    # The string kernel has tests of its own; here a document goes by its score.
    left = docs.where(docs.doc_id.isin(list(good)))
    scores = toxicity.scored(left, toxicity.train(left, labels)).collect()
    clean = {r.doc_id: good[r.doc_id] for r in scores if r.score < 0.5}
    assert len(clean) < len(good)
    groups = plain_groups(clean)
    first = {i: clean[i] for i in set(groups.values())}
    assert len(first) < len(clean)
    items = {r.item_id: r.text.lower().split() for r in table(spark, SF, "benchmark").collect() if (r.text or "").split()}
    of = {i: {" ".join(w[j : j + k]) for k in [min(5, len(w))] for j in range(len(w) - k + 1)} for i, w in items.items()}
    seen = {}
    for own in of.values():
        for x in own:
            seen[x] = seen.get(x, 0) + 1
    weight, rare = {x: math.log(1 + len(of) / n) for x, n in seen.items()}, math.log(1 + len(of))
    kept = {i for i, t in first.items() if not with_passage(t, items, of, weight, rare)}
    assert len(kept) < len(first)
    pieces = corpus_pipeline.run(spark, SF).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in pieces} == kept
