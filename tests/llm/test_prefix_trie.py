import hashlib
import random
import zlib

import pytest

from check_oracle import connect, differences
from strataflow.llm import prefix_trie as pt
from tests.conftest import SF, rows

SCHEMA = "conv_id LONG, turn INT, role STRING, text STRING, node STRING, words STRING, place STRING, base LONG"


def conversations(spark, *turns):
    return spark.createDataFrame([(*t, "n", "w", "p", 7) for t in turns], SCHEMA)


def rebuilt(turns):
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - c % 20, [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def plain_trie(paths):
    members = {}
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members.setdefault(tuple(paths[c][:d]), []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        inner = {n[:-1] for n in members if n}
        ends = ",".join(str(c) for c in convs if len(paths[c]) == len(node))
        saved = sum((len(members[n]) - 1) * len(n[-1][1].split()) for n in below if n)
        parent = members[node[:-1]][0] if node else None
        children = sum(1 for n in below if len(n) == len(node) + 1)
        leaves = sum(n not in inner for n in below)
        row = (convs[0], len(node), parent, len(convs), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
        out.append(row)
    return sorted(out, key=repr)


def some_turns(draw, ids, texts, longest):
    made = []
    for c in ids:
        for t in range(draw.randrange(1, longest)):
            turn = None if draw.random() < 0.1 else t
            made.append((c, turn, draw.choice(["user", "bot", None]), draw.choice(texts)))
    draw.shuffle(made)
    return made


@pytest.mark.parametrize(("shard", "limit"), [(1024, 100_000), (3, 100_000), (1024, 5)])
def test_trie_equals_plain_version(spark, monkeypatch, shard, limit):
    monkeypatch.setattr(pt, "SHARD", shard)
    monkeypatch.setattr(pt, "TURNS", limit)
    draw = random.Random(shard + limit)
    turns = some_turns(draw, [*range(45), *range(300, 310), 10**12], ["a b", "c", "", None, "é  \n x"], 5)
    turns += [(None, 1, "user", "lost"), *turns[:4]]
    got = pt.prefix_trie(pt.rebuilt(pt.numbered_turns(conversations(spark, *turns).repartition(3))))
    assert rows(got) == plain_trie(rebuilt(turns))


def test_one_beginning_in_every_conversation_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(pt, "SHARD", 16)
    paths = {c: [("user", "same words here"), ("bot", "same")] for c in range(200)}
    paths[7] = [("user", "same words here"), *[("bot", f"{i} turns") for i in range(400)]]
    turns = [(c, i, *t) for c, path in paths.items() for i, t in enumerate(path)]
    got = pt.prefix_trie(pt.numbered_turns(conversations(spark, *turns).repartition(5)))
    found = {(r.conv_id, r.depth): r for r in got.collect()}
    assert len(found) == 3 + 400
    assert found[0, 0].n_leaves == 2
    assert found[0, 1].saved_tokens == 199 * 3 + 198
    assert found[7, 401].parent_conv_id == 7
    ends = ",".join(str(c) for c in paths if c != 7)
    assert found[0, 2].ends_sha256 == hashlib.sha256(ends.encode()).hexdigest()


def test_no_conversation_and_no_turn(spark):
    assert pt.prefix_trie(pt.rebuilt(pt.numbered_turns(conversations(spark).where("conv_id > 0")))).count() == 0
    alone = [(1, None, None, None)]  # all of its turns are before its first h
    assert zlib.crc32(b"1") % 4 > 0
    got = pt.prefix_trie(pt.rebuilt(pt.numbered_turns(conversations(spark, *alone))))
    assert rows(got) == [(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())]


def test_same_rows_as_sql(spark):
    assert differences(spark, connect(SF), "op12_prefix_trie", SF) == []
