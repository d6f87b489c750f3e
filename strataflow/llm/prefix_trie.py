"""Prefix trie of conversations by vertical bitmaps.

A node is a distinct sequence of first turns, from the root (no turn); its members are the conversations that start with
it.  Conversations are cut into shards, ``SHARD`` neighbouring ids each.  A shard is indexed vertically: for each
(position, turn) the bitset of its conversations that have this turn there.  Depth first, the bitset of a node
intersected with the postings of the next position gives its children, popcounts the numbers of members, and what has no
further turn is the end list.

Nodes of different shards are one if they have the same key, 128 bits hashed along the path, so the texts themselves are
not moved.  What a node sums over its subtree is summed inside each shard first: a node that several shards have is
counted by the shard of its smallest member only, and whether it has children or how many members is brought back to
all of them.  So no step follows the depth of the trie, no key meets more rows than there are shards, and the trie is
never in one place.

A shard is closed after ``SHARD`` conversations or ``TURNS`` turns, never inside a conversation: a task's memory grows
with the longest conversation, some 500 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import WORD, rows_of, stored

SHARD = 1_024
TURNS = 100_000
ROOT = bytes(16)
NODES = (
    "shard long, number int, above int, node binary, depth long, words long, conv_id long, n long, inner boolean, "
    "ends array<long>"
)
KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 4, pa.bool_(), pa.list_(pa.int64())]
SUMS = "node binary, parent_conv_id long, n_children long, n_leaves long, saved_tokens long"


@dataclass
class Shard:
    """Conversations with ascending ids; ``postings`` and ``longer`` are bitsets over their places in ``ids``."""

    ids: list[int] = field(default_factory=list)
    turns: list[list[tuple[bytes, int]]] = field(default_factory=list)
    postings: dict[tuple[int, bytes], int] = field(default_factory=dict)
    longer: dict[int, int] = field(default_factory=dict)
    size: int = 0

    def start(self, conv_id: int) -> None:
        self.ids.append(conv_id)
        self.turns.append([])

    def add(self, turn: bytes, words: int) -> None:
        """The next turn of the last conversation."""
        mine, bit = self.turns[-1], 1 << len(self.ids) - 1
        place = len(mine)
        mine.append((turn, words))
        self.postings[place, turn] = self.postings.get((place, turn), 0) | bit
        self.longer[place] = self.longer.get(place, 0) | bit
        self.size += 1

    def members(self, bits: int) -> list[int]:
        found = []
        while bits:
            low = bits & -bits
            found.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return found

    def nodes(self) -> Iterator[tuple]:
        """Rows of ``NODES``; ``number`` counts them and ``above`` is the parent's, which comes earlier."""
        open_ = [((1 << len(self.ids)) - 1, 0, -1, ROOT, 0)]
        number = 0
        while open_:
            bits, depth, above, node, words = open_.pop()
            rest = bits & self.longer.get(depth, 0)
            ends = self.members(bits ^ rest)
            first = self.ids[(bits & -bits).bit_length() - 1]
            yield self.ids[0], number, above, node, depth, words, first, bits.bit_count(), bool(rest), ends
            while rest:
                turn, length = self.turns[(rest & -rest).bit_length() - 1][depth]
                child = bits & self.postings[depth, turn]
                rest &= ~child
                key = hashlib.blake2b(node + turn, digest_size=16).digest()
                open_.append((child, depth + 1, number, key, length))
            number += 1


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place, turn (128 bits of role and text) and words of the turns of ``conversations``.

    Places count from 0 by ``turn``, null first, then by role and text.  A null role or text is empty.  Rows without
    conv_id are no conversation's.
    """
    own = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("at"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("at"), "role", "text")
    return own.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("place"),
        F.expr("unhex(md5(concat(length(role), ':', role, text)))").alias("turn"),
        F.size(F.regexp_extract_all("text", F.lit(f"({WORD})"))).cast("long").alias("words"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that share beginnings: the first h turns of number ``c - c % 20``, then c's own after its first h.

    h is ``crc32(c) % 4``.  Takes and returns the columns of ``numbered_turns``; each conversation also has a row without
    place, so that one without turns is there.
    """
    h = "crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % 4"
    every = turns.select("conv_id").distinct()
    heads = turns.where("place < 3").withColumnRenamed("conv_id", "base")
    before = every.withColumn("base", F.expr("conv_id - conv_id % 20")).join(heads, "base").where(f"place < {h}")
    after = turns.where(f"place >= {h}").withColumn("place", F.col("place") + 3)
    marks = every.selectExpr("conv_id", "CAST(NULL AS LONG) AS place", "CAST(NULL AS BINARY) AS turn", "0L AS words")
    return before.select("conv_id", "place", "turn", "words").unionByName(after).unionByName(marks)


def shard_nodes(turns: DataFrame) -> DataFrame:
    """The nodes of every shard, as ``NODES``."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")])

    def parts(shard: Shard) -> Iterator[pa.RecordBatch]:
        rows = []
        for row in shard.nodes():
            rows.append(row)
            if len(rows) == 10_000:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()
        for conv_id, turn, words in rows_of(batches, "conv_id", "turn", "words"):
            if not shard.ids or conv_id != shard.ids[-1]:
                if len(shard.ids) >= SHARD or shard.size >= TURNS:
                    yield from parts(shard)
                    shard = Shard()
                shard.start(conv_id)
            if turn is not None:
                shard.add(turn, words)
        if shard.ids:
            yield from parts(shard)

    near = turns.repartitionByRange("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("place"))
    return near.select("conv_id", "turn", "words").mapInArrow(run, NODES)


def subtree_sums(shard: pd.DataFrame) -> pd.DataFrame:
    """What one shard adds to its nodes: only nodes whose smallest member it has count, and each below its ancestors."""
    shard = shard.sort_values("number")
    own = shard["conv_id"] == shard["owner"]
    above, owner = shard["above"].tolist(), shard["owner"].tolist()
    children = [0] * len(shard)
    leaves = (own & ~shard["inner"]).astype(int).tolist()
    saved = ((shard["n_convs"] - 1) * shard["words"] * own).tolist()
    for i, mine in zip(range(len(shard) - 1, 0, -1), own.tolist()[:0:-1], strict=True):
        leaves[above[i]] += leaves[i]
        saved[above[i]] += saved[i]
        children[above[i]] += mine
    parent = pd.array([owner[a] if a >= 0 else None for a in above], "Int64")
    names = [c.split()[0] for c in SUMS.split(", ")]
    return pd.DataFrame(dict(zip(names, (shard["node"], parent, children, leaves, saved), strict=True)))


def trie(parts: DataFrame) -> DataFrame:
    """The whole trie from the (stored) nodes of the shards: one row per node, with its 128-bit ``node`` key."""
    merged = parts.groupBy("node").agg(
        F.min("conv_id").alias("owner"), F.sum("n").alias("n_convs"), F.max("inner").alias("inner")
    )
    known = parts.select("node", "shard", "number", "above", "words", "conv_id", "depth").join(merged, "node")
    sums = known.groupBy("shard").applyInPandas(subtree_sums, SUMS).groupBy("node")
    sums = sums.agg(F.max("parent_conv_id").alias("parent_conv_id"), *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
    depths = parts.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"))
    return depths.join(sums, "node")


def end_digests(parts: DataFrame) -> DataFrame:
    """node and the SHA-256 of the ids that end there, ascending, comma-joined.

    The lists of a node come by shard and run through one digest without being put together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        done: list[tuple[bytes, str]] = []

        def rows() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), (pa.binary(), pa.string()), strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])

        for node, ends in rows_of(batches, "node", "ends"):
            text = ",".join(map(str, ends)).encode()
            if node == now:
                digest.update(b"," + text)
                continue
            if now is not None:
                done.append((now, digest.hexdigest()))
            if len(done) == 10_000:
                yield rows()
            now, digest = node, hashlib.sha256(text)
        if now is not None:
            done.append((now, digest.hexdigest()))
            yield rows()

    lists = parts.where("size(ends) > 0").select("node", "shard", "ends")
    sorted_ = lists.repartition("node").sortWithinPartitions("node", "shard")
    return sorted_.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie of ``turns`` (as of ``numbered_turns``; a row without turn only names a conversation).

    conv_id: smallest member; depth; parent_conv_id: the parent's (root: null); n_convs: members; n_children; n_leaves:
    nodes without children in its subtree, itself included; saved_tokens: over the subtree, words of a node's last turn
    for every member but one; ends_sha256: digest of the conversations that are just this sequence.  No conversation
    gives no node.  Repeated rows are turns of their own.
    """
    parts = stored(shard_nodes(stored(turns, "trie-turns")), "trie-nodes")
    found = trie(parts).join(end_digests(parts), "node", "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return found.select(*names, F.coalesce("ends_sha256", none).alias("ends_sha256"))


CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
        lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))))"""

ORACLE = rf"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
        {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
    FROM conversations WHERE conv_id IS NOT NULL
), every AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)
), placed AS (
    SELECT e.conv_id, t.place, t.said FROM every e JOIN turns t ON t.conv_id = e.base AND t.place < e.h
    UNION ALL SELECT e.conv_id, t.place + 3, t.said FROM every e JOIN turns t ON t.conv_id = e.conv_id AND t.place >= e.h
), whole AS (
    SELECT e.conv_id, coalesce(list(p.said ORDER BY p.place) FILTER (p.said IS NOT NULL), []) AS path
    FROM every e LEFT JOIN placed p ON p.conv_id = e.conv_id GROUP BY e.conv_id
), members AS (
    SELECT conv_id, d AS depth, len(path) AS turns, md5(path[1:d]::VARCHAR) AS node, CASE WHEN d > 0 THEN md5(path[1:d - 1]::VARCHAR) END AS above,
        CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
    FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM whole)
), nodes AS (
    SELECT node, min(conv_id) AS conv_id, min(depth) AS depth, min(above) AS above, min(words) AS words, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (turns = depth), '')) AS ends_sha256
    FROM members GROUP BY node
), children AS (
    SELECT above AS node, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY above
), below AS (
    SELECT m.node, n.node AS inner_node FROM nodes n JOIN members m ON m.conv_id = n.conv_id AND m.depth <= n.depth
), summed AS (
    SELECT b.node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.words) AS saved_tokens
    FROM below b JOIN nodes n ON n.node = b.inner_node LEFT JOIN children c ON c.node = b.inner_node GROUP BY b.node
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves,
    s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN summed s USING (node) LEFT JOIN nodes p ON p.node = n.above LEFT JOIN children c ON c.node = n.node
"""
