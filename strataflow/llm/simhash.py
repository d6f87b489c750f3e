"""Near-duplicate groups by SimHash fingerprints, compared through tables of distances to pivots.

A fingerprint has one bit per hash bit of a text's word shingles: 1 if the bit is set in over half of them.  Texts
with one fingerprint form a class at once; links are then sought between classes only.

*Where pairs come from.*  Comparing all pairs would not scale, so the 64 bits are cut into six blocks.  Two
fingerprints at distance 3 or less agree on at least three blocks, so each is filed under its twenty choices of three
blocks, and only fingerprints filed together meet.  No pair within the radius is missed.  Another radius takes three
blocks more than its bits.

*Pivots.*  For every fingerprint the distances to ``PIVOTS`` reference fingerprints are computed once.  By the triangle
inequality two fingerprints whose distances to one pivot differ by more than the radius cannot be linked; a pair is
dropped on the largest difference over all pivots, and the survivors are verified bit by bit.

*Large buckets.*  A bucket of more than ``BUCKET`` fingerprints is not compared in one task: its members are filed
again by blocks of the bits the bucket leaves free (64, then 32, 16, 8 bits), which keeps the search exact.  It ends at
``FEW_BITS`` free bits, where a bucket has at most 4,096 fingerprints.  From each bucket only the edges of a spanning forest leave,
never all its pairs.

*A second fingerprint.*  A wide radius over 64 bits would link unrelated texts of a large corpus by chance.  A second
fingerprint, of shingles of another length, can be carried along and must then also agree within a radius of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stored, words_of
from strataflow.llm.graph import components

SHINGLE = 3
RADIUS = 3
SEED = 42
PIVOTS = 16
KEPT = 3  # blocks that two fingerprints filed together agree on
BUCKET = 2_048
FEW_BITS = 12
CHOICES_AT_ONCE = 24
AT_ONCE = 1_000_000  # pairs looked at together
BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a text's word shingles, as an unsigned number; zero without words."""
    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    last = ends[shingle - 1 :].tolist() if len(words) >= shingle else [len(joined)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=True)], "<u8")
    octets = hashes.view(np.uint8).reshape(-1, 8)
    value = 0
    for i in range(8):
        set_in = np.bincount(octets[:, i], minlength=256) @ BYTE_BITS
        value |= int(np.packbits(2 * set_in > n, bitorder="little")[0]) << (8 * i)
    return value


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, second: int | None = None) -> DataFrame:
    """doc_id, fingerprint and second fingerprint (signed longs) of every row; null and empty texts have zeros.

    ``second`` is the shingle length of the second fingerprint, which is zero without it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            columns = [batch.column("doc_id")]
            for size in (shingle, second):
                columns.append(pa.array([signed(fingerprint(t, size)) if size else 0 for t in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fingerprint", "second"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fingerprint long, second long"
    )


def pivot_fingerprints(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints, spread by hashing their number."""
    return np.array([xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(count)], np.uint64)


def pivot_table(values: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each fingerprint to each pivot."""
    return np.bitwise_count(values[:, None] ^ pivots[None, :]).astype(np.int16)


def forest(
    values: np.ndarray, second: np.ndarray, runs: np.ndarray, radius: int, second_radius: int, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest over the fingerprints that are linked within a run, as positions.

    ``runs`` numbers the runs, equal numbers side by side.
    """
    n = len(values)
    root = np.arange(n)
    distances = pivot_table(values, pivots)
    starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
    ends = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
    partners = ends - np.arange(n) - 1  # later members of the row's own run
    first = 0
    while first < n:
        sums = np.cumsum(partners[first:])
        last = first + max(1, int(np.searchsorted(sums, AT_ONCE, side="right")))
        count = partners[first:last]
        left = np.repeat(np.arange(first, last), count)
        offset = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        right = left + 1 + offset
        for column in range(distances.shape[1]):
            near = np.abs(distances[left, column] - distances[right, column]) <= radius
            left, right = left[near], right[near]
        linked = np.bitwise_count(values[left] ^ values[right]) <= radius
        linked &= np.bitwise_count(second[left] ^ second[right]) <= second_radius
        join(root, left[linked], right[linked])
        first = last
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def join(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Merge the trees of each pair, the smaller root winning; ``root`` points at roots before and after."""
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        if not len(left):
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def masks(free: int, radius: int) -> list[int]:
    """The parts of the ``free`` bits that stay free when ``radius`` of ``radius + KEPT`` blocks may differ."""
    bits = [i for i in range(64) if free >> i & 1]
    blocks = [sum(1 << b for b in bits[i :: radius + KEPT]) for i in range(radius + KEPT)]
    return [sum(chosen) for chosen in combinations(blocks, radius)]


def filed(rows: DataFrame, radius: int, choices: slice) -> DataFrame:
    """Rows (value, second, free) repeated under each key of some choices: the bits kept, and the bits left free."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[int]] = {}
        for batch in batches:
            values, second, free = unsigned(batch, "value", "second", "free")
            for mask in np.unique(free).tolist():
                part, more = values[free == mask], second[free == mask]
                for left_free in known.setdefault(mask, masks(mask, radius)[choices]):
                    m = np.full(len(part), left_free, np.uint64)
                    arrays = [pa.array(x.view(np.int64)) for x in (part, more, m, part & ~m)]
                    yield pa.RecordBatch.from_arrays(arrays, ["value", "second", "free", "key"])

    return rows.mapInArrow(run, "value long, second long, free long, key long")


def unsigned(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).view(np.uint64) for n in names]


LINKS = "a long, a2 long, b long, b2 long, free long"


def links_of(*columns: np.ndarray | None) -> pa.RecordBatch:
    n = len(columns[0])
    arrays = [pa.nulls(n, pa.int64()) if x is None else pa.array(x.view(np.int64)) for x in columns]
    return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in LINKS.split(", ")])


def links_in_buckets(keyed: DataFrame, radius: int, second_radius: int, bucket: int, pivot_count: int) -> DataFrame:
    """From rows (value, second, free, key): edges (a, a2, b, b2), and the rows of large buckets (a, a2, free) for the
    next round.  A task reads its buckets one after the other and holds no more than one of bounded size."""
    pivots = pivot_fingerprints(pivot_count)

    def complete(part: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        value, second, free, key = part
        run_of = np.cumsum(starts_of(free, key))
        size = np.bincount(run_of)[run_of]
        large = (size > bucket) & (np.bitwise_count(free) > FEW_BITS)
        several = (size > 1) & ~large
        if large.any():
            yield links_of(value[large], second[large], None, None, free[large])
        if several.any():
            v, w = value[several], second[several]
            a, b = forest(v, w, run_of[several], radius, second_radius, pivots)
            yield links_of(v[a], w[a], v[b], w[b], None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the rows of a bucket that may go on in the next batch
        overflown = None  # free and key of a bucket that went on too long to be held
        for batch in batches:
            part = unsigned(batch, "value", "second", "free", "key")
            if not len(part[0]):
                continue
            if overflown:
                same = (part[2] == overflown[0]) & (part[3] == overflown[1])
                n = len(same) if same.all() else int(np.argmin(same))
                if n:
                    yield links_of(part[0][:n], part[1][:n], None, None, part[2][:n])
                if n == len(same):
                    continue
                part, overflown = [x[n:] for x in part], None
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part, strict=True)]
            last = int(np.flatnonzero(starts_of(part[2], part[3]))[-1])
            if last:
                yield from complete([x[:last] for x in part])
            held = [x[last:] for x in part]
            if len(held[0]) > bucket and int(held[2][0]).bit_count() > FEW_BITS:
                yield links_of(held[0], held[1], None, None, held[2])
                overflown, held = (held[2][0], held[3][0]), None
        if held is not None:
            yield from complete(held)

    ordered = keyed.repartition("free", "key").sortWithinPartitions("free", "key", "value", "second")
    return ordered.mapInArrow(run, LINKS)


def starts_of(free: np.ndarray, key: np.ndarray) -> np.ndarray:
    return np.r_[True, (free[1:] != free[:-1]) | (key[1:] != key[:-1])]


def linked_fingerprints(
    classes: DataFrame, radius: int = RADIUS, second_radius: int = 64, bucket: int = BUCKET, pivots: int = PIVOTS
) -> DataFrame:
    """Edges (a, b) between the nodes of ``classes`` (value, second; distinct) that connect all linked ones."""
    rows = classes.select("value", "second", F.lit(-1).cast("long").alias("free"))
    found = []
    while True:
        large = []
        # A few choices of blocks at a time: a wide radius has many, and their rows would all be in flight together.
        for first in range(0, len(masks(2**64 - 1, radius)), CHOICES_AT_ONCE):
            keyed = filed(rows, radius, slice(first, first + CHOICES_AT_ONCE))
            step = stored(links_in_buckets(keyed, radius, second_radius, bucket, pivots), "simhash-links")
            found.append(step.where("b IS NOT NULL").selectExpr("xxhash64(a, a2) AS a", "xxhash64(b, b2) AS b"))
            large.append(step.where("b IS NULL").selectExpr("a AS value", "a2 AS second", "free"))
        rows = reduce(DataFrame.unionByName, large)
        if rows.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).distinct()


def near_duplicate_groups(
    prints: DataFrame, radius: int = RADIUS, second_radius: int = 64, bucket: int = BUCKET, pivots: int = PIVOTS
) -> DataFrame:
    """doc_id, fingerprint and component_id of every row of ``prints`` (doc_id, fingerprint, second).

    ``component_id`` is the smallest doc_id that links reach, its own included; rows without id are grouped too.
    """
    each = prints.groupBy("fingerprint", "second").agg(F.min("doc_id").alias("first"))
    classes = stored(each.withColumn("node", F.xxhash64("fingerprint", "second")), "simhash-classes")
    values = classes.select(F.col("fingerprint").alias("value"), "second")
    roots = components(linked_fingerprints(values, radius, second_radius, bucket, pivots))
    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = stored(named.join(least, "root").select("fingerprint", "second", "component_id"), "simhash-labels")
    joined = prints.join(labels, ["fingerprint", "second"])
    return joined.select("doc_id", "fingerprint", "component_id")


def first_of_groups(docs: DataFrame, prints: DataFrame, **settings) -> DataFrame:
    """One row of each group of ``docs``, all columns as they are: that with the smallest doc_id.

    Of rows with one doc_id and one text one stays.  A row without id is taken for a document of its own text.
    """
    return first_rows(docs, near_duplicate_groups(prints.where("doc_id IS NOT NULL"), **settings))


def first_rows(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``first_of_groups`` for the rows of ``groups`` (doc_id, component_id)."""
    chosen = groups.select(F.col("component_id").alias("doc_id")).distinct()
    named = docs.join(chosen, "doc_id", "left_semi")
    unnamed = docs.where("doc_id IS NULL")
    both = named.unionByName(unnamed)
    mark = "_text" + "_" * max(map(len, docs.columns))  # longer than any name there is
    once = both.withColumn(mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark])
    return once.select(*docs.columns)
