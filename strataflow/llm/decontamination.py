"""Benchmark passages in documents: SimHash of item-sized windows, and an exact weighted check.

A benchmark item of ``n`` words is compared with the windows of ``n`` words of every document (a shorter document is
one window).  Window and item have a 64-bit SimHash over their shingles of five words.  Candidates are all pairs of
fingerprints within ``RADIUS`` bits: the bits are cut into ``RADIUS + 1`` blocks, of which at least one must then be
equal, and the items are filed under each of their blocks.  A candidate is verified exactly: shingles weigh
``ln(1 + items / items with the shingle)``, those of no item as if one had them, and the weight of the shared shingles
must be at least ``SIMILARITY`` of the weight of all shingles of both.  The counts are those of the whole benchmark: what
is found does not depend on how the items are put into blocks.

Fingerprints are made only of windows that could pass: one whose item shingles weigh less than ``SIMILARITY`` of the
lightest item of its size has no verified pair, so leaving it out loses nothing.

The items are taken in blocks of at most ``SHINGLES_AT_ONCE`` shingles, which bounds what the executors are sent; each
block is one pass over the documents.  With every block go the shingles that several items have (16 bytes each; all others
have the weight of a single item); a benchmark with more than ``COMMON_SHINGLES`` of them is refused with an error before
any document is read.  Documents are neither moved nor cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import WORD, rows_of, sized, words_of

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 16
SHINGLES_AT_ONCE = 1_000_000
COMMON_SHINGLES = 4_000_000
READ_BYTES = 2_000_000
WINDOWS_AT_ONCE = 4_096
PAIRS_AT_ONCE = 1_000_000
WORDS_KNOWN = 200_000
FACTORS = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % 2**64 | 1 for i in range(SHINGLE)], np.uint64)
MATCHES = "doc_id long, item_id long, start long, n_words long, similarity double, distance int"


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, 42)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > WORDS_KNOWN:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h += words[i : i + n] * FACTORS[i]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """Running counts of set bits: row ``i`` holds those of the first ``i`` hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=out[1:])
    return out


def fingerprints(set_bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Bits that are set in over half the shingles."""
    return np.packbits(2 * set_bits > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()


def item_shingles(words: np.ndarray) -> np.ndarray:
    """Shingles of an item; one of fewer words than a shingle is a shingle itself."""
    return shingle_hashes(words, min(SHINGLE, len(words)))


@dataclass(frozen=True)
class Frequencies:
    """How many items the benchmark has, and in how many a shingle stands: listed if in several."""

    n_items: int
    common: np.ndarray
    count: np.ndarray

    @property
    def rare(self) -> float:
        return math.log(1 + max(1, self.n_items))

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        count = np.ones(len(hashes))
        if len(self.common):
            place = np.minimum(np.searchsorted(self.common, hashes), len(self.common) - 1)
            count = np.where(self.common[place] == hashes, self.count[place], count)
        return np.log(1 + max(1, self.n_items) / count)


@dataclass(frozen=True)
class Item:
    item_id: int
    n_words: int
    shingles: frozenset[int]
    weight: float
    fingerprint: int


@dataclass
class SizeClass:
    """Items of one number of words: their shingle length and fingerprints, the blocks these are filed under in
    order, and the item that each entry stands for."""

    n_words: int
    shingle: int
    least: float
    items: list[Item]
    marks: np.ndarray
    filed: np.ndarray
    place: np.ndarray


class Index:
    """Items of one block of the benchmark."""

    def __init__(
        self,
        rows: list[tuple[int, str]],
        frequencies: Frequencies,
        radius: int = RADIUS,
        similarity: float = SIMILARITY,
    ):
        self.radius, self.similarity, self.frequencies = radius, similarity, frequencies
        hashes = WordHashes()
        parts = []
        for item_id, text in rows:
            words = hashes.of(words_of(text))
            if len(words):
                parts.append((item_id, len(words), item_shingles(words)))
        self.known = np.unique(np.concatenate([hs for *_, hs in parts] or [np.zeros(0, np.uint64)]))
        self.known_weight = frequencies.weights(self.known)
        self.weight = dict(zip(self.known.tolist(), self.known_weight.tolist(), strict=True))
        edges = np.linspace(0, 64, radius + 2).astype(int).tolist()
        self.low = np.array(edges[:-1], np.uint64)
        self.mask = np.array([(1 << b - a) - 1 for a, b in zip(edges, edges[1:], strict=False)], np.uint64)
        self.number = np.arange(radius + 1, dtype=np.uint64) << np.uint64(32)
        self.classes: list[SizeClass] = []
        by_size: dict[int, list[Item]] = {}
        for item_id, n, hs in parts:
            distinct = frozenset(hs.tolist())
            mark = fingerprints(bit_counts(hs)[-1:], np.array([len(hs)]))[0]
            by_size.setdefault(n, []).append(Item(item_id, n, distinct, sum(map(self.weight.get, distinct)), int(mark)))
        for n, items in sorted(by_size.items()):
            marks = np.array([item.fingerprint for item in items], np.uint64)
            filed = self.blocks(marks)
            order = np.argsort(filed, kind="stable")
            least = min(item.weight for item in items)
            self.classes.append(SizeClass(n, min(SHINGLE, n), least, items, marks, filed[order], order // (radius + 1)))
        self.gate = np.zeros(1 << 22, bool)
        self.gate[(self.known & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def blocks(self, marks: np.ndarray) -> np.ndarray:
        """Number and bits of every block of every fingerprint, one fingerprint after the other."""
        return (marks[:, None] >> self.low & self.mask | self.number).ravel()

    def weights(self, hashes: np.ndarray) -> np.ndarray:
        """Weight of each shingle that an item has, 0 for the others."""
        out = np.zeros(len(hashes))
        maybe = np.flatnonzero(self.gate[(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        if len(maybe):
            place = np.minimum(np.searchsorted(self.known, hashes[maybe]), len(self.known) - 1)
            hit = self.known[place] == hashes[maybe]
            out[maybe[hit]] = self.known_weight[place[hit]]
        return out

    def near(self, marks: np.ndarray, kind: SizeClass) -> Iterator[tuple[int, int, int]]:
        """All pairs within the radius of some windows and the items of one size: their places and distance."""
        keys = self.blocks(marks)
        low = np.searchsorted(kind.filed, keys)
        count = np.searchsorted(kind.filed, keys, side="right") - low
        window = np.repeat(np.arange(len(keys)) // (self.radius + 1), count)
        entry = np.arange(len(window)) + np.repeat(low - (np.cumsum(count) - count), count)
        item = kind.place[entry]
        close = np.bitwise_count(marks[window] ^ kind.marks[item]) <= self.radius
        for pair in np.unique(window[close] * len(kind.items) + item[close]).tolist():
            w, i = divmod(pair, len(kind.items))
            yield w, i, (int(marks[w]) ^ kind.items[i].fingerprint).bit_count()

    def matches(self, hashes: np.ndarray, weights: np.ndarray, kind: SizeClass) -> Iterator[tuple[int, Item, float, int]]:
        """Verified windows of one document, for the items of one size: start, item, similarity, distance."""
        total = len(hashes)
        size = min(kind.n_words - kind.shingle + 1, total)
        sums = np.r_[0.0, np.cumsum(weights)]
        starts = np.flatnonzero(sums[size:] - sums[:-size] >= self.similarity * kind.least - 1e-9)
        at_once = max(1, min(WINDOWS_AT_ONCE, PAIRS_AT_ONCE // len(kind.filed)))
        for s in range(0, len(starts), at_once):
            part = starts[s : s + at_once]
            low = part[0]
            counts = bit_counts(hashes[low : part[-1] + size])
            marks = fingerprints(counts[part - low + size] - counts[part - low], np.full(len(part), size))
            for w, i, distance in self.near(marks, kind):
                start, item = int(part[w]), kind.items[i]
                window = set(hashes[start : start + size].tolist())
                shared = sum(self.weight[h] for h in window & item.shingles)
                other = self.frequencies.weights(np.array(list(window - item.shingles), np.uint64)).sum()
                similarity = float(shared / (item.weight + other))
                if similarity >= self.similarity - 1e-12:
                    yield start, item, similarity, distance

    def passages(self, words: np.ndarray, five: np.ndarray, weights: np.ndarray) -> Iterator[tuple]:
        """item_id, start, n_words, similarity and distance: of windows that overlap, the best for each item."""
        any_hit = bool(weights.any())
        for kind in self.classes:
            if kind.shingle == SHINGLE and len(words) >= SHINGLE:
                hashes, own = five, weights
                if not any_hit:
                    continue
            else:
                size = min(kind.shingle, len(words))
                hashes = shingle_hashes(words, size)
                own = self.weights(hashes)
                if not own.any():
                    continue
            best: dict[int, list] = {}
            for start, item, similarity, distance in self.matches(hashes, own, kind):
                last = best.get(item.item_id)
                if last and start < last[0] + kind.n_words:
                    last[0] = start
                    if similarity > last[2] + 1e-12:
                        last[1:] = [start, similarity, distance]
                    continue
                if last:
                    yield item.item_id, last[1], kind.n_words, last[2], last[3]
                best[item.item_id] = [start, start, similarity, distance]
            for item_id, (_, start, similarity, distance) in best.items():
                yield item_id, start, kind.n_words, similarity, distance


def found(texts: list[str | None], index: Index, known: WordHashes) -> Iterator[tuple]:
    """Row number and passage, for the texts of one batch read together."""
    words = [words_of(t) for t in texts]
    flat = known.of([w for part in words for w in part])
    five = shingle_hashes(flat, SHINGLE)
    weights = index.weights(five)
    short = any(k.shingle < SHINGLE for k in index.classes)
    end = 0
    for row, part in enumerate(words):
        begin, end = end, end + len(part)
        inside = slice(begin, max(begin, end - SHINGLE + 1))
        if part and (short or len(part) < SHINGLE or weights[inside].any()):
            for passage in index.passages(flat[begin:end], five[inside], weights[inside]):
                yield row, *passage


def items_of(benchmark: DataFrame) -> DataFrame:
    """Distinct items; rows without id or without a word are none."""
    rows = benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    return rows.where(F.col("text").rlike(WORD)).distinct()


def frequencies(benchmark: DataFrame, most: int = COMMON_SHINGLES) -> Frequencies:
    """Counts over the whole benchmark, whatever blocks it is taken in."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in sized(batches, "text", READ_BYTES):
            own = [np.unique(item_shingles(known.of(words_of(t)))) for (t,) in rows_of([batch], "text")]
            flat = np.concatenate(own or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat)], ["shingle"])

    items = items_of(benchmark)
    counted = items.mapInArrow(shingles, "shingle long").groupBy("shingle").count().where("count > 1")
    found = counted.limit(most + 1).toArrow()
    if found.num_rows > most:
        raise ValueError(f"more than {most} shingles stand in several items: take the benchmark in parts")
    common = found.column("shingle").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(common)
    return Frequencies(items.count(), common[order], found.column("count").to_numpy().astype(np.float64)[order])


def item_blocks(benchmark: DataFrame, at_once: int = SHINGLES_AT_ONCE) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size."""
    rows, size = [], 0
    for r in items_of(benchmark).sort("item_id", "text").toLocalIterator():
        n = len(r.text.split())
        if rows and size + n > at_once:
            yield rows
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += n
    if rows:
        yield rows


def passages(docs: DataFrame, benchmark: DataFrame, at_once: int = SHINGLES_AT_ONCE, **settings) -> DataFrame:
    """doc_id, item_id, start (word), n_words, similarity and distance of every passage found in ``docs``.

    Repeated documents and items give a row each; null and empty texts give none.
    """
    counts = docs.sparkSession.sparkContext.broadcast(frequencies(benchmark))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    result = docs.sparkSession.createDataFrame([], MATCHES)
    for rows in item_blocks(benchmark, at_once):

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            index, known = Index(rows, counts.value, **settings), WordHashes()
            for batch in sized(batches, "text", READ_BYTES):
                ids = batch.column("doc_id").to_pylist()
                out = [(ids[r], *rest) for r, *rest in found(batch.column("text").to_pylist(), index, known)]
                if out:
                    kinds = [pa.int64()] * 4 + [pa.float64(), pa.int32()]
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in MATCHES.split(", ")])

        result = result.unionByName(chosen.mapInArrow(run, MATCHES))
    return result


def without_passages(docs: DataFrame, benchmark: DataFrame, at_once: int = SHINGLES_AT_ONCE, **settings) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark passage is found, all columns as they are."""
    counts = docs.sparkSession.sparkContext.broadcast(frequencies(benchmark))
    for rows in item_blocks(benchmark, at_once):

        def run(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            index, known = Index(rows, counts.value, **settings), WordHashes()
            for batch in sized(batches, "text", READ_BYTES):
                hit = {r for r, *_ in found(batch.column("text").to_pylist(), index, known)}
                yield batch.filter(pa.array([i not in hit for i in range(batch.num_rows)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
