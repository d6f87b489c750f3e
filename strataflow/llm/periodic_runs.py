"""Periodic runs of words: stretches that repeat a period of words twice or more.

A run is a stretch with smallest period q, at least ``SHORTEST`` words and two periods long, that no neighbouring word
extends.  On the diagonal of lag q (word i against word i - q) it is a series of matches that is as long as the run
without its first period.

*Online diagonals.*  A diagonal is active while its words match; its match length grows word by word, and when it ends
with sufficient length its run is emitted at once.  Only the active lags are held.

*Sparse.*  Opening a lag for every earlier occurrence of a word costs the square of the number of occurrences, too much
for a text of one word.  A run of lag q needs q matches and ``SHORTEST`` - q, so a lag opens where that many words have
an earlier occurrence together: lags are taken in classes from k to 2 k, and in a class the occurrences of runs of k
words are looked at.  Occurrences nearer than k / 2 to each other are a series with one step; of the lags between
its members only the step itself can be a smallest period.  Between two series only the first member of one of
them can be where a diagonal opens.  So each class looks at about as many pairs as there are words.

A stretch that is found with several lags has the least of them as period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import WORD, sized, words_of

SHORTEST = 12
READ_BYTES = 2_000_000
FACTOR = 0x9E3779B97F4A7C15
RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def pair_numbers(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each pair; equal pairs get equal numbers."""
    if not len(first):
        return first
    return np.unique(first * (second.max() + 1) + second, return_inverse=True)[1]


def any_repeat(words: np.ndarray, k: int) -> bool:
    """False only if no run of ``k`` words occurs twice (a hash in common may say True for others)."""
    n = len(words) - k + 1
    if n < 2:
        return False
    total, w = np.zeros(n, np.uint64), words.astype(np.uint64)
    for i in range(k):
        total = total * np.uint64(FACTOR) + w[i : i + n]
    total.sort()
    return bool((total[1:] == total[:-1]).any())


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A number for the ``k`` words from each word on; equal ones get equal numbers."""
    now, have = words, 1
    while have < k:
        step = min(have, k - have)
        now = pair_numbers(now[: len(now) - step], now[step:])
        have += step
    return now


def repeated(at: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only what occurs more than once."""
    if not len(at):
        return at, gram
    often = np.bincount(gram)[gram] > 1
    return at[often], gram[often]


def ranges(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, member) for every member of the ranges ``first`` to before ``end``."""
    sizes = np.maximum(end - first, 0)
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


def openings(words: np.ndarray, at: np.ndarray, gram: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, lag) of the diagonals with a lag from ``low`` to before ``high`` that open with ``k`` matches.

    ``at`` are the ascending places of repeated runs of ``k`` words, ``gram`` their numbers.
    """
    order = np.argsort(gram, kind="stable")
    at, gram = at[order], gram[order]
    head = np.ones(len(at), bool)
    head[1:] = (gram[1:] != gram[:-1]) | (at[1:] - at[:-1] > k // 2)
    heads = np.flatnonzero(head)
    ends = np.append(heads[1:], len(at))
    place = gram * (len(words) + high + 1) + at  # no lag reaches from one number to another
    own = place[heads]
    which, back = ranges(np.searchsorted(place, own - high + 1), np.searchsorted(place, own - low, "right"))
    which_too, on = ranges(
        np.maximum(np.searchsorted(place, own + low), ends), np.searchsorted(place, own + high - 1, "right")
    )
    step = heads[ends - heads > 1]  # where a series begins; its step may be a lag of the first class
    later = np.concatenate([at[heads][which], at[on], at[step + 1]])
    earlier = np.concatenate([at[back], at[heads][which_too], at[step]])
    opens = (later - earlier >= low) & ((earlier == 0) | (words[later - 1] != words[earlier - 1]))
    return later[opens], later[opens] - earlier[opens]


def matches(words: np.ndarray, at: int, lag: int) -> int:
    """Match length of the diagonal from word ``at`` to its end; compared in growing blocks."""
    i, size = at, 64
    while i < len(words):
        now = words[i : i + size]
        differs = now != words[i - lag : i - lag + len(now)]
        if differs.any():
            return i + int(differs.argmax()) - at
        i, size = i + size, 2 * size
    return len(words) - at


def runs_of(words: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    k, low = -(-shortest // 2), 1
    if not any_repeat(words, k):
        return []
    found: dict[tuple[int, int], int] = {}
    gram = grams(words, k)
    at, gram = repeated(np.arange(len(gram)), gram)
    while len(at) and 2 * low <= len(words):
        later, lag = openings(words, at, gram, k, low, 2 * k)
        need = np.maximum(lag, shortest - lag)
        last = later + need - 1  # the least that must match
        fits = last < len(words)
        later, lag, need, last = later[fits], lag[fits], need[fits], last[fits]
        fits = words[last] == words[last - lag]
        for i, q, least in zip(later[fits].tolist(), lag[fits].tolist(), need[fits].tolist(), strict=True):
            if (n := matches(words, i, q)) >= least:
                stretch = (i - q, n + q)
                found[stretch] = min(q, found.get(stretch, q))
        # Runs of 2 k words are pairs of repeated runs of k words.
        every = np.full(len(words) + k, -1)
        every[at] = gram
        both = every[at + k] >= 0
        at, gram = at[both], pair_numbers(gram[both], every[at[both] + k])
        at, gram = repeated(at, gram)
        low, k = 2 * k, 2 * k
    return sorted((start, n, q) for (start, n), q in found.items())


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, keep in zip(words, kept.tolist(), strict=True) if keep]


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, its runs (start, length and period in words, by start, then period) and its words without the repeats.

    ``collapsed`` has single spaces.  A null or empty text has no run and an empty ``collapsed``.  Every row, repeated
    ones and those without id included, gives one row; other columns are not looked at.  A text is worked on by the
    task that reads it, whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, "text", READ_BYTES):
            every, texts = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text, lower=False)
                runs = runs_of(numbered(words), shortest)
                every.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                texts.append(b" ".join(without_repeats(words, runs)).decode("utf-8", "surrogatepass"))
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            columns = [batch.column("doc_id"), pa.array(every, kind), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RUNS)


def digests(runs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the longest one (ties: least start, then period), and hashes of the rest."""
    longest = "array_max(transform(runs, r -> struct(r.length AS length, -r.start AS s, -r.period AS p)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    return runs.withColumn("_best", F.expr(longest)).selectExpr(
        "doc_id",
        "CAST(size(runs) AS LONG) AS n_runs",
        "-_best.s AS start",
        "_best.length AS length",
        "-_best.p AS period",
        "1000 * _best.length DIV -_best.p AS exponent_milli",
        f"sha2({lines}, 256) AS runs_sha256",
        "sha2(collapsed, 256) AS collapsed_sha256",
    )


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id and text; of every tenth document, by crc32 of its id, the end repeats a few of its words.

    With g the tenth of the crc32, words from number ``g % n`` on become repeats of the first of them, three to ten
    times over.  Rows without id or words stay as they are.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = own.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = F.when(F.col("_h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    split = hashed.withColumn("_w", chosen).withColumn("_g", F.expr("_h DIV 10"))
    a = split.withColumn("_a", F.expr("CASE WHEN size(_w) > 0 THEN _g % size(_w) END"))
    p = a.withColumn("_p", F.expr("1 + (size(_w) - _a) DIV (3 + _g % 8)"))
    word = "CASE WHEN i < _a THEN w ELSE _w[CAST(_a + (i - _a) % _p AS INT)] END"
    text: Column = F.expr(f"CASE WHEN _a IS NULL THEN text ELSE array_join(transform(_w, (w, i) -> {word}), ' ') END")
    return p.select("doc_id", text.alias("text"))
