"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

``P(w | h) = a2 * c(h, w) / c(h) + a1 * c(w) / N + a0 / (V + 1)``, where the mixture weights ``a`` depend on the
bucket of the context's frequency ``c(h)`` (powers of two; an unseen context has no bigram part).  The weights are
learned by expectation-maximisation: counts of nine tenths of the training documents are the estimates, the tokens of
the remaining tenth are the held-out counts.  Scores then use the counts of all training documents.

Counts never meet in one place.  The documents are packed into blocks of text, held-out ones into blocks of their own,
so that learning the weights opens no others; a block sends each of its distinct
n-grams once, with its counts, to the reducer that owns the n-gram's hash range, and gets back the totals in the same
order.  So a frequent word costs a reducer one row per block, the counts grow with the corpus, and no text is joined
with a table of n-grams.  N-grams are told apart by 63 bits of hash.

The held-out tokens reach the driver as a table over (bucket, bigram estimate, unigram estimate), the estimates in
eighths of a power of two with their exact means; its size is bounded whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import remainder, sized, stored, words_of

BLOCK_BYTES = 4_000_000
BLOCKS_A_RANGE = 12
BUCKETS = 24  # of context frequencies: unseen, 1, 2-3, 4-7, ...
ADD = 0.1  # of the base score
BOUNDS = (b"end", b"begin")  # of a document; hashed with a seed of their own
STEPS = 60
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed; small or slowly growing ones take little room."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(blob: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


@dataclass
class Tokens:
    """The tokens of one block: a document's words, then one end."""

    doc_of: np.ndarray  # document of each token
    word: np.ndarray  # number of the token's word in the block
    context: np.ndarray  # number of the word before, or of the begin
    pair: np.ndarray  # key of both
    known: np.ndarray  # keys of the block's words by number: first the end and the begin

    @staticmethod
    def of(texts: list[str | None]) -> Tokens:
        known: dict[bytes | int, int] = {0: 0, 1: 1}  # the bounds first, under keys that no word has
        ids, lengths = [], []
        for text in texts:
            words = words_of(text)
            ids.append(1)
            ids.extend([known.setdefault(w, len(known)) for w in words])
            ids.append(0)
            lengths.append(len(words) + 1)
        bounds = [xxhash.xxh64_intdigest(w, 7) for w in BOUNDS]
        hashes = mixed(np.array(bounds + [xxhash.xxh64_intdigest(w, 42) for w in list(known)[2:]], np.uint64))
        # The last bit tells single words from pairs.
        hashes |= np.uint64(1)
        sequence = np.array(ids, np.int32)
        at = np.flatnonzero(sequence != 1)  # all but the begins
        word, context = sequence[at], sequence[at - 1]
        pair = mixed(hashes[context] * np.uint64(0x9E3779B97F4A7C15) + hashes[word]) & ~np.uint64(1)
        return Tokens(np.repeat(np.arange(len(texts)), lengths), word, context, pair, hashes)

    def keys(self) -> np.ndarray:
        """Distinct keys of the block, in order."""
        return np.unique(np.concatenate([self.known, self.pair]))


def range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def block_frame(docs: DataFrame, modulus: int, tune_fold: int) -> DataFrame:
    """Blocks of documents: block, and the packed ids, folds and texts.  Those of the fold ``tune_fold`` are odd."""
    from pyspark import TaskContext

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for odd, part in joined(batches, BLOCK_BYTES, tune_fold):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as writer:
                writer.write_table(part)
            blob = zstandard.ZstdCompressor(level=3).compress(sink.getvalue().to_pybytes())
            own = [pa.array([number + odd]), pa.array([blob], pa.binary())]
            yield pa.RecordBatch.from_arrays(own, ["block", "packed"])
            number += 2

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), remainder(F.col("doc_id"), modulus).alias("fold"), "text")
    return stored(chosen.mapInArrow(run, "block long, packed binary"), "lm-blocks")


def joined(batches: Iterator[pa.RecordBatch], size: int, apart: int) -> Iterator[tuple[int, pa.Table]]:
    """Batches put together until they hold about ``size`` bytes; with 1, those of the fold ``apart``, with 0 the others."""
    held: tuple[list[pa.RecordBatch], list[pa.RecordBatch]] = ([], [])
    total = [0, 0]
    for batch in sized(batches, "text", size):
        chosen = pc.equal(batch.column("fold"), apart)
        for odd, part in enumerate((batch.filter(pc.invert(chosen)), batch.filter(chosen))):
            if part.num_rows:
                held[odd].append(part)
                total[odd] += part.nbytes
            if total[odd] >= size:
                yield odd, pa.Table.from_batches(held[odd])
                held[odd].clear()
                total[odd] = 0
    for odd in (0, 1):
        if held[odd]:
            yield odd, pa.Table.from_batches(held[odd])


def opened(blob: bytes) -> tuple[list, np.ndarray, list]:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()
    return table["doc_id"].to_pylist(), np.array(table["fold"].to_pylist(), np.int64), table["text"].to_pylist()


def requests(blocks: DataFrame, ranges: int, test_fold: int, tune_fold: int) -> DataFrame:
    """One row per block and hash range: its distinct keys and their counts in the two parts of the training rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("packed").to_pylist(), strict=True):
                _, folds, texts = opened(blob)
                tokens = Tokens.of(texts)
                keys = tokens.keys()
                pair, known = np.searchsorted(keys, tokens.pair), np.searchsorted(keys, tokens.known)
                counts = []
                for part in ((folds != test_fold) & (folds != tune_fold), (folds == tune_fold) & (tune_fold != test_fold)):
                    chosen = part[tokens.doc_of]
                    c = np.bincount(pair[chosen], minlength=len(keys))
                    c += np.bincount(known[tokens.word[chosen]], minlength=len(keys))
                    c[known[1]] = part.sum()
                    counts.append(c.astype("<u4"))
                del tokens, pair, known
                cuts = np.searchsorted(range_of(keys, ranges), np.arange(ranges + 1))
                rows = []
                for r in range(ranges):
                    a, b = cuts[r], cuts[r + 1]
                    if a < b:
                        steps = np.diff(keys[a:b], prepend=np.uint64(0))
                        rows.append((r, block, squeeze(steps), squeeze(counts[0][a:b]), squeeze(counts[1][a:b])))
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["range", "block", "keys", "kept", "tuned"])

    return blocks.mapInArrow(run, "range int, block long, keys binary, kept binary, tuned binary")


def answers(asked: DataFrame) -> DataFrame:
    """The totals of each request's keys, in its order; and per range, under block -1, what all single words sum to."""
    begin = int(Tokens.of([]).known[1])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unsqueeze(b, "<u8")) for b in rows["keys"]]
        every = np.concatenate(keys)
        distinct, place = np.unique(every, return_inverse=True)
        del every
        totals = []
        for name in ("kept", "tuned"):
            counts = np.concatenate([unsqueeze(b, "<u4") for b in rows[name]])
            totals.append(np.bincount(place, counts, len(distinct)).astype("<u8"))
        cuts = np.cumsum([0, *map(len, keys)])
        out = []
        for i, block in enumerate(rows["block"]):
            own = place[cuts[i] : cuts[i + 1]]
            out.append((int(key[0]), block, *[squeeze(t[own]) for t in totals]))
        single = (distinct & np.uint64(1)).astype(bool) & (distinct != np.uint64(begin))
        kept, tuned = totals[0][single], totals[1][single]
        sums = np.array([kept.sum(), (kept > 0).sum(), (kept + tuned).sum(), (kept + tuned > 0).sum()], "<u8")
        out.append((int(key[0]), -1, sums.tobytes(), b""))
        return pd.DataFrame(out, columns=["range", "block", "kept", "tuned"])

    return asked.groupBy("range").applyInPandas(run, "range int, block long, kept binary, tuned binary")


@dataclass(frozen=True)
class Sizes:
    """Tokens and distinct tokens, of the estimates' part of the training rows and of all of them."""

    kept_tokens: int
    kept_words: int
    tokens: int
    words: int


def frequency_bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.where(c > 0, np.floor(np.log2(np.maximum(c, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


@dataclass
class Looked:
    """Counts of a block's tokens: of the pair, the context and the word."""

    tokens: Tokens
    pair: np.ndarray
    context: np.ndarray
    word: np.ndarray

    @staticmethod
    def up(texts: list[str | None], replies: pd.DataFrame, parts: tuple[str, ...]) -> Looked:
        tokens = Tokens.of(texts)
        keys = tokens.keys()
        rows = replies.sort_values("range")
        total = sum(np.concatenate([unsqueeze(b, "<u8") for b in rows[name]]).astype(np.int64) for name in parts)
        if len(total) != len(keys):
            raise RuntimeError("a block has changed between two readings")
        known = total[np.searchsorted(keys, tokens.known)]
        return Looked(tokens, total[np.searchsorted(keys, tokens.pair)], known[tokens.context], known[tokens.word])

    def estimates(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return self.pair / np.maximum(self.context, 1), self.word / max(n, 1)


def tuning_table(blocks: DataFrame, replies: DataFrame, sizes: Sizes, tune_fold: int) -> DataFrame:
    """bucket, q2, q1 (estimates in eighths of a power of two), n tokens, and the sums of the estimates' logarithms."""
    columns = ["bucket", "q2", "q1", "n", "s2", "s1"]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for blob in left["packed"]:
            _, folds, texts = opened(blob)
            look = Looked.up(texts, right, ("kept",))
            held = folds[look.tokens.doc_of] == tune_fold
            p2, p1 = look.estimates(sizes.kept_tokens)
            with np.errstate(divide="ignore"):
                l2, l1 = np.log2(p2[held]), np.log2(p1[held])
            frame = pd.DataFrame({"bucket": frequency_bucket(look.context[held])})
            for name, logs in (("2", l2), ("1", l1)):
                seen = np.isfinite(logs)
                frame[f"q{name}"] = np.where(seen, np.round(np.where(seen, logs, 0) * 8), -9999).astype(np.int64)
                frame[f"s{name}"] = np.where(seen, logs, 0.0)
            frame["n"] = 1
            found.append(frame.groupby(["bucket", "q2", "q1"], as_index=False).sum())
        return pd.concat(found)[columns] if found else pd.DataFrame(columns=columns)

    schema = "bucket long, q2 long, q1 long, n long, s2 double, s1 double"
    odd = "block % 2 = 1"
    each = blocks.where(odd).groupBy("block").cogroup(replies.where(odd).groupBy("block")).applyInPandas(run, schema)
    return each.groupBy("bucket", "q2", "q1").agg(*[F.sum(c).alias(c) for c in ("n", "s2", "s1")])


def mixture_weights(table: pd.DataFrame, kept_words: int) -> np.ndarray:
    """Weights (bigram, unigram, uniform) per bucket, by expectation-maximisation with one pseudo-count each."""
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    if not kept_words:
        weights[:] = 0, 0, 1
    for b, rows in table.groupby("bucket"):
        n = rows["n"].to_numpy(float)
        p = np.zeros((len(rows), 3))
        for i, name in ((0, "2"), (1, "1")):
            seen = rows[f"q{name}"].to_numpy() > -9999
            p[:, i] = np.where(seen, np.exp2(rows[f"s{name}"].to_numpy(float) / n), 0)
        p[:, 2] = 1 / (kept_words + 1)
        w = weights[int(b)].copy()
        for _ in range(STEPS):
            share = p * w
            share /= share.sum(axis=1, keepdims=True)
            w = (share * n[:, None]).sum(axis=0) + (w > 0)
            w /= w.sum()
        weights[int(b)] = w
    return weights


def scores(blocks: DataFrame, replies: DataFrame, sizes: Sizes, weights: np.ndarray, test_fold: int) -> DataFrame:
    names = [c.split()[0] for c in SCORES.split(", ")]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for blob in left["packed"]:
            ids, folds, texts = opened(blob)
            look = Looked.up(texts, right, ("kept", "tuned"))
            p2, p1 = look.estimates(sizes.tokens)
            w = weights[frequency_bucket(look.context)]
            p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (sizes.words + 1)
            base = (look.word + ADD) / (sizes.tokens + ADD * (sizes.words + 1))
            doc, n = look.tokens.doc_of, len(ids)
            frame = {
                "doc_id": pd.array(ids, "Int64"),
                "held_out": folds == test_fold,
                "n_tokens": np.bincount(doc, minlength=n),
                "n_known": np.bincount(doc, look.word > 0, n).astype(np.int64),
                "train_tokens": sizes.tokens,
                "base_score": np.bincount(doc, np.log10(base), n),
                "score": np.bincount(doc, np.log10(p), n),
            }
            out.append(pd.DataFrame(frame))
        return pd.concat(out) if out else pd.DataFrame(columns=names)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(run, SCORES)


def interpolated_scores(docs: DataFrame, modulus: int = 10, test_fold: int = 0, tune_fold: int = 1) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text), learning from all folds but ``test_fold``.

    A row's fold is the crc32 of its doc_id modulo ``modulus``; a null id has fold 0, a null text is empty and has its
    end only.  Repeated rows count and score each.  Without training rows every token has probability 1.
    """
    spark = docs.sparkSession
    blocks = block_frame(docs, modulus, tune_fold)
    # A range gets the keys of BLOCKS_A_RANGE blocks at most, however many there are.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // BLOCKS_A_RANGE))
    given = stored(answers(requests(blocks, ranges, test_fold, tune_fold)), "lm-counts")
    parts = [np.frombuffer(r.kept, "<u8") for r in given.where("block = -1").select("kept").toLocalIterator()]
    sizes = Sizes(*[int(x) for x in np.sum(parts, axis=0)]) if parts else Sizes(0, 0, 0, 0)
    replies = given.where("block >= 0")
    tuning = tuning_table(blocks, replies, sizes, tune_fold).toPandas()
    return scores(blocks, replies, sizes, mixture_weights(tuning, sizes.kept_words), test_fold)
