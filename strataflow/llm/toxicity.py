"""Toxicity: a support vector machine over a gapped-subsequence string kernel with Nyström landmarks.

The kernel counts, for two fragments of a sentence, the three-character subsequences they share, each occurrence
weighted ``DECAY ** span``; so a fragment with inserted characters, or with gaps between the letters of an insult,
stays close to the plain spelling.  Subsequences wider than ``MAX_SPAN`` characters weigh nothing, and every fragment
is divided by the norm its length allows.

Landmarks are fragments of the labelled sentences: those most associated with the label, and others drawn evenly.  A
linear machine in the landmarks' feature space is then one weight per subsequence, so scoring does not visit the
landmarks: it is a sum of table entries.  The table has a fixed size, whatever the corpus.

Labels mark documents.  A sentence of an unmarked document is an example of its label; of a marked document only the
best fragments are positive, found in a few rounds (multiple-instance training).  A document scores as its worst
fragment, turned into a probability on labelled documents the machine was not fitted on.

Only the fit uses a sample, bounded by ``FIT_TOXIC``, ``FIT_CLEAN`` and ``CALIBRATION`` rows, drawn by hash; every
document is scored whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import rows_of

DECAY = 0.7
MAX_SPAN = 6
CLASSES = 64  # character classes
MAX_UNIT = 24  # longer fragments are read in windows of this many characters, half overlapping
LANDMARKS = 96
FIT_TOXIC, FIT_CLEAN, CALIBRATION = 800, 1_600, 1_200
CACHE = 150_000  # words whose score a task remembers

SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n")
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
EDGES = ".,;:!?|()[]{}\"'«»“”"
SCORE_COLUMNS = "doc_id long, score double, predicted int, worst string"


def char_class(char: str) -> int:
    code = ord(char)
    if 97 <= code <= 122:
        return code - 96
    if 48 <= code <= 57:
        return 62
    return 27 + (code * 2654435761 >> 7) % 34 if char.isalpha() else 61


def subsequences(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and weights of the weighted subsequences of a fragment with ``length`` characters."""
    at = [
        (i, j, k)
        for i in range(length)
        for j in range(i + 1, min(length, i + MAX_SPAN))
        for k in range(j + 1, min(length, i + MAX_SPAN))
    ]
    places = np.array(at, np.int64).reshape(-1, 3)
    weight = DECAY ** (places[:, 2] - places[:, 0] + 1.0)
    norm = np.sqrt((weight**2).sum()) if len(at) else 1.0
    return places, (weight / norm).astype(np.float32)


def sentences(text: str | None) -> list[str]:
    """Sentences in lower case; letters set apart by single blanks are drawn together first."""
    low = (text or "").lower()
    return [s for s in SENTENCE.split(SPACED.sub(lambda m: re.sub(r"[ \t]", "", m[0]), low)) if s.strip()]


def windows(unit: str) -> list[str]:
    if len(unit) <= MAX_UNIT:
        return [unit]
    half = MAX_UNIT // 2
    return [unit[i : i + MAX_UNIT] for i in range(0, len(unit) - half, half)]


def units(sentence: str) -> list[str]:
    """The fragments the kernel compares: words without the punctuation around them."""
    stripped = (w.strip(EDGES) for w in sentence.split())
    return [x for w in stripped if w for x in windows(w)]


def coded(fragments: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: which fragments, their subsequence codes, and the weights."""
    classes: dict[str, int] = {}
    by_length: dict[int, list[int]] = {}
    for i, u in enumerate(fragments):
        by_length.setdefault(len(u), []).append(i)
    for length, members in by_length.items():
        places, weight = subsequences(length)
        for start in range(0, len(members) if len(places) else 0, 4096):
            part = members[start : start + 4096]
            grid = np.array(
                [[classes.get(c) or classes.setdefault(c, char_class(c)) for c in fragments[i]] for i in part], np.int32
            )
            codes = (grid[:, places[:, 0]] * CLASSES + grid[:, places[:, 1]]) * CLASSES + grid[:, places[:, 2]]
            yield np.array(part), codes, weight


class Landmarks:
    """Features of the landmark fragments, over the subsequences that occur in them."""

    def __init__(self, fragments: Sequence[str]):
        parts = list(coded(fragments))
        self.codes = np.unique(np.concatenate([np.zeros(1, np.int32), *[c.ravel() for _, c, _ in parts]]))
        self.features = np.zeros((len(fragments), len(self.codes)), np.float32)
        for members, codes, weight in parts:
            for row, i in enumerate(members):
                np.add.at(self.features[i], np.searchsorted(self.codes, codes[row]), weight)
        self.place = np.full(CLASSES**3, len(self.codes), np.int32)
        self.place[self.codes] = np.arange(len(self.codes))

    def project(self, fragments: Sequence[str], root: np.ndarray) -> np.ndarray:
        """Nyström features of fragments and a constant column: kernel values times ``root``."""
        across = np.r_[self.features.T @ root, np.zeros((1, root.shape[1]))].astype(np.float32)
        out = np.zeros((len(fragments), root.shape[1] + 1), np.float32)
        out[:, -1] = 1
        for members, codes, weight in coded(fragments):
            for s in range(0, len(members), 256):
                out[members[s : s + 256], :-1] = np.einsum(
                    "btm,t->bm", across[self.place[codes[s : s + 256]]], weight
                )
        return out

    def table(self, weights: np.ndarray) -> np.ndarray:
        """One weight per subsequence code."""
        out = np.zeros(CLASSES**3, np.float32)
        out[self.codes] = self.features.T @ weights
        return out


def squared_hinge(x: np.ndarray, up: np.ndarray, down: np.ndarray, c: float = 1.0) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by Newton steps; the last column of ``x`` is constant.

    A row counts ``up`` times as positive and ``down`` times as negative.
    """
    w, reg = np.zeros(x.shape[1]), np.r_[np.ones(x.shape[1] - 1), 1e-3]
    for _ in range(30):
        gradient, hessian = reg * w, np.diag(reg)
        for s in range(0, len(x), 16384):
            part, u, d = x[s : s + 16384].astype(float), up[s : s + 16384], down[s : s + 16384]
            f = part @ w
            gradient += 2 * c * part.T @ (d * np.maximum(1 + f, 0) - u * np.maximum(1 - f, 0))
            active = np.flatnonzero(u * (f < 1) + d * (f > -1))
            hessian += 2 * c * (part[active].T * (u * (f < 1) + d * (f > -1))[active]) @ part[active]
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Machine:
    """One weight per subsequence, a bias, and the slope and offset that turn a margin into a probability."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, fragments: Sequence[str]) -> np.ndarray:
        out = np.full(len(fragments), self.bias, np.float32)
        for members, codes, weight in coded(fragments):
            out[members] += self.table[codes] @ weight
        return out

    def probability(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -500, 500))))


def fit_machine(toxic: list[list[str]], clean: list[list[str]]) -> tuple[np.ndarray, float]:
    """Weight table and bias from the fragments of marked and unmarked documents."""
    seen_toxic, seen_clean = Counter(), Counter()
    for doc in toxic:
        seen_toxic.update(set(doc))
    for doc in clean:
        seen_clean.update(set(doc))
    total = len(toxic) + len(clean)
    lift = {
        u: (n / len(toxic) - seen_clean[u] / len(clean)) / np.sqrt((n + seen_clean[u] + 1) / total)
        for u, n in seen_toxic.items()
    }
    ranked = sorted(lift, key=lambda u: (-lift[u], u))
    chosen = ranked[: LANDMARKS * 2 // 3]
    rest = sorted(set(seen_clean) - set(chosen))
    chosen += rest[:: max(1, len(rest) // (LANDMARKS - LANDMARKS * 2 // 3))][: LANDMARKS - len(chosen)]
    landmarks = Landmarks(chosen)
    values, vectors = np.linalg.eigh((landmarks.features @ landmarks.features.T).astype(float))
    keep = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, keep] / np.sqrt(values[keep])

    vocabulary = sorted(set(seen_toxic) | set(seen_clean))
    place = {u: i for i, u in enumerate(vocabulary)}
    x = landmarks.project(vocabulary, root)
    negative = np.array([seen_clean[u] for u in vocabulary], float)
    members = [np.array([place[u] for u in set(doc)]) for doc in toxic if doc]
    lifts = np.array([lift.get(u, 0.0) for u in vocabulary])
    margin = None
    for _ in range(3):
        positive = np.zeros(len(vocabulary))
        for doc in members:
            by = lifts[doc] if margin is None else margin[doc]
            best = by.max()
            hit = doc[by >= (0.5 * best if margin is None else max(0.0, 0.5 * best))] if best > 0 else doc[by >= best]
            positive[hit] += 1
        w = squared_hinge(x, 2.0 * positive, negative)
        margin = x @ w
    return landmarks.table(root @ w[:-1]), float(w[-1])


def fit_probability(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by damped Newton steps; the slope stays positive."""
    x = np.c_[margin, np.ones(len(margin))]
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w, ridge = np.array([1.0, 0.0]), np.diag([1e-3, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (weight * (p - target)) + ridge @ w
        hessian = (x.T * (weight * np.maximum(p * (1 - p), 1e-6))) @ x + ridge
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, float(np.log((n1 + 1) / (n0 + 1))))


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for doc_id, part, toxic, text in rows_of(batches, "doc_id", "part", "toxic", "text"):
        found = "\n".join(sorted({u for s in sentences(text) for u in units(s)}))
        columns = [pa.array([doc_id]), pa.array([part], pa.int32()), pa.array([toxic], pa.int32()), pa.array([found])]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "toxic", "units"])


def train(docs: DataFrame, labels: DataFrame) -> Machine | float:
    """Fit on ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text); the share of marked rows where one class is missing.

    Rows without id or label are left out; a document labelled twice counts as marked if one row marks it.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    known = docs.select("doc_id").distinct().join(marked, "doc_id")
    draw = F.xxhash64(F.lit("toxicity"), "doc_id")
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    if not n1 or not n0:
        return n1 / (n1 + n0) if n1 + n0 else 0.0
    spare = CALIBRATION // 4
    take1, take0 = min(n1, FIT_TOXIC + spare), min(n0, FIT_CLEAN + CALIBRATION - spare)
    order = [F.col("draw"), F.col("doc_id")]
    sample = [
        known.where(F.col("toxic") == k).withColumn("draw", draw).orderBy(*order).limit(n).collect()
        for k, n in ((1, take1), (0, take0))
    ]
    # The last fifth of each class at least is kept for the calibration.
    rows = [
        (r.doc_id, int(i >= min(most, max(1, len(part) * 4 // 5))), r.toxic)
        for part, most in zip(sample, (FIT_TOXIC, FIT_CLEAN), strict=True)
        for i, r in enumerate(part)
    ]
    chosen = docs.sparkSession.createDataFrame(rows, "doc_id long, part int, toxic int")
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "part", "toxic", "text")
    found = picked.mapInArrow(_fragments, "doc_id long, part int, toxic int, units string")
    by_id = {r.doc_id: (r.part, r.toxic, r.units) for r in found.sort("doc_id").toLocalIterator()}
    fit = [[u.split("\n") for p, t, u in by_id.values() if p == 0 and t == k and u] for k in (1, 0)]
    if not all(fit):
        return n1 / (n1 + n0)
    table, bias = fit_machine(*fit)
    machine = Machine(table, bias, 1.0, 0.0)
    held = [(t, u) for p, t, u in by_id.values() if p == 1]
    held = held if len({t for t, _ in held}) == 2 else [(t, u) for _, t, u in by_id.values()]
    margin = np.array([machine.margins(u.split("\n")).max() if u else bias for _, u in held])
    label = np.array([t for t, _ in held], float)
    # The sample has its own mix of classes; weights bring back the mix of all labelled rows.
    weight = np.where(label == 1, n1 / label.sum(), n0 / (1 - label).sum())
    machine.slope, machine.offset = fit_probability(margin, label, weight / weight.mean())
    return machine


class Reader:
    """Finds the worst fragment of texts; remembers the fragments it has scored, a bounded number of them."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.known: dict[str, tuple[float, str]] = {}

    def worst(self, texts: Iterable[str | None]) -> Iterator[tuple[float, str]]:
        for text in texts:
            words = {w for s in sentences(text) for w in s.split()}
            missing = [(w, w.strip(EDGES)) for w in words if w not in self.known]
            margins = iter(self.machine.margins([x for _, b in missing if b for x in windows(b)]).tolist())
            for w, b in missing:
                self.known[w] = (max([next(margins) for _ in windows(b)]) if b else self.machine.bias, b)
            yield max([self.known[w] for w in words], default=(self.machine.bias, ""))
            if len(self.known) > CACHE:
                self.known.clear()


def scored(docs: DataFrame, machine: Machine | float) -> DataFrame:
    """doc_id, score, predicted and the fragment that decided, for every row; repeated rows are scored each.

    Null and empty texts have no fragment and score as the bias alone.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(machine)
        for batch in batches:
            found = list(reader.worst(t.as_py() for t in batch.column("text")))
            scores = [machine.probability(margin) for margin, _ in found]
            predicted = pa.array([int(s >= 0.5) for s in scores], pa.int32())
            columns = [pa.array(scores, pa.float64()), predicted, pa.array([w for _, w in found], pa.string())]
            names = ["doc_id", "score", "predicted", "worst"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    if isinstance(machine, float):
        values = F.lit(machine), (F.lit(machine) >= 0.5).cast("int"), F.lit("")
        return docs.select(doc_id, *[v.alias(n) for v, n in zip(values, ("score", "predicted", "worst"), strict=True)])
    return docs.select(doc_id, "text").mapInArrow(score, SCORE_COLUMNS)


def kept_documents(docs: DataFrame, machine: Machine | float) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    if isinstance(machine, float):
        return docs if machine < 0.5 else docs.limit(0)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(machine)
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            verdicts = [machine.probability(m) < 0.5 for m, _ in reader.worst(texts)]
            yield batch.filter(pa.array(verdicts, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
