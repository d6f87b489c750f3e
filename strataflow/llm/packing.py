"""Packing examples into training sequences: vector bin packing under limits on tokens, segments and loss tokens.

An example is a text, optionally after a prompt whose tokens bear no loss, and an end id.  Each task packs the examples
it reads, so no example moves.  Whatever is longer than a sequence is cut into full sequences first; the remainders are
placed bin by bin.  Into the open bin goes the remainder with the largest dot product of its size (tokens, segments,
loss tokens, each as a share of its limit) and the room the bin has left, among those that fit all three limits.  When
none fits, a gap of ``CUT_FROM`` tokens or more is filled with the head of a longer remainder.  At the end of a task the
last bin is split into sequences whose lengths are powers of two, which need no padding, where that saves any.

Remainders wait in a pool of bounded size, refilled while the task reads, so memory does not grow with the input.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import sized

END = 0
POOL = 8_192  # remainders a task holds before it packs half of them
CUT_FROM = 32
READ_BYTES = 4_000_000
PIECES = (
    "doc_id long, start long, length long, ids binary, loss_tokens long, doc_tokens long, sequence_id long, offset long"
)
VOCABULARY = "byte_bpe_50k.tiktoken"  # the ranks of byte_bpe_50k.json: the same ids, four times as fast
TOKENIZER = "byte_bpe_50k.json"
WHITE_RUN = 100_000
LONG_WHITE = re.compile(rf"\s{{{WHITE_RUN}}}")
SPECIAL = {"<|endoftext|>": 50256}


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


def encoder(vocabulary: str | None = None, exact: str | None = None):
    """A function from text to ids; ``vocabulary`` is the path of a rank file, by default the public one.

    The pattern of the rank file cannot split very long white space.  Such a text is encoded with the tokenizer file
    ``exact``, by default that of the same vocabulary, which is opened when the first one comes.
    """
    import tiktoken

    with open(vocabulary or public_tokenizers.path(VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    known = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )
    slow = []

    def encode(text: str) -> list[int]:
        if len(text) < WHITE_RUN or not LONG_WHITE.search(text):
            return known.encode(text, allowed_special="all")
        if not slow:
            from tokenizers import Tokenizer

            slow.append(Tokenizer.from_file(exact or public_tokenizers.path(TOKENIZER)))
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


@dataclass
class Piece:
    """Ids ``start`` and after of one example; ``bare`` of the example's first ids bear no loss."""

    doc_id: int | None
    start: int
    ids: np.ndarray
    bare: int
    doc_tokens: int

    @property
    def loss(self) -> int:
        return len(self.ids) - min(len(self.ids), max(0, self.bare - self.start))

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[:n], self.bare, self.doc_tokens)
        return head, Piece(self.doc_id, self.start + n, self.ids[n:], self.bare, self.doc_tokens)

    def longest(self, tokens: int, loss: int) -> int:
        """How many leading ids stay within both limits."""
        free = min(len(self.ids), max(0, self.bare - self.start))
        return min(len(self.ids), tokens, free + loss)


@dataclass
class Packer:
    """Packs pieces; finished sequences are handed out as lists of pieces."""

    limits: Limits
    pool: dict[tuple[int, int], list[Piece]] = field(default_factory=dict)
    held: int = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        most = self.limits
        while (n := piece.longest(most.tokens, most.loss_tokens)) < len(piece.ids):
            head, piece = piece.cut(n)
            yield [head]
        if len(piece.ids) == most.tokens or piece.loss == most.loss_tokens:
            yield [piece]
        else:
            self.keep(piece)

    def keep(self, piece: Piece) -> None:
        self.pool.setdefault((len(piece.ids), piece.loss), []).append(piece)
        self.held += 1

    def take(self, kind: tuple[int, int]) -> Piece:
        stack = self.pool[kind]
        piece = stack.pop()
        if not stack:
            del self.pool[kind]
        self.held -= 1
        return piece

    def drain(self, down_to: int) -> Iterator[list[Piece]]:
        """Fill bins until at most ``down_to`` remainders are left."""
        cap = np.array([self.limits.tokens, self.limits.segments, self.limits.loss_tokens], float)
        while self.held > down_to:
            kinds = sorted(self.pool, reverse=True)
            size = np.array([(n, 1, loss) for n, loss in kinds], float)
            share = size / cap
            left = np.array([len(self.pool[k]) for k in kinds])
            # Bins are filled from this table of kinds until the pool is down, or a cut makes a new kind.
            while self.held > down_to:
                room, chosen, filled = cap.copy(), [], False
                while True:
                    fits = (left > 0) & (size <= room).all(axis=1)
                    if not fits.any():
                        break
                    best = int(np.argmax(np.where(fits, share @ (room / cap), -1.0)))
                    chosen.append(self.take(kinds[best]))
                    left[best] -= 1
                    room -= size[best]
                if room[0] >= CUT_FROM and room[1] >= 1 and room[2] >= 1:
                    filled = self.fill(room, chosen)
                yield chosen
                if filled:
                    break

    def fill(self, room: np.ndarray, chosen: list[Piece]) -> bool:
        """Put the head of the longest remainder into the open bin; whether there was one."""
        if not self.pool:
            return False
        kind = max(self.pool)
        n = self.pool[kind][-1].longest(int(room[0]), int(room[2]))
        if not 0 < n < kind[0]:
            return False
        head, rest = self.take(kind).cut(n)
        chosen.append(head)
        self.keep(rest)
        return True

    def finish(self) -> Iterator[list[Piece]]:
        """All that is left; a last bin that is not full is split by powers of two."""
        waiting: list[Piece] = []
        for bin_ in self.drain(0):
            if waiting:
                yield waiting
            waiting = bin_
        total = sum(len(p.ids) for p in waiting)
        if total in (0, self.limits.tokens):
            if waiting:
                yield waiting
            return
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                part, need = [], 1 << bit
                while need:
                    piece = waiting.pop(0)
                    if len(piece.ids) > need:
                        piece, rest = piece.cut(need)
                        waiting.insert(0, rest)
                    need -= len(piece.ids)
                    part.append(piece)
                yield part


def packed(
    docs: DataFrame, limits: Limits = Limits(), prompt: str | None = None, vocabulary: str | None = None
) -> DataFrame:
    """One row per piece: ids ``start`` to ``start + length`` of an example, in a sequence at an offset.

    ``ids`` holds little-endian 32-bit numbers.  A null text or prompt counts as empty, so every row, repeated ones
    included, has at least its end id.  A full sequence, or one of a power of two, needs no padding.  Sequence ids are
    unique and say in which task a sequence was made.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(vocabulary), Packer(limits)
        first = TaskContext.get().partitionId() << 36
        done: list[list[Piece]] = []
        made = 0

        def rows() -> pa.RecordBatch:
            nonlocal made
            out = []
            for number, sequence in enumerate(done, first + made):
                offset = 0
                for p in sequence:
                    n = len(p.ids)
                    out.append((p.doc_id, p.start, n, p.ids.tobytes(), p.loss, p.doc_tokens, number, offset))
                    offset += n
            made += len(done)
            done.clear()
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
            columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

        for batch in sized(batches, "text", READ_BYTES):
            prompts = batch.column("prompt").to_pylist()
            for doc_id, text, before in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), prompts, strict=True
            ):
                lead = encode(before) if before else []
                ids = np.array([*lead, *encode(text or ""), END], "<u4")
                done.extend(packer.add(Piece(doc_id, 0, ids, len(lead), len(ids))))
                if packer.held >= POOL:
                    done.extend(packer.drain(POOL // 2))
            if done:
                yield rows()
        done.extend(packer.finish())
        if done:
            yield rows()

    before = F.col(prompt) if prompt else F.lit(None).cast("string")
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", before.alias("prompt"))
    return chosen.mapInArrow(run, PIECES)
