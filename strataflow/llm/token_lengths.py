"""Exact length histogram of encoded documents, and what it answers for every context limit.

Each task counts its documents by encoded length, so what is shuffled is a histogram per task.  Suffix sums over the
merged histogram then give, for every limit, how many documents reach it, their tokens, and the tokens left when every
document is cut at it.  The sums are taken inside ranges of lengths and over the ranges' totals, so no task sees the
whole histogram at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import sized
from strataflow.llm.packing import READ_BYTES, encoder

RANGE = 1_024  # lengths summed together first


def length_histogram(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """length and n_docs; null and empty texts have length 0, repeated rows count each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(vocabulary), Counter()
        for batch in sized(batches, "text", READ_BYTES):
            seen.update(len(encode(t)) if t else 0 for t in batch.column("text").to_pylist())
        lengths = sorted(seen)
        columns = [pa.array(lengths, pa.int64()), pa.array([seen[n] for n in lengths], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["length", "n"])

    counted = docs.select("text").mapInArrow(run, "length long, n long")
    return counted.groupBy("length").agg(F.sum("n").alias("n_docs"))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """A row per length that occurs, as context limit: documents and tokens from it upward, and truncated totals.

    ``truncated_tokens`` is the sum of ``min(length, limit)`` over all documents, ``quantile`` the share of documents
    that fit the limit.
    """
    rows = histogram.withColumn("part", F.expr(f"length DIV {RANGE}")).withColumn("tokens", F.expr("length * n_docs"))
    totals = rows.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # As many rows as the longest document has ranges.
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    later = totals.select(
        "part",
        F.coalesce(F.sum("d").over(above), F.lit(0)).alias("d_later"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t_later"),
        F.sum("d").over(Window.partitionBy()).alias("d_all"),
        F.sum("t").over(Window.partitionBy()).alias("t_all"),
    )
    within = Window.partitionBy("part").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(later, "part").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(within) + F.col("d_later")).alias("docs_from"),
        (F.sum("tokens").over(within) + F.col("t_later")).alias("tokens_from"),
        "d_all",
        "t_all",
    )
    return summed.select(
        "length",
        "n_docs",
        "docs_from",
        "tokens_from",
        F.expr("t_all - tokens_from + length * docs_from").alias("truncated_tokens"),
        F.expr("(d_all - docs_from + n_docs) / d_all").alias("quantile"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """The totals for any limits, whether a document has that length or not.

    Between two lengths that occur nothing changes but the cut: the row of the next length that occurs answers.
    """
    asked = sums.sparkSession.createDataFrame([(int(n),) for n in limits], "limit long")
    next_up = F.min_by(F.struct("docs_from", "tokens_from"), F.when(F.col("length") >= F.col("limit"), F.col("length")))
    whole = F.max(F.expr("truncated_tokens"))  # at the longest length nothing is cut
    # The limits are a short list given by the caller.
    joined = sums.join(F.broadcast(asked)).groupBy("limit").agg(next_up.alias("up"), whole.alias("all"))
    docs, tokens = F.coalesce("up.docs_from", F.lit(0)), F.coalesce("up.tokens_from", F.lit(0))
    return joined.select(
        "limit",
        docs.alias("docs_from"),
        tokens.alias("tokens_from"),
        (F.col("all") - tokens + F.col("limit") * docs).alias("truncated_tokens"),
    )


def length_quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The least length that at least each share of the documents does not exceed."""
    picks = [F.min(F.when(F.col("quantile") >= s, F.col("length"))).alias(f"q{s:g}") for s in shares]
    return sums.agg(*picks)
