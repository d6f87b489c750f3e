"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path

# Words are runs of anything but ASCII white space; ``bytes.split`` cuts at exactly these six characters.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read again: what follows does not compute it twice,
    and no lost executor takes it away."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key's text modulo ``modulus``: the fold a row belongs to; 0 for a null key."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus)), F.lit(0)).cast("int")


def words_of(text: str | None, lower: bool = True) -> list[bytes]:
    """UTF-8 words; ``lower`` turns A-Z only, as ``bytes.lower`` does."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()


def rows_of(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def sized(batches: Iterable[pa.RecordBatch], text: str, bytes_at_once: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about ``bytes_at_once`` of ``text``, one row at least."""
    for batch in batches:
        start, size = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()):
            if size and size + n > bytes_at_once:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


SENTENCE_END = re.compile(rb"[.!?]+(?=\s|$)|\n")
