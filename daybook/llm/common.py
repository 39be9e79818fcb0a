"""What several of the operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch: with texts of any length a Python worker holds a few MB at a time.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4194304"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Bound what Spark sends to a Python worker at a time, for the jobs that run inside; the session's own settings come back."""
    before = {k: v for k, v in dict(spark.conf.getAll).items() if k in BATCHES}
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in BATCHES:
            if key in before:
                spark.conf.set(key, before[key])
            else:
                spark.conf.unset(key)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; null ids count as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(parts))


def parts_of(texts, limit: int = 1 << 22):
    """Slices of a list of texts, each of about so many characters (one text at least)."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
