"""A training corpus from raw documents, in stages that each work on all that the one before kept.

STAGES lists them in order; each function takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents; the last returns the packed
pieces. run() applies them to the documents of a folder.

Rows that repeat with one id, or have none, are decided one by one (see _kept).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches, table
from daybook.llm.listed import joined
from daybook.scratch import Scratch, borrowed
from daybook.session import spread

#: Share of a document that its languages together must explain, and rows of a list of ids that may be broadcast.
LEAST_SHARE, BROADCAST_ROWS = 0.3, 500_000


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _kept(spark: SparkSession, docs: DataFrame, label: str, decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """docs less the rows that are decided not to stay; decide: from docs and its id column to (doc_id, keep) of each row.

    Usually ids are unique and identify the rows. If some id repeats or is null, rows go under keys of their own instead:
    the id (null ones last) and a number, which are written with them. Dropped rows are joined away; where they are too
    many to be broadcast, only rows that a filter says may be among them are shuffled.
    """
    scratch = Scratch(spark, label)
    columns, key = docs.columns, _free(docs, "row_key")
    id_col = "doc_id"
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count():
        numbered = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"))
        docs, id_col = scratch.save(docs.withColumn(key, numbered), "numbered"), key
    dropped = scratch.save(decide(docs, id_col).where(~F.col("keep")).select(F.col("doc_id").alias(id_col)), "dropped")
    return joined(docs, dropped, [id_col], "left_anti", BROADCAST_ROWS).select(*columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language or mixture; those without text or letters, or that no languages explain, go.

    If no document says its language, nothing is known of any, and all stay.
    """
    from daybook.llm.language_mixture import detect, fit, selected

    model, name = fit(docs), _free(docs, "found")
    if not model.languages:
        return docs
    found = docs.withColumn(name, detect(model, F.col("text"), spark))
    return selected(found, LEAST_SHARE, name).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    from daybook.llm.exact_dedup import exact_dedup

    return _kept(spark, docs, "exact", lambda rows, key: exact_dedup(rows, key).select("doc_id", F.col("kept").alias("keep")))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id."""
    from daybook.llm.hamming_dedup import near_duplicates

    return _kept(spark, docs, "near", lambda rows, key: near_duplicates(rows, key).select("doc_id", F.col("kept").alias("keep")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    from daybook.llm.decontaminate import decontaminate

    items = table(spark, sf_dir, "benchmark")
    clean = (F.size("spans") == 0).alias("keep")
    return _kept(spark, docs, "decontaminated", lambda rows, key: decontaminate(rows, items, key).select("doc_id", clean))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' pieces with their places in sequences of 2048 tokens."""
    import public_tokenizers

    from daybook.llm.vector_packing import pack

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), tokens=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("decontaminated", decontaminated),
    ("packed", packed),
]

#: Learned models and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES:
        # What a stage and its operator have written goes once its result is.
        with borrowed(spark), bounded_batches(spark):
            docs = scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(*(scratch.names - {name}))
    return docs
