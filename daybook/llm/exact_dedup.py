"""Exact deduplication with a heavy-hitter split. DataFrame and SQL functions only.

1. One scan turns each text into the SHA-256 of its normalised form; digests, not texts, are shuffled after that.
2. Misra-Gries: approx_top_k (a merging sketch of the Misra-Gries family with a fixed number of counters) is
   accumulated per group of tasks and then combined. A digest that it doesn't report has at most about
   rows / tracked, or rows / heavy, rows.
3. Verification: exact counts and exact winners of the reported digests, pre-aggregated on the map side; a false
   candidate falls out here. At most `heavy` winners remain, which is the bound of the broadcast.
4. Rows of verified heavy digests get their winner map-side from the broadcast and are never shuffled. All other
   digests go through an ordinary shuffle: their winners are pre-aggregated on the map side, and joined back to the rows
   (a join that adaptive execution can split, whatever the size of the largest digest that is left).

Defined cases: a null text counts as the empty text, and all empty texts are one group. Ties in length go to the
smallest id; a null id comes after all others; of rows equal in both, the first one read stays, alone. An empty
table gives an empty result. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.scratch import Scratch

#: Digests reported as heavy candidates at most, and counters of the sketch.
HEAVY, TRACKED = 256, 2048
#: Groups of tasks whose sketches are merged before the last merge.
FAN_IN = 64
WHITE_SPACE = "[\\x20\\x09-\\x0D]+"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256, n_chars, row): no texts."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.sha2(F.encode(F.regexp_replace(text, WHITE_SPACE, ""), "UTF-8"), 256).alias("text_sha256"),
        F.length(text).alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    )


def heavy_candidates(thin: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """(text_sha256): at most `heavy` digests, among them every one with more than about rows / tracked rows."""
    states = thin.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("fan")).agg(
        F.expr(f"approx_top_k_accumulate(text_sha256, {tracked})").alias("state")
    )
    # Grouped by a constant: a global aggregate would also start a sketch in empty partitions, which it can't serialise.
    merged = states.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(state, {tracked})").alias("state"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(state, {heavy})")).alias("t"))
    return top.where("t.count > 1").select(F.col("t.item").alias("text_sha256"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY, tracked: int = TRACKED
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    thin = scratch.save(digests(docs, id_col, text_col), "digests")
    order = F.struct(
        (-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"), F.col("row").alias("d")
    )
    rows = thin.count()
    if rows:
        candidates = heavy_candidates(thin, heavy, tracked)
        winners = (
            thin.join(F.broadcast(candidates), "text_sha256")
            .groupBy("text_sha256")
            .agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
            .where(F.col("group_size") > max(1, rows // (4 * tracked)))
        )
    else:
        winners = thin.limit(0).select("text_sha256", order.alias("best"), F.lit(1).cast("long").alias("group_size"))
    winners = scratch.save(winners, "winners")
    hot = thin.join(F.broadcast(winners), "text_sha256").select(
        "doc_id",
        F.col("best.c").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.d")).alias("kept"),
        "text_sha256",
    )
    light = thin.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti")
    best = light.groupBy("text_sha256").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    alone = F.col("group_size").isNull()
    rest = light.join(best, "text_sha256", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.c")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("best.d"))).alias("kept"),
        "text_sha256",
    )
    return scratch.result(hot.unionByName(rest))
