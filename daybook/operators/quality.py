"""Counts, reconciliation, verification, duplicates: the proofs that a day is what it should be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def row_counts(rows: DataFrame, dt: str) -> DataFrame:
    """(total, distinct_ids) row ids of one day; the day is a literal that prunes partitions."""
    return rows.where(F.col("dt") == F.lit(dt)).agg(F.count(F.lit(1)).alias("total"), F.count_distinct("row_uid").alias("distinct_ids"))


def per_day(rows: DataFrame) -> DataFrame:
    """dt, rows, distinct_ids, dup. Ids are counted before days are, so that a large day is spread over all tasks."""
    by_id = rows.groupBy("dt", "row_uid").agg(F.count(F.lit(1)).alias("n"))
    return by_id.groupBy("dt").agg(F.sum("n").alias("rows"), F.count("row_uid").alias("distinct_ids")).withColumn("dup", F.col("rows") - F.col("distinct_ids"))


def duplicate_days(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("rows") != F.col("distinct_ids"))


def scan_summary(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count(F.lit(1)).alias("days"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count_if(F.col("rows") != F.col("distinct_ids")).alias("dup_days")
    )


def dedupe(rows: DataFrame) -> DataFrame:
    """One row for each id; where conflicting() finds none, equal ids are equal rows, so it doesn't matter which."""
    return rows.dropDuplicates(["dt", "row_uid"])


def dedupe_ordered(rows: DataFrame, *order: str) -> DataFrame:
    """One row for each id, the first in a given order."""
    nth = F.row_number().over(Window.partitionBy("dt", "row_uid").orderBy(*order))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def assertions() -> dict[str, Column]:
    """The three equations of a day's counters."""
    return {
        "linesEqualsSilverPlusQuarantine": F.col("bronzeLinesParsed") == F.col("silverRows") + F.col("quarantinedRows"),
        "silverEqualsGoldRequests": F.col("silverRows") == F.col("goldRequestsSum"),
        "objectsListedEqualsRead": (F.col("bronzeObjectCount") == F.col("bronzeObjectsRead")) & (F.col("bronzeObjectsMissing") == 0),
    }


def reconcile(counters: DataFrame) -> DataFrame:
    """Counters by day with their assertions and status: done, or mismatch."""
    checked = counters.withColumns(assertions())
    holds = F.col("linesEqualsSilverPlusQuarantine") & F.col("silverEqualsGoldRequests") & F.col("objectsListedEqualsRead")
    return checked.withColumn("status", F.when(holds, "done").otherwise("mismatch"))


def verified(manifests: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """manifests (dt, status, silverRows, goldRows) against what is stored, as counted by per_day.

    Distinct ids that differ from the manifest are a mismatch, which outranks duplicates; else the status stays.
    """
    s = silver.select("dt", F.col("rows").alias("s_rows"), F.col("distinct_ids").alias("s_distinct"))
    g = gold.select("dt", F.col("rows").alias("g_rows"), F.col("distinct_ids").alias("g_distinct"))
    found = manifests.join(s, "dt", "left").join(g, "dt", "left").fillna(0, ["s_rows", "s_distinct", "g_rows", "g_distinct"])
    same_silver, same_gold = F.col("s_distinct") == F.col("silverRows"), F.col("g_distinct") == F.col("goldRows")
    more = (F.col("s_rows") > F.col("s_distinct")) | (F.col("g_rows") > F.col("g_distinct"))
    status = F.when(~same_silver | ~same_gold, "mismatch").when(more, "duplicates").otherwise(F.col("status"))
    return found.select(
        "dt", status.alias("status"), same_silver.alias("silverDistinctEqualsManifest"), same_gold.alias("goldDistinctEqualsManifest"),
        "s_rows", "s_distinct", "g_rows", "g_distinct",
    )


def against_manifests(silver: DataFrame, gold: DataFrame, manifests: DataFrame) -> DataFrame:
    """layer, dt, rows, distinct_ids, want of every day and layer whose counts differ from its manifest (dt, silverRows, goldRows)."""
    days = silver.select("dt").union(gold.select("dt")).distinct().join(manifests, "dt")
    found = None
    for layer, counts, want in (("silver", silver, "silverRows"), ("gold", gold, "goldRows")):
        one = days.join(counts.select("dt", "rows", "distinct_ids"), "dt", "left").select(
            F.lit(layer).alias("layer"), "dt", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("distinct_ids", F.lit(0)).alias("distinct_ids"),
            F.col(want).alias("want"),
        )
        found = one if found is None else found.unionByName(one)
    return found.where((F.col("rows") != F.col("want")) | (F.col("distinct_ids") != F.col("want")))


def without_manifest(silver: DataFrame, gold: DataFrame, manifests: DataFrame) -> DataFrame:
    return silver.select("dt").union(gold.select("dt")).distinct().join(manifests.select("dt"), "dt", "left_anti")


def missing_objects(listing: DataFrame, read: DataFrame) -> DataFrame:
    """Listed objects that were not read; empty ones have nothing to read."""
    return listing.where(F.col("length") > 0).join(read.select("source_key").distinct(), "source_key", "left_anti")


def listing_problems(listed: DataFrame, read: DataFrame, again: DataFrame) -> DataFrame:
    """dt, source_key, problem of objects that weren't the same before, during and after reading.

    Each frame has dt, source_key, length, modified. late: not listed before; lost: listed before, but not read (empty ones
    have nothing to read) or not there afterwards; changed: of another length or time when it was read or listed again.
    """
    frames = [("listed", listed), ("read", read), ("again", again)]
    one = [
        f.groupBy("dt", "source_key").agg(F.max("length").alias(f"{n}_length"), F.max("modified").alias(f"{n}_modified")).withColumn(n, F.lit(True)) for n, f in frames
    ]
    both = one[0].join(one[1], ["dt", "source_key"], "full").join(one[2], ["dt", "source_key"], "full")
    there = {n: F.col(n).isNotNull() for n, _ in frames}
    other = lambda n: there[n] & (~F.col(f"{n}_length").eqNullSafe(F.col("listed_length")) | ~F.col(f"{n}_modified").eqNullSafe(F.col("listed_modified")))
    problem = (
        F.when(~there["listed"], "late").when((~there["read"] & (F.col("listed_length") > 0)) | ~there["again"], "lost")
        .when(other("read") | other("again"), "changed")
    )
    return both.select("dt", "source_key", problem.alias("problem")).where("problem is not null")


def conflicting(rows: DataFrame) -> DataFrame:
    """dt, row_uid, copies, contents of ids that stand for rows of different content, by a fingerprint of all columns."""
    content = F.struct(*(c for c in rows.columns if c not in ("dt", "row_uid")))
    marks = rows.select("dt", "row_uid", F.xxhash64(content).alias("a"), F.crc32(F.encode(F.to_json(content), "UTF-8")).alias("b"))
    by_mark = marks.groupBy("dt", "row_uid", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    return by_mark.groupBy("dt", "row_uid").agg(F.sum("n").alias("copies"), F.count(F.lit(1)).alias("contents")).where("contents > 1")


# The sentences on what is wrong with a manifest; what follows a colon or "is" is its own.
MISSING, STATUS, UNVERIFIED = "manifest is missing (the workflow may not have completed)", "status is ", "verify has not run"
FAILED, SKIPPED = "verify failed: ", "verify was skipped: "


def problems(status: Column, verify: Column, error: Column, skipped: Column) -> Column:
    """Sentences on what is wrong with a manifest; status null: there is none. verify: whether that step has run."""
    texts = F.array(
        F.when(status != "done", F.concat(F.lit(STATUS), status)),
        F.when(~verify, F.lit(UNVERIFIED)).when(error.isNotNull(), F.concat(F.lit(FAILED), error))
        .when(skipped.isNotNull(), F.concat(F.lit(SKIPPED), skipped)),
    )
    return F.when(status.isNull(), F.array(F.lit(MISSING))).otherwise(F.filter(texts, lambda x: x.isNotNull()))


#: Characters of an alert at most; chat services cut longer ones.
ALERT_LENGTH = 1900


def alert_text(dt: Column, source: str, found: Column) -> Column:
    head = F.concat(F.lit("daybook dt="), dt, F.lit(f" ({source})"))
    items = F.transform(found, lambda p: F.concat(F.lit("- "), p))
    return F.substring(F.array_join(F.concat(F.array(head), items, F.array(F.concat(F.lit("check: status "), dt, F.lit(" / verify-all")))), "\n"), 1, ALERT_LENGTH)


def chunk_plan(pages: DataFrame, chunk: int = 2000) -> DataFrame:
    """pages (service, page_no, n_objects): chunks of whole pages, each closed at `chunk` objects or the service's end.

    Returns service, chunk_no, expected_count. A running sum can't express the restart, so each service's page sizes
    are folded in order; a service has a page for every thousand objects.
    """
    sizes = pages.groupBy("service").agg(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "n_objects"))), lambda x: x["n_objects"].cast("long")).alias("sizes"))
    fold = F.expr(
        f"""aggregate(sizes, named_struct('open', 0L, 'done', cast(array() AS array<bigint>)),
            (a, n) -> CASE WHEN a.open + n >= {chunk} THEN named_struct('open', 0L, 'done', concat(a.done, array(a.open + n)))
                           ELSE named_struct('open', a.open + n, 'done', a.done) END,
            a -> CASE WHEN a.open > 0 THEN concat(a.done, array(a.open)) ELSE a.done END)"""
    )
    return sizes.select("service", F.posexplode(fold).alias("chunk_no", "expected_count"))
