"""Sharding by balanced label propagation.

Documents of one group (for the query: of equal text) are linked with each other. A group is one hyperedge, so the
links of a group with any number of members take as many rows as members, not their square.

Each round is a few joins and aggregates over the linked documents alone:
1. members are tallied by (group, shard), pre-aggregated on the map side;
2. a group's targets are the shards where most of its members are, as many as its members fill; a shard that is full
   counts only for groups that are whole there already;
3. members elsewhere ask to move to a target; shards by demand, a table of as many rows as shards, goes to the driver;
4. a shard with less room than demand accepts that share of the groups, by a hash of group and round, so that groups
   move as wholes.
The rounds end when nothing moves, or after `rounds` of them.

Then the law `rows` is made exact: counts differ by one at most. Shards above their quota give up surplus documents,
unlinked ones first and then whole groups as far as possible; ranks are computed in buckets of bounded size, and the
surplus fills the other shards exactly. No texts are shuffled, and each round's state is written once.

Defined cases: a null text counts as the empty text; null ids and repeated rows are rows of their own; an empty table
gives an empty result; there may be fewer rows than shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.scratch import Scratch, is_at_most

SHARDS, ROUNDS = 40, 6
#: Groups of two and more whose list may be broadcast (a shard list each, 200 bytes); beyond, joins are shuffled.
BROADCAST_GROUPS = 100_000
#: Rows ranked together at most, about.
BUCKET = 20_000


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, size, text_crc32, group: what sharding needs of a document, without its text."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    return docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("group"),
    )


def _unit(*columns: Column | str) -> Column:
    """From 0 to 1, evenly, by hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 40)) / float(1 << 40)


def ranked(rows: DataFrame, by: str, total: int, keys: int, last: Column | None = None, group: Column | None = None, size: Column | None = None) -> DataFrame:
    """rows with a column rank, gapless from 0 within each value of `by` (an int column of about `keys` values).

    The order is: rows that are not `last` first, then by hash of `group`, so that a group stays together, then by row.
    Ranks are taken in buckets of about BUCKET rows and shifted by the rows of the buckets before; a group with more
    rows than that is spread over several buckets.
    """
    buckets = max(1, total // (keys * BUCKET))
    group = F.col("row") if group is None else group
    flags = F.lit(False) if last is None else last
    parts = F.lit(1) if size is None else F.greatest(F.lit(1), F.ceil(size / BUCKET).cast("int"))
    rows = rows.select(
        "*", flags.cast("int").alias("_last"), F.floor(_unit(group, F.lit("rank")) * buckets).cast("int").alias("_bucket"),
        F.pmod(F.xxhash64("row"), parts).cast("int").alias("_part"), F.xxhash64(group).alias("_group"),
    )
    bucket = [by, "_last", "_bucket", "_part"]
    counts = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(by).orderBy("_last", "_bucket", "_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(*bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy(*bucket).orderBy("_group", "row")) - 1
    return rows.withColumn("_within", within).join(shift, bucket).withColumn("rank", F.col("_shift") + F.col("_within")).drop(
        "_last", "_bucket", "_part", "_group", "_shift", "_within"
    )


def propagate(linked: DataFrame, capacity: int, scratch: Scratch, rounds: int = ROUNDS, few: bool = False) -> DataFrame:
    """(row, group, members, shard) after propagation; linked: the same, with the shards to begin with.

    few: whether the groups are few enough to be broadcast.
    """
    spark = linked.sparkSession
    now = linked
    for k in range(rounds):
        load = {r[0]: r[1] for r in now.groupBy("shard").agg(F.count(F.lit(1))).collect()}
        full = [s for s, n in load.items() if n >= capacity]
        tally = now.groupBy("group", "members", "shard").agg(F.count(F.lit(1)).alias("n"))
        order = F.struct(
            (F.col("shard").isin(full) & (F.col("n") < F.col("members"))).alias("full"), (-F.col("n")).alias("n"),
            F.xxhash64("group", "shard").alias("h"), "shard",
        )
        # A group has at most as many entries as there are shards.
        targets = tally.groupBy("group", "members").agg(F.sort_array(F.collect_list(order)).alias("by"))
        targets = targets.select("group", F.slice(F.transform("by", lambda x: x["shard"]), 1, F.ceil(F.col("members") / capacity).cast("int")).alias("targets"))
        asked = now.join(F.broadcast(targets) if few else targets, "group").withColumn("many", F.size("targets"))
        asked = asked.withColumn(
            "target", F.when(F.array_contains("targets", F.col("shard")), F.col("shard")).otherwise(F.element_at("targets", (F.pmod(F.xxhash64("row"), F.col("many")) + 1).cast("int")))
        )
        asked = scratch.save(asked.select("row", "group", "members", "shard", "target", "many"), f"asked-{k}")
        counts = {(r[0], r[1]): r[2] for r in asked.groupBy("target", F.col("target") == F.col("shard")).agg(F.count(F.lit(1))).collect()}
        moving = {t: n for (t, stays), n in counts.items() if not stays}
        if not moving:
            break
        share = {t: max(0.0, min(1.0, (capacity - counts.get((t, True), 0)) / n)) for t, n in moving.items()}
        accepted = spark.createDataFrame([(t, p) for t, p in sorted(share.items())], "target int, share double")
        drawn = _unit(F.when(F.col("many") > 1, F.col("row").cast("string")).otherwise(F.col("group")), F.lit(k))
        moved = asked.join(F.broadcast(accepted), "target", "left")
        stays = (F.col("target") == F.col("shard")) | (drawn >= F.col("share"))
        now = scratch.save(moved.select("row", "group", "members", F.when(stays, F.col("shard")).otherwise(F.col("target")).alias("shard")), f"round-{k}")
        if not any(share.values()):
            break
    return now


def quotas(counts: dict[int, int], shards: int) -> tuple[dict[int, int], list[tuple[int, int, int]]]:
    """Surplus of each shard above its quota, and (from, until, shard): which places of the surplus each lacking one takes."""
    total = sum(counts.values())
    order = sorted(range(shards), key=lambda s: (-counts.get(s, 0), s))
    quota = {s: total // shards + (i < total % shards) for i, s in enumerate(order)}
    surplus = {s: counts.get(s, 0) - quota[s] for s in range(shards) if counts.get(s, 0) > quota[s]}
    takes, at = [], 0
    for s in range(shards):
        if (n := quota[s] - counts.get(s, 0)) > 0:
            takes.append((at, at + n, s))
            at += n
    return surplus, takes


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, group of every row; the law is `rows`."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "sharding")
    rows = scratch.save(described(docs, id_col, text_col), "rows")
    total = rows.count()
    begin = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard")
    groups = rows.groupBy("group").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    groups = scratch.save(groups, "groups")
    few = is_at_most(groups, BROADCAST_GROUPS)
    members = rows.select("row", "group").join(F.broadcast(groups) if few else groups, "group")
    linked = scratch.save(members.select("row", "group", "members", begin), "linked")
    linked = propagate(linked, max(1, -(-total // shards)), scratch, rounds, few)
    placed = rows.join(linked.select("row", "members", F.col("shard").alias("linked_shard")), "row", "left").select(
        "row", "doc_id", "size", "text_crc32", "group", F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("linked_shard", begin).alias("shard")
    )
    placed = scratch.save(placed, "placed")
    surplus, takes = quotas({r[0]: r[1] for r in placed.groupBy("shard").agg(F.count(F.lit(1))).collect()}, shards)
    in_order = ranked(placed, "shard", total, shards, F.col("members") > 1, F.col("group"), F.col("members"))
    first, at = {}, 0
    for s, n in sorted(surplus.items()):
        first[s], at = (at, n), at + n
    leaving = spark.createDataFrame([(s, a, n) for s, (a, n) in first.items()], "shard int, first long, surplus long")
    taking = spark.createDataFrame(takes, "from long, until long, to int")
    moved = in_order.join(F.broadcast(leaving), "shard", "left").withColumn("place", F.when(F.col("rank") < F.col("surplus"), F.col("first") + F.col("rank")))
    # A row for each shard at most; each place is in one interval.
    moved = moved.join(F.broadcast(taking), (F.col("place") >= F.col("from")) & (F.col("place") < F.col("until")), "left")
    final = scratch.save(moved.select("row", "doc_id", "size", "text_crc32", "group", F.coalesce("to", "shard").alias("shard")), "final")
    return scratch.result(
        ranked(final, "shard", total, shards).select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "group"
        )
    )
