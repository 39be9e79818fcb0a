"""What five filters remove together, in every order, by inclusion and exclusion.

Each document gets five flags, one for each filter that it fails. The joint-failure counts J(S) of all 32 sets S of
filters are sums of flag products. Everything else follows from these 32 numbers of a part, without another look at a row:

- Survivors of a set T of filters, by Möbius inversion: the sum over all S within T of (-1)^|S| J(S).
- In an order of filters, a step removes the survivors of those before it less the survivors with it; what else fails it is
  redundant; and what survives all others but not all five fails it alone.
- Shapley values: J is, up to sign, the Harsanyi dividend of a set in the game "documents removed", so a filter's sum over
  all 120 orders is the sum over all S that hold it of (-1)^(|S|+1) J(S) 120/|S|.

The duplicates' filter compares texts table-wide, by their SHA-256: copies are counted before anything is joined, and only
one row for each (text, id) meets the smallest id of its text, so a group of copies of any size is spread over all tasks.

Defined cases: a null text is the empty one and a null part the empty string; a null id is smaller than none, and none is
smaller than it; rows that share an id are documents of their own, none a duplicate of the other; a document is good or
toxic if any of its labels says so; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.scratch import Scratch

FILTERS = "ABCDE"
SETS, ALL = 1 << len(FILTERS), (1 << len(FILTERS)) - 1
_COUNTS = ("n", "good", "toxic")


def flags(text: Column) -> list[Column]:
    """Whether a text fails each of the filters that need nothing else: short, repetitive, upper case, symbols."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [n < 200, 100 * distinct < 50 * n, 100 * upper > 2 * F.length(text), text.rlike("[#$%&*|]")]


def joint_failures(docs: DataFrame, labels: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part and, for all documents and for good and toxic ones, the array of J(S) over all S as bits (n, good, toxic)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    code = None
    for i, failed in enumerate(flags(text)):
        bit = F.when(failed, 1 << i).otherwise(0)
        code = bit if code is None else code + bit
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), code.alias("code"))
    rows = scratch.save(rows.groupBy("digest", "doc_id", "part", "code").agg(F.count(F.lit(1)).alias("n")), "rows")
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    duplicate = F.when(F.col("doc_id").isNotNull() & F.col("is_first").isNull(), SETS // 2).otherwise(0)
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(first, ["digest", "doc_id"], "left").join(said, "doc_id", "left")
    of = lambda c: F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c)
    by_code = rows.groupBy("part", (F.col("code") + duplicate).alias("code")).agg(F.sum("n").alias("n"), of("good"), of("toxic"))
    failed = [F.shiftright("code", i).bitwiseAND(F.lit(1)) for i in range(len(FILTERS))]

    def product(s: int) -> Column:
        out = F.lit(1)
        for i, flag in enumerate(failed):
            out = out * flag if s >> i & 1 else out
        return out

    return by_code.groupBy("part").agg(*(F.array(*(F.sum(F.col(c) * product(s)) for s in range(SETS))).alias(c) for c in _COUNTS))


def _survivors(joint: str) -> Column:
    """The array of survivors of each T, from that of J."""
    return F.expr(
        f"""transform(sequence(0, {ALL}), t -> aggregate(sequence(0, {ALL}), 0L, (sum, s) ->
            sum + CASE WHEN (s & ~t) <> 0 THEN 0L WHEN bit_count(s) % 2 = 0 THEN {joint}[s] ELSE -{joint}[s] END))"""
    )


def audited(joint: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from the joint failures."""
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    rows = joint.select("part", F.col("n").alias("joint"), *(_survivors(c).alias(c) for c in _COUNTS))
    rows = rows.select("*", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter, earlier = F.expr("substring(filter_order, step, 1)"), F.expr("substring(filter_order, 1, step - 1)")
    before, bit = F.lit(0), F.lit(0)
    for i, c in enumerate(FILTERS):
        before = before + F.when(F.contains(earlier, F.lit(c)), 1 << i).otherwise(0)
        bit = bit + F.when(letter == c, 1 << i).otherwise(0)
    rows = rows.withColumns({"before": before, "bit": bit})
    lost = lambda c: F.col(c)[F.col("before")] - F.col(c)[F.col("before") + F.col("bit")]
    dividends = F.expr(
        f"""aggregate(sequence(1, {ALL}), 0L, (sum, s) -> sum + CASE WHEN (s & bit) = 0 THEN 0L
            ELSE joint[s] * (CASE WHEN bit_count(s) % 2 = 1 THEN 1 ELSE -1 END) * (120 DIV bit_count(s)) END)"""
    )
    return rows.select(
        "part", "filter_order", "step", F.col("n")[F.col("before") + F.col("bit")].alias("kept"), lost("n").alias("removed"),
        (F.col("joint")[F.col("bit")] - lost("n")).alias("redundant"), (F.col("n")[ALL - F.col("bit")] - F.col("n")[ALL]).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), dividends.alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    scratch = Scratch(docs.sparkSession, "audit")
    return scratch.result(audited(joint_failures(docs, labels, scratch, id_col, text_col, part_col)))
