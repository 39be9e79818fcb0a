"""The daily aggregate per service, endpoint and method.

Everything comes from partial aggregates: how many requests there were of each latency and colo. Such counts can be added
in any order, and taken back by adding their negatives. Percentiles are exact (nearest rank), by selection: counts of
buckets tell which one holds a rank, and only its values are looked at, so no task gets all values of a group. Requests of
latency 0 were not measured: they count as requests and errors, but not in the latencies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions.columns import gold_endpoint, gold_uid, listed
from daybook.scratch import Scratch

KEYS = ("dt", "service", "endpoint", "method")
_COUNTS = ("requests", "errors_4xx", "errors_5xx")
PERCENTS = (50, 95, 99)
#: Rows of counts that a group may have to be ranked within one task.
ONE_TASK = 1_000_000
#: Parts of a group's values that are counted first, for each doubling, and parts of the one that holds a rank.
BUCKETS_PER_DOUBLING, EQUAL_PARTS = 64, 4096


def error_rate(errors: Column, requests: Column) -> Column:
    return F.when(requests == 0, F.lit(0.0)).otherwise(errors / requests)


def folded(silver: DataFrame, *more: str) -> DataFrame:
    """What the aggregate needs of a row, requests to no route under one endpoint."""
    return silver.select(
        *more, "dt", "service", gold_endpoint(F.col("endpoint"), F.col("status")).alias("endpoint"), "method", "status_class",
        F.when(F.col("latency_ms") != 0, F.col("latency_ms")).alias("measured"), F.when(F.col("cf_colo") != "", F.col("cf_colo")).alias("colo"),
    )


def _counted() -> list[Column]:
    return [F.count(F.lit(1)).alias("requests"), *(F.count_if(F.col("status_class") == c).alias(f"errors_{c}") for c in ("4xx", "5xx"))]


def daily(silver: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    return merged(partial(silver), scratch)


def groups(silver: DataFrame) -> DataFrame:
    """dt, row_uid and requests of the daily aggregate's rows, for those who only count them."""
    rows = folded(silver).groupBy(*KEYS).agg(F.count(F.lit(1)).cast("int").alias("requests"))
    return rows.select("dt", gold_uid(*(F.col(k) for k in KEYS)).alias("row_uid"), "requests")


def _finished(rows: DataFrame) -> DataFrame:
    rows = rows.withColumns({c: F.col(c).cast("int") for c in (*_COUNTS, "requests_measured")})
    return rows.select(
        *KEYS, *_COUNTS, error_rate(F.col("errors_4xx") + F.col("errors_5xx"), F.col("requests")).alias("error_rate"),
        "requests_measured", (F.col("requests") - F.col("requests_measured")).alias("requests_zero_latency"), "latency_p50", "latency_p95",
        "latency_p99", "latency_avg", "latency_max", "colos", gold_uid(*(F.col(k) for k in KEYS)).alias("row_uid"),
    )


def partial(silver: DataFrame, chunk: Column | None = None) -> DataFrame:
    """Mergeable partial aggregates, of each chunk if these are told apart: counts by latency and colo, one row each."""
    more = () if chunk is None else ("chunk",)
    rows = folded(silver if chunk is None else silver.withColumn("chunk", chunk), *more)
    return rows.groupBy(*more, *KEYS, "measured", "colo").agg(*_counted())


def retracted(partials: DataFrame) -> DataFrame:
    """What takes these partial aggregates back when it is added."""
    return partials.withColumns({c: -F.col(c) for c in _COUNTS})


def merged(partials: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The daily aggregate of partial ones; what was taken back altogether leaves no trace.

    Groups of at most ONE_TASK different latencies and colos are ranked by running counts within a task each; larger ones,
    which are found by counting, by selection (nearest_ranks). Both are exact. The added counts are written, and the result
    reads them from there.
    """
    net = partials.groupBy(*KEYS, "measured", "colo").agg(*(F.sum(c).alias(c) for c in _COUNTS)).where("requests > 0")
    net = (scratch or Scratch(partials.sparkSession, "gold")).save(net, "counts")
    large = net.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > ONE_TASK).drop("size")
    if not large.limit(1).count():
        return _in_tasks(net)
    rest = net.join(large, [*KEYS], "left_semi")
    values = rest.where("measured is not null").groupBy(*KEYS, "measured").agg(F.sum("requests").alias("n"))
    selected = rest.groupBy(*KEYS).agg(*_totals()).join(nearest_ranks(values), [*KEYS], "left")
    return _in_tasks(net.join(large, [*KEYS], "left_anti")).unionByName(_finished(selected))


def _n() -> Column:
    return F.when(F.col("measured").isNotNull(), F.col("requests")).otherwise(0)


def _totals() -> list[Column]:
    """What a group has but for its ranks, from its counts."""
    return [
        *(F.sum(c).alias(c) for c in _COUNTS), F.sum(_n()).alias("requests_measured"), F.try_divide(F.sum(F.col("measured") * _n()), F.sum(_n())).alias("latency_avg"),
        F.max("measured").alias("latency_max"), listed(F.col("colo")).alias("colos"),
    ]


def _in_tasks(net: DataFrame) -> DataFrame:
    """The daily aggregate from counts, by running sums."""
    group = Window.partitionBy(*KEYS)
    running = net.withColumns({"until": F.sum(_n()).over(group.orderBy("measured")), "all": F.sum(_n()).over(group)})
    ranked = lambda p: F.min(F.when(F.col("until") >= F.ceil(F.lit(p / 100) * F.col("all")), F.col("measured"))).alias(f"latency_p{p}")
    return _finished(running.groupBy(*KEYS).agg(*_totals(), *map(ranked, PERCENTS)))


def nearest_ranks(values: DataFrame) -> DataFrame:
    """KEYS and the value of rank ceil(share * n), from 1, for each of PERCENTS, from counts n of positive values (measured).

    First the buckets are fractions of powers of two, so a group has a few thousand at most; then equal parts of the
    bucket that holds a rank, between its least and its largest value; what is left is counted value by value.
    """
    rows = values.withColumn("part", F.floor(F.log2("measured") * BUCKETS_PER_DOUBLING))
    parts = rows.groupBy(*KEYS, "part").agg(F.sum("n").alias("n"), F.min("measured").alias("low"), F.max("measured").alias("high"))
    parts = parts.withColumns({"until": F.sum("n").over(Window.partitionBy(*KEYS).orderBy("part")), "all": F.sum("n").over(Window.partitionBy(*KEYS))})
    wanted = F.explode(F.array(*(F.struct(F.lit(p).alias("percent"), F.ceil(F.lit(p / 100) * F.col("all")).alias("rank")) for p in PERCENTS))).alias("w")
    parts = parts.select(*KEYS, "part", "low", "high", "n", "until", wanted).select("*", "w.percent", "w.rank")
    rows = rows.join(_holding(parts).select(*KEYS, "percent", "part", "low", "high", "rank"), [*KEYS, "part"]).drop("part")
    share = F.when(F.col("high") > F.col("low"), (F.col("measured") - F.col("low")) / (F.col("high") - F.col("low")))
    rows = rows.select(*KEYS, "percent", "rank", "measured", "n", F.floor(F.coalesce(share, F.lit(0.0)) * EQUAL_PARTS).alias("part"))
    one = Window.partitionBy(*KEYS, "percent")
    parts = rows.groupBy(*KEYS, "percent", "rank", "part").agg(F.sum("n").alias("n")).withColumn("until", F.sum("n").over(one.orderBy("part")))
    rows = rows.drop("rank").join(_holding(parts).select(*KEYS, "percent", "part", "rank"), [*KEYS, "percent", "part"])
    found = _holding(rows.withColumn("until", F.sum("n").over(one.orderBy("measured"))))
    return found.groupBy(*KEYS).agg(*(F.max(F.when(F.col("percent") == p, F.col("measured"))).alias(f"latency_p{p}") for p in PERCENTS))


def _holding(parts: DataFrame) -> DataFrame:
    """The part in which each rank lies, and its rank there; until: how many there are up to the part's end."""
    before = F.col("until") - F.col("n")
    return parts.where((before < F.col("rank")) & (F.col("rank") <= F.col("until"))).withColumn("rank", F.col("rank") - before)


def totals(gold: DataFrame) -> DataFrame:
    return gold.agg(F.count(F.lit(1)).alias("gold_rows"), F.coalesce(F.sum("requests"), F.lit(0)).alias("gold_requests_sum"))
