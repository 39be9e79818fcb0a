"""The driver's tables as an API-metrics workload.

Every event becomes one request. Most of its fields follow from the event's own (k is the number in props), and every
fortieth of the events breaks one rule of the line format, so that each reason for refusal occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import gold, quality, validate
from daybook.session import dealt, prepare, spread


def requests(spark: SparkSession, sf_dir: str, deal=spread) -> DataFrame:
    """event_id, ts, dt, service, endpoint, method, status, latency_ms, cf_colo, k, case: one row per event; deal puts the scan into tasks."""
    events = deal(prepare(spark).read.parquet(f"{sf_dir}/events.parquet"))
    k = F.get_json_object("props", "$.k").cast("int")
    e = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", k.alias("k"))
    return e.select(
        "event_id", "ts", "k", F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.concat(F.lit("svc"), F.col("user_id") % 4).alias("service"),
        F.concat(F.lit("/"), "event_type", F.lit("/"), F.col("user_id") % 7).alias("endpoint"),
        F.when(F.col("event_id") % 3 == 0, "POST").otherwise("GET").alias("method"),
        F.when(F.col("k") < 60, 200).when(F.col("k") < 70, 301).when(F.col("k") < 80, 404).when(F.col("k") < 90, 429).otherwise(503).alias("status"),
        F.when(F.col("k") % 5 == 0, 0.0).otherwise(F.col("value")).alias("latency_ms"),
        F.when(F.col("k") % 4 == 1, "NRT").when(F.col("k") % 4 == 2, "KIX").when(F.col("k") % 4 == 3, "ICN").alias("cf_colo"),
        (F.col("event_id") % 40).cast("int").alias("case"),
    )


def _field(name: str, usual, **cases) -> F.Column:
    """`"name":value` as JSON text, with another value (None: no such field) in the cases given as c<n>."""
    out = F.concat(F.lit(f',"{name}":'), usual)
    for case, value in cases.items():
        out = F.when(F.col("case") == int(case[1:]), F.lit("" if value is None else f',"{name}":{value}')).otherwise(out)
    return out


def bronze_lines(spark: SparkSession, sf_dir: str, deal=spread) -> DataFrame:
    """dt, service, source_key, line_index, line: a JSON line for each event."""
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = F.concat(
        F.lit('{"n":'), F.col("event_id").cast("string"),
        _field("timestamp", q(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")), c2=None, c17='"not-a-date"'),
        _field("endpoint", q(F.col("endpoint")), c3='""'), _field("method", q(F.col("method")), c4=None),
        _field("status", F.col("status").cast("string"), c5='"200"', c14="200.5", c15="99"),
        _field("latency_ms", F.col("latency_ms").cast("string"), c6="-1", c16="1e400"),
        _field("request_size", (F.col("k") * 3 - 50).cast("string"), c7='"big"'), _field("response_size", F.lit("null"), c8="[]"),
        _field("user_id", F.lit('""'), c9="{}"), _field("cf_ray", F.lit("null"), c10="1"),
        _field("cf_colo", F.coalesce(q(F.col("cf_colo")), F.lit("null")), c11="123"), _field("error_message", F.lit("null"), c12="false"), F.lit("}"),
    )
    line = (
        F.when(F.col("case") == 0, "{not json").when(F.col("case") == 1, "[1,2,3]").when(F.col("case") == 13, F.concat(line, F.lit(" junk")))
        .when(F.col("case") == 18, "null").otherwise(line)
    )
    key = F.concat(F.lit("api-metrics/"), "dt", F.lit("/"), "service", F.lit("/"), F.date_format("ts", "HH"), F.lit("/"), "event_id", F.lit(".jsonl"))
    return requests(spark, sf_dir, deal).select("dt", "service", key.alias("source_key"), F.lit(0).alias("line_index"), line.alias("line"))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.parsed(bronze_lines(spark, sf_dir, dealt))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as valid rows, without the detour over lines."""
    return requests(spark, sf_dir).withColumns(
        {"status_class": F.concat((F.col("status") / 100).cast("int"), F.lit("xx")), "row_uid": F.concat(F.lit("e#"), "event_id")}
    )


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver with every fiftieth event of the days ending in 3 stored twice."""
    rows = silver(spark, sf_dir)
    return rows.unionByName(rows.where((F.col("event_id") % 50 == 0) & F.col("dt").endswith("3")))


def day_of(dt: F.Column) -> F.Column:
    return F.substring(dt, 9, 2).cast("int")


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's counters as a run would have them, wrong by one in some: lines on days 5n, requests on 7n, objects on 11n."""
    by_day = parsed(spark, sf_dir).groupBy("dt").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("valid"), F.count_distinct("source_key").alias("objects")
    )
    day = day_of(F.col("dt"))
    off = lambda n: F.when(day % n == 0, 1).otherwise(0)
    return by_day.select(
        "dt", F.col("objects").alias("bronzeObjectCount"), (F.col("objects") - off(11)).alias("bronzeObjectsRead"),
        off(11).cast("long").alias("bronzeObjectsMissing"), (F.col("lines") + off(5)).alias("bronzeLinesParsed"), F.col("valid").alias("silverRows"),
        (F.col("lines") - F.col("valid")).alias("quarantinedRows"), (F.col("valid") + off(7)).alias("goldRequestsSum"),
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dt, status, silverRows, goldRows of each day but days 6n, one row too many on days 8n."""
    rows = silver(spark, sf_dir)
    s = rows.groupBy("dt").agg(F.count(F.lit(1)).alias("silverRows"))
    g = gold.groups(rows).groupBy("dt").agg(F.count(F.lit(1)).alias("goldRows"))
    day = day_of(F.col("dt"))
    return s.join(g, "dt").where(day % 6 != 0).select(
        "dt", F.lit("done").alias("status"), (F.col("silverRows") + F.when(day % 8 == 0, 1).otherwise(0)).alias("silverRows"), "goldRows"
    )


def day_counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return quality.per_day(stored_silver(spark, sf_dir)), quality.per_day(gold.groups(silver(spark, sf_dir)))
