"""All queries of the metrics engine and the SQL that DuckDB checks them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions import columns as fn
from daybook.functions.days import check_dt, run_id
from daybook.functions.times import point_in_time
from daybook.operators import gold, quality, validate
from daybook.plans import workload as w
from daybook.session import prepare, spread
from daybook.sources import bronze

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Register a query of (spark, sf_dir) under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


_REQUESTS = """
    ev AS (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k, strftime(ts, '%Y-%m-%d') AS dt FROM events),
    req AS (SELECT event_id, ts, k, dt, 'svc' || (user_id % 4) AS service, '/' || event_type || '/' || (user_id % 7) AS endpoint,
                   CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method,
                   CAST(CASE WHEN k < 60 THEN 200 WHEN k < 70 THEN 301 WHEN k < 80 THEN 404 WHEN k < 90 THEN 429 ELSE 503 END AS INT) AS status,
                   CASE WHEN k % 5 = 0 THEN 0.0::DOUBLE ELSE value END AS latency_ms,
                   CASE k % 4 WHEN 1 THEN 'NRT' WHEN 2 THEN 'KIX' WHEN 3 THEN 'ICN' END AS cf_colo,
                   CAST(event_id % 40 AS INT) AS c FROM ev),
    lines AS (SELECT *, 'api-metrics/' || dt || '/' || service || '/' || strftime(ts, '%H') || '/' || event_id || '.jsonl' AS source_key,
                     CASE c WHEN 0 THEN 'invalid_json' WHEN 13 THEN 'invalid_json' WHEN 1 THEN 'not_an_object' WHEN 18 THEN 'not_an_object'
                            WHEN 2 THEN 'missing_or_invalid_timestamp' WHEN 17 THEN 'missing_or_invalid_timestamp' WHEN 3 THEN 'missing_endpoint'
                            WHEN 4 THEN 'missing_method' WHEN 5 THEN 'missing_or_invalid_status' WHEN 14 THEN 'missing_or_invalid_status'
                            WHEN 15 THEN 'missing_or_invalid_status' WHEN 6 THEN 'missing_or_invalid_latency_ms'
                            WHEN 16 THEN 'missing_or_invalid_latency_ms' WHEN 7 THEN 'invalid_request_size' WHEN 8 THEN 'invalid_response_size'
                            WHEN 9 THEN 'invalid_user_id' WHEN 10 THEN 'invalid_cf_ray' WHEN 11 THEN 'invalid_cf_colo'
                            WHEN 12 THEN 'invalid_error_message' END AS reason FROM req),
    texts AS (SELECT *, '{"n":' || event_id || CASE c WHEN 2 THEN '' WHEN 17 THEN ',"timestamp":"not-a-date"' ELSE ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"' END
                     || ',"endpoint":"' || CASE c WHEN 3 THEN '' ELSE endpoint END || '"' || CASE c WHEN 4 THEN '' ELSE ',"method":"' || method || '"' END
                     || ',"status":' || CASE c WHEN 5 THEN '"200"' WHEN 14 THEN '200.5' WHEN 15 THEN '99' ELSE status::VARCHAR END
                     || ',"latency_ms":' || CASE c WHEN 6 THEN '-1' WHEN 16 THEN '1e400' ELSE latency_ms::VARCHAR END
                     || ',"request_size":' || CASE c WHEN 7 THEN '"big"' ELSE (k * 3 - 50)::VARCHAR END || ',"response_size":' || CASE c WHEN 8 THEN '[]' ELSE 'null' END
                     || ',"user_id":' || CASE c WHEN 9 THEN '{}' ELSE '""' END || ',"cf_ray":' || CASE c WHEN 10 THEN '1' ELSE 'null' END
                     || ',"cf_colo":' || CASE WHEN c = 11 THEN '123' ELSE coalesce('"' || cf_colo || '"', 'null') END
                     || ',"error_message":' || CASE c WHEN 12 THEN 'false' ELSE 'null' END || '}' AS usual FROM lines),
    refused AS (SELECT dt, reason, source_key, source_key || '#0' AS row_uid,
                       CASE c WHEN 0 THEN '{not json' WHEN 1 THEN '[1,2,3]' WHEN 13 THEN usual || ' junk' WHEN 18 THEN 'null' ELSE usual END AS raw
                FROM texts WHERE reason IS NOT NULL),
    silver AS (SELECT *, (status // 100) || 'xx' AS status_class, 'e#' || event_id AS row_uid FROM req),
    stored AS (SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE event_id % 50 = 0 AND dt LIKE '%3'),
    folded AS (SELECT *, CASE WHEN status = 404 THEN '(unmatched)' ELSE endpoint END AS e, nullif(latency_ms, 0) AS m FROM silver),
    gold AS (SELECT dt, service, e AS endpoint, method, count(*)::INT AS requests, (count(*) FILTER (status_class = '4xx'))::INT AS errors_4xx,
                    (count(*) FILTER (status_class = '5xx'))::INT AS errors_5xx,
                    count(*) FILTER (status_class IN ('4xx', '5xx')) / count(*) AS error_rate, count(m)::INT AS requests_measured,
                    (count(*) - count(m))::INT AS requests_zero_latency, quantile_disc(m, 0.5) AS latency_p50, quantile_disc(m, 0.95) AS latency_p95,
                    quantile_disc(m, 0.99) AS latency_p99, round(avg(m), 6) AS latency_avg, max(m) AS latency_max,
                    coalesce(string_agg(DISTINCT cf_colo, ',' ORDER BY cf_colo), '') AS colos,
                    dt || '|' || service || '|' || e || '|' || method AS row_uid FROM folded GROUP BY dt, service, e, method),
    days_s AS (SELECT dt, count(*) AS rows, count(DISTINCT row_uid) AS distinct_ids FROM stored GROUP BY dt),
    days_g AS (SELECT dt, count(*) AS rows, count(DISTINCT row_uid) AS distinct_ids FROM gold GROUP BY dt),
    days AS (SELECT *, substr(dt, 9, 2)::INT AS d FROM (SELECT dt, count(*) AS n, count(*) FILTER (reason IS NULL) AS valid FROM lines GROUP BY dt)),
    manifests AS (SELECT dt, 'done' AS status, s.n + CASE WHEN substr(dt, 9, 2)::INT % 8 = 0 THEN 1 ELSE 0 END AS silver_rows, g.rows AS gold_rows
                  FROM (SELECT dt, count(*) AS n FROM silver GROUP BY dt) s JOIN days_g g USING (dt) WHERE substr(dt, 9, 2)::INT % 6 <> 0)
"""


def _sql(select: str) -> str:
    return f"WITH {_REQUESTS} {select}"


@query(_sql(
    """SELECT ts, dt, service, endpoint, method, status, (status // 100) || 'xx' AS status_class, latency_ms, (k * 3 - 50)::DOUBLE AS request_size,
              NULL::DOUBLE AS response_size, '' AS user_id, cf_colo, source_key, source_key || '#0' AS row_uid FROM lines WHERE reason IS NULL"""
))
def silver_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = validate.silver(w.parsed(spark, sf_dir)).drop("cf_ray", "error_message")
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(_sql("SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM lines GROUP BY 1"))
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return w.parsed(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(_sql("SELECT reason, source_key, row_uid, dt, raw FROM refused"))
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.quarantine(w.parsed(spark, sf_dir))


@query(_sql("""SELECT '{"reason":"' || reason || '","source_key":"' || source_key || '","raw":' || to_json(raw) || ',"row_uid":"' || row_uid || '"}' AS json FROM refused"""))
def quarantine_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused lines as JSON lines, with their text."""
    return validate.quarantine(w.parsed(spark, sf_dir)).select(F.to_json(F.struct("reason", "source_key", "raw", "row_uid")).alias("json"))


@query(_sql("SELECT dt, count(*) AS lines, count(*) FILTER (reason IS NULL) AS valid, count(*) FILTER (reason IS NOT NULL) AS refused, count(DISTINCT source_key) AS objects FROM lines GROUP BY dt"))
def bronze_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    refused = F.count_if(F.col("reason").isNotNull()).alias("refused")
    return w.parsed(spark, sf_dir).groupBy("dt").agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("valid"), refused, F.count_distinct("source_key").alias("objects"))


@query("SELECT n, CASE WHEN n // 100 BETWEEN 1 AND 5 THEN (n // 100) || 'xx' ELSE 'unknown' END AS status_class, count(*) AS c FROM (SELECT (event_id % 800)::INT AS n FROM events) GROUP BY n, 2")
def status_class_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spread(spark.read.parquet(f"{sf_dir}/events.parquet")).select((F.col("event_id") % 800).cast("int").alias("n"))
    return n.groupBy("n", fn.status_class(F.col("n")).alias("status_class")).agg(F.count(F.lit(1)).alias("c"))


@query(_sql("SELECT * FROM gold"))
def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold.daily(w.silver(spark, sf_dir))
    return g.withColumn("latency_avg", F.round("latency_avg", 6))


@query(_sql("SELECT dt, service, endpoint, method, latency_p50, latency_p95, latency_p99, latency_max FROM gold"))
def gold_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily(w.silver(spark, sf_dir)).select(*gold.KEYS, "latency_p50", "latency_p95", "latency_p99", "latency_max")


@query(_sql("SELECT dt, service, method, requests, errors_4xx FROM gold WHERE endpoint = '(unmatched)'"))
def gold_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gold.daily(w.silver(spark, sf_dir)).where(F.col("endpoint") == fn.UNMATCHED)
    return g.select("dt", "service", "method", "requests", "errors_4xx")


@query(_sql("SELECT dt, service, endpoint, method, requests_measured, requests_zero_latency, latency_avg FROM gold WHERE requests_zero_latency > 0"))
def gold_zero_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily(w.silver(spark, sf_dir)).where("requests_zero_latency > 0").select(*gold.KEYS, "requests_measured", "requests_zero_latency", F.round("latency_avg", 6).alias("latency_avg"))


@query(_sql("SELECT colos, count(*) AS n FROM gold GROUP BY colos"))
def gold_colos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily(w.silver(spark, sf_dir)).groupBy("colos").agg(F.count(F.lit(1)).alias("n"))


@query(_sql("SELECT row_uid, error_rate, errors_4xx, errors_5xx, requests FROM gold WHERE error_rate > 0"))
def gold_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily(w.silver(spark, sf_dir)).where("error_rate > 0").select("row_uid", "error_rate", "errors_4xx", "errors_5xx", "requests")


@query(_sql("SELECT * FROM gold"))
def gold_partial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate from partial ones of three chunks: the same rows as gold_daily."""
    return gold.merged(gold.partial(w.silver(spark, sf_dir), F.col("event_id") % 3)).withColumn("latency_avg", F.round("latency_avg", 6))


@query(_sql("SELECT count(*) AS gold_rows, sum(requests)::BIGINT AS gold_requests_sum FROM gold"))
def gold_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.totals(gold.groups(w.silver(spark, sf_dir)))


_DAY = "2024-01-13"


@query(_sql(f"SELECT count(*) AS total, count(DISTINCT row_uid) AS distinct_ids FROM stored WHERE dt = '{_DAY}'"))
def day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts(w.stored_silver(spark, sf_dir), _DAY)


@query(_sql(f"SELECT count(*) AS total, count(DISTINCT row_uid) AS distinct_ids FROM stored WHERE dt = '{_DAY}'"))
def day_counts_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by SQL text; the day is a parameter, never part of the text."""
    rows = w.stored_silver(spark, sf_dir)
    return spark.sql("SELECT count(*) AS total, count(DISTINCT row_uid) AS distinct_ids FROM {t} WHERE dt = :dt", args={"dt": check_dt(_DAY)}, t=rows)


@query(_sql("SELECT *, rows - distinct_ids AS dup FROM days_s"))
def per_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.per_day(w.stored_silver(spark, sf_dir))


@query(_sql("SELECT *, rows - distinct_ids AS dup FROM days_s WHERE rows <> distinct_ids"))
def scan_all_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_days(quality.per_day(w.stored_silver(spark, sf_dir)))


@query(_sql("SELECT count(*) AS days, sum(rows)::BIGINT AS rows, count(*) FILTER (rows <> distinct_ids) AS dup_days FROM days_s"))
def scan_all_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scan_summary(quality.per_day(w.stored_silver(spark, sf_dir)))


_STORED = ("dt", "row_uid", "service", "endpoint", "status", "latency_ms")


@query(_sql("SELECT DISTINCT dt, row_uid, service, endpoint, status, latency_ms FROM stored"))
def dedupe_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedupe(w.stored_silver(spark, sf_dir).select(*_STORED))


@query(_sql("SELECT dt, row_uid, service, endpoint, status, latency_ms FROM stored QUALIFY row_number() OVER (PARTITION BY dt, row_uid ORDER BY endpoint) = 1"))
def dedupe_row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dedupe_ordered(w.stored_silver(spark, sf_dir).select(*_STORED), "endpoint")


@query(_sql(
    """SELECT dt, n AS "bronzeObjectCount", n + CASE WHEN d % 5 = 0 THEN 1 ELSE 0 END AS "bronzeLinesParsed", valid AS "silverRows",
              d % 5 <> 0 AS "linesEqualsSilverPlusQuarantine", d % 7 <> 0 AS "silverEqualsGoldRequests", d % 11 <> 0 AS "objectsListedEqualsRead",
              CASE WHEN d % 5 <> 0 AND d % 7 <> 0 AND d % 11 <> 0 THEN 'done' ELSE 'mismatch' END AS status FROM days"""
))
def reconcile_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reconcile(w.counters(spark, sf_dir)).select(
        "dt", "bronzeObjectCount", "bronzeLinesParsed", "silverRows", "linesEqualsSilverPlusQuarantine", "silverEqualsGoldRequests",
        "objectsListedEqualsRead", "status",
    )


@query(_sql(
    """SELECT m.dt, CASE WHEN s.distinct_ids <> m.silver_rows THEN 'mismatch' WHEN s.rows > s.distinct_ids THEN 'duplicates' ELSE m.status END AS status,
              s.distinct_ids = m.silver_rows AS "silverDistinctEqualsManifest", g.distinct_ids = m.gold_rows AS "goldDistinctEqualsManifest",
              s.rows AS s_rows, s.distinct_ids AS s_distinct, g.rows AS g_rows, g.distinct_ids AS g_distinct
       FROM manifests m JOIN days_s s USING (dt) JOIN days_g g USING (dt)"""
))
def verify_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verified(w.manifests(spark, sf_dir), *w.day_counts(spark, sf_dir))


@query(_sql(
    """SELECT * FROM (SELECT 'silver' AS layer, dt, s.rows, s.distinct_ids, m.silver_rows AS want FROM days_s s JOIN manifests m USING (dt)
                      UNION ALL SELECT 'gold', dt, g.rows, g.distinct_ids, m.gold_rows FROM days_g g JOIN manifests m USING (dt))
       WHERE rows <> want OR distinct_ids <> want"""
))
def verify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.against_manifests(*w.day_counts(spark, sf_dir), w.manifests(spark, sf_dir))


@query(_sql(
    """SELECT 'silver' AS layer, count(*) AS days, sum(rows)::BIGINT AS rows FROM days_s
       UNION ALL SELECT 'gold', count(*), sum(rows)::BIGINT FROM days_g"""
))
def verify_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda layer, c: quality.scan_summary(c).select(F.lit(layer).alias("layer"), "days", "rows")
    silver, gold_ = w.day_counts(spark, sf_dir)
    return one("silver", silver).unionByName(one("gold", gold_))


@query(_sql("SELECT dt FROM (SELECT dt FROM days_s UNION SELECT dt FROM days_g) WHERE dt NOT IN (SELECT dt FROM manifests)"))
def days_without_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.without_manifest(*w.day_counts(spark, sf_dir), w.manifests(spark, sf_dir))


@query(_sql("SELECT source_key, dt FROM lines WHERE event_id % 97 = 0"))
def missing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects listed but not read, where every ninety-seventh couldn't be."""
    lines = w.bronze_lines(spark, sf_dir).select("source_key", "dt", F.lit(1).alias("length"))
    number = F.regexp_extract("source_key", "([0-9]+)[.]jsonl$", 1).cast("long")
    return quality.missing_objects(lines, lines.where(number % 97 != 0)).select("source_key", "dt")


_STATES = """
    st AS (SELECT dt, d, CASE WHEN d % 9 = 0 THEN NULL WHEN d % 5 = 0 THEN 'mismatch' WHEN d % 7 = 0 THEN 'duplicates' ELSE 'done' END AS status,
                  d % 4 <> 0 AS verify, CASE WHEN d % 4 = 1 THEN 'timeout' END AS error, CASE WHEN d % 4 = 2 THEN 'no token' END AS skipped FROM days),
    pr AS (SELECT dt, CASE WHEN status IS NULL THEN ['manifest is missing (the workflow may not have completed)']
                  ELSE list_filter([CASE WHEN status <> 'done' THEN 'status is ' || status END,
                                    CASE WHEN NOT verify THEN 'verify has not run' WHEN error IS NOT NULL THEN 'verify failed: ' || error
                                         WHEN skipped IS NOT NULL THEN 'verify was skipped: ' || skipped END], lambda x: x IS NOT NULL) END AS p FROM st)
"""


def _states(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = w.bronze_lines(spark, sf_dir).select("dt").distinct().withColumn("d", w.day_of(F.col("dt")))
    status = F.when(F.col("d") % 9 == 0, None).when(F.col("d") % 5 == 0, "mismatch").when(F.col("d") % 7 == 0, "duplicates").otherwise("done")
    error, skipped = F.when(F.col("d") % 4 == 1, "timeout"), F.when(F.col("d") % 4 == 2, "no token")
    return days.select("dt", quality.problems(status, F.col("d") % 4 != 0, error, skipped).alias("p"))


@query(_sql("").rstrip() + "," + _STATES + "SELECT dt, array_to_string(p, '; ') AS problems FROM pr")
def manifest_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).select("dt", F.array_join("p", "; ").alias("problems"))


@query(_sql("").rstrip() + "," + _STATES + """SELECT dt, left('daybook dt=' || dt || ' (health-check)' || chr(10) || array_to_string(list_transform(p, lambda x: '- ' || x || chr(10)), '')
    || 'check: status ' || dt || ' / verify-all', 1900) AS alert FROM pr WHERE len(p) > 0""")  # fmt: skip
def alert_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _states(spark, sf_dir).where(F.size("p") > 0).select("dt", quality.alert_text(F.col("dt"), "health-check", F.col("p")).alias("alert"))


@query(_sql("SELECT DISTINCT dt, service FROM lines"))
def services_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.services(bronze.placed(w.bronze_lines(spark, sf_dir).select("source_key")))


_PAGES = """
    pg AS (SELECT 'svc' || (user_id % 4) AS service, (event_id // 1000)::INT AS page_no, (count(*) * 3)::BIGINT AS n FROM events GROUP BY ALL),
    num AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY page_no) AS i FROM pg),
    rec AS (SELECT service, i, n AS open, 0 AS chunk_no FROM num WHERE i = 1
            UNION ALL SELECT r.service, x.i, CASE WHEN r.open >= 2000 THEN x.n ELSE r.open + x.n END,
                             r.chunk_no + CASE WHEN r.open >= 2000 THEN 1 ELSE 0 END FROM rec r JOIN num x ON x.service = r.service AND x.i = r.i + 1)
"""


@query(f"WITH RECURSIVE {_PAGES} SELECT service, chunk_no::INT AS chunk_no, max(open) AS expected_count FROM rec GROUP BY service, chunk_no")
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    service, page = F.concat(F.lit("svc"), F.col("user_id") % 4).alias("service"), F.floor(F.col("event_id") / 1000).cast("int").alias("page_no")
    return quality.chunk_plan(events.groupBy(service, page).agg((F.count(F.lit(1)) * 3).alias("n_objects")))


@query(_sql("SELECT dt, service, (count(*) + 1999) // 2000 AS batches, (count(*) - 1) % 2000 + 1 AS last_batch FROM silver GROUP BY dt, service"))
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many batches of 2000 rows a day's rows of a service would be sent in."""
    n = F.count(F.lit(1))
    return w.silver(spark, sf_dir).groupBy("dt", "service").agg(F.ceil(n / 2000).alias("batches"), ((n - 1) % 2000 + 1).alias("last_batch"))


@query(
    """WITH b AS (SELECT event_id, 'a' || chr(13) || chr(10) || chr(10) || '  b' || event_id || chr(160) || chr(10) || chr(65279) || 'c ' || chr(10) || ' ' || chr(9) AS body FROM events),
       l AS (SELECT event_id, list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(160) || chr(65279))), lambda x: x <> '') AS l FROM b)
       SELECT event_id, unnest(generate_series(0, len(l) - 1))::INT AS line_index, unnest(l) AS line FROM l"""
)
def line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    body = F.concat(F.lit("a\r\n\n  b"), F.col("event_id").cast("string"), F.lit(" \n﻿c \n \t"))
    return events.select("event_id", F.posexplode(fn.lines(body)).alias("line_index", "line"))


@query(
    """WITH r AS (SELECT min(ts)::DATE AS a, max(ts)::DATE AS b FROM events), d AS (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS x FROM r)
       SELECT strftime(x, '%Y-%m-%d') AS dt, strftime(x - 1, '%Y-%m-%d') AS yesterday, 'day-' || strftime(x, '%Y-%m-%d') || '-r2' AS run_id FROM d"""
)
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last, its day before, and the id of its second run."""
    ends = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("b"))
    day = ends.select(F.explode(F.sequence("a", "b")).alias("x"))
    head, tail = run_id("\0", "2").split("\0")
    dt = F.date_format("x", "yyyy-MM-dd")
    return day.select(dt.alias("dt"), F.date_format(F.date_sub("x", 1), "yyyy-MM-dd").alias("yesterday"), F.concat(F.lit(head), dt, F.lit(tail)).alias("run_id"))


@query(
    """WITH t AS (SELECT DISTINCT printf('%04d-%02d-%02d', (2023 + event_id % 3)::INT, (event_id % 14)::INT, (event_id % 33)::INT) AS dt FROM events
                  UNION SELECT '2026-9-21' UNION SELECT '' UNION SELECT '2026-09-21'' OR ''1''=''1')
       SELECT dt, regexp_full_match(dt, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND try_cast(dt AS DATE) IS NOT NULL AS valid FROM t"""
)
def valid_dt(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    made = F.format_string("%04d-%02d-%02d", 2023 + n % 3, n % 14, n % 33)
    days = spread(spark.read.parquet(f"{sf_dir}/events.parquet")).select(made.alias("dt"))
    odd = spark.createDataFrame([("2026-9-21",), ("",), ("2026-09-21' OR '1'='1",)], "dt string")
    return days.union(odd).distinct().select("dt", fn.is_day(F.col("dt")).alias("valid"))


# The forms in which an event's time is written, by its id; the last ones are refused.
_FORMS_SQL = """
    CASE event_id % 20
        WHEN 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(t, '%a, %d %b %Y %H:%M:%S GMT') WHEN 2 THEN strftime(t, '%A, %B %d, %Y %H:%M:%S')
        WHEN 3 THEN strftime(t, '%a %b %d %Y %H:%M:%S GMT+0900 (Somewhere Standard Time)') WHEN 4 THEN strftime(t, '%d %B %Y %H:%M:%S EST') WHEN 5 THEN strftime(t, '%m/%d/%Y %I:%M:%S %p')
        WHEN 6 THEN strftime(t, '%Y/%m/%d %H:%M:%S') WHEN 7 THEN strftime(t, '+00%Y-%m-%dT%H:%M:%S.5Z') WHEN 8 THEN strftime(t, '%Y %b %d') WHEN 9 THEN strftime(t, '%d-%b-%y %H:%M:%S')
        WHEN 10 THEN strftime(t, '%b %d %Y %H:%M:%S -0730') WHEN 11 THEN strftime(t, '%Y-%m-%dT24:00:00Z') WHEN 12 THEN strftime(t, '%Y-02-31T%H:%M:%SZ')
        WHEN 13 THEN strftime(t, '%b %Y') WHEN 14 THEN strftime(t, '%d Foo %Y') WHEN 15 THEN strftime(t, '%d %b %Y 25:00') WHEN 16 THEN strftime(t, '%Y/13/%d')
        WHEN 17 THEN strftime(t, '%d %b %Y tomorrow') WHEN 18 THEN strftime(t, '%H:%M:%S') ELSE ' ' || strftime(t, '%Y-%m-%d') END"""


@query(
    f"""WITH e AS (SELECT event_id, date_trunc('second', ts) AS t FROM events), f AS (SELECT event_id, t, {_FORMS_SQL} AS text FROM e)
        SELECT event_id, text, CASE event_id % 20 WHEN 3 THEN t - INTERVAL 9 HOUR WHEN 4 THEN t + INTERVAL 5 HOUR WHEN 7 THEN t + INTERVAL 500 MILLISECOND WHEN 8 THEN date_trunc('day', t)
            WHEN 10 THEN t + INTERVAL 450 MINUTE WHEN 11 THEN date_trunc('day', t) + INTERVAL 1 DAY
            WHEN 12 THEN date_trunc('year', t) + INTERVAL 61 DAY + (t - date_trunc('day', t)) ELSE CASE WHEN event_id % 20 < 13 THEN t END END::TIMESTAMP AS found FROM f"""
)
def time_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's time written in one of many forms, and what is read from it; null where it is refused."""
    day, clock = "yyyy-MM-dd", "HH:mm:ss"
    made = [
        f"{day}'T'{clock}'Z'", f"EEE, dd MMM yyyy {clock} 'GMT'", f"EEEE, MMMM dd, yyyy {clock}", f"EEE MMM dd yyyy {clock} 'GMT+0900 (Somewhere Standard Time)'", f"dd MMMM yyyy {clock} 'EST'",
        "MM/dd/yyyy hh:mm:ss a", f"yyyy/MM/dd {clock}", f"'+00'{day}'T'{clock}'.5Z'", "yyyy MMM dd", f"dd-MMM-yy {clock}", f"MMM dd yyyy {clock} '-0730'", f"{day}'T24:00:00Z'", f"yyyy-'02-31T'{clock}'Z'",
        "MMM yyyy", "dd 'Foo' yyyy", "dd MMM yyyy '25:00'", "yyyy'/13/'dd", "dd MMM yyyy 'tomorrow'", clock, f"' '{day}",
    ]
    events = spread(prepare(spark).read.parquet(f"{sf_dir}/events.parquet"))
    t, text = F.date_trunc("second", F.col("ts").cast("timestamp")), None
    for k, form in enumerate(made):
        one = F.date_format(t, form)
        text = F.when(F.col("event_id") % len(made) == k, one) if text is None else text.when(F.col("event_id") % len(made) == k, one)
    return events.select("event_id", text.alias("text")).withColumn("found", point_in_time(F.col("text")).cast("timestamp_ntz"))


@query(_sql(
    """SELECT dt, source_key, CASE WHEN event_id % 31 = 0 THEN 'late' WHEN event_id % 37 = 0 OR event_id % 41 = 0 THEN 'lost' ELSE 'changed' END AS problem
       FROM lines WHERE event_id % 31 = 0 OR event_id % 37 = 0 OR event_id % 41 = 0 OR event_id % 43 = 0 OR event_id % 47 = 0"""
))
def listing_proof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that weren't the same before, during and after reading: of the events' objects some came late, some were lost
    while reading or afterwards, some were changed while reading or afterwards."""
    n = F.regexp_extract("source_key", "([0-9]+)[.]jsonl$", 1).cast("long")
    lines = w.bronze_lines(spark, sf_dir).select("dt", "source_key", F.length("line").cast("long").alias("length"), F.lit("2026-01-01").cast("timestamp").alias("modified"), n.alias("n"))
    listed = lines.where(F.col("n") % 31 != 0)
    read = lines.where((F.col("n") % 31 == 0) | (F.col("n") % 37 != 0)).withColumn("length", F.when(F.col("n") % 43 == 0, F.col("length") + 1).otherwise(F.col("length")))
    again = lines.where((F.col("n") % 31 == 0) | (F.col("n") % 41 != 0)).withColumn("modified", F.when(F.col("n") % 47 == 0, F.lit("2026-01-02").cast("timestamp")).otherwise(F.col("modified")))
    return quality.listing_problems(listed, read, again)


@query(_sql(
    """SELECT dt, row_uid, 2::BIGINT AS copies, 2::BIGINT AS contents FROM silver WHERE event_id % 50 = 0 AND dt LIKE '%3' AND event_id % 100 = 0"""
))
def content_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids stored twice, of which every other's rows differ in their latency."""
    rows = w.silver(spark, sf_dir).select("event_id", *_STORED)
    twice = rows.where((F.col("event_id") % 50 == 0) & F.col("dt").endswith("3"))
    other = twice.withColumn("latency_ms", F.when(F.col("event_id") % 100 == 0, F.col("latency_ms") + 1).otherwise(F.col("latency_ms")))
    return quality.conflicting(rows.unionByName(other).drop("event_id"))


@query(_sql("SELECT * FROM gold"))
def gold_retraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily aggregate of partial ones of which a third was added twice and taken back once."""
    rows = w.silver(spark, sf_dir)
    third = gold.partial(rows.where(F.col("event_id") % 3 == 1))
    parts = gold.partial(rows).unionByName(third).unionByName(gold.retracted(third))
    return gold.merged(parts).withColumn("latency_avg", F.round("latency_avg", 6))
