"""The daily aggregate: fixed cases, nearest ranks, and merging of parts."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators import gold

SCHEMA = "dt string, service string, endpoint string, method string, status int, status_class string, latency_ms double, cf_colo string, part int"


def rows(*items):
    out = []
    for i, (latency, cls, colo, *more) in enumerate(items):
        status = {"2xx": 200, "4xx": 400, "5xx": 500}[cls]
        out.append(("2026-09-21", "web", more[0] if more else "/x", "GET", more[1] if len(more) > 1 else status, cls, float(latency), colo, i % 3))
    return out


def one(spark, *items):
    found = gold.daily(spark.createDataFrame(rows(*items), SCHEMA)).collect()
    assert len(found) == 1
    return found[0]


def test_counts_rates_and_colos(spark):
    r = one(spark, (100, "2xx", "NRT"), (100, "2xx", "NRT"), (300, "4xx", "KIX"), (900, "5xx", "ICN"))
    assert (r["requests"], r["errors_4xx"], r["errors_5xx"], r["error_rate"]) == (4, 1, 1, 0.5)
    assert (r["latency_avg"], r["latency_max"], r["colos"]) == (350, 900, "ICN,KIX,NRT")
    assert r["row_uid"] == "2026-09-21|web|/x|GET"


def test_zero_latencies_are_not_measured(spark):
    r = one(spark, *((x, "2xx", None) for x in (0, 0, 0, 100, 200, 300)))
    assert (r["requests"], r["requests_zero_latency"], r["requests_measured"]) == (6, 3, 3)
    assert (r["latency_avg"], r["latency_max"], r["latency_p50"], r["colos"]) == (200, 300, 200, "")


def test_only_zero_latencies(spark):
    r = one(spark, (0, "5xx", "KIX"))
    assert (r["requests"], r["errors_5xx"], r["error_rate"], r["colos"], r["latency_p50"], r["latency_max"], r["latency_avg"]) == (1, 1, 1, "KIX", None, None, None)


def test_empty_colo_is_none(spark):
    assert one(spark, (1, "2xx", ""), (1, "2xx", "NRT"))["colos"] == "NRT"


def test_unmatched_are_folded(spark):
    items = [(1, "4xx", None, "/.env", 404), (1, "4xx", None, "/wp", 404), (1, "2xx", None, "/a", 200), (1, "4xx", None, "/b", 401), (1, "5xx", None, "/c", 500)]
    got = {r["endpoint"]: r["requests"] for r in gold.daily(spark.createDataFrame(rows(*items), SCHEMA)).collect()}
    assert got == {"(unmatched)": 2, "/a": 1, "/b": 1, "/c": 1}


@pytest.mark.parametrize("n", [1, 2, 20, 101, 1000])
def test_nearest_rank(spark, n):
    r = one(spark, *((x, "2xx", None) for x in range(1, n + 1)))
    assert [r[f"latency_p{p}"] for p in (50, 95, 99)] == [max(1, math.ceil(p / 100 * n)) for p in (50, 95, 99)]


def test_selection_finds_the_same_ranks(spark, monkeypatch):
    rng = random.Random(3)
    kinds = [lambda: rng.random() * 1e-300, lambda: rng.lognormvariate(3, 2), lambda: 1 + rng.random() * 1e-12, lambda: float(rng.randint(0, 3)), lambda: rng.choice([5e-324, 1e308, 7.0])]
    items = [(kinds[k](), "2xx", rng.choice(["NRT", None]), f"/{k}") for k in range(5) for _ in range(rng.choice([1, 50, 400]))]
    df = spark.createDataFrame(rows(*items), SCHEMA)
    want = {}
    for latency, _, _, endpoint in items:
        if latency:
            want.setdefault(endpoint, []).append(latency)
    rounded = lambda found: sorted(repr(r.asDict() | {"latency_avg": f"{r['latency_avg'] or 0:.9e}"}) for r in found)
    plain = rounded(gold.daily(df).collect())
    for limit, parts in ((40, 4096), (0, 4096), (0, 2)):
        monkeypatch.setattr(gold, "ONE_TASK", limit), monkeypatch.setattr(gold, "EQUAL_PARTS", parts)
        found = gold.daily(df).collect()
        assert rounded(found) == plain
        for r in found:
            v = sorted(want[r["endpoint"]])
            assert [r[f"latency_p{p}"] for p in gold.PERCENTS] == [v[math.ceil(p / 100 * len(v)) - 1] for p in gold.PERCENTS]


def test_no_window_holds_a_group(spark, monkeypatch):
    """The rows that a task orders are counts of buckets, or the values of the one that holds a rank."""
    monkeypatch.setattr(gold, "ONE_TASK", 0)
    values = spark.range(1, 20_001).selectExpr("'d' dt", "'s' service", "'e' endpoint", "'m' method", "1000 + id / 7 measured", "1L n")
    held = []
    plain = gold._holding
    monkeypatch.setattr(gold, "_holding", lambda parts: held.append(parts.count()) or plain(parts))
    found = gold.nearest_ranks(values).first()
    assert [found[f"latency_p{p}"] for p in gold.PERCENTS] == [1000 + math.ceil(p / 100 * 20_000) / 7 for p in gold.PERCENTS]
    # The first counts are there once for each of the three ranks.
    assert held[0] <= 3 * 64 * 2 and held[1] <= 3 * 4096 and held[2] <= 30


def test_what_is_taken_back_leaves_no_trace(spark):
    rng = random.Random(8)
    made = lambda n: [(rng.choice([0, 1.5, 2, 80]), rng.choice(["2xx", "4xx"]), rng.choice(["NRT", "KIX", None]), rng.choice(["/a", "/b", "/c"])) for _ in range(n)]
    kept, gone = made(40), [*made(40), (9999, "5xx", "XXX", "/gone")]
    frame = lambda items: spark.createDataFrame(rows(*items), SCHEMA)
    stored = gold.partial(frame(kept + gone)).unionByName(gold.retracted(gold.partial(frame(gone))))
    rounded = lambda df: sorted(map(repr, df.withColumn("latency_avg", F.round("latency_avg", 9)).collect()))
    assert rounded(gold.merged(stored)) == rounded(gold.daily(frame(kept)))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 5, 7.5, 120]), st.sampled_from(["2xx", "4xx", "5xx"]), st.sampled_from([None, "", "NRT", "KIX"]), st.sampled_from(["/a", "/b"])), min_size=1, max_size=40))
def test_parts_merge_to_the_whole(spark, items):
    df = spark.createDataFrame(rows(*items), SCHEMA)
    whole = gold.daily(df).withColumn("latency_avg", F.round("latency_avg", 9))
    parts = gold.merged(gold.partial(df, F.col("part"))).withColumn("latency_avg", F.round("latency_avg", 9)).select(*whole.columns)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, parts.collect()))


def test_counts_are_added_before_and_after_one_shuffle(spark):
    plan = gold.partial(spark.createDataFrame(rows((1, "2xx", None)), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan
