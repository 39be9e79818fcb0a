"""Refusals by name, and what is accepted."""

import json

import pytest
from pyspark.sql import functions as F

from daybook.functions import columns as fn
from daybook.operators import validate

KEY = "api-metrics/2026-09-21/web/14/a-b.jsonl"
GOOD = {
    "timestamp": "2026-09-21T14:03:00.000Z", "service": "other", "endpoint": "/v1/x", "method": "GET", "status": 200, "latency_ms": 42,
    "request_size": 128, "response_size": 4096, "user_id": "u_1", "cf_ray": "r-NRT", "cf_colo": "NRT",
}


def but(drop=None, **changes):
    line = {k: v for k, v in {**GOOD, **changes}.items() if k != drop}
    return json.dumps(line)


CASES = [
    ("{not json", "invalid_json"), (but() + " junk", "invalid_json"), (but() + " ] x", "invalid_json"), (but() + "} x", "invalid_json"),
    ("", "invalid_json"), ("1,2", "invalid_json"), ("{} , {}", "invalid_json"), ("[1,2,3]", "not_an_object"), ("null", "not_an_object"),
    ("5", "not_an_object"), ('"x"', "not_an_object"), ("true", "not_an_object"),
    (but("timestamp"), "missing_or_invalid_timestamp"), (but(timestamp="not-a-date"), "missing_or_invalid_timestamp"),
    (but(timestamp=5), "missing_or_invalid_timestamp"), (but("endpoint"), "missing_endpoint"), (but(endpoint=""), "missing_endpoint"),
    (but(endpoint=None), "missing_endpoint"), (but(endpoint=1), "missing_endpoint"), (but("method"), "missing_method"),
    *((but(status=s), "missing_or_invalid_status") for s in (200.5, 99, 600, "200", None, True)), (but("status"), "missing_or_invalid_status"),
    (but(latency_ms=-1), "missing_or_invalid_latency_ms"), (but(latency_ms="fast"), "missing_or_invalid_latency_ms"),
    (but("latency_ms"), "missing_or_invalid_latency_ms"), (but().replace('"latency_ms": 42', '"latency_ms": 1e400'), "missing_or_invalid_latency_ms"),
    (but(request_size="big"), "invalid_request_size"), (but(response_size=[]), "invalid_response_size"), (but(user_id={}), "invalid_user_id"),
    (but(cf_ray=1), "invalid_cf_ray"), (but(cf_colo=123), "invalid_cf_colo"), (but(error_message=False), "invalid_error_message"),
    (but(status=99, endpoint=""), "missing_endpoint"),
    *((x, None) for x in (
        but(), but(request_size=None), but(request_size=-5.5), but(latency_ms=0), but(latency_ms=-0.0), but(cf_colo=""), but(endpoint=" "),
        but(timestamp="2026-09-21T14:03Z"), but(timestamp="2026-09-21"), but().replace("200", "200.0"), but().replace("200", "2e2"),
        but()[:-1] + ', "status": 404}',
    )),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = [("2026-09-21", "web", KEY, i, line) for i, (line, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "dt string, service string, source_key string, line_index int, line string")
    from daybook.session import prepare

    prepare(spark)
    return {r["row_uid"]: r for r in validate.parsed(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_reason(results, i):
    assert results[f"{KEY}#{i}"]["reason"] == CASES[i][1]


def test_typed_row(results):
    r = results[f"{KEY}#{next(i for i, c in enumerate(CASES) if c == (but(), None))}"].asDict()
    assert (r["service"], r["status"], r["status_class"], r["latency_ms"], r["request_size"]) == ("web", 200, "2xx", 42.0, 128.0)
    assert r["error_message"] is None and r["user_id"] == "u_1" and r["dt"] == "2026-09-21"


def test_last_of_repeated_fields_counts(results):
    assert results[f"{KEY}#{len(CASES) - 1}"]["status"] == 404


def test_lines(spark):
    bodies = ["a\n\n b \n\nc\n", "", "\r\n\t\n", "﻿x  \r\n　y "]
    df = spark.createDataFrame(list(enumerate(bodies)), "i int, body string").select("i", fn.lines(F.col("body")).alias("l"))
    assert {r["i"]: r["l"] for r in df.collect()} == {0: ["a", "b", "c"], 1: [], 2: [], 3: ["x", "y"]}


def test_status_class(spark):
    df = spark.createDataFrame([(s,) for s in (99, 100, 404, 599, 600, 0)], "s int")
    got = {r[0]: r[1] for r in df.select("s", fn.status_class(F.col("s"))).collect()}
    assert got == {99: "unknown", 100: "1xx", 404: "4xx", 599: "5xx", 600: "unknown", 0: "unknown"}
