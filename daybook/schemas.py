"""Schemas of the tables; nothing is ever inferred. The names of all columns and fields are fixed values."""

from pyspark.sql import types as T

_s, _d, _i, _l, _b = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()

SILVER = T.StructType(
    [
        T.StructField("ts", T.TimestampType()), T.StructField("dt", _s), T.StructField("service", _s), T.StructField("endpoint", _s),
        T.StructField("method", _s), T.StructField("status", _i), T.StructField("status_class", _s), T.StructField("latency_ms", _d),
        T.StructField("request_size", _d), T.StructField("response_size", _d), T.StructField("user_id", _s), T.StructField("cf_ray", _s),
        T.StructField("cf_colo", _s), T.StructField("error_message", _s), T.StructField("source_key", _s), T.StructField("row_uid", _s),
    ]
)

GOLD = T.StructType(
    [
        T.StructField("dt", _s), T.StructField("service", _s), T.StructField("endpoint", _s), T.StructField("method", _s),
        T.StructField("requests", _i), T.StructField("errors_4xx", _i), T.StructField("errors_5xx", _i), T.StructField("error_rate", _d),
        T.StructField("requests_measured", _i), T.StructField("requests_zero_latency", _i), T.StructField("latency_p50", _d),
        T.StructField("latency_p95", _d), T.StructField("latency_p99", _d), T.StructField("latency_avg", _d), T.StructField("latency_max", _d),
        T.StructField("colos", _s), T.StructField("row_uid", _s),
    ]
)

QUARANTINE = T.StructType([T.StructField(c, _s) for c in ("reason", "source_key", "raw", "row_uid", "dt")])

#: Counts by measured latency and colo (null: none); they may be negative, to take others back.
PARTIALS = T.StructType(
    [
        *(T.StructField(c, _s) for c in ("dt", "service", "endpoint", "method")), T.StructField("measured", _d), T.StructField("colo", _s),
        *(T.StructField(c, _l) for c in ("requests", "errors_4xx", "errors_5xx")),
    ]
)
#: The objects that a day was made of, as they were then.
OBJECTS = T.StructType([T.StructField("dt", _s), T.StructField("service", _s), T.StructField("source_key", _s), T.StructField("length", _l), T.StructField("modified", T.TimestampType())])
#: Objects that were late, lost or changed while a day was read; ids that stand for rows of different content.
DISCREPANCIES = T.StructType([T.StructField(c, _s) for c in ("dt", "source_key", "problem")])
CONFLICTS = T.StructType([T.StructField("dt", _s), T.StructField("row_uid", _s), T.StructField("copies", _l), T.StructField("contents", _l)])

REQUIRED = {
    "silver": ("ts", "dt", "service", "endpoint", "method", "status", "status_class", "latency_ms", "source_key", "row_uid"),
    "gold": (
        "dt", "service", "endpoint", "method", "requests", "errors_4xx", "errors_5xx", "error_rate", "requests_measured",
        "requests_zero_latency", "colos", "row_uid",
    ),
}

COUNTERS = (
    "bronzeObjectCount", "bronzeObjectsRead", "bronzeObjectsMissing", "bronzeLinesParsed", "silverRows", "quarantinedRows", "goldRows",
    "goldRequestsSum",
)

MANIFEST = T.StructType(
    [
        T.StructField("dt", _s), T.StructField("status", _s), T.StructField("startedAt", _s), T.StructField("finishedAt", _s),
        *(T.StructField(c, _l) for c in COUNTERS), T.StructField("services", T.ArrayType(_s)),
        T.StructField("objectProblems", T.StructType([*(T.StructField(c, _l) for c in ("late", "lost", "changed")), T.StructField("keys", T.ArrayType(_s))])),
        T.StructField(
            "assertions",
            T.StructType(
                [
                    T.StructField(c, _b)
                    for c in (
                        "linesEqualsSilverPlusQuarantine", "silverEqualsGoldRequests", "objectsListedEqualsRead",
                        "silverDistinctEqualsManifest", "goldDistinctEqualsManifest",
                    )
                ]
            ),
        ),
        T.StructField(
            "verify",
            T.StructType(
                [T.StructField(c, _l) for c in ("silverRows", "silverDistinct", "goldRows", "goldDistinct")]
                + [T.StructField(c, _s) for c in ("checkedAt", "skipped", "error")]
            ),
        ),
    ]
)
