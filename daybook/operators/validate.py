"""Strict validation of JSON lines: typed rows, or a named reason for refusal.

A line is parsed as VARIANT, so that the type of each value is known: "200" isn't 200, and null isn't absent. The
first rule that a line breaks, in the order below, is its reason. Everything is an expression; one pass, no UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.columns import silver_uid, status_class
from daybook.functions.times import point_in_time
from daybook.schemas import SILVER

_OPTIONAL_NUMBERS = ("request_size", "response_size")
_OPTIONAL_TEXTS = ("user_id", "cf_ray", "cf_colo", "error_message")


def _in_list(line: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))


def _alone(line: Column, parsed_list: Column) -> Column:
    """The line as VARIANT if it is exactly one JSON value, else null; parsed_list: what _in_list made of it.

    The parser forgives what follows a value, so the line is parsed within brackets, where the first element must be
    the only one. Only a line with a closing bracket of its own can end the list early: that one is parsed within an
    object too, and what fits both is one whole value.
    """
    one = parsed_list.isNotNull() & F.try_variant_get(parsed_list, "$[1]", "variant").isNull()
    in_object = F.try_parse_json(F.concat(F.lit('{"r":'), line, F.lit("}")))
    return F.when(one & (~F.contains(line, F.lit("]")) | in_object.isNotNull()), F.try_variant_get(parsed_list, "$[0]", "variant"))


def _kind(name: str) -> Column:
    return F.col(f"_k_{name}")


def _is_number(name: str) -> Column:
    kind, value = _kind(name), F.col(f"_n_{name}")
    return F.coalesce((kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")) & (F.abs(value) < F.lit(float("inf"))), F.lit(False))


def _is_text(name: str) -> Column:
    return F.coalesce(_kind(name) == "STRING", F.lit(False))


def _absent(name: str) -> Column:
    return _kind(name).isNull() | (_kind(name) == "VOID")


def parsed(df: DataFrame, *more: str) -> DataFrame:
    """df (dt, service, source_key, line_index, line) with its typed columns and reason (null: valid), and more columns of its own."""
    texts, numbers = ("timestamp", "endpoint", "method", *_OPTIONAL_TEXTS), ("status", "latency_ms", *_OPTIONAL_NUMBERS)
    # A generator between the steps keeps Catalyst from writing each step out again wherever the next one uses it.
    df = df.select("*", F.explode(F.array(_in_list(F.col("line")))).alias("_l"))
    df = df.select("*", F.explode(F.array(_alone(F.col("line"), F.col("_l")))).alias("_v"))
    field = lambda name, kind: F.try_variant_get(F.col("_v"), f"$.{name}", kind)
    found = [F.schema_of_variant(field(n, "variant")).alias(f"_k_{n}") for n in (*texts, *numbers)]
    found += [field(n, "string").alias(f"_t_{n}") for n in texts] + [field(n, "double").alias(f"_n_{n}") for n in numbers]
    found += [point_in_time(field("timestamp", "string")).alias("_ts")]
    df = df.select("*", F.inline(F.array(F.struct(*found))))
    status, latency = F.col("_n_status"), F.col("_n_latency_ms")
    # The names of the reasons, in the order in which the rules are tried.
    rules = [
        ("invalid_json", F.col("_v").isNull()),
        ("not_an_object", ~F.schema_of_variant("_v").startswith("OBJECT")),
        ("missing_or_invalid_timestamp", ~_is_text("timestamp") | F.col("_ts").isNull()),
        ("missing_endpoint", ~_is_text("endpoint") | (F.col("_t_endpoint") == "")),
        ("missing_method", ~_is_text("method") | (F.col("_t_method") == "")),
        ("missing_or_invalid_status", ~_is_number("status") | (status != F.floor(status)) | ~status.between(100, 599)),
        ("missing_or_invalid_latency_ms", ~_is_number("latency_ms") | (latency < 0)),
        *((f"invalid_{n}", ~_absent(n) & ~_is_number(n)) for n in _OPTIONAL_NUMBERS),
        *((f"invalid_{n}", ~_absent(n) & ~_is_text(n)) for n in _OPTIONAL_TEXTS),
    ]
    reason = None
    for name, broken in rules:
        reason = F.when(broken, name) if reason is None else reason.when(broken, name)
    kept = lambda n, by: F.when(by(n), F.col(f"_{'t' if by is _is_text else 'n'}_{n}")).alias(n)
    return df.select(
        F.col("_ts").alias("ts"), "dt", "service", F.col("_t_endpoint").alias("endpoint"), F.col("_t_method").alias("method"),
        F.when(_is_number("status") & status.between(100, 599), status).cast("int").alias("status"),
        status_class(status).alias("status_class"), latency.alias("latency_ms"), *(kept(n, _is_number) for n in _OPTIONAL_NUMBERS),
        *(kept(n, _is_text) for n in _OPTIONAL_TEXTS), "source_key", silver_uid(F.col("source_key"), F.col("line_index")).alias("row_uid"),
        reason.alias("reason"), F.col("line").alias("raw"), *more,
    )


def silver(df: DataFrame) -> DataFrame:
    """The valid rows of `parsed`."""
    return df.where(F.col("reason").isNull()).select(*SILVER.fieldNames())


def quarantine(df: DataFrame) -> DataFrame:
    """The refused lines of `parsed`, with their reasons."""
    return df.where(F.col("reason").isNotNull()).select("reason", "source_key", "raw", "row_uid", "dt")
