"""Scalar expressions, all inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endpoint under which all requests that matched no route are counted.
UNMATCHED = "(unmatched)"
#: What the trimming of a line removes at both ends: white space of Unicode and the byte order mark.
_BLANK = "[\\x09-\\x0d\\x20\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"


def status_class(status: Column) -> Column:
    """1xx to 5xx, else unknown."""
    hundreds = F.floor(status / 100)
    return F.when(hundreds.between(1, 5), F.concat(hundreds.cast("string"), F.lit("xx"))).otherwise("unknown")


def gold_endpoint(endpoint: Column, status: Column) -> Column:
    """404s are one endpoint, whatever they asked for."""
    return F.when(status == 404, F.lit(UNMATCHED)).otherwise(endpoint)


def silver_uid(source_key: Column, line: Column) -> Column:
    return F.concat(source_key, F.lit("#"), line.cast("string"))


def gold_uid(*keys: Column) -> Column:
    """Not injective where a key holds the separator; the format is a given."""
    return F.concat_ws("|", *keys)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")


def lines(body: Column) -> Column:
    """The non-blank lines of an object's body, trimmed."""
    return F.filter(F.transform(F.split(body, "\n", -1), trimmed), lambda x: F.length(x) > 0)


def is_day(text: Column) -> Column:
    return text.isNotNull() & text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull()


def listed(values: Column) -> Column:
    """Sorted distinct values joined by commas, '' for none."""
    return F.array_join(F.array_sort(F.collect_set(values)), ",")
