"""Points in time as people and programs write them, as expressions.

ISO-8601 comes first. What isn't that is taken apart by one pattern for the other common forms: days before or after the
name of a month (of which three letters count), years first, dates with slashes, all with an optional time of day, morning
or afternoon, the name of a zone or an offset, and a remark in brackets; words before the first number, such as weekdays,
don't count. Days up to 31 run over into the next month, hour 24 is the next day's first, signed years have six digits, and
years of two digits lie between 1950 and 2049. Without a zone it is UTC. Forms without a year are refused.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}(-\d{2}(-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?(Z|[+-]\d{2}:\d{2})?)?)?)?$"
# Names of months and of zones, with their hours from UTC.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_ZONES = {"est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}
_DATE = "|".join(
    [
        r"(\d{1,2})[\s-]+([a-z]{3,})[.]?[\s,-]+(\d{1,4})",  # 1 day, 2 name, 3 year
        r"([a-z]{3,})[.]?[\s-]*[\s-](\d{1,2})(?:,\s*|[\s-]+)(\d{1,4})",  # 4 name, 5 day, 6 year
        r"(\d{3,4})[\s-]+([a-z]{3,})[.]?[\s-]+(\d{1,2})",  # 7 year, 8 name, 9 day
        r"(\d{3,4})/(\d{1,2})/(\d{1,2})",  # 10 year, 11 month, 12 day
        r"(\d{1,2})/(\d{1,2})/(\d{1,4})",  # 13 month, 14 day, 15 year
        r"([+-]\d{6}|\d{4})-(\d{2})-(\d{2})",  # 16 year, 17 month, 18 day
    ]
)
_FORM = (
    rf"(?i)^(?:[a-z]+[.,]*\s+)*?(?:{_DATE})(?:(?:,?\s+|t)(\d{{1,2}}):(\d{{2}})(?::(\d{{2}})(?:[.](\d+))?)?(?:\s*([ap]m))?)?"
    r"(?:\s*(z|utc?|gmt|[ecmp][sd]t)(?![a-z]))?(?:\s*([+-])(\d{2}):?(\d{2})?)?(?:\s*\([^()]*\))?$"
)
_PARTS = ("$3$6$7$10$15$16", "$2$4$8", "$11$13$17", "$1$5$9$12$14$18", "$19", "$20", "$21", "$22", "$23", "$24", "$25", "$26", "$27")


def _at(p: Column) -> Column:
    """The time that the parts of a text stand for, or null."""
    year_text, name, month_text, day_text, hour_text, minute_text, second_text, fraction, half, zone, sign, off_hours, off_minutes = (p[i] for i in range(len(_PARTS)))
    number = lambda c: F.coalesce(F.nullif(c, F.lit("")).try_cast("int"), F.lit(0))
    year, day, hour, minute, second = map(number, (year_text, day_text, hour_text, minute_text, second_text))
    year = F.when(F.length(year_text) > 2, year).when(year < 50, year + 2000).otherwise(year + 1900)
    named = F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(F.substring(name, 1, 3))).cast("int")
    month = F.when(name != "", named).otherwise(number(month_text))
    noon = F.lower(half)
    of_day = F.when(noon == "", hour).otherwise(hour % 12 + F.when(noon == "pm", 12).otherwise(0))
    hours = F.lit(0)
    for word, h in _ZONES.items():
        hours = F.when(F.lower(zone) == word, h).otherwise(hours)
    offset = F.when(sign == "", hours * 60).otherwise((number(off_hours) * 60 + number(off_minutes)) * F.when(sign == "-", -1).otherwise(1))
    micros = F.rpad(F.substring(fraction, 1, 6), 6, "0")
    whole = F.when(hour == 24, (minute == 0) & (second == 0) & (number(fraction) == 0) & (noon == "")).otherwise(hour <= F.when(noon == "", 23).otherwise(12))
    fits = (
        month.between(1, 12) & day.between(1, 31) & whole & (minute < 60) & (second < 60) & (F.abs(year) <= 275_000) & (year_text != "-000000")
        & ((sign == "") | (hour_text != "") | (zone != "")) & ((half == "") | (hour_text != ""))
    )
    days = F.unix_date(F.date_add(F.make_date(year, month, F.lit(1)), day - 1)).cast("long")
    seconds = days * 86_400 + of_day * 3600 + minute * 60 + second - offset * 60
    return F.when(fits, F.timestamp_micros(seconds * 1_000_000 + F.when(fraction != "", micros.try_cast("int")).otherwise(0)))


def point_in_time(text: Column) -> Column:
    """A text as a timestamp, or null; minutes without seconds are completed for the cast."""
    seconds = F.regexp_replace(text, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(?=Z|[+-]|$)", "$1:00")
    iso = F.when(text.rlike(_ISO), seconds.try_cast("timestamp"))
    parts = F.split(F.regexp_replace(text, _FORM, "|".join(_PARTS)), r"\|", -1)
    # The parts are bound to a name, so they are made once.
    other = F.when(text.rlike(_FORM), F.transform(F.array(parts), _at)[0])
    return F.coalesce(iso, other)
