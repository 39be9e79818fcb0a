"""Lines that come to days that are there already: late objects, replaced objects, stream batches, mended lines.

What a day holds is never read anew: its partial aggregates are kept, so new lines add theirs, and lines of an object that
was replaced, or that went, are taken back by the negatives of theirs. The daily aggregate is made of the partial ones only.
Every merge is one commit; if somebody else commits one of its days first, it is done again over what is there then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.days import check_dt
from daybook.operators import gold, quality, validate
from daybook.plans.run import PROBLEMS, _finished, _now, build_manifest
from daybook.schemas import COUNTERS
from daybook.scratch import Scratch
from daybook.sources import bronze
from daybook.sources.log import ConflictError
from daybook.sources.store import Change, Lake

_ID = ["dt", "row_uid"]
#: How often a merge is begun anew because of others' commits.
ATTEMPTS = 5


def _again(work: Callable[[], dict]) -> dict:
    for attempt in range(ATTEMPTS):
        try:
            return work()
        except ConflictError:
            if attempt == ATTEMPTS - 1:
                raise
    return {}


def merge(change: Change, parsed: DataFrame, days: list[str], started: str, scratch: Scratch, replaced: DataFrame | None = None) -> dict[str, dict]:
    """Add parsed lines to these days in a change, and make the days' manifests; nothing is committed.

    A line whose id is there already changes nothing, except that a refused one that is valid now leaves the quarantine.
    replaced: (dt, source_key) of objects whose old lines go first.
    """
    before = {t: change.read(t, days) for t in ("silver", "quarantine")}
    counted = lambda: {r["dt"]: r["n"] for r in _sources(change, days).groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    objects = counted()
    stays = dict(before)
    if replaced is not None:
        gone = before["silver"].join(replaced, ["dt", "source_key"], "left_semi")
        change.add("partials", gold.retracted(gold.partial(gone)), days)
        stays = {t: rows.join(replaced, ["dt", "source_key"], "left_anti") for t, rows in before.items()}
    lines = scratch.save(parsed.where(F.col("raw").isNotNull()).dropDuplicates(_ID), "lines")
    valid = validate.silver(lines).join(stays["silver"].select(_ID), _ID, "left_anti")
    valid = scratch.save(valid, "valid")
    change.add("partials", gold.partial(valid), days)
    refused = validate.quarantine(lines).join(stays["silver"].select(_ID).unionByName(stays["quarantine"].select(_ID)), _ID, "left_anti")
    left = stays["quarantine"].join(valid.select(_ID), _ID, "left_semi").limit(1).count()
    if replaced is None and not left:
        change.add("quarantine", refused, days)
    else:
        change.replace("quarantine", stays["quarantine"].join(valid.select(_ID), _ID, "left_anti").unionByName(refused), days)
    if replaced is None:
        change.add("silver", valid, days)
    else:
        change.replace("silver", stays["silver"].unionByName(valid), days)
    change.replace("gold", gold.merged(change.read("partials", days), scratch), days)
    n = F.count(F.lit(1)).alias("n")
    by_day = lambda df, *of: {r["dt"]: r for r in df.groupBy("dt").agg(*of).collect()}
    rows = {t: by_day(change.read(t, days), n) for t in ("silver", "quarantine")}
    built = by_day(change.read("gold", days), n, F.sum("requests").alias("r"))
    services = by_day(_sources(change, days), F.array_sort(F.collect_set("service")).alias("s"))
    after, made = counted(), {}
    of = lambda table, d, c="n": table[d][c] if d in table else 0
    for d in days:
        was = change.entry(d)["manifest"] or dict.fromkeys(COUNTERS, 0) | {"services": []}
        more = after.get(d, 0) - objects.get(d, 0)
        counters = {
            "dt": d, "bronzeObjectCount": was["bronzeObjectCount"] + more, "bronzeObjectsRead": was["bronzeObjectsRead"] + more,
            "bronzeObjectsMissing": was["bronzeObjectsMissing"], "bronzeLinesParsed": of(rows["silver"], d) + of(rows["quarantine"], d), "silverRows": of(rows["silver"], d),
            "quarantinedRows": of(rows["quarantine"], d), "goldRows": of(built, d), "goldRequestsSum": of(built, d, "r"),
        }
        made[d] = build_manifest(counters, started, sorted({*was["services"], *of(services, d, "s")} if d in services else was["services"]), objects=was.get("objectProblems"))
        change.manifest(made[d])
    return made


def _sources(change: Change, days: list[str]) -> DataFrame:
    """dt, source_key, service of the objects that the days' lines are from."""
    rows = change.read("silver", days).select("dt", "source_key").unionByName(change.read("quarantine", days).select("dt", "source_key"))
    return rows.distinct().withColumn("service", F.split("source_key", "/")[2])


def days_of(rows: DataFrame) -> list[str]:
    """The days that rows are of; as many names as there are days."""
    return sorted(check_dt(r[0]) for r in rows.select("dt").distinct().collect())


def add_lines(lake: Lake, parsed: DataFrame, operation: str, batches: Callable[[Change], dict[str, int]] | None = None, webhook: str | None = None) -> dict[str, dict]:
    """Merge parsed lines into the days they are of, found from the lines; the days' manifests, verified."""
    scratch = Scratch(lake.spark, "merge")

    def once() -> dict:
        change, started = lake.change(operation), _now()
        change.batches = batches(change) if batches else {}
        days = days_of(parsed)
        made = merge(change, parsed, days, started, scratch) if days else {}
        if days or change.batches:
            change.commit()
        return made

    try:
        made = _again(once)
        return _finished(lake, list(made), made, webhook, None)
    finally:
        scratch.release()


def update_days(spark: SparkSession, bronze_root: str, lake: Lake, days: list[str], webhook: str | None = None) -> dict[str, dict]:
    """Bring days up to the objects that are there now, reading only new and replaced ones; manifests of days that changed.

    The lines of an object that has another length or time than the day was made of, or that is gone, are taken back. Objects
    that were late, lost or changed when the day was made are always read anew, so that none of them is forgotten.
    """
    scratch = Scratch(spark, "update")

    def once() -> dict:
        change, started = lake.change("update"), _now()
        listed = scratch.save(bronze.listing(spark, bronze_root, days), f"listing-{len(scratch.names)}")
        known = change.read("objects", days).withColumnsRenamed({"length": "old_length", "modified": "old_modified"}).drop("service")
        odd = change.read("discrepancies", days).select("dt", "source_key").distinct().withColumn("odd", F.lit(True))
        both = listed.join(known, ["dt", "source_key"], "full").join(odd, ["dt", "source_key"], "full")
        same = F.col("length").eqNullSafe(F.col("old_length")) & F.col("modified").eqNullSafe(F.col("old_modified")) & F.col("odd").isNull()
        both = scratch.save(both.where(~same), f"differences-{len(scratch.names)}")
        touched = days_of(both)
        if not touched:
            return {}
        new = both.where("length is not null")
        read = validate.parsed(bronze.read_lines(spark, bronze_root, new, scratch), *bronze.SEEN)
        read = scratch.save(read, f"read-{len(scratch.names)}")
        old = both.where("old_length is not null or odd").select("dt", "source_key")
        again = bronze.listing(spark, bronze_root, touched).join(new.select("dt", "source_key"), ["dt", "source_key"], "left_semi")
        change.replace("discrepancies", quality.listing_problems(new, read, again), touched)
        made = merge(change, read, touched, started, scratch, old if old.limit(1).count() else None)
        now = {r["dt"]: r["n"] for r in listed.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
        told = {r["dt"]: r for r in change.read("discrepancies", touched).groupBy("dt").agg(*(F.count_if(F.col("problem") == k).alias(k) for k in PROBLEMS)).collect()}
        change.replace("objects", listed, touched)
        for d in touched:
            m = made[d]
            lost = told[d]["lost"] if d in told else 0
            counters = {**{c: m[c] for c in COUNTERS}, "dt": d, "bronzeObjectCount": now.get(d, 0), "bronzeObjectsRead": now.get(d, 0) - lost, "bronzeObjectsMissing": lost}
            objects = {**{k: told[d][k] for k in PROBLEMS}, "keys": []} if d in told else None
            made[d] = build_manifest(counters, started, m["services"], objects=objects)
            change.manifest(made[d])
        change.commit()
        return made

    try:
        made = _again(once)
        return _finished(lake, list(made), made, webhook, None)
    finally:
        scratch.release()
