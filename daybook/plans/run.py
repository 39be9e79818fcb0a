"""Days from raw objects to checked tables: the same few Spark jobs for any number of days."""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.functions.days import (
    check_dt, day_range, is_valid_attempt, is_valid_dt, is_valid_force, is_valid_run_id, parse_force, run_id, yesterday,
)
from daybook.operators import gold as gold_ops
from daybook.operators import quality, validate
from daybook.plans.alerts import format_alert, manifest_problems, notify
from daybook.schemas import COUNTERS
from daybook.scratch import Scratch
from daybook.sources import bronze
from daybook.sources.log import ConflictError
from daybook.sources.store import Change, Lake


class MismatchError(RuntimeError):
    """A day's own counters disagree; its manifest is written."""


class ContentConflictError(RuntimeError):
    """Rows with one id aren't the same; nothing was removed."""


#: What can be wrong with the listing of an object, and keys of such objects that a manifest tells at most.
PROBLEMS, KEYS_TOLD = ("late", "lost", "changed"), 20


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")


def build_manifest(counters: dict, started: str, services: list[str], finished: str | None = None, objects: dict | None = None) -> dict:
    """objects: how many were late, lost or changed while the day was read, and some of their keys."""
    lines = counters["bronzeLinesParsed"] == counters["silverRows"] + counters["quarantinedRows"]
    requests = counters["silverRows"] == counters["goldRequestsSum"]
    same = counters["bronzeObjectCount"] == counters["bronzeObjectsRead"] and counters["bronzeObjectsMissing"] == 0 and not objects
    return {
        "dt": counters["dt"], "status": "done" if lines and requests and same else "mismatch", "startedAt": started, "finishedAt": finished or _now(),
        **{c: counters[c] for c in COUNTERS}, "services": services, **({"objectProblems": objects} if objects else {}),
        "assertions": {"linesEqualsSilverPlusQuarantine": lines, "silverEqualsGoldRequests": requests, "objectsListedEqualsRead": same},
    }


def apply_counts(manifest: dict, counts: dict) -> dict:
    silver, gold = counts["silverDistinct"] == manifest["silverRows"], counts["goldDistinct"] == manifest["goldRows"]
    more = counts["silverRows"] > counts["silverDistinct"] or counts["goldRows"] > counts["goldDistinct"]
    status = "mismatch" if not (silver and gold) else "duplicates" if more else manifest["status"]
    checks = {**manifest["assertions"], "silverDistinctEqualsManifest": silver, "goldDistinctEqualsManifest": gold}
    return {**manifest, "status": status, "assertions": checks, "verify": counts}


def verify_days(lake: Lake, manifests: list[dict], count: Callable | None = None, skip: str | None = None) -> dict[str, dict]:
    """Count what is stored of these days, one count for each table; record it in the manifests, and store them.

    A failure is recorded in all of them, not raised; skip: why nothing is to be counted, which is recorded likewise.
    """
    days, base = [m["dt"] for m in manifests], lake.snapshot()
    if skip is not None:
        made = [{**m, "verify": {"skipped": skip}} for m in manifests]
    else:
        try:
            counts = {t: (count or stored_day_counts)(lake, t, days) for t in ("silver", "gold")}
            made = []
            for m in manifests:
                silver, gold = (counts[t].get(m["dt"], (0, 0)) for t in ("silver", "gold"))
                made.append(apply_counts(m, {"silverRows": silver[0], "silverDistinct": silver[1], "goldRows": gold[0], "goldDistinct": gold[1], "checkedAt": _now()}))
        except Exception as error:  # the days are complete either way
            made = [{**m, "verify": {"error": str(error)}} for m in manifests]
    change = lake.change("verify", base)
    for m in made:
        change.manifest(m)
    try:
        change.commit()
    except ConflictError as error:  # some day is another one by now, and whoever made it verifies it
        made = [{**m, "verify": {"error": str(error)}} for m in manifests]
    return {m["dt"]: m for m in made}


def stored_day_counts(lake: Lake, table: str, days: list[str]) -> dict[str, tuple[int, int]]:
    """(rows, distinct ids) of each day that has any."""
    rows = lake.read_of(lake.snapshot(), table, [check_dt(d) for d in days])
    return {r["dt"]: (r["rows"], r["distinct_ids"]) for r in quality.per_day(rows).collect()}


def stored_counts(lake: Lake, table: str, dt: str) -> tuple[int, int]:
    return tuple(quality.row_counts(lake.read(table), check_dt(dt)).first())


def run_days(
    spark: SparkSession, bronze_root: str, lake: Lake, days: list[str], force: bool = False, attempt: str | None = None,
    webhook: str | None = None, skip_verify: str | None = None,
) -> dict[str, dict]:
    """Build all days that are not done (or all, if forced); their manifests by day.

    Objects are listed before and after they are read, once each, and the number of jobs doesn't depend on that of days.
    All tables and manifests of all days become visible by one commit; until then the days are what they were. A day that a
    run began to rebuild and didn't finish counts as not done. skip_verify: why the stored rows are not to be counted.
    Raises MismatchError after everything is written if the counters of some day disagree, and ConflictError, with nothing
    changed, if somebody else has committed one of the days in the meantime.
    """
    started, base = _now(), lake.snapshot()
    known, open_ = lake.manifests_of(days, base), lake.log.intended(base)
    for d in days:
        if not is_valid_run_id(run_id(d, attempt)):
            raise ValueError("a run needs an id")
    todo = [d for d in days if force or not known[d] or known[d]["status"] != "done" or d in open_]
    out = {d: known[d] for d in days if d not in todo}
    if not todo:
        return out
    scratch, note = Scratch(spark, "day"), lake.log.intend(todo, base)
    try:
        made = _build(spark, bronze_root, lake.change("run", base), todo, started, scratch)
        lake.log.done(note)
        return out | _finished(lake, todo, made, webhook, skip_verify)
    finally:
        scratch.release()


def _build(spark: SparkSession, bronze_root: str, change: Change, todo: list[str], started: str, scratch: Scratch) -> dict[str, dict]:
    """Write and commit the days; their manifests."""
    listed = snapshot(bronze.listing(spark, bronze_root, todo), scratch)
    # Objects without lines stay, with a null line: what was read is what this one scan saw.
    read = scratch.save(validate.parsed(bronze.read_lines(spark, bronze_root, listed, scratch, todo), *bronze.SEEN), "parsed")
    again = scratch.save(bronze.listing(spark, bronze_root, todo), "again")
    parsed = read.where(F.col("raw").isNotNull())
    change.replace("silver", validate.silver(parsed), todo)
    change.replace("quarantine", validate.quarantine(parsed), todo)
    change.replace("partials", gold_ops.partial(validate.silver(parsed)), todo)
    change.replace("gold", gold_ops.merged(change.read("partials", todo), scratch), todo)
    change.replace("objects", listed, todo)
    change.replace("discrepancies", quality.listing_problems(listed, read, again), todo)
    # From here on everything is one row for each day.
    by_day = lambda df, *of: {r["dt"]: r for r in df.groupBy("dt").agg(*of).collect()}
    n = F.count(F.lit(1)).alias("n")
    objects = by_day(listed, n, F.array_sort(F.collect_set("service")).alias("services"))
    seen = read.select("dt", "source_key").unionByName(listed.where("length = 0").select("dt", "source_key")).distinct()
    got, rows = by_day(seen, n), by_day(parsed, n, F.count_if(F.col("reason").isNull()).alias("valid"))
    built = by_day(change.read("gold", todo), n, F.sum("requests").alias("r"))
    lost = by_day(quality.missing_objects(listed, read), n)
    found = change.read("discrepancies", todo)
    odd = by_day(found, *(F.count_if(F.col("problem") == k).alias(k) for k in PROBLEMS))
    # A few keys of each day; all of them are in the table.
    few = F.row_number().over(Window.partitionBy("dt").orderBy("problem", "source_key"))
    keys: dict[str, list[str]] = {}
    for r in found.withColumn("nth", few).where(F.col("nth") <= KEYS_TOLD).orderBy("dt", "nth").collect():
        keys.setdefault(r["dt"], []).append(f"{r['problem']}: {r['source_key']}")
    of = lambda table, d, c="n": table[d][c] if d in table else 0
    made = {}
    for d in todo:
        counters = {
            "dt": d, "bronzeObjectCount": of(objects, d), "bronzeObjectsRead": of(got, d), "bronzeObjectsMissing": of(lost, d), "bronzeLinesParsed": of(rows, d),
            "silverRows": of(rows, d, "valid"), "quarantinedRows": of(rows, d) - of(rows, d, "valid"), "goldRows": of(built, d), "goldRequestsSum": of(built, d, "r"),
        }
        told = {**{k: odd[d][k] for k in PROBLEMS}, "keys": keys[d]} if d in odd else None
        made[d] = build_manifest(counters, started, list(objects[d]["services"]) if d in objects else [], objects=told)
        change.manifest(made[d])
    change.commit()
    return made


def _finished(lake: Lake, todo: list[str], made: dict[str, dict], webhook: str | None, skip: str | None) -> dict[str, dict]:
    """What follows a commit: verification, alerts, and an error for days whose counters disagree."""
    broken = [d for d in todo if made[d]["status"] == "mismatch"]
    if whole := [made[d] for d in todo if d not in broken]:
        made = made | verify_days(lake, whole, skip=skip)
    for d in todo:
        if d not in broken and (found := manifest_problems(made[d])):
            notify(format_alert(d, "workflow", found), webhook)
    if broken:
        told = [k for d in broken for k in made[d].get("objectProblems", {}).get("keys", [])][:KEYS_TOLD]
        raise MismatchError(f"the counters of {', '.join(broken)} disagree; see their manifests{'; ' if told else ''}{'; '.join(told)}")
    return made


def snapshot(listing: DataFrame, scratch: Scratch) -> DataFrame:
    """The listing, written once; raises if what is read back isn't as long as what was written."""
    seen = Observation("listing")
    stored = scratch.save(listing.observe(seen, F.count(F.lit(1)).alias("n")), "listing")
    written, back = seen.get["n"], stored.count()
    if written != back:
        raise RuntimeError(f"{written} objects were listed, but {back} are in the snapshot")
    return stored


def backfill(spark: SparkSession, bronze_root: str, lake: Lake, start: str, end: str, **options) -> dict[str, dict]:
    return run_days(spark, bronze_root, lake, day_range(start, end), **options)


def health_check(lake: Lake, now: datetime | None = None, webhook: str | None = None) -> list[str]:
    """What is wrong with yesterday; says so if anything is. Never raises."""
    try:
        dt = yesterday(now)
        found = manifest_problems(lake.manifest(dt))
        if found:
            notify(format_alert(dt, "health-check", found), webhook)
        return found
    except Exception as error:
        notify(f"health check failed: {error}", None)
        return [f"health check failed: {error}"]


def dedupe_day(lake: Lake, table: str, dt: str) -> tuple[tuple[int, int], tuple[int, int]]:
    """Remove repeated rows of a day: (rows, distinct) before and after. Raises if the result isn't what it should be.

    Ids whose rows differ are recorded in the table of conflicts, and the day stays as it is.
    """
    base = lake.snapshot()
    stored = lambda: tuple(quality.row_counts(lake.read(table), check_dt(dt)).first())
    rows = lake.read_of(base, table, [check_dt(dt)])
    before = tuple(quality.row_counts(rows, dt).first())
    if before[0] == before[1]:
        return before, before
    change = lake.change("dedupe", base)
    change.replace("conflicts", quality.conflicting(rows), [dt])
    if differing := change.read("conflicts", [dt]).count():
        only = lake.change("conflicts", base)
        only.entry(dt)["tables"]["conflicts"] = change.entry(dt)["tables"]["conflicts"]
        only.commit()
        raise ContentConflictError(f"{differing} ids of {dt} stand for rows of different content; see the table of conflicts")
    change.replace(table, quality.dedupe(rows), [dt])
    change.commit()
    after = stored()
    if after[0] != before[1]:
        raise RuntimeError(f"expected {before[1]} rows of {dt}, got {after[0]}; rebuild this day")
    return before, after


# The two calls of the service, without a server: (status code, body). Parameters, codes and messages are fixed values.


def is_authorised(header: str | None, token: str | None) -> bool:
    """A bearer token, compared in constant time; without an expected token nobody is."""
    found = re.fullmatch(r"Bearer\s+(.+)", (header or "").strip(), re.IGNORECASE)
    if not token or not found:
        return False
    return hmac.compare_digest(hashlib.sha256(found[1].encode()).digest(), hashlib.sha256(token.encode()).digest())


def handle_run(start: Callable[[str, str, bool], None], query: dict[str, str], header: str | None, token: str | None) -> tuple[int, dict]:
    """start(run id, dt, force) raises if a run of that id exists."""
    if not is_authorised(header, token):
        return 401, {"ok": False, "error": "unauthorized"}
    dt, attempt, force = query.get("dt"), query.get("attempt"), query.get("force")
    if not is_valid_dt(dt):
        return 400, {"ok": False, "error": "query ?dt=YYYY-MM-DD required"}
    if not is_valid_attempt(attempt):
        return 400, {"ok": False, "error": "query ?attempt= must be a positive integer (1, 2, 3, ...)"}
    if not is_valid_force(force):
        return 400, {"ok": False, "error": "query ?force= must be 1 or true if present"}
    name = run_id(dt, attempt)
    try:
        start(name, dt, parse_force(force))
    except Exception as error:
        return 409, {"ok": False, "dt": dt, "error": "create_failed_or_already_exists", "detail": str(error)}
    return 202, {"ok": True, "dt": dt, "instanceId": name, "force": parse_force(force), "status": "created"}


def handle_status(lake: Lake, query: dict[str, str], header: str | None, token: str | None) -> tuple[int, dict]:
    if not is_authorised(header, token):
        return 401, {"ok": False, "error": "unauthorized"}
    dt = query.get("dt")
    if not is_valid_dt(dt):
        return 400, {"ok": False, "error": "query ?dt=YYYY-MM-DD required"}
    manifest = lake.manifest(dt)
    if manifest is None:
        return 404, {"ok": False, "dt": dt, "error": "no manifest for this dt yet"}
    return 200, {"ok": True, "dt": dt, "manifest": manifest}
