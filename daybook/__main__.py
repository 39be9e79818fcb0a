"""python -m daybook --bronze ROOT --lake ROOT run [DT] | backfill START END | update START END | status DT | count DT | scan-all |
dedupe DT | verify-all | health-check | history | compact DT... | expire | export DT | readmit DT (these two with --exports ROOT)

A schedule of two commands runs the lake: `run` for yesterday (UTC) after midnight, `health-check` an hour later.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from daybook.functions.days import day_range, is_valid_attempt, is_valid_force, parse_force, yesterday
from daybook.operators import quality
from daybook.plans import export, merge, run
from daybook.session import local_session
from daybook.sources.store import Lake


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--bronze", default="")
    p.add_argument("--lake", required=True)
    p.add_argument("--exports", default="", help="where refused lines are exported to, and mended ones are read from")
    p.add_argument("--layer", choices=("silver", "gold"), default="silver")
    p.add_argument("--attempt")
    p.add_argument("--force")
    p.add_argument("--skip-verify", metavar="WHY", help="don't count what was stored, and record why")
    p.add_argument("command", choices=("run", "backfill", "update", "status", "count", "scan-all", "dedupe", "verify-all", "health-check", "history", "compact", "expire", "export", "readmit"))
    p.add_argument("days", nargs="*")
    a = p.parse_args(argv)
    if not is_valid_attempt(a.attempt) or not is_valid_force(a.force):
        p.error("attempt is a positive integer, force is 1 or true")
    if a.command in ("run", "status", "count", "dedupe", "compact", "export", "readmit") and not a.days:
        a.days = [yesterday()]
    if a.command in ("backfill", "update") and len(a.days) != 2:
        p.error(f"{a.command} takes the first and the last day")
    if a.command in ("export", "readmit") and not a.exports:
        p.error(f"{a.command} needs --exports")
    spark = local_session()
    lake = Lake(spark, a.lake)
    if a.command in ("run", "backfill"):
        first, last = a.days[0], a.days[-1]
        made = run.backfill(spark, a.bronze, lake, first, last, force=parse_force(a.force), attempt=a.attempt, webhook=os.environ.get("DAYBOOK_WEBHOOK"), skip_verify=a.skip_verify)
        for dt, m in sorted(made.items()):
            print(dt, m["status"])
        return 0
    if a.command in ("update", "readmit"):
        if a.command == "update":
            made = merge.update_days(spark, a.bronze, lake, day_range(*a.days), webhook=os.environ.get("DAYBOOK_WEBHOOK"))
        else:
            made = export.readmit(lake, a.exports, a.days[0])
        for dt, m in sorted(made.items()):
            print(dt, m["status"])
        return 0
    if a.command == "export":
        print("\n".join(export.export(lake, a.exports, a.days[0])))
        return 0
    if a.command == "history":
        for n in lake.log.versions():
            v = lake.snapshot(n)
            print(f"{v.number} {v.at} {v.operation}: {sum(e['version'] == n for e in v.days.values())} of {len(v.days)} days")
        return 0
    if a.command == "compact":
        print(f"version {lake.compact(a.layer, a.days).number}")
        return 0
    if a.command == "expire":
        gone = lake.expire()
        print(f"{len(gone['versions'])} versions and {gone['folders']} folders are gone")
        return 0
    if a.command == "status":
        print(json.dumps(lake.manifest(a.days[0]), indent=2))
        return 0
    if a.command == "health-check":
        return int(bool(run.health_check(lake, webhook=os.environ.get("DAYBOOK_WEBHOOK"))))
    if a.command == "count":
        print(f"{a.days[0]} {a.layer} {_said(*run.stored_counts(lake, a.layer, a.days[0]))}")
        return 0
    if a.command == "dedupe":
        was, now = run.dedupe_day(lake, a.layer, a.days[0])
        print(f"{a.days[0]} {a.layer} {_said(*was)}; stored now: {_said(*now)}")
        return 0
    if a.command == "scan-all":
        counts = quality.per_day(lake.read(a.layer))
        days, rows, bad = quality.scan_summary(counts).first()
        for r in quality.duplicate_days(counts).orderBy("dt").toLocalIterator():
            print(f"{r['dt']} {_said(r['rows'], r['distinct_ids'])}")
        print(f"{a.layer}: {days} days, {rows} rows, {bad} days with repeated ids")
        return 0
    return _verify_all(lake)


def _said(rows: int, distinct: int) -> str:
    return f"{rows} rows, {distinct} ids, {rows - distinct} repeated"


def _verify_all(lake: Lake) -> int:
    """Report every day whose counts aren't its manifest's and every day without one, then totals; 1 if there is any."""
    counts = {t: quality.per_day(lake.read(t)) for t in ("silver", "gold")}
    wanted = lake.manifests().select("dt", "silverRows", "goldRows")
    wrong, without = dict.fromkeys(counts, 0), 0
    for r in quality.against_manifests(counts["silver"], counts["gold"], wanted).orderBy("layer", "dt").toLocalIterator():
        print(f"{r['dt']} {r['layer']} {_said(r['rows'], r['distinct_ids'])}, but its manifest says {r['want']}")
        wrong[r["layer"]] += 1
    for r in quality.without_manifest(counts["silver"], counts["gold"], wanted).orderBy("dt").toLocalIterator():
        print(f"{r['dt']} has rows but no manifest")
        without += 1
    for layer in counts:
        days, rows, _ = quality.scan_summary(counts[layer]).first()
        print(f"{layer}: {days} days, {rows} rows, {wrong[layer]} days unlike their manifests")
    print(f"days without a manifest: {without}")
    return int(bool(without or any(wrong.values())))


if __name__ == "__main__":
    sys.exit(main())
