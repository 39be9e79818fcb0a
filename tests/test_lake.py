"""The commit log: nothing is seen by half, nothing is lost; late, lost and replaced objects; streams; expiry."""

import json
import os
import pathlib
import random
import threading
from datetime import UTC, datetime, timedelta

import pytest
from test_run import DT, line, roots  # noqa: F401

from daybook.operators import gold, quality
from daybook.plans import merge, run
from daybook.scratch import Scratch
from daybook.sources import bronze
from daybook.sources.log import CommitLog, ConflictError, Snapshot
from daybook.sources.store import SCHEMAS, Change, Lake

NEXT = "2026-09-22"
TABLES = ("silver", "gold", "quarantine")


def put(root, key, *lines_, at=None):
    path = pathlib.Path(root) / "api-metrics" / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines_))
    if at:
        os.utime(path, (at, at))


def held(lake, version=None):
    return {t: sorted(map(repr, lake.read(t, version).collect())) for t in TABLES}


def agrees(lake, days):
    """Rows, daily aggregates and manifests say the same."""
    for d in days:
        m, silver = lake.manifest(d), lake.read("silver").where(f"dt = '{d}'")
        assert m["silverRows"] == silver.count() == silver.select("row_uid").distinct().count() == m["goldRequestsSum"]
        assert m["quarantinedRows"] == lake.read("quarantine").where(f"dt = '{d}'").count() and m["status"] == "done"
        rounded = lambda df: sorted(repr(r.asDict() | {"latency_avg": round(r["latency_avg"] or 0, 9)}) for r in df.select(*SCHEMAS["gold"].fieldNames()).collect())
        assert rounded(lake.read("gold").where(f"dt = '{d}'")) == rounded(gold.daily(silver))


class Killed(BaseException):
    pass


@pytest.mark.parametrize("after", ["silver", "partials", "discrepancies", "commit"])
def test_a_killed_run_leaves_the_old_day_whole(spark, roots, monkeypatch, after):  # noqa: F811
    lake = Lake(spark, roots[1])
    run.run_days(spark, roots[0], lake, [DT])
    old, manifest, version = held(lake), lake.manifest(DT), lake.snapshot().number
    put(roots[0], f"{DT}/web/05/more.jsonl", line(7), line(8))
    write, commit = Lake.write, CommitLog.commit

    def dying(self, table, *args, **more):
        out = write(self, table, *args, **more)
        if table == after:
            raise Killed
        return out

    def no_commit(self, *args, **more):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Lake, "write", dying) if after != "commit" else m.setattr(CommitLog, "commit", no_commit)
        with pytest.raises(Killed):
            run.run_days(spark, roots[0], lake, [DT], force=True)
    assert CommitLog.commit is commit and held(lake) == old and lake.manifest(DT) == manifest and lake.snapshot().number == version
    # The next run isn't forced, and isn't skipped.
    assert run.run_days(spark, roots[0], lake, [DT])[DT]["silverRows"] == manifest["silverRows"] + 2
    agrees(lake, [DT])
    now = lake.snapshot().number
    run.run_days(spark, roots[0], lake, [DT])
    assert lake.snapshot().number == now


def test_of_two_writers_of_a_day_one_wins(spark, roots):  # noqa: F811
    lake = Lake(spark, roots[1])
    run.run_days(spark, roots[0], lake, [DT])
    rows = lake.read("silver")
    changes = [lake.change("a"), lake.change("b"), lake.change("c")]
    for c in changes[:2]:
        c.replace("silver", rows.limit(1), [DT])
    changes[2].replace("silver", rows.selectExpr("*").withColumn("dt", __import__("pyspark").sql.functions.lit(NEXT)), [NEXT])
    changes[0].commit()
    with pytest.raises(ConflictError, match=DT):
        changes[1].commit()
    # Another day's writer began before, and needn't give up.
    made = changes[2].commit()
    assert set(made.days) == {DT, NEXT} and lake.read("silver").where(f"dt = '{DT}'").count() == 1


def test_one_number_is_given_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    wins, start = [], threading.Barrier(6)

    def writer(k):
        start.wait()
        wins.append(log.commit(Snapshot(), "test", {f"2026-01-0{k + 1}": {"tables": {}, "manifest": None}}).number)

    threads = [threading.Thread(target=writer, args=(k,)) for k in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(wins) == log.versions() == [1, 2, 3, 4, 5, 6] and len(log.read().days) == 6
    assert not list((tmp_path / "_log").glob("*.tmp"))


def test_time_travel_and_expiry(spark, roots):  # noqa: F811
    lake = Lake(spark, roots[1])
    run.run_days(spark, roots[0], lake, [DT, NEXT])
    first, rows = lake.snapshot(), held(lake)
    put(roots[0], f"{DT}/web/06/x.jsonl", line(9))
    run.run_days(spark, roots[0], lake, [DT], force=True)
    second = held(lake)
    compacted = lake.compact("silver", [DT, NEXT])
    assert held(lake) == second and held(lake, first.number) == rows and rows != second
    assert lake.read("silver", as_of=first.at).count() == 5 and lake.manifest(DT)["silverRows"] == 5
    with pytest.raises(LookupError):
        lake.snapshot(as_of="2020-01-01")
    used = lake.references()
    assert used["gold", first.days[DT]["tables"]["gold"][0], DT] == 2 and max(used.values()) == len(lake.log.versions())
    # Too young, or among the last ones: nothing goes.
    assert lake.expire()["versions"] == [] and lake.expire(keep=1)["versions"] == [] and lake.expire(days=0)["versions"] == []
    pathlib.Path(lake.path("silver"), "write=dead", f"dt={DT}").mkdir(parents=True)
    later = datetime.now(UTC) + timedelta(days=8)
    gone = lake.expire(keep=2, now=later, orphan_hours=24 * 30)
    assert gone["versions"] and gone["folders"] > 0 and len(lake.log.versions()) == 2
    assert held(lake) == second and held(lake, compacted.number) == second and pathlib.Path(lake.path("silver"), "write=dead").exists()
    with pytest.raises(LookupError):
        lake.read("silver", first.number)
    there = {(t, p.parent.name.removeprefix("write="), p.name.removeprefix("dt=")) for t in SCHEMAS for p in pathlib.Path(lake.path(t)).glob("write=*/dt=*")}
    assert there - {("silver", "dead", DT)} == set(lake.references())
    lake.expire(now=later)
    assert not pathlib.Path(lake.path("silver"), "write=dead").exists() and held(lake) == second


@pytest.mark.parametrize("kind", ["late", "lost", "changed", "empty grew"])
def test_objects_that_are_not_the_same_are_told(spark, roots, monkeypatch, kind):  # noqa: F811
    lake, lines_ = Lake(spark, roots[1]), bronze.read_lines
    key = {"late": "web/09/late.jsonl", "lost": "api/00/c.jsonl", "changed": "web/00/a.jsonl", "empty grew": "api/00/empty.jsonl"}[kind]

    def meanwhile(*args):
        if kind == "lost":
            (pathlib.Path(roots[0]) / "api-metrics" / DT / key).unlink()
        else:
            put(roots[0], f"{DT}/{key}", line(1), line(2), at=1_900_000_000)
        return lines_(*args)

    monkeypatch.setattr(bronze, "read_lines", meanwhile)
    problem = {"empty grew": "changed"}.get(kind, kind)
    told = f"{problem}: api-metrics/{DT}/{key}"
    with pytest.raises(run.MismatchError, match=told):
        run.run_days(spark, roots[0], lake, [DT])
    m = lake.manifest(DT)
    assert m["status"] == "mismatch" and not m["assertions"]["objectsListedEqualsRead"] and m["objectProblems"]["keys"] == [told] and m["objectProblems"][problem] == 1
    assert [tuple(r) for r in lake.read("discrepancies").collect()] == [(DT, f"api-metrics/{DT}/{key}", problem)]
    assert lake.manifests().first()["objectProblems"][problem] == 1
    monkeypatch.undo()
    assert run.run_days(spark, roots[0], lake, [DT])[DT]["status"] == "done" and lake.read("discrepancies").count() == 0


@pytest.mark.parametrize("kind", ["lost", "late", "late and gone"])
def test_an_update_mends_what_a_run_saw_wrong(spark, roots, monkeypatch, kind):  # noqa: F811
    """The object is there again as it was, and only another one is new: the update reads both, or takes back what is gone."""
    lake, lines_ = Lake(spark, roots[1]), bronze.read_lines
    key, late = pathlib.Path(roots[0]) / "api-metrics" / DT / "api/00/c.jsonl", f"{DT}/web/09/late.jsonl"
    body, clock = key.read_text(), 1_700_000_000
    os.utime(key, (clock, clock))

    def meanwhile(*args):
        if kind == "lost":
            key.unlink()
        else:
            put(roots[0], late, line(7), line(8), at=clock)
        return lines_(*args)

    monkeypatch.setattr(bronze, "read_lines", meanwhile)
    with pytest.raises(run.MismatchError):
        run.run_days(spark, roots[0], lake, [DT])
    monkeypatch.undo()
    if kind == "lost":
        put(roots[0], f"{DT}/api/00/c.jsonl", body, at=clock)
    if kind == "late and gone":
        (pathlib.Path(roots[0]) / "api-metrics" / late).unlink()
    put(roots[0], f"{DT}/web/00/new.jsonl", line(9), at=clock)
    merge.update_days(spark, roots[0], lake, [DT])
    agrees(lake, [DT])
    other = Lake(spark, f"{roots[1]} anew")
    run.run_days(spark, roots[0], other, [DT])
    assert held(lake)["silver"] == held(other)["silver"] and lake.read("discrepancies").count() == 0
    assert [lake.manifest(DT)[c] for c in ("bronzeObjectCount", "bronzeObjectsRead", "silverRows")] == [other.manifest(DT)[c] for c in ("bronzeObjectCount", "bronzeObjectsRead", "silverRows")]
    assert merge.update_days(spark, roots[0], lake, [DT]) == {}


def test_random_arrivals_touch_their_own_partials(spark, tmp_path):
    rng, root, lake = random.Random(6), str(tmp_path / "in"), Lake(spark, str(tmp_path / "lake"))
    made = lambda: [line(rng.randrange(60), latency_ms=rng.choice([0, 1.5, 7, 80]), status=rng.choice([200, 404, 500]), cf_colo=rng.choice(["NRT", None])) for _ in range(rng.randint(0, 5))]
    clock = 1_700_000_000
    names = [f"{d}/{s}/00/{i}.jsonl" for d in (DT, NEXT) for s in ("web", "api") for i in range(3)]
    for name in names[::2]:
        put(root, name, *made(), at=clock)
    run.run_days(spark, root, lake, [DT, NEXT])
    for _ in range(2):
        clock += 100
        touched = rng.sample(names, 3)
        for name in touched[:2]:
            put(root, name, *made(), rng.choice(["{bad", line(1)]), at=clock)
        (pathlib.Path(root) / "api-metrics" / touched[2]).unlink(missing_ok=True)
        before = lake.snapshot()
        found = merge.update_days(spark, root, lake, [DT, NEXT])
        # A day's partial aggregates are added to, not made anew.
        for d in found:
            assert set(before.days[d]["tables"]["partials"]) <= set(lake.snapshot().days[d]["tables"]["partials"])
        agrees(lake, [DT, NEXT])
        other = Lake(spark, str(tmp_path / f"fresh{clock}"))
        run.run_days(spark, root, other, [DT, NEXT])
        same = lambda x: {t: sorted(map(repr, x.read(t).drop("latency_avg").collect())) for t in TABLES}
        assert same(lake) == same(other)
        counters = lambda x, d: [x.manifest(d)[c] for c in ("bronzeObjectCount", "bronzeObjectsRead", "bronzeLinesParsed", "silverRows", "goldRows")]
        assert all(counters(lake, d) == counters(other, d) for d in (DT, NEXT))
    assert merge.update_days(spark, root, lake, [DT, NEXT]) == {}


def test_stream_batches_are_merged_once(spark, roots, tmp_path):  # noqa: F811
    from daybook.streaming.ingest import ingest, ingested, publish

    lake, out, state = Lake(spark, roots[1]), str(tmp_path / "out"), str(tmp_path / "state")
    run.run_days(spark, roots[0], lake, [DT, NEXT])
    built = held(lake)
    put(roots[0], f"{NEXT}/web/09/new.jsonl", line(3), "{bad")
    for _ in range(2):
        ingest(spark, roots[0], out, state)
    assert ingested(spark, out, "silver").count() == 6 and ingested(spark, out, "quarantine").count() == 2
    made = publish(spark, out, lake)
    assert lake.manifest(NEXT)["silverRows"] == 2 and lake.manifest(DT)["silverRows"] == 4 and set(made) == {DT, NEXT}
    assert lake.manifest(NEXT)["bronzeObjectCount"] == 2 and lake.manifest(NEXT)["quarantinedRows"] == 1
    agrees(lake, [DT, NEXT])
    now = held(lake)
    assert set(built["silver"]) < set(now["silver"])
    version = lake.snapshot().number
    assert publish(spark, out, lake) == {} and lake.snapshot().number == version
    # The checkpoint is lost: all objects come again, under another stream's id.
    ingest(spark, roots[0], out, str(tmp_path / "other state"))
    publish(spark, out, lake)
    assert held(lake) == now and len(lake.snapshot().batches) == 2
    # Without a run before, the stream makes the days.
    alone = Lake(spark, str(tmp_path / "alone"))
    publish(spark, out, alone)
    agrees(alone, [DT, NEXT])
    assert held(alone)["silver"] == now["silver"]


def test_a_merge_begins_anew_when_a_day_was_changed(spark, roots, tmp_path, monkeypatch):  # noqa: F811
    from daybook.streaming.ingest import ingest, publish

    lake, out = Lake(spark, roots[1]), str(tmp_path / "out")
    ingest(spark, roots[0], out, str(tmp_path / "state"))
    commit, first = Change.commit, []

    def interrupted(self):
        if self.operation == "publish" and not first:
            first.append(run.run_days(spark, roots[0], lake, [DT]))
        return commit(self)

    monkeypatch.setattr(Change, "commit", interrupted)
    publish(spark, out, lake)
    assert first and lake.read("silver").count() == 5
    agrees(lake, [DT, NEXT])


def test_ids_of_different_content_are_not_removed(spark, roots):  # noqa: F811
    from pyspark.sql import functions as F

    lake = Lake(spark, roots[1])
    run.run_days(spark, roots[0], lake, [DT])
    one = lake.read("silver").orderBy("row_uid").limit(1)
    lake.append("silver", one.unionByName(one.withColumn("latency_ms", F.lit(77.0))), [DT])
    rows = held(lake)["silver"]
    with pytest.raises(run.ContentConflictError, match="1 ids"):
        run.dedupe_day(lake, "silver", DT)
    assert held(lake)["silver"] == rows and [(r["copies"], r["contents"]) for r in lake.read("conflicts").collect()] == [(3, 2)]
    assert quality.conflicting(one.unionByName(one)).count() == 0


@pytest.mark.parametrize("seed", range(2))
def test_large_objects_are_read_by_ranges(spark, tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    pieces = ["", " ", "\r", "x", "漢字" * 7, "﻿", "é" * 11, "🙂", " ", "a b"]
    bodies = ["".join(rng.choice(pieces) + rng.choice(["\n", "\r\n", "\n\n", ""]) for _ in range(rng.randint(0, 300))) for _ in range(5)]
    for i, body in enumerate(bodies):
        path = tmp_path / "api-metrics" / DT / "web" / f"{i} [x]*{{y}}.jsonl"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body.encode())
    monkeypatch.setattr(bronze, "SPLIT_FROM", 200)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(rng.choice([37, 64, 101])))
    scratch = Scratch(spark, "ranges")
    try:
        listed = bronze.listing(spark, str(tmp_path), [DT])
        found = bronze.read_lines(spark, str(tmp_path), listed, scratch, [DT]).where("line is not null")
        whole = bronze.numbered_lines(bronze.bodies(spark, str(tmp_path), [DT]))
        key = lambda df: sorted((r["source_key"], r["line_index"], r["line"]) for r in df.collect())
        assert key(found) == key(whole) and listed.where("length >= 200").count() > 0
        parts = bronze.split_lines(spark, str(tmp_path), [r[0] for r in listed.where("length >= 1000").select("source_key").collect()], scratch)
        assert parts.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        scratch.release()


def test_manifest_copies_are_for_others(spark, roots):  # noqa: F811
    lake = Lake(spark, roots[1])
    m = run.run_days(spark, roots[0], lake, [DT])[DT]
    copy = pathlib.Path(roots[1]) / "_state/days" / f"dt={DT}.json"
    assert json.loads(copy.read_text()) == m
    copy.unlink()
    assert lake.manifest(DT) == m
