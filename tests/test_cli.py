import json
import re

import pandas as pd
from pyspark.sql import functions as F

from daybook.__main__ import main
from daybook.operators import quality
from daybook.sources.store import Lake


def test_commands(spark, tmp_path, capsys):
    obj = tmp_path / "in/api-metrics/2026-09-21/web/00/a.jsonl"
    obj.parent.mkdir(parents=True)
    obj.write_text(json.dumps({"timestamp": "2026-09-21T00:00:00Z", "endpoint": "/x", "method": "GET", "status": 200, "latency_ms": 5}))
    roots = ["--bronze", str(tmp_path / "in"), "--lake", str(tmp_path / "lake")]
    assert main([*roots, "backfill", "2026-09-21", "2026-09-22"]) == 0
    assert main([*roots, "run", "2026-09-21", "--force", "1"]) == 0
    assert main([*roots, "verify-all"]) == 0 and main([*roots, "scan-all"]) == 0 and main([*roots, "dedupe", "2026-09-21"]) == 0
    capsys.readouterr()
    assert main([*roots, "count", "2026-09-21", "--layer", "gold"]) == 0
    assert capsys.readouterr().out.strip() == "2026-09-21 gold 1 rows, 1 ids, 0 repeated"
    assert main([*roots, "verify-all"]) == 0
    assert capsys.readouterr().out.splitlines() == ["silver: 1 days, 1 rows, 0 days unlike their manifests", "gold: 1 days, 1 rows, 0 days unlike their manifests", "days without a manifest: 0"]
    assert main([*roots, "run", "2026-09-22", "--force", "1", "--skip-verify", "trial"]) == 0
    assert main([*roots, "status", "2026-09-22"]) == 0 and '"skipped": "trial"' in capsys.readouterr().out
    assert main([*roots, "status", "2026-09-21"]) == 0 and json.loads(capsys.readouterr().out)["status"] == "done"
    assert main([*roots, "health-check"]) == 1


def test_commands_on_versions(spark, tmp_path, capsys):
    obj = tmp_path / "in/api-metrics/2026-09-21/web/00/a.jsonl"
    obj.parent.mkdir(parents=True)
    obj.write_text(json.dumps({"timestamp": "2026-09-21T00:00:00Z", "endpoint": "/x", "method": "GET", "status": 200, "latency_ms": 5}))
    roots = ["--bronze", str(tmp_path / "in"), "--lake", str(tmp_path / "lake"), "--exports", str(tmp_path / "out")]
    assert main([*roots, "run", "2026-09-21"]) == 0
    (obj.parent / "b.jsonl").write_text("{bad")
    capsys.readouterr()
    assert main([*roots, "update", "2026-09-20", "2026-09-22"]) == 0 and main([*roots, "export", "2026-09-21"]) == 0
    assert capsys.readouterr().out.splitlines() == ["2026-09-21 done", "quarantine/api-metrics/dt=2026-09-21/web-0.jsonl"]
    exported = tmp_path / "out/quarantine/api-metrics/dt=2026-09-21/web-0.jsonl"
    mended = json.loads(exported.read_text()) | {"raw": obj.read_text()}
    (exported.parent / ".web-0.jsonl.crc").unlink(missing_ok=True)
    exported.write_text(json.dumps(mended))
    assert main([*roots, "readmit", "2026-09-21"]) == 0 and Lake(spark, str(tmp_path / "lake")).manifest("2026-09-21")["silverRows"] == 2
    assert main([*roots, "compact", "2026-09-21"]) == 0
    capsys.readouterr()
    assert main([*roots, "history"]) == 0
    assert [x.split()[2] for x in capsys.readouterr().out.splitlines()] == ["run:", "verify:", "update:", "verify:", "readmit:", "verify:", "compact:"]
    assert main([*roots, "expire"]) == 0 and "0 versions and 0 folders" in capsys.readouterr().out


def test_lists_of_days_are_whole(spark, tmp_path, capsys, monkeypatch):
    n = 1100
    days = [f"{d:%Y-%m-%d}" for d in pd.date_range("2020-01-01", periods=n)]
    counts = spark.createDataFrame([(d, 3, 2, 1) for d in days], "dt string, rows long, distinct_ids long, dup long")
    monkeypatch.setattr(quality, "per_day", lambda rows: counts)
    monkeypatch.setattr(Lake, "read", lambda self, table: None)
    lake = ["--lake", str(tmp_path / "lake")]

    def listed(*command):
        capsys.readouterr()
        code = main([*lake, *command])
        return code, [d for line in capsys.readouterr().out.splitlines() for d in re.findall(r"\d{4}-\d\d-\d\d", line)]

    assert listed("scan-all") == (0, days)
    assert listed("verify-all") == (1, days)
    manifests = counts.select("dt", F.lit(2).cast("long").alias("silverRows"), F.lit(3).cast("long").alias("goldRows"))
    monkeypatch.setattr(Lake, "manifests", lambda self: manifests)
    assert listed("verify-all") == (1, [*days, *days])
    assert main([*lake, "verify-all"]) == 1
    totals = capsys.readouterr().out.splitlines()[-3:]
    assert totals == [*(f"{t}: {n} days, {3 * n} rows, {n} days unlike their manifests" for t in ("silver", "gold")), "days without a manifest: 0"]
    same = counts.select("dt", F.lit(2).cast("long").alias("rows"), F.lit(2).cast("long").alias("distinct_ids"), F.lit(0).cast("long").alias("dup"))
    monkeypatch.setattr(quality, "per_day", lambda rows: same)
    monkeypatch.setattr(Lake, "manifests", lambda self: manifests.withColumn("goldRows", F.col("silverRows")))
    assert listed("verify-all") == (0, [])
