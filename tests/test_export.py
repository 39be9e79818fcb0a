"""Exported refused lines: export, mend, and back."""

import json
import pathlib

from test_lake import agrees, put
from test_run import DT, line, roots  # noqa: F401

from daybook.functions.days import quarantine_key
from daybook.plans import export, run
from daybook.sources.store import Lake


def test_export_mend_and_back(spark, roots, tmp_path):  # noqa: F811
    lake, root = Lake(spark, roots[1]), str(tmp_path / "for people")
    put(roots[0], f"{DT}/web/07/z.jsonl", "[1]", line(1), line(2, status="200"), "  é { ")
    put(roots[0], f"{DT}/api/07/y.jsonl", line(3, endpoint=""))
    m = run.run_days(spark, roots[0], lake, [DT])[DT]
    assert m["quarantinedRows"] == 5
    assert export.export(lake, root, DT) == [quarantine_key(DT, "api-0"), quarantine_key(DT, "web-0")]
    folder = pathlib.Path(root) / "quarantine/api-metrics" / f"dt={DT}"
    lines = [json.loads(x) for x in (folder / "web-0.jsonl").read_text().split("\n") if x]
    stored = {r["row_uid"]: (r["reason"], r["source_key"], r["raw"]) for r in lake.read("quarantine").collect()}
    assert {x["row_uid"]: (x["reason"], x["source_key"], x["raw"]) for x in lines} == {k: v for k, v in stored.items() if "/web/" in k}
    assert len(export.export(lake, root, DT, lines_each=1)) > 2
    # Objects of another export don't stay.
    assert len(export.export(lake, root, DT)) == 2 and sorted(x.name for x in folder.iterdir() if x.name[0] != ".") == ["api-0.jsonl", "web-0.jsonl"]
    assert export.readmit(lake, root, DT)[DT]["quarantinedRows"] == 5
    mended = [x | {"raw": line(2)} if '"200"' in x["raw"] else x for x in lines]
    (folder / ".web-0.jsonl.crc").unlink(missing_ok=True)
    (folder / "web-0.jsonl").write_text("\n".join(map(json.dumps, mended)))
    after = export.readmit(lake, root, DT)[DT]
    assert (after["silverRows"], after["quarantinedRows"], after["bronzeLinesParsed"]) == (m["silverRows"] + 1, 4, m["bronzeLinesParsed"])
    agrees(lake, [DT])
    assert f"api-metrics/{DT}/web/07/z.jsonl#2" in {r[0] for r in lake.read("silver").select("row_uid").collect()}
    now = sorted(map(repr, lake.read("silver").collect()))
    export.readmit(lake, root, DT)
    assert sorted(map(repr, lake.read("silver").collect())) == now


def test_nothing_to_export(spark, roots, tmp_path):  # noqa: F811
    lake = Lake(spark, roots[1])
    run.run_days(spark, roots[0], lake, ["2026-09-22"])
    assert export.export(lake, str(tmp_path / "x"), "2026-09-22") == [] and export.exported(lake, str(tmp_path / "x"), "2026-09-22").count() == 0
