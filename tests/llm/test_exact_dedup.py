import hashlib
import re

from daybook.llm.exact_dedup import exact_dedup, heavy_candidates
from daybook.scratch import Scratch


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest(), []).append((-len(text or ""), doc is None, doc))
    best = {d: min(g, key=lambda x: (x[0], x[1], x[2] or 0)) for d, g in groups.items()}
    return {d: (b[2], len(groups[d])) for d, b in best.items()}


ROWS = [(i, t) for i, t in enumerate(["a b", "ab", " a\tb\r\n", "ab", None, "", "  ", "A b", "a b", "x" * 200_000, "é\x0b", "é", " é"])]


def test_against_brute_force_with_and_without_heavy_digests(make):
    rows = ROWS + [(1000 + i, "hot text" + " " * (i % 7)) for i in range(300)]
    want = brute(rows)
    for heavy, tracked in ((256, 2048), (1, 64)):
        got = exact_dedup(make(rows), heavy=heavy, tracked=tracked).collect()
        assert len(got) == len(rows)
        assert all((r["keep_id"], r["group_size"]) == want[r["text_sha256"]] and r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got)


def test_heavy_digests_are_found(spark, make):
    rows = spark.range(5000).selectExpr("id doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END text_sha256").repartition(7)
    assert "hot" in {r[0] for r in heavy_candidates(rows, 8, 64).collect()}


def test_repeated_rows_and_null_ids(make):
    got = exact_dedup(make([(5, "a"), (5, "a"), (None, "a"), (None, "b"), (None, "b")])).collect()
    assert [r["keep_id"] for r in got if r["group_size"] == 3] == [5, 5, 5] and sum(r["kept"] for r in got) == 2


def test_empty_and_clashing_columns(spark, make):
    assert exact_dedup(make([])).count() == 0
    rows = spark.createDataFrame([(1, "a", 1, "x", 2), (2, "a", 3, "y", 4)], "doc_id long, text string, row int, group_size string, text_sha256 int")
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in exact_dedup(rows).collect()} == {(1, 1, True), (2, 1, False)}


def test_native(make, monkeypatch):
    plans, save = [], Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or save(self, df, name))
    exact_dedup(make(ROWS))
    assert len(plans) == 3 and not any(x in p for p in plans for x in ("Python", "Arrow", "Pandas"))
