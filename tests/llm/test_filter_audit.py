"""Filters in every order: inclusion and exclusion against removing documents one filter at a time."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from daybook.llm import filter_audit as fa
from daybook.llm.common import table


def brute(rows, labels):
    """(part, order, step) to the eight counts; rows of (doc_id, text, source)."""
    smallest = {}
    for doc, text, _ in rows:
        if doc is not None:
            smallest[text or ""] = min(smallest.get(text or "", doc), doc)
    good, toxic = ({d for d, *v in labels if d is not None and v[k] == 1} for k in (0, 1))
    found = {}
    for doc, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": re.search("[#$%&*|]", t) is not None, "E": doc is not None and doc > smallest[t],
        }
        found.setdefault(part or "", []).append(("".join(k for k, v in failed.items() if v), doc in good, doc in toxic))
    out, shares = {}, Counter()
    for part, docs in found.items():
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if f in d[0]], [d for d in left if f not in d[0]]
                shares[part, f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == f for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def as_found(df):
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in df.collect()}


def test_against_brute_force(make, spark):
    rng = random.Random(4)
    words = ["alpha", "BETA", "g#", "delta", "Éa", "zeta\t", "\x0b", "CAPS"]
    texts = [None, "", " ", "#", "A", "漢" * 60 + "AB"] + [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 199, 200, 260]))) for _ in range(30)]
    texts += [" ".join(f"w{i % m}" for i in range(220)) for m in (109, 110, 111, 220)]
    rows = [(i if i % 17 else None, rng.choice(texts), rng.choice(["web", "", None, "books", "web", "web"])) for i in range(400)]
    rows += [(5, texts[-1], "web")] * 3 + [(700, "x", "books")] * 2
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 400, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = make([(*r, "k", 1) for r in rows], "doc_id long, text string, source string, digest string, n int")
    assert as_found(fa.audit(docs, make(labels, "doc_id long, quality int, toxic int"))) == brute(rows, labels)


def test_no_documents_and_no_labels(make):
    schema, of_labels = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"
    assert fa.audit(make([], schema), make([], of_labels)).count() == 0
    assert as_found(fa.audit(make([(1, "a #", None)], schema), make([], of_labels))) == brute([(1, "a #", None)], [])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_over_the_whole_table(spark, sf):
    import duckdb

    from daybook.llm.queries import ORACLE_SQL, QUERIES

    folder = f"/root/testdata/{sf}"
    rows = [(r["doc_id"], r["text"], r["source"]) for r in table(spark, folder, "documents").collect()]
    labels = [tuple(r) for r in table(spark, folder, "labels").select("doc_id", "quality", "toxic").collect()]
    found = QUERIES["op13_filter_interactions"](spark, folder)
    mine = as_found(found)
    assert mine == brute(rows, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    sql = con.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLE_SQL['op13_filter_interactions']})").fetchall()
    assert {r[:3]: r[3:] for r in sql} == mine and len(sql) == len(mine)


def test_copies_are_spread_and_nothing_is_python(spark, make):
    docs = make([(i, "same", "web") for i in range(50)], "doc_id long, text string, source string")
    labels = make([], "doc_id long, quality int, toxic int")
    from daybook.scratch import Scratch

    plan = fa.joint_failures(docs, labels, Scratch(spark, "audit-test"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop", "SinglePartition"))
