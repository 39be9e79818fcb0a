"""Near-duplicates and decontamination against brute force."""

import random

import numpy as np
import pytest
from brute import benchmark_brute, near_brute

from daybook.llm import decontaminate as dc
from daybook.llm import hamming_dedup as hd
from daybook.llm import listed
from daybook.llm.components import components
from daybook.scratch import Scratch

DATA = "/root/testdata/sf0.001"


def varied(seed, groups, members, edits, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                text[rng.randrange(words)] = rng.choice(vocabulary)
            rows.append((rng.randrange(10**6), " ".join(text)))
    return list({r[0]: r for r in rows}.values())


def same(rows, df):
    want = sorted(((rows[i][0], n, c if c is not None else None) for i, (n, c) in near_brute(rows).items()), key=repr)
    got = df.collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=repr) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_of_borderline_copies(make):
    rows = varied(1, 6, 40, 12)
    same(rows, hd.near_duplicates(make(rows)))


def test_with_many_comparisons(make, monkeypatch):
    monkeypatch.setattr(hd, "PER_ROW", 0)
    rows = varied(7, 5, 30, 12)
    same(rows, hd.near_duplicates(make(rows)))


def test_near_copies_without_ids(make):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text), (None, text + " more"), (None, "more " + text), (4, "another text of six words"), (4, text + " x y"), (4, text + " x y")]
    got = hd.near_duplicates(make(rows)).collect()
    assert sorted((repr(r["doc_id"]), r["component_id"]) for r in got) == [("4", 4)] * 3 + [("None", 4)] * 3


@pytest.mark.parametrize("ids", [None, 7])
def test_many_rows_without_ids_or_with_one(make, ids, monkeypatch):
    """A class's text is read once for each row that holds it, however many rows share the id."""
    seen = []
    plain = hd.NearDuplicates._from_texts

    def counted(self, *args):
        made = plain(self, *args)
        seen.append((made.count(), made.select("cid").distinct().count()))
        return made

    monkeypatch.setattr(hd.NearDuplicates, "_from_texts", counted)
    rng = random.Random(9)
    rows = []
    for g in range(100):
        base = [f"g{g}w{i}" for i in range(60)]
        for _ in range(20):
            base[rng.randrange(60)] = f"x{rng.random()}"
            rows.append((ids, " ".join(base)))
    got = hd.near_duplicates(make(rows)).collect()
    assert len(got) == 2000 and {(r["doc_id"], r["component_id"]) for r in got} == {(ids, ids)}
    assert seen and all(texts == classes for texts, classes in seen)


def test_without_broadcasts(make, monkeypatch):
    monkeypatch.setattr(hd, "BROADCAST_ROWS", 0)
    rows = varied(2, 3, 15, 8)
    same(rows, hd.near_duplicates(make(rows)))


def test_documents(spark):
    """Whole tables, the larger one by the query that DuckDB checks too: no link is missed."""
    for data in (DATA, "/root/testdata/sf0.01"):
        docs = spark.read.parquet(f"{data}/documents.parquet")
        same([tuple(r) for r in docs.select("doc_id", "text").collect()], hd.near_duplicates(docs))


def test_near_edge_cases(spark, make):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE\x0btwo"), (6, "one  two three"), (7, "a b c d e"), (8, "A B c d\re"), (9, "a b c d f"), (10, "É a b c d"), (11, "é a b c d"), (12, "w " * 30_000), (13, "W " * 20_000)]
    same(rows, hd.near_duplicates(make(rows)))
    assert hd.near_duplicates(make([])).count() == 0
    got = hd.near_duplicates(make([(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, "z")])).collect()
    found = sorted((repr(r["doc_id"]), repr(r["component_id"]), r["kept"]) for r in got)
    assert found == [("5", "5", True), ("5", "5", True), ("None", "5", False), ("None", "None", True)]
    clash = spark.createDataFrame([(1, "a b c d e", 1, "k"), (2, "a b c d e", 2, "k")], "doc_id long, text string, cid int, key string")
    assert {(r["doc_id"], r["component_id"]) for r in hd.near_duplicates(clash).collect()} == {(1, 1), (2, 1)}
    with pytest.raises(ValueError):
        hd.near_duplicates(make([]), percent=50)


def test_every_pair_within_the_radius_shares_a_key(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(200):
        a = rng.integers(0, 1 << 14, 4 * hd.CHUNKS)
        b = a.copy()
        for i in rng.choice(len(a), hd.RADIUS, replace=False):
            b[i] ^= rng.integers(1, 1 << 14)
        for x in (a, b):
            words = np.bitwise_or.reduce(x.reshape(hd.CHUNKS, 4).astype(np.uint64) << (hd._LANE * np.arange(4, dtype=np.uint64)), axis=1)
            rows.append((k, *words.view(np.int64).tolist()))
    keys = spark.createDataFrame(rows, "k long, " + ", ".join(f"{c} long" for c in hd._CHUNK)).select("k", hd._keys())
    assert keys.count() == 400 * 4 * hd.CHUNKS
    shared = keys.groupBy("k", "key").count().where("count > 1").select("k").distinct()
    assert shared.count() == 200


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components(edges.limit(0), Scratch(spark, "test")).count() == 0


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again and again today"), (2, "quick brown"), (3, ""), (4, None), (5, "É1-b"), (1, "the of"), (10, "the of")]
LONG = " ".join(f"filler{i % 977}" if i % 3000 else "the quick brown fox jumps over the lazy dog again and again today" for i in range(60_000))
DOCS = [LONG, "the quick brown fox jumps over the lazy dog again " * 40, None, "", "the QUICK,brown fox jumps over the lazy dog again", "x the quick brown fox jumps over the lazy dog again and again today the of", "brown quick", "é1_B é1", "of the of the of", "quick " * 1000 + "brown", "no hit here", "no hit here"]


@pytest.mark.parametrize("rows_bound", [dc.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("filter_bits", [listed.FILTER_BITS, 64])
def test_benchmark_against_brute_force(spark, make, monkeypatch, rows_bound, filter_bits):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", rows_bound)
    monkeypatch.setattr(listed, "FILTER_BITS", filter_bits)
    rows = list(enumerate(DOCS))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {r["doc_id"]: r for r in dc.decontaminate(make(rows), items).collect()}
    want = benchmark_brute(DOCS, ITEMS)
    assert len(got) == len(rows)
    for i, (n, hit, found) in enumerate(want):
        r = got[i]
        assert (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), list(r["items"])) == (n, hit, found), DOCS[i]


def test_benchmark_documents(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = dict(zip((r[0] for r in rows), benchmark_brute([r[1] for r in rows], [tuple(r) for r in items.select("item_id", "text").collect()]), strict=True))
    got = dc.digest_columns(dc.decontaminate(docs, items)).collect()
    assert sum(r["contaminated"] for r in got) > 0
    assert all((r["n_words"], r["n_hit"], r["n_items"]) == (want[r["doc_id"]][0], want[r["doc_id"]][1], len(want[r["doc_id"]][2])) for r in got)


def test_benchmark_edge_cases(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.decontaminate(make([]), items).count() == 0
    clash = spark.createDataFrame([(1, "the of", 1, 2, "w", "i", 3)], "doc_id long, text string, row int, first int, words string, items string, n_words int")
    assert [(r["n_words"], list(r["items"])) for r in dc.decontaminate(clash, items).collect()] == [(2, ["1", "10"])]
    got = dc.decontaminate(make([(1, "the of"), (1, "the of"), (None, "the of")]), items.limit(0)).collect()
    assert [len(r["spans"]) for r in got] == [0, 0, 0] and {r["n_words"] for r in got} == {2}
