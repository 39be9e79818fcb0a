"""Hard negatives by the block product: against plain scores of all pairs."""

import math
import random

import numpy as np
import pytest

from daybook.llm import summa_negatives as sn
from daybook.llm.common import table


def brute(rows, rule=None):
    """Sorted result rows of (vec_id, vector, label) rows."""
    rule, fit = rule or sn.Rule(), []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if i is not None and i % 7 == 0:
            label = (label + 1) % 10
        fit.append((i, [math.floor(256 * float(x)) for x in vector], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for k, (anchor, vector, label) in enumerate(fit):
        if anchor is None or anchor % rule.every:
            continue
        scored = [(sum(map(int.__mul__, vector, v)), i, other) for j, (i, v, other) in enumerate(fit) if j != k]
        scored.sort(key=lambda x: (-x[0], last(x[1])))
        for p, positive, _ in [x for x in scored if x[2] == label][: rule.positives]:
            fitting = [x for x in scored if x[2] != label and rule.least * p <= 100 * x[0] <= rule.most * p][: rule.negatives]
            out += [(anchor, positive, rank, i, p, n) for rank, (n, i, _) in enumerate(fitting, 1)]
    return sorted(out, key=repr)


def as_found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def vectors(spark, rows):
    real = lambda v: v and [x if x is None else float(x) for x in v]
    return spark.createDataFrame([(i, real(v), label, "x", 3) for i, v, label in rows], "vec_id long, embedding array<float>, label int, row string, block int").repartition(3)


@pytest.mark.parametrize("sizes", [(128, 1024, 32, 8), (2, 3, 2, 2), (1, 7, 64, 1)])
def test_against_all_pairs(spark, monkeypatch, sizes):
    for name, value in zip(("ANCHORS", "ROWS", "CHUNK", "TOGETHER"), sizes, strict=True):
        monkeypatch.setattr(sn, name, value)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0.1, 0.3, 5)], int(rng.choice([1, 1, 1, 2, 3, 9]))) for i in range(0, 300, 5)]
    rows += [(i, rows[3][1], random.Random(i).choice([1, 2])) for i in range(1000, 1040)]  # equal vectors
    rows += [(None, rows[4][1], 1), (None, rows[5][1], 2), (100, rows[6][1], 2), (105, None, 1), (110, rows[1][1], None), (115, [1.0, None, 0, 0, 0], 1)]
    rows += [(120, [float("nan")] * 5, 1), (125, [float("inf"), 0, 0, 0, 0], 2), (-200, rows[7][1], -9), (700, rows[8][1], 12)]
    found = as_found(sn.mine(vectors(spark, rows)))
    assert found == brute(rows) and len(found) > 50


def test_no_rows_no_anchors_no_positives(spark):
    one = [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 1)]
    for rows in ([], one, [(100, [1.0], 1), (2, [1.0], 2)], [(100, [], 1), (2, [], 1), (3, [], 2)], [(100, None, 1)]):
        assert as_found(sn.mine(vectors(spark, rows))) == brute(rows)


def test_negative_scores_and_window_ends(spark):
    rows = [(0, [1.0], 1), (1, [1.0], 2), (2, [-1.0], 2), (3, [-0.5], 3)] + [(10 + i, [i / 100], 5) for i in range(0, 101)]
    assert as_found(sn.mine(vectors(spark, rows))) == brute(rows)
    only = [(100, [-1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (3, [-0.5], 2)]
    assert as_found(sn.mine(vectors(spark, only))) == brute(only) == []


def test_large_components_are_exact_or_refused(spark):
    big = [(0, [1e6, 2.5e6], 1), (1, [1e6, 2.4e6], 1), (2, [4e5, 1e6], 3), (8, [2e5, 9e5], 3)]
    assert as_found(sn.mine(vectors(spark, big))) == brute(big)
    with pytest.raises(ValueError, match="too large"):
        sn.mine(vectors(spark, [(0, [1e30], 1), (1, [1e30], 1)]))


def test_numbers_keep_their_values():
    for top in (5, 40_000, 3 << 40):
        a = np.array([-top, 0, top], np.int64)
        assert (sn.wide(sn.narrow(a)) == a).all() and len(sn.narrow(a)) == 1 + 3 * {5: 2, 40_000: 4}.get(top, 8)
    assert not len(sn.wide(sn.narrow(np.zeros(0, np.int64))))


def test_a_label_with_most_rows_makes_no_larger_block(spark, monkeypatch):
    monkeypatch.setattr(sn, "ROWS", 10)
    rows = [(i, [float(i % 9)], 1 if i % 10 else 2) for i in range(205)]
    mining = sn.Mining(vectors(spark, rows), sn.Rule(), "vec_id", "embedding", "label")
    assert sorted(r["count"] for r in mining.rows.groupBy("block").count().collect()) == [5] + [10] * 20


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_the_query_over_the_whole_table(spark, sf):
    from daybook.llm.queries import QUERIES

    rows = [tuple(r) for r in table(spark, f"/root/testdata/{sf}", "embeddings").select("vec_id", "embedding", "label").collect()]
    assert as_found(QUERIES["op12_summa_negatives"](spark, f"/root/testdata/{sf}")) == brute(rows)


@pytest.mark.parametrize("sizes", [(2, 3, 2, 2, 4), (3, 4, 8, 64, 3), (128, 1024, 32, 64, 24)])
def test_several_panels_and_groups_lose_nothing(spark, monkeypatch, sizes):
    for name, value in zip(("ANCHORS", "ROWS", "CHUNK", "TOGETHER", "GROUPS"), sizes, strict=True):
        monkeypatch.setattr(sn, name, value)
    monkeypatch.setattr(sn, "PANEL", 2)
    rng = np.random.default_rng(5)
    # Scores that rise with the id, many of them equal: every later block has some that must still come in.
    rows = [(i, [float(np.float32(i // 4 / 50)), float(np.float32(rng.normal(0, 0.2))) if i % 3 else 0.25, 0.5], i % 5) for i in range(120)]
    rule = sn.Rule(every=4, positives=3, negatives=4)
    found = as_found(sn.mine(vectors(spark, rows), rule))
    assert found == brute(rows, rule) and len(found) > 200


def test_anchors_sent_to_all_rows_are_never_broadcast(spark, monkeypatch):
    """The driver collects what is broadcast: once, the pieces of anchors for all blocks of rows, 32 MiB here."""
    rng = np.random.default_rng(3)
    rows = [(100 * i, rng.normal(0.1, 0.3, 64).tolist(), i % 10) for i in range(1200)]
    plain = as_found(sn.mine(vectors(spark, rows)))
    monkeypatch.setattr(sn, "ROWS", 8)
    spark.conf.set("spark.sql.maxBroadcastTableSize", 12 << 20)
    try:
        assert as_found(sn.mine(vectors(spark, rows))) == plain and len(plain) > 10_000
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
