import functools
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

from hypothesis import given
from hypothesis import strategies as st

from daybook.llm import balanced_sharding as b


def check(rows, got, shards):
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    assert all(0 <= x < shards for x in counts) and max(counts.values(), default=0) - min((counts[x] for x in range(shards)), default=0) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in got)


def test_groups_stay_together_under_the_law(spark, make):
    rows = [(i, f"single {i}") for i in range(300)] + [(1000 + i, f"group {i % 40}") for i in range(120)] + [(5000 + i, None) for i in range(4)]
    got = b.assign(make(rows), shards=8).collect()
    check(rows, got, 8)
    texts = dict(rows)
    whole = defaultdict(set)
    for r in got:
        t = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 16, zlib.crc32(t))
        whole[texts[r["doc_id"]]].add(r["shard"])
    assert sum(len(x) > 1 for x in whole.values()) <= 2


def test_many_groups_are_joined_by_a_shuffle(make, monkeypatch):
    monkeypatch.setattr(b, "BROADCAST_GROUPS", 3)
    rows = [(i, f"t{i % 50}") for i in range(150)]
    check(rows, b.assign(make(rows), shards=6).collect(), 6)


def test_a_group_larger_than_shards_fills_few_of_them(make):
    rows = [(i, "hot") for i in range(200)] + [(1000 + i, f"t{i}") for i in range(400)]
    got = b.assign(make(rows), shards=10).collect()
    check(rows, got, 10)
    assert len({r["shard"] for r in got if r["doc_id"] < 1000}) <= 5


def test_few_rows_repeated_rows_and_none(spark, make):
    rows = [(1, "a"), (1, "a"), (None, "a")]
    check(rows, b.assign(make(rows), shards=40).collect(), 40)
    assert b.assign(make([])).count() == 0
    df = spark.createDataFrame([(1, "a", 3, "x"), (2, "a", 4, "y")], "doc_id long, text string, shard int, row string")
    check([1, 2], b.assign(df, shards=3).collect(), 3)


def test_ranks_over_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(b, "BUCKET", 10)
    rows = spark.range(700).selectExpr("id row", "cast(id % 2 AS int) shard", "id % 5 = 0 last", "CASE WHEN id < 300 THEN 'g' ELSE cast(id AS string) END g", "CASE WHEN id < 300 THEN 300 ELSE 1 END n")
    from pyspark.sql import functions as F

    got = b.ranked(rows, "shard", 700, 2, F.col("last"), F.col("g"), F.col("n")).collect()
    for s in (0, 1):
        own = sorted((r for r in got if r["shard"] == s), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(350)) and [r["last"] for r in own] == sorted(r["last"] for r in own)


@given(st.dictionaries(st.integers(0, 9), st.integers(0, 50)), st.integers(10, 12))
def test_quotas(counts, shards):
    surplus, takes = b.quotas(counts, shards)
    final = Counter({s: counts.get(s, 0) - surplus.get(s, 0) for s in range(shards)})
    assert [a for a, _, _ in takes[1:]] == [e for _, e, _ in takes[:-1]] and sum(surplus.values()) == (takes[-1][1] if takes else 0)
    for a, e, s in takes:
        final[s] += e - a
    assert max(final.values()) - min(final.values()) <= 1


def cut_pairs(shards_of_groups):
    """Linked pairs in different shards, each pair of a group being linked."""
    total = 0
    for counts in shards_of_groups:
        n = sum(counts)
        total += (n * n - sum(c * c for c in counts)) // 2
    return total


def least_cut(sizes, capacities):
    """The least number of cut pairs of all ways to deal groups of these sizes out over shards of these capacities."""

    @functools.cache
    def best(k, room):
        if k == len(sizes):
            return 0
        found = math.inf
        for counts in itertools.product(*(range(min(sizes[k], r) + 1) for r in room)):
            if sum(counts) == sizes[k]:
                rest = best(k + 1, tuple(r - c for r, c in zip(room, counts, strict=True)))
                found = min(found, cut_pairs([counts]) + rest)
        return found

    return best(0, tuple(capacities))


def test_cut_is_near_the_least_possible(make):
    rng = random.Random(4)
    for _ in range(3):
        sizes = [rng.randint(2, 5) for _ in range(6)]
        rows = [(100 * g + i, f"group {g}") for g, n in enumerate(sizes) for i in range(n)]
        rows += [(10_000 + i, f"alone {i}") for i in range(rng.randint(12, 20))]
        got = b.assign(make(rows), shards=3).collect()
        check(rows, got, 3)
        texts, by_group = dict(rows), defaultdict(Counter)
        for r in got:
            by_group[texts[r["doc_id"]]][r["shard"]] += 1
        cut = cut_pairs([tuple(c.values()) for c in by_group.values()])
        before = cut_pairs([Counter(rng.randrange(3) for _ in range(n)).values() for n in sizes])
        capacities = [len(rows) // 3 + (s < len(rows) % 3) for s in range(3)]
        # A group at most is cut that need not be, and far less is cut than by dealing rows out.
        assert cut <= least_cut(tuple(sizes), capacities) + 6 and cut <= before


def test_propagation_moves_no_group_apart(spark, make):
    from pyspark.sql import functions as F

    from daybook.scratch import Scratch

    rows = [(i, i % 30, 6, (i * 7 + i // 30) % 5) for i in range(180)]
    linked = spark.createDataFrame(rows, "row long, group string, members long, shard int")
    after = b.propagate(linked, 45, Scratch(spark, "test")).collect()
    before, now = defaultdict(Counter), defaultdict(Counter)
    for _, g, _, s in rows:
        before[str(g)][s] += 1
    for r in after:
        now[r["group"]][r["shard"]] += 1
    assert {r["row"] for r in after} == set(range(180))
    assert all(cut_pairs([tuple(now[g].values())]) <= cut_pairs([tuple(before[g].values())]) for g in before)
    assert sum(len(c) == 1 for c in now.values()) >= 0.8 * len(now)
    assert linked.agg(F.count("row")).first()[0] == 180


def test_very_long_texts(make):
    rows = [(1, "é" * 2_000_000), (2, "é" * 2_000_000), (3, "short")]
    got = {r["doc_id"]: r for r in b.assign(make(rows), shards=2).collect()}
    assert got[1]["size"] == 4_000_016 and got[1]["text_crc32"] == zlib.crc32(rows[0][1].encode()) and got[1]["shard"] == got[2]["shard"]
