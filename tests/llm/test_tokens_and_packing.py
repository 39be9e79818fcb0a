"""Token counts and packing: the library's own tokens, and every capacity."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from brute import message  # noqa: E402

from daybook.llm import token_counts as tc  # noqa: E402
from daybook.llm import vector_packing as vp  # noqa: E402

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = [" ", "  ", "▁", "\n", "a", "th", "é", "漢", "\t", "the", "<s>", "🙂", "\x00", "ing", "</s>", "<unk>", "<0x0A>", "　", "\x85", "'s", "12", "!", "<|endoftext|>", "ɐ", "ﬁ"]


def texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_counts_are_the_librarys():
    counter = tc.counter(PIECES)
    assert counter.cuts and len(counter.words.fixed) > 10_000
    some = texts(8000) + ["word " * 3000, "x" * 50_000, " lead", "trail "]
    assert [counter.count(t) for t in some] == [len(x) for x in counter.processor.encode(some)]


def test_no_cuts_without_proof(monkeypatch):
    counter = tc.Counter(PIECES)
    counter.cuts = False
    assert [counter.count(t) for t in texts(200)] == [len(x) for x in counter.processor.encode(texts(200))]


def test_the_specification_decides_about_cuts():
    model = tc.counter(PIECES).processor.serialized_model_proto()
    assert tc.words_are_independent(model)
    bpe, plain = (3, 2), (4, 0)
    good = message((1, message((1, b"piece"))), (2, message(bpe, (4, 300))), (3, message((1, b"identity"), plain)))
    assert tc.words_are_independent(good)
    for trainer, normalizer in (([(3, 1)], [plain]), ([], [plain]), ([bpe, (24, 1)], [plain]), ([bpe], []), ([bpe], [plain, (2, b"map")]), ([bpe], [plain, (3, 0)]), ([bpe], [plain, (5, 0)]), ([bpe], [plain, (6, b"rules")])):
        assert not tc.words_are_independent(message((2, message(*trainer)), (3, message(*normalizer))))


def test_remembering_is_bounded(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 50)
    counter = tc.Counter(PIECES)
    some = [f"qz{i}x{i % 7} qz{i % 90}" for i in range(500)]
    assert [counter.count(t) for t in some] == [len(x) for x in counter.processor.encode(some)]
    assert len(counter.words) <= len(counter.words.fixed) + 52


def test_count_query_shape(spark, make):
    rows = [(1, None), (2, ""), (3, "é a"), (3, "é a"), (None, "the " * 5000)]
    got = sorted((tuple(r) for r in tc.token_counts(make(rows), PIECES).collect()), key=repr)
    n = len(tc.counter(PIECES).processor.encode("the " * 5000))
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), *[(3, 4, len(tc.counter(PIECES).processor.encode("é a")), False)] * 2, (None, 20_000, n, True)], key=repr)
    assert tc.token_counts(make([]), PIECES).count() == 0


def ids(text):
    return vp.encoder(BYTES).tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_the_librarys():
    e = vp.encoder(BYTES)
    assert e.fast is not None
    for t in texts(6000, 3) + [" " * 600_000 + "x", "word " * 1000]:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == ids(t), t[:50]


def test_settled_characters_are_in_the_same_classes():
    e = vp.encoder(BYTES)
    chars = [chr(c) for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF and not vp._OTHER.match(chr(c))]
    for form in ("a{0}b 1{0}2", " {0} {0}{0}\n{0}"):
        some = [form.format(c) for c in chars]
        for t, r in zip(some, e.tokenizer.encode_batch(some, add_special_tokens=False), strict=True):
            assert np.frombuffer(e.encode(t), "<u4").tolist() == r.ids, t


def placed(counts, tokens, documents, cost, rule):
    """Sequences as lists of (offset, length), by the same look-up as the query's."""
    placements, made = vp.plan(counts, tokens, documents, cost, rule)
    keys, sequences = placements[:, 0] * (1 << 42) + placements[:, 1], {}
    for n, c in counts.items():
        for r in range(c):
            p = placements[np.searchsorted(keys, n * (1 << 42) + r, "right") - 1]
            nth = r - p[1]
            sequences.setdefault(int(p[3] + nth // p[2]), []).append((int(p[5] + nth % p[2] * n), n))
    assert len(sequences) == made
    return sequences


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30)), st.sampled_from(["norm", "dot"]), st.integers(1, 45), st.integers(1600, 3000))
def test_plans_hold_every_capacity(counts, rule, documents, cost):
    sequences = placed(counts, 40, documents, cost, rule)
    assert Counter(n for s in sequences.values() for _, n in s) == Counter({n: c for n, c in counts.items() if c})
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))]
        assert sum(n for _, n in s) <= 40 and len(s) <= documents and sum(n * n for _, n in s) <= cost


def test_plans_are_near_the_least():
    rng = random.Random(5)
    counts = Counter(min(2048, int(rng.lognormvariate(6, 1)) + 1) for _ in range(5000))
    least = sum(n * c for n, c in counts.items()) / 2048
    assert vp.plan(counts, 2048, 2048, 2048**2)[1] <= least * 1.01 + 1
    many = {n: c * 10**7 for n, c in counts.items()}
    assert vp.plan(many, 2048, 2048, 2048**2)[1] <= least * 10**7 * 1.01 + 1


def test_pack(spark, make):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "word " * 5000), (None, "x"), (6, "<|endoftext|> x")]
    got = vp.pack(make(rows), BYTES).collect()
    by_row = Counter()
    for r in got:
        by_row[r["doc_id"]] += r["length"]
    want = Counter()
    for d, t in rows:
        want[d] += len(ids(t or "")) + 1
    assert by_row == want
    full = ids("word " * 5000) + [0]
    own = sorted((r for r in got if r["doc_id"] == 4), key=lambda r: r["piece"])
    assert [r["piece"] for r in own] == list(range(len(own))) and [r["length"] for r in own[1:]] == [2048] * (len(own) - 1)
    for r in own:
        part = np.array(full[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes())
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 2048
    assert vp.pack(make([]), BYTES).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_weighs_in_the_choice(rule):
    """Against a slow version that looks at every sequence for every piece, in the query's proportions of capacities."""
    rng = random.Random(9)
    differ = 0
    for _ in range(40):
        counts = Counter(rng.randint(1, 40) for _ in range(30))
        slow, one = (slow_plan(counts, 40, 40, 1600, rule, only_tokens) for only_tokens in (False, True))
        got = sorted(sorted((n for _, n in s), reverse=True) for s in placed(counts, 40, 40, 1600, rule).values())
        assert got == sorted(sorted(s, reverse=True) for s in slow)
        differ += sorted(map(sorted, slow)) != sorted(map(sorted, one))
    assert differ > 10


def slow_plan(counts, tokens, documents, cost, rule, only_tokens):
    capacity = np.array([tokens, documents, cost], float)
    vector = lambda n: np.array([n, 1, n * n], float)
    weight = sum(c * vector(n) for n, c in counts.items()) / capacity
    weight = np.array([1.0, 0, 0]) if only_tokens else weight / weight.max()
    sequences = []
    for n in sorted(counts, reverse=True):
        left = counts[n]
        open_ = [(capacity - sum(map(vector, s)), s) for s in sequences]
        open_ = [(r, s) for r, s in open_ if (r >= vector(n)).all()]

        def score(x):
            r = x[0]
            part = ((r - vector(n)) / capacity) ** 2 if rule == "norm" else -(vector(n) / capacity) * (1 - r / capacity)
            return (weight * part).sum(), *r

        for r, s in sorted(open_, key=score):
            while left and (r >= vector(n)).all():
                s.append(n)
                r, left = r - vector(n), left - 1
        while left:
            most = int(min(capacity // vector(n)))
            sequences.append([n] * min(most, left))
            left -= min(most, left)
    return sequences


def test_clashing_columns_of_counts_and_packing(spark):
    df = spark.createDataFrame([(1, "a b", 5, "x", 7, 8, 9, 1.0), (2, None, 6, "y", 7, 8, 9, 2.0)], "doc_id long, text string, n_bytes int, piece string, length int, task int, rank int, base double")
    assert sorted(tuple(r) for r in tc.token_counts(df, PIECES).select("doc_id", "n_bytes").collect()) == [(1, 3), (2, 0)]
    got = vp.pack(df, BYTES)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted((r["doc_id"], r["length"]) for r in got.collect()) == [(1, len(ids("a b")) + 1), (2, 1)]
