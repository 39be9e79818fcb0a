"""Language mixtures and the quality machine: the mathematics, and held-out accuracy."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest

from daybook.llm import fm_quality as fm
from daybook.llm import language_mixture as lm
from daybook.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    got = QUERIES["op8_language_mixture"](spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.count() > 100 and held.where("lang_pred = lang").count() >= 0.99 * held.count()
    assert got.where("score < 0 or score > 1").count() == 0


def test_mixtures_find_both_languages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = lm.fit(docs)
    texts = {r["lang"]: r["text"] for r in docs.where("n_chars between 1500 and 2500").orderBy("doc_id").collect()}
    found = model.infer(texts["de"][:1000] + "\n" + texts["es"][:1000])[2]
    assert {lang for lang, share in found if share > 0.2} == {"de", "es"}
    assert [x[0] for x in model.infer(texts["fr"])[2] if x[1] > 0.05] == ["fr"]


def small_model(seed, languages=3, grams=12):
    """Languages that share their few grams in different proportions, and where those are."""
    rng = np.random.default_rng(seed)
    table = np.full((languages + 1, 1 << lm.BITS), 1e-6)
    at = rng.choice(1 << lm.BITS, grams, replace=False)
    table[:languages][:, at] = rng.dirichlet(np.full(grams, 0.4), languages)
    table[languages] = 1.0
    return lm.Model([f"l{k}" for k in range(languages)], table / table.sum(axis=1, keepdims=True)), at


def test_proportions_are_the_likeliest():
    """Expectation-maximisation against a search of all proportions in steps."""
    rng = np.random.default_rng(5)
    for seed in range(12):
        model, at = small_model(seed, 2)
        n = rng.integers(0, 30, len(at)).astype(float) + 0.0
        p = model.grams[:, at]
        shares, likelihood = model._shares(n, p, n.sum())
        assert shares.sum() == pytest.approx(1) and (shares >= 0).all()
        steps = np.linspace(0, 1, 101)
        grid = [(a, b, 1 - a - b) for a in steps for b in steps if a + b <= 1 + 1e-9]
        best = max(float(n @ np.log(np.maximum(np.array(g) @ p, 1e-300))) for g in grid)
        assert likelihood >= best - 0.02 * abs(best) ** 0.5


def test_language_sets_are_those_of_full_enumeration(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = lm.fit(docs)
    parts = {r["lang"]: [] for r in docs.select("lang").distinct().collect() if r["lang"]}
    for r in docs.where("n_chars between 900 and 2500 and lang is not null").orderBy("doc_id").collect():
        parts[r["lang"]].append(r["text"][:500])
    languages = sorted(parts)
    texts = [parts[a][k] for k in range(6) for a in languages] + [parts[a][k] + "\n" + parts[b][k] for k in range(4) for a, b in itertools.combinations(languages, 2)]
    same = 0
    for text in texts:
        counts = lm.trigrams(text)
        at = np.flatnonzero(counts)
        n, total = counts[at].astype(float), counts.sum()

        def penalised(of, n=n, at=at, total=total):
            rows = [*(model.languages.index(x) for x in of), len(model.languages)]
            return model._shares(n, model.grams[rows][:, at], total)[1] / 3 - lm.PENALTY * len(of) * np.log(total + 1)

        best = max((s for k in range(1, len(languages) + 1) for s in itertools.combinations(languages, k)), key=penalised)
        found = [x for x, _ in model.infer(text)[2]]
        assert penalised(found) >= penalised(best) - 1.0
        same += set(found) == set(best)
    assert same >= 0.95 * len(texts)


def test_ties_go_to_the_first_language(spark):
    rows = [(i, "same words in both of them " * 3, lang) for i, lang in enumerate(["zz", "aa"] * 20)]
    model = lm.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows_per_language=10**6)
    assert model.languages == ["aa", "zz"] and model.grams.shape[0] == 3
    model.grams[1] = model.grams[0]
    assert model.infer("same words in both of them")[0] == "aa"


def test_all_languages_are_learned_or_refused(spark):
    rows = [(i, f"word{i % 205} of its own " * 5, f"l{i % 205:03d}") for i in range(820)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held_out = {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % lm.FOLDS == lm.HELD_OUT}
    learned = sorted({lang for i, _, lang in rows if i not in held_out})
    assert lm.fit(docs, rows_per_language=10**6).languages == learned and len(learned) > 200
    with pytest.raises(ValueError, match="more than 200 languages"):
        lm.fit(docs, most=200)


def test_language_edge_cases(spark):
    schema = "doc_id long, text string, lang string, found string, score string"
    rows = [(i, "und der die das nicht ein " * 3, "de", "x", "y") for i in range(20)] + [(100 + i, "the and of that with for " * 3, "en", "x", "y") for i in range(20)]
    odd = [(200, None, "de", None, None), (201, "", "en", None, None), (202, "123 !?", None, None, None), (203, "der die das" * 50_000, None, None, None), (None, "the and of", "en", None, None), (100, rows[20][1], "en", "x", "y")]
    got = {r["doc_id"]: r for r in lm.identify(spark.createDataFrame(rows + odd, schema)).collect()}
    assert [got[i]["lang_pred"] for i in (200, 201, 202, 203, None, 0, 100)] == ["und", "und", "und", "de", "en", "de", "en"]
    assert got[200]["score"] == 0
    nothing = lm.identify(spark.createDataFrame([(1, "text", None, None, None)], schema)).first()
    assert (nothing["lang_pred"], nothing["score"]) == ("und", 0)
    assert lm.identify(spark.createDataFrame([], schema)).count() == 0


def test_pairwise_interactions_by_sum_of_squares():
    rng = np.random.default_rng(1)
    machine = fm.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, fm.RANK)))
    rows = [(rng.choice(50, n, replace=False), rng.normal(size=n)) for n in (12, 1, 30)]
    slow = [0.3 + machine.w[at] @ x + sum(machine.v[at[i]] @ machine.v[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i)) for at, x in rows]
    first = np.cumsum([0, *(len(at) for at, _ in rows)])
    assert machine.margins(first, *(np.concatenate(c) for c in zip(*rows, strict=True))) == pytest.approx(slow)


def test_interactions_are_learned():
    """Exclusive or: no single feature says anything."""
    rows, labels = [], []
    for i in range(2000):
        a, b = i % 2, (i // 2) % 2
        rows.append((np.array([a, 2 + b]), np.ones(2)))
        labels.append(float(a ^ b))
    machine = fm.learn(rows, np.array(labels), 4)
    assert all((machine.margins(np.array([0, 2]), at, x)[0] > 0) == (y == 1) for (at, x), y in zip(rows[:4], labels[:4], strict=True))


def test_features_of_a_text():
    """Counts by hand, and a text's features don't depend on those beside it."""
    texts = [b"a b a\nA 1!\n\na b a", None, b"", b"\xc3\xa9 x " * 3000, b"same same same\nsame\nsame"]
    metadata = np.array([[1.0], [np.nan], [0.0], [5.0], [-3.0]])
    first, at, x = fm.describe(texts, metadata)
    base = 1 << fm.BITS
    assert len(first) == 6 and at.max() < fm.width(1)
    for i, t in enumerate(texts):
        own_at, own_x = at[first[i] : first[i + 1]], x[first[i] : first[i + 1]]
        assert len(set(own_at.tolist())) == len(own_at)
        f, a1, x1 = fm.describe([t], metadata[i : i + 1])
        assert a1.tolist() == own_at.tolist() and x1 == pytest.approx(own_x)
        words = Counter((t or b"").split())
        norm = own_x[own_at < base]
        assert len(norm) == len(words) and sorted(norm) == pytest.approx(sorted(np.log1p(list(words.values())) / np.sqrt((np.log1p(list(words.values())) ** 2).sum()) if words else []))
    s = x[first[0] : first[1]][-49:-25]
    # distinct, neighbours alike, commonest word, commonest pair, repeated lines
    assert s[11:16] == pytest.approx([4 / 8, 0, 4 / 8, 2 / 8, 1 / 3])
    assert s[16:18] == pytest.approx([9 / 8 / 20, np.log1p(17) / 16]) and s[22:] == pytest.approx([1 / 4, 3 / 4])
    again = x[first[4] : first[5]][-49:-25]
    assert again[11:16] == pytest.approx([1 / 5, 4 / 5, 1, 4 / 5, 1 / 3])


def test_words_in_one_bucket_are_summed(monkeypatch):
    monkeypatch.setattr(fm, "BITS", 1)
    words = b"a b c d e f g h"
    first, at, x = fm.describe([words], np.zeros((1, 0)))
    n = np.array([x[i] for i in range(len(at)) if at[i] < 2])
    assert len(n) == 2 and n @ n == pytest.approx(1) and len(set(at.tolist())) == len(at)


def test_the_model_depends_on_its_rows_only(spark):
    rows = [(i % 40, f"text {i} " + ("good words here " if i % 3 else "BAD BAD BAD ") * (1 + i % 5), i) for i in range(120)]
    docs = spark.createDataFrame([*rows, *rows[:30], (5, None, None)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    for options in ({}, {"sample": 20}, {"sample": 20, "entries": 700}):
        one, other = (fm.fit(d, labels, **options) for d in (docs.repartition(7), docs.orderBy("text").coalesce(2)))
        assert one.bias == other.bias and (one.w == other.w).all() and (one.v == other.v).all()


def test_quality_held_out_accuracy(spark):
    got = QUERIES["op6_factorisation_machine"](spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id")
    held = got.where("held_out")
    assert held.where("predicted = quality").count() >= 0.95 * held.count()
    bad = held.where("quality = 0")
    assert bad.count() > 3 and bad.where("predicted = 0").count() >= 0.7 * bad.count()


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", 0), (3, "a b c", 5), (3, "a b c", 5), (None, "x " * 100_000, -3)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 1), (None, 1), (7, None)], "doc_id long, quality int")
    for marked in (labels, labels.limit(0)):
        rows = fm.scored(docs, fm.fit(docs, marked)).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert fm.scored(docs.limit(0), fm.fit(docs, labels)).count() == 0
    clash = docs.selectExpr("*", "1 score", "2 label", "'x' h", "3 place", "4 m0", "5 predicted")
    assert fm.scored(clash, fm.fit(clash, labels)).columns == ["doc_id", "held_out", "score", "predicted"]
