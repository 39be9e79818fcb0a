"""The pipeline's stages against brute force, each on its own input."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from brute import benchmark_brute, near_brute
from pyspark.sql import functions as F

import corpus_pipeline as p
from daybook.llm import language_mixture as lm

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(p.STAGES):
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, DATA)
        if name == "language":
            model = lm.fit(docs)
            found = {d: model.infer(t) for d, t in rows.items()}
            want = {d for d, (lang, _, shares) in found.items() if lang != "und" and sum(s for _, s in shares) >= p.LEAST_SHARE}
            assert len(want) >= 0.95 * len(rows)
        elif name == "exact":
            best = {}
            for d, t in rows.items():
                key = re.sub(r"[\x20\x09-\x0D]", "", t)
                best[key] = min(best.get(key, (1, 0)), (-len(t), d)) if key in best else (-len(t), d)
            want = {d for _, d in best.values()}
        elif name == "near":
            items = list(rows.items())
            want = {c for _, c in near_brute(items).values()}
        elif name == "decontaminated":
            bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
            want = {d for d, (_, hit, _) in zip(rows, benchmark_brute(rows.values(), bench), strict=True) if not hit}
        else:
            check_packed(rows, out.collect())
            return
        path = str(tmp_path / str(k))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        assert {r[0] for r in docs.select("doc_id").collect()} == want and docs.count() == len(want)


def check_packed(rows, pieces):
    """Every document's ids are there once, in order, and sequences are filled without gaps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        own[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(own) == set(rows)
    for d, text in rows.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        of = sorted(own[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in of] == list(range(len(of))) and sum(r["length"] for r in of) == len(ids)
        for r in of:
            assert zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:i]) for i in range(len(s))] and sum(n for _, n in s) <= 2048


def test_documents_of_no_known_language_stay(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    out = p.STAGES[0][1](spark, docs, DATA)
    assert out.count() == docs.count() and out.columns == docs.columns


def test_a_mixture_stays(spark):
    rows = [(i, "und der die das nicht ein " * 9, "de") for i in range(30)] + [(100 + i, "the and of that with for " * 9, "en") for i in range(30)]
    rows += [(200, "und der die das nicht ein the and of that with for " * 9, None), (201, "1234 5678", None), (202, "qxz" * 200, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in p.STAGES[0][1](spark, docs, DATA).collect()} == {201, 202}


def test_a_run_leaves_its_result_only(spark, tmp_path, monkeypatch):
    from daybook import scratch

    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(60)
    (tmp_path / "in").mkdir()
    docs.unionByName(docs.limit(9)).write.parquet(str(tmp_path / "in/documents.parquet"))
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(str(tmp_path / "in/benchmark.parquet"))
    monkeypatch.setattr(scratch, "shared_root", lambda _: f"file:{tmp_path}/shared")
    assert p.run(spark, str(tmp_path / "in")).count() > 60
    left = {str(x.relative_to(tmp_path / "shared")).partition("/")[2] for x in (tmp_path / "shared").glob("*/*")}
    assert left == {"packed"} and len(list((tmp_path / "shared").iterdir())) == 1


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for name, stage in p.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0 and (name == "packed" or out.columns == docs.columns)


def test_random_rows_with_few_ids_against_brute_force(spark):
    """Ids repeat, are null, and stand for different texts: every stage decides row by row."""
    rng = random.Random(11)
    bench = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "rho", "tau"]) + str(rng.randrange(50)) for _ in range(60)) for _ in range(6)]
    texts = []
    for _ in range(40):
        t = rng.choice(base)
        kind = rng.randrange(4)
        texts.append(t if kind == 0 else t + " " * rng.randrange(3) if kind == 1 else t + f" end{rng.randrange(3)}" if kind == 2 else f"{t} {rng.choice(bench)[1]}")
    rows = [(rng.choice([None, 1, 2, 3, 4]), t, i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row_key int").repartition(4)
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    kept = lambda stage: Counter(rows[r["row_key"]][:2] for r in stage(spark, docs, DATA).collect())

    groups = defaultdict(list)
    for i, (_, t, _) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append(i)
    best = [min(g, key=lambda i: (-len(rows[i][1]), order(i))) for g in groups.values()]
    # Of rows that are equal in length and id, any stays.
    assert sorted(len(t) for _, t in kept(p.exact).elements()) == sorted(len(rows[i][1]) for i in best)
    assert sorted(repr(d) for d, _ in kept(p.exact).elements()) == sorted(repr(rows[i][0]) for i in best)

    near = near_brute([(i, t) for i, (_, t, _) in enumerate(rows)])
    groups = defaultdict(list)
    for i, (_, c) in near.items():
        groups[c].append(i)
    assert sorted(repr(d) for d, _ in kept(p.near).elements()) == sorted(repr(rows[min(g, key=order)][0]) for g in groups.values())

    clean = [rows[i][:2] for i, (_, hit, _) in enumerate(benchmark_brute(texts, bench)) if not hit]
    assert 0 < len(clean) < len(rows) and kept(p.decontaminated) == Counter(clean)


def test_repeated_ids_and_clashing_columns(spark):
    schema = "doc_id long, text string, lang string, found string, other_id int, stay int, nth int"
    rows = [(1, "the and of that " * 9, "en", "f", 1, 1, 1), (1, "the and of that " * 9, "en", "f", 1, 1, 1), (2, "the and of that " * 9, "en", "f", 2, 2, 2), (None, "with for this but " * 9, "en", "f", 3, 3, 3), (None, "with for this but " * 9, "en", "f", 3, 3, 3), (4, None, "en", "f", 4, 4, 4)]
    docs = spark.createDataFrame(rows, schema)
    kept = p.exact(spark, docs, DATA)
    assert kept.columns == docs.columns
    assert sorted(repr(r["doc_id"]) for r in kept.collect()) == ["1", "4", "None"]
    assert p.exact(spark, docs.limit(0), DATA).count() == 0
    assert sorted(repr(r["doc_id"]) for r in p.near(spark, kept, DATA).collect()) == ["1", "4", "None"]
    assert p.decontaminated(spark, kept, DATA).count() == 3
    assert p.language(spark, kept, DATA).columns == docs.columns


def test_even_mixtures_of_languages_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = {}
    for r in docs.where("n_chars between 1500 and 2500").orderBy("doc_id").collect():
        parts.setdefault(r["lang"], []).append(r["text"][:800])
    mixed = [(-k - 1, "\n".join(four)) for k, four in enumerate(zip(*(parts[lang][:10] for lang in ("de", "en", "es", "fr")), strict=True))]
    noise = (-99, "qxzj wvkq " * 200)
    docs = docs.unionByName(spark.createDataFrame([*mixed, noise], "doc_id long, text string"), allowMissingColumns=True)
    model = lm.fit(docs)
    assert sum(model.infer(t)[1] < p.LEAST_SHARE for _, t in mixed) > 0
    assert sum(share for _, share in model.infer(noise[1])[2]) < p.LEAST_SHARE
    assert {r[0] for r in p.language(spark, docs, DATA).where("doc_id < 0").select("doc_id").collect()} == {d for d, _ in mixed}


def test_decisions_hold_for_rows_that_share_an_id_or_have_none(spark):
    passage = max((r[0] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("text").collect()), key=len)
    base = " ".join(f"word{k}" for k in range(60))
    unique = [f"{x}one {x}two {x}three {x}four {x}five {x}six" for x in "abc"]
    for stage, first, longer in ((p.exact, base, base), (p.near, base, base + " more"), (p.decontaminated, "another text", base + " " + passage)):
        rows = [(0, first, 0), (1, longer, 1), (1, unique[0], 2), (None, longer, 3), (None, unique[1], 4), (2, unique[2], 5)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, row_number int").repartition(3)
        kept = stage(spark, docs, DATA)
        assert kept.columns == docs.columns
        assert sorted((r["text"], r["row_number"]) for r in kept.collect()) == sorted([(first, 0), (unique[0], 2), (unique[1], 4), (unique[2], 5)])
