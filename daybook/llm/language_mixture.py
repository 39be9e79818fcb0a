"""Language identification as inference of a mixture of languages.

A language's model is its distribution of hashed byte trigrams of letters and the spaces around them. A document is
taken as a mixture of languages: expectation-maximisation estimates the proportions that make its trigrams likeliest.
The set of languages is the one of least penalised likelihood: languages enter by their proportion, and one more is
kept only if it gains more than PENALTY * log(trigrams) in log-likelihood (trigrams overlap, so a third of the
likelihood counts). A background of equal likelihood for all trigrams takes what no language explains, free of charge.

Learning: of the labelled rows outside the held-out fold, a sample by hash of about `rows_per_language` rows of each
language (this bound is the parameter; how many rows each language has is counted over all of them). All labelled
languages are learned; more than `most` of them, which would no longer be a column of languages and would make the model
too large to send to every task, are an error. Prediction reads nothing but the text, whole.

Defined cases: null and texts without a letter get `und` and score 0, and so do all texts if nothing could be learned;
rows without a language label are not learned from; repeated rows are predicted each; ties go to the language first
in alphabetical order. A model is 256 KB for each language.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches, fold
from daybook.scratch import Scratch

BITS = 15
ROWS_PER_LANGUAGE, LANGUAGES = 3000, 1000
PENALTY, ROUNDS, TOLERANCE = 2.0, 25, 1e-3
UNDETERMINED = "und"
#: Folds, and the one that is never learned from.
FOLDS, HELD_OUT = 4, 2
RESULT = "lang string, score double, languages array<struct<lang:string,share:double>>"
_TABLE = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def trigrams(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams of the lower-cased text; runs of what isn't a letter are one space."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_TABLE).split()) + b" ", np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(1 << BITS, np.int64)
    h = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return np.bincount((h * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)


@dataclass
class Model:
    languages: list[str]
    #: A row for each language and, last, one for the background; probabilities.
    grams: np.ndarray

    def _shares(self, n: np.ndarray, p: np.ndarray, total: float) -> tuple[np.ndarray, float]:
        """Proportions by expectation-maximisation, and the log-likelihood."""
        shares = np.full(len(p), 1.0 / len(p))
        for _ in range(ROUNDS):
            mixed = shares @ p
            new = shares * (p @ (n / mixed)) / total
            moved = np.abs(new - shares).max()
            shares = new
            if moved < TOLERANCE:
                break
        return shares, float(n @ np.log(shares @ p))

    def infer(self, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
        """(language, its share, all languages of the set with their shares)."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, []
        counts = trigrams(text)
        at = np.flatnonzero(counts)
        n, p = counts[at].astype(np.float64), self.grams[:, at]
        total = n.sum()
        if not total:
            return UNDETERMINED, 0.0, []
        shares, _ = self._shares(n, p, total)
        order = np.lexsort((np.arange(len(self.languages)), -shares[:-1]))
        last = len(self.languages)
        best = None
        for k in range(1, len(order) + 1):
            if best is not None and shares[order[k - 1]] * total < 3 * PENALTY:
                break
            kept, likelihood = self._shares(n, p[[*order[:k], last]], total)
            penalised = likelihood / 3 - PENALTY * k * np.log(total + 1)
            if best is not None and penalised <= best[0]:
                break
            best = (penalised, kept, order[:k])
        found = sorted(zip(best[1][:-1].tolist(), (self.languages[i] for i in best[2]), strict=True), key=lambda x: (-x[0], x[1]))
        return found[0][1], min(1.0, max(0.0, found[0][0])), [(lang, share) for share, lang in found]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_language: int = ROWS_PER_LANGUAGE, most: int = LANGUAGES) -> Model:
    """Learn from the labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most + 1)
    sizes = sorted((r[0], r[1]) for r in sizes.collect())
    if len(sizes) > most:
        raise ValueError(f"there are labels of more than {most} languages")
    if not sizes:
        return Model([], np.zeros((1, 1 << BITS)))
    number = F.create_map(*(F.lit(x) for k, (lang, _) in enumerate(sizes) for x in (lang, k)))[F.col("lang")]
    share = F.create_map(*(F.lit(x) for lang, n in sizes for x in (lang, min(1.0, rows_per_language / n))))[F.col("lang")]
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(drawn < share).select(number.alias("k"), "text")

    def count(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n = trigrams(text)
                total[k] = total[k] + n if k in total else n
        for k, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["k", "gram", "n"]
            )

    with bounded_batches(spark):
        # Three numbers for each language and gram at most.
        counted = sample.mapInArrow(count, "k int, gram int, n long").groupBy("k", "gram").agg(F.sum("n").alias("n")).toArrow()
    k, gram, n = (counted.column(c).to_numpy() for c in ("k", "gram", "n"))
    grams = np.full((len(sizes) + 1, 1 << BITS), 0.05)
    grams[k, gram] += n
    learned = [i for i in range(len(sizes)) if i in set(k.tolist())]
    grams = grams[[*learned, len(sizes)]]
    return Model([sizes[i][0] for i in learned], grams / grams.sum(axis=1, keepdims=True))


def detect(model: Model, text: Column, spark) -> Column:
    """A struct (lang, score, languages) for a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [shared.value.infer(t) for t in texts]
        return pd.DataFrame(
            {"lang": [f[0] for f in found], "score": [f[1] for f in found],
             "languages": [[{"lang": a, "share": s} for a, s in f[2]] for f in found]}
        )

    return run(text)


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages of every row; the model is learned from docs if not given."""
    spark = docs.sparkSession
    model = model or fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.withColumn("found", detect(model, F.col("text"), spark)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.languages"
    )
    with bounded_batches(spark):
        return Scratch(spark, "languages").result(found)


def selected(docs: DataFrame, least: float, found: str = "found") -> DataFrame:
    """Rows whose detected language (the struct of `detect` in column `found`) isn't `und` and whose languages together,
    which is all but the background, explain at least this share of the text."""
    explained = F.aggregate(F.col(found)["languages"], F.lit(0.0), lambda total, x: total + x["share"])
    return docs.where((F.col(found)["lang"] != UNDETERMINED) & (explained >= least))
