"""Text quality by a factorisation machine over hashed words, structure statistics and metadata.

The score of a document with features x is sigmoid(w0 + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j). All
pairwise interactions are summed in linear time by the identity
    sum over i < j of <v_i, v_j> x_i x_j = 1/2 * sum over f of ((sum v_if x_i)^2 - sum v_if^2 x_i^2).

Features: words under a hash of 14 bits, a bucket's value being the sum over its distinct words of the logarithm of
their counts, scaled to length 1; shares of upper-case, digits, symbols and the like, repetition of words, lines and
neighbours, lengths, each as a number and as one of eight steps; the metadata columns named, in steps. Labels,
language, source and id are no inputs. All texts of a slice of a batch are described at once, in array operations.

Learning: labelled rows outside the held-out fold. Of the labelled ids the first `sample` by hash are taken, and of
their distinct (id, text) rows again the first `sample` by hash, less where they would hold more than ENTRIES features
in all: these bounds are the parameters. Stochastic gradient steps on the log-loss go in a fixed order, so the same rows
give the same model, whatever their partitions.

Defined cases: a null text scores as the empty one; null metadata is a step of its own; several labels of one id
count as their mean; without labelled rows, or with labels of one kind only, all scores are the same prior; repeated
rows are learned from once and scored each; texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches, fold, parts_of
from daybook.scratch import Scratch

BITS, RANK = 14, 8
SAMPLE, ENTRIES = 8000, 20_000_000
EPOCHS, BATCH, RATE, RIDGE = 8, 128, 0.08, 1e-5
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
STEPS = 8
METADATA = ("n_chars",)
#: Bytes of texts described at once, about.
SLICE = 1 << 20
#: Classes of bytes: other, lower, upper, digit, space, line end, bar, sentence mark, other symbol, beyond ASCII.
_CLASSES = 10
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 8
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 9
_CLASS[32], _CLASS[10], _CLASS[ord("|")] = 4, 5, 6
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 7
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
N_STATISTICS = 24


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def width(metadata: int) -> int:
    """Features in all: words, statistics as numbers and as steps, metadata as steps and as null."""
    return (1 << BITS) + N_STATISTICS * (1 + STEPS) + metadata * 33


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of True."""
    turn = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    return turn[::2], turn[1::2]


def _before(values: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)))


def _most(doc: np.ndarray, n: np.ndarray, docs: int) -> np.ndarray:
    """The largest of the counts of each document."""
    out = (np.bincount(doc, minlength=docs) > 0).astype(np.float64)
    doc, n = doc[n > 1], n[n > 1]
    order = np.argsort(n)
    out[doc[order]] = n[order]
    return out


def describe(texts: list[bytes | None], metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, at, x): features at[first[i] : first[i + 1]] of text i that aren't 0, and their values.

    metadata has a row for each text; nan stands for null.
    """
    docs, texts = len(texts), [t or b"" for t in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    # A line end after each text parts words and lines of neighbours; it is no part of either.
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    begin = np.concatenate(([0], np.cumsum(lengths + 1)))
    kinds = _CLASS[data]
    own = np.ones(len(data), bool)
    own[begin[1:] - 1] = False
    doc_of = np.repeat(np.arange(docs), lengths + 1)
    shares = np.bincount((doc_of * _CLASSES + kinds)[own], minlength=docs * _CLASSES).reshape(docs, _CLASSES) / np.maximum(lengths, 1)[:, None]

    # The hash of a word or line: its bytes as digits in a base, brought back to its first place.
    powers, back = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(len(data), b, np.uint64)))) for b in (_BASE, _BACK))
    sums = _before((data.astype(np.uint64) + np.uint64(1)) * powers[:-1])

    def hashed(s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return _mixed((sums[e] - sums[s]) * back[s])

    def of_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return _mixed(h + doc.astype(np.uint64) * _BASE)

    s, e = _runs(~_SPACE[data])
    words, doc = hashed(s, e), doc_of[s]
    n = np.bincount(doc, minlength=docs)
    some = np.maximum(n, 1)
    neighbours = doc[1:] == doc[:-1]
    again = np.bincount(doc[1:][neighbours & (words[1:] == words[:-1])], minlength=docs)
    _, one, counts = np.unique(of_doc(words, doc), return_index=True, return_counts=True)
    one_doc = doc[one]
    distinct = np.bincount(one_doc, minlength=docs)
    pairs = of_doc(words[:-1] * _BASE + words[1:], doc[:-1])[neighbours]
    _, two, two_counts = np.unique(pairs, return_index=True, return_counts=True)
    ls, le = _runs(data != 10)
    line_doc = doc_of[ls]
    lines = np.bincount(line_doc, minlength=docs)
    _, line_one = np.unique(of_doc(hashed(ls, le), line_doc), return_index=True)
    some_lines = np.maximum(lines, 1)
    lower, upper, letter = (_before(k.astype(np.int32)) for k in (kinds == 1, kinds == 2, (kinds == 1) | (kinds == 2) | (kinds == 9)))
    ws, we = s[one], e[one]
    shouted = (upper[we] > upper[ws]) & (lower[we] == lower[ws])
    spelled = letter[we] - letter[ws] == we - ws
    marked = ~np.isin(kinds[e - 1], (1, 2, 3, 9))
    letters = shares[:, 1] + shares[:, 2] + shares[:, 9]
    by_doc = lambda of, flags=None: np.bincount(of if flags is None else of[flags], minlength=docs)
    statistics = np.column_stack(
        [
            shares, shares[:, 2] / np.where(letters > 0, letters, 1), distinct / some, again / some, _most(one_doc, counts, docs) / some,
            _most(doc[:-1][neighbours][two], two_counts, docs) / some, 1 - by_doc(line_doc[line_one]) / some_lines,
            np.minimum(1, np.bincount(doc, e - s, docs) / some / 20), np.minimum(1, np.log1p(lengths) / 16), np.minimum(1, np.log1p(n) / 14),
            np.minimum(1, np.log1p(lines) / 10), np.minimum(1, some / some_lines / 100), by_doc(doc, marked) / some,
            by_doc(one_doc, shouted) / np.maximum(distinct, 1), by_doc(one_doc, spelled) / np.maximum(distinct, 1),
        ]
    )

    base = 1 << BITS
    bucket, slot = np.unique(one_doc * base + (words[one] & np.uint64(base - 1)).astype(np.int64), return_inverse=True)
    x = np.bincount(slot, np.log1p(counts), len(bucket)).astype(np.float64)
    bucket_doc = bucket >> BITS
    x /= np.sqrt(np.bincount(bucket_doc, x * x, docs))[bucket_doc]
    k = np.arange(N_STATISTICS)
    # Steps are finer near 0, where most shares lie.
    steps = np.minimum((np.sqrt(statistics) * STEPS).astype(np.int64), STEPS - 1)
    known = ~np.isnan(metadata)
    meta = np.where(known, np.minimum(31, (2 * np.log1p(np.maximum(np.where(known, metadata, 0), 0))).astype(np.int64)), 32)
    meta = meta + base + N_STATISTICS * (1 + STEPS) + 33 * np.arange(metadata.shape[1])
    fixed = np.concatenate((np.broadcast_to(base + k, statistics.shape), base + N_STATISTICS + k * STEPS + steps, meta), axis=1)
    values = np.concatenate((statistics, np.full((docs, N_STATISTICS + metadata.shape[1]), 0.3)), axis=1)
    n, each = np.bincount(bucket_doc, minlength=docs), fixed.shape[1]
    first = np.concatenate(([0], np.cumsum(n + each)))
    # A document's words come before its fixed features.
    words_at = np.arange(len(bucket)) + bucket_doc * each
    fixed_at = (first[:-1] + n)[:, None] + np.arange(each)
    at, found = np.empty(first[-1], np.int64), np.empty(first[-1])
    at[words_at], found[words_at] = bucket & (base - 1), x
    at[fixed_at], found[fixed_at] = fixed, values
    return first, at, found


def _slices(texts: list, metadata: list):
    """describe() of bounded slices of a batch."""
    columns = np.array([[np.nan if v is None else v for v in m] for m in metadata], np.float64).reshape(len(metadata), len(texts)).T
    for a, b in parts_of([t or b"" for t in texts], SLICE):
        yield describe(texts[a:b], columns[a:b])


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray

    def margins(self, first: np.ndarray, at: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Before the sigmoid; every document has a feature at least."""
        vx = self.v[at] * x[:, None]
        sums = np.add.reduceat(vx, first[:-1], axis=0)
        linear = np.add.reduceat(self.w[at] * x, first[:-1])
        return self.bias + linear + 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((vx * vx).sum(axis=1), first[:-1]))


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def learn(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_features: int, seed: int = 7) -> Machine:
    """A machine from features and labels (0 to 1), by adaptive gradient steps."""
    rng = np.random.Generator(np.random.PCG64(seed))
    prior = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    machine = Machine(np.log(prior / (1 - prior)), np.zeros(n_features), rng.normal(0, 0.01, (n_features, RANK)))
    if not len(labels) or labels.min() == labels.max():
        machine.v[:] = 0
        return machine
    seen_w, seen_v, seen_b = np.full(n_features, 1e-6), np.full((n_features, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            part = [rows[i] for i in order[start : start + BATCH]]
            y = labels[order[start : start + BATCH]]
            at, x = np.concatenate([p[0] for p in part]).astype(np.int64), np.concatenate([p[1] for p in part]).astype(np.float64)
            sizes = np.array([len(p[0]) for p in part])
            first, row = np.concatenate(([0], np.cumsum(sizes))), np.repeat(np.arange(len(part)), sizes)
            error = (_sigmoid(machine.margins(first, at, x)) - y) / len(part)
            vx = machine.v[at] * x[:, None]
            sums = np.add.reduceat(vx, first[:-1], axis=0)
            used, slot = np.unique(at, return_inverse=True)
            ex = error[row] * x
            gw = np.bincount(slot, ex, len(used)) + RIDGE * machine.w[used]
            gv = np.stack([np.bincount(slot, ex * (sums[row, f] - vx[:, f]), len(used)) for f in range(RANK)], axis=1) + RIDGE * machine.v[used]
            seen_w[used] += gw * gw
            seen_v[used] += gv * gv
            seen_b += error.sum() ** 2
            machine.w[used] -= RATE * gw / np.sqrt(seen_w[used])
            machine.v[used] -= RATE * gv / np.sqrt(seen_v[used])
            machine.bias -= RATE * error.sum() / np.sqrt(seen_b)
    return machine


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", metadata: tuple[str, ...] = METADATA, sample: int = SAMPLE, entries: int = ENTRIES) -> Machine:
    """Learn from labelled rows outside the held-out fold, `sample` of them and `entries` features at most."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    marked = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    marked = marked.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    marked = marked.groupBy("doc_id").agg(F.avg("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    marked = scratch.save(marked, "marked")
    columns = [F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(metadata)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(text_col, "UTF-8").alias("text"), *columns).join(F.broadcast(marked), "doc_id")
    rows = rows.withColumn("h", F.xxhash64(F.coalesce("text", F.lit(b""))))
    drawn = rows.select("doc_id", "h").distinct().select("*", F.xxhash64("doc_id", "h").alias("place")).orderBy("place", "doc_id", "h").limit(sample)
    rows = rows.join(F.broadcast(scratch.save(drawn, "drawn")), ["doc_id", "h"])
    described = rows.select("doc_id", "h", "place", "label", _described(len(metadata))("text", *(f"m{i}" for i in range(len(metadata)))).alias("f"))
    with bounded_batches(spark):
        # Repeated rows count once; if only their metadata differ, the least of their descriptions does.
        once = described.groupBy("doc_id", "h").agg(F.min("place").alias("place"), F.min("label").alias("label"), F.min(F.struct("f.at", "f.x")).alias("f"))
        once = scratch.save(once, "described")
    # `sample` rows of a few numbers; then the features of as many of them as the second bound allows.
    sizes = once.select("place", (F.octet_length("f.at") / 2).cast("long")).orderBy("place", "doc_id").collect()
    fitting = int(np.searchsorted(np.cumsum([r[1] for r in sizes]), entries, "right")) if sizes else 0
    kept = once.where(F.col("place") <= sizes[fitting - 1][0]) if fitting else once.limit(0)
    got = sorted((r[0], r[1], bytes(r[2]), r[3], bytes(r[4])) for r in kept.select("place", F.col("doc_id").cast("string"), "f.at", "label", "f.x").collect())
    scratch.release()
    vectors = [(np.frombuffer(at, "<u2"), np.frombuffer(x, "<f4")) for _, _, at, _, x in got]
    return learn(vectors, np.array([r[3] for r in got]), width(len(metadata)))


def _described(n: int):
    # Packed as bytes: a list of numbers would take the driver many times the memory.
    if width(n) > 1 << 16:
        raise ValueError("feature numbers are packed into 16 bits")

    @F.pandas_udf("at binary, x binary")
    def run(texts: pd.Series, *metadata: pd.Series) -> pd.DataFrame:
        ats, xs = [], []
        for first, at, x in _slices(texts.tolist(), [m.tolist() for m in metadata]):
            at, x = at.astype("<u2"), x.astype("<f4")
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                ats.append(at[a:b].tobytes()), xs.append(x[a:b].tobytes())
        return pd.DataFrame({"at": ats, "x": xs})

    return run


def scored(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = METADATA, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; one scan, no shuffle."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def run(texts: pd.Series, *columns: pd.Series) -> pd.Series:
        found = [_sigmoid(shared.value.margins(*f)) for f in _slices(texts.tolist(), [c.tolist() for c in columns])]
        return pd.Series(np.concatenate(found) if found else [], dtype="float64")

    score = run(F.encode(text_col, "UTF-8"), *(F.col(c).cast("double") for c in metadata))
    rows = docs.select(F.col(id_col).alias("doc_id"), (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"), score.alias("score"))
    with bounded_batches(spark):
        return Scratch(spark, "quality-scores").result(rows.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)))
