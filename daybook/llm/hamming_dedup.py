"""Near-duplicate detection: b-bit MinHash signatures, a multi-index Hamming join, and exact confirmation.

A document's set holds its distinct shingles (64-bit hashes). Its signature has CHUNKS chunks of four 14-bit minima;
the distance of two signatures is the number of minima that differ. At a similarity of 0.75 a distance above RADIUS
has a probability of about 1e-5, and of nearly nothing at higher ones.

- Classes. Documents with equal sets (by size and a 128-bit sum) form one class; only classes are compared.
- Multi-index. If at most RADIUS = 2 * CHUNKS - 1 minima differ, some chunk has at most one error (pigeonhole). Each
  chunk is therefore listed under its four keys with one minimum left out, which enumerates all allowed errors: two
  chunks within one error share a key. All pairs within RADIUS share a key, so none is lost.
- Stars first. Under each key all classes are compared with the smallest one: as many pairs as rows, whatever the
  size of the group. What is confirmed is contracted to components.
- Then the rest. Under keys that still hold several components, classes outside the key's largest component are
  compared with all classes of other components. Pairs inside one component are never formed, which spares the
  square of a large group of copies, and nothing is capped: every pair within RADIUS is compared or already connected.
- How many comparisons the rest takes is counted before. If they are more than PER_ROW for each row of the listing, they
  are made fewer first: under keys that still hold several components, classes outside the largest are compared with
  one class inside it, another one under each key, and what that confirms is contracted too. Then the classes involved
  get a wide signature of WIDE two-bit minima, and a pair is formed under the first key that it shares only. The wide
  signature accepts nothing: it only stops pairs whose distance in it is above WIDE_RADIUS, which at a similarity of 0.75
  has a probability of about 1e-6.
- All rounds accept by size and RADIUS inside the join and confirm the survivors on their full sets, recomputed from
  the texts of the documents involved. A class's text is fetched by a hash of an id and the text, so rows that share an
  id, or have none, meet their own classes only.

Defined cases: null and blank texts have empty sets, linked with nothing; a text with fewer words than a shingle has
one shingle of all its words; equal ids are one document for component_id; a null id is never the smallest unless all
are null; empty tables give empty results. Texts are read whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches
from daybook.llm.components import components
from daybook.llm.listed import joined
from daybook.scratch import Scratch, small
from daybook.session import spread

CHUNKS = 16
RADIUS = 2 * CHUNKS - 1
SHINGLE, PERCENT = 5, 75
#: Rows of a list of ids that may be broadcast.
BROADCAST_ROWS = 500_000
#: Comparisons of the last round for each row under a key, beyond which they are prepared for.
PER_ROW = 2
_CHUNK = [f"c{i}" for i in range(CHUNKS)]
WIDE, WIDE_RADIUS = 1024, 251
_WORD = [f"w{i}" for i in range(WIDE // 32)]
#: Bits of a lane; its highest is 0 in signatures. All these highest bits.
_LANE = np.uint64(15)
_GUARDS = sum(1 << (15 * j + 14) for j in range(4))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_rng = np.random.Generator(np.random.PCG64(20240229))
_A = _rng.integers(0, 1 << 63, 4 * CHUNKS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, 4 * CHUNKS, dtype=np.uint64)
_WIDE_A = _rng.integers(0, 1 << 63, WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WIDE_B = _rng.integers(0, 1 << 63, WIDE, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text in UTF-8; A-Z count as lower-case."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = min(size, len(words))
    n = len(words) - run + 1
    out = np.full(n, run, np.uint64)
    for i in range(run):
        out = (out + hashes[i : i + n]) * _FACTOR
        out ^= out >> np.uint64(29)
    return np.unique(_mixed(out))


def signature(distinct: np.ndarray) -> np.ndarray:
    """CHUNKS words of four 14-bit minima each, in lanes of 15 bits; zeros for the empty set."""
    if not len(distinct):
        return np.zeros(CHUNKS, np.uint64)
    least = np.full(4 * CHUNKS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(distinct), 4096):
        part = distinct[None, i : i + 4096] * _A[:, None] + _B[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    lanes = ((least >> np.uint64(20)) & np.uint64(0x3FFF)).reshape(CHUNKS, 4) << (_LANE * np.arange(4, dtype=np.uint64))
    return np.bitwise_or.reduce(lanes, axis=1)


def wide_signature(distinct: np.ndarray) -> np.ndarray:
    """Two bits of each of WIDE minima, in words of 32 of them."""
    least = np.full(WIDE, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(distinct), 256):
        part = distinct[None, i : i + 256] * _WIDE_A[:, None] + _WIDE_B[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    pairs = ((least >> np.uint64(33)) & np.uint64(3)).reshape(-1, 32) << np.arange(0, 64, 2, dtype=np.uint64)
    return np.bitwise_or.reduce(pairs, axis=1).view(np.int64)


def _sums(distinct: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets have in common."""
    return tuple(int(x.sum(dtype=np.uint64).view(np.int64)) for x in (distinct, _mixed(distinct ^ _FACTOR)))


def _describe(size: int):
    def run(batches):
        for batch in batches:
            n, sums, sig = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, size)
                n.append(len(s)), sums.append(_sums(s)), sig.append(signature(s))
            signed = np.array(sig, np.uint64).reshape(-1, CHUNKS).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2), pa.array(n, pa.int64()), *(pa.array([x[k] for x in sums], pa.int64()) for k in (0, 1)),
                    *(pa.array(np.ascontiguousarray(c)) for c in signed.T),
                ],
                names=["doc_id", "hash", "n_shingles", "f1", "f2", *_CHUNK],
            )

    return run


def _keys() -> Column:
    """Every chunk under its four keys with one minimum left out: 6 bits say which, 45 hold the other three."""
    keys = []
    for i, c in enumerate(_CHUNK):
        for j in range(4):
            low = F.col(c).bitwiseAND(F.lit((1 << 15 * j) - 1).cast("long"))
            high = F.shiftleft(F.shiftrightunsigned(c, 15 * (j + 1)), 15 * j)
            keys.append(low.bitwiseOR(high).bitwiseOR(F.lit((4 * i + j) << 48)))
    return F.explode(F.array(*keys)).alias("key")


def _same(c: str) -> Column:
    """Of one chunk of a pair, the highest bit of each lane whose minima are equal. Names begin with a_ and b_."""
    return (F.lit(_GUARDS) - F.col("a_" + c).bitwiseXOR(F.col("b_" + c))).bitwiseAND(F.lit(_GUARDS))


def _sizes_allow(percent: int) -> Column:
    na, nb = F.col("a_n_shingles"), F.col("b_n_shingles")
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def _within_radius() -> Column:
    return reduce(Column.__add__, (F.bit_count(_same(c)) for c in _CHUNK)) >= 4 * CHUNKS - RADIUS


def _within_wide_radius() -> Column:
    wrong = None
    for w in _WORD:
        x = F.col("a_" + w).bitwiseXOR(F.col("b_" + w))
        n = F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
        wrong = n if wrong is None else wrong + n
    return wrong <= WIDE_RADIUS


def _first_shared(key: Column) -> Column:
    """Whether the pair shares no key before this one, in the order of the keys' first 6 bits."""
    firsts = []
    for i, c in enumerate(_CHUNK):
        one_error = [_GUARDS - (1 << (15 * j + 14)) for j in range(4)]
        tag = F.when(_same(c).isin(_GUARDS, one_error[0]), 4 * i)
        for j in range(1, 4):
            tag = tag.when(_same(c) == one_error[j], 4 * i + j)
        firsts.append(tag)
    return F.coalesce(*firsts) == F.shiftrightunsigned(key, 48)


def _over_sets(size: int, names: list[str], columns):
    """A step from (cid, n_shingles, f1, f2, text) to the class and the columns made from its set, of texts that are the class's."""

    def run(batches):
        for batch in batches:
            cid, n, f1, f2, texts = (c.to_pylist() for c in batch.columns)
            own, sets = [], []
            for k, text in enumerate(texts):
                s = shingles(text, size)
                if (len(s), *_sums(s)) == (n[k], f1[k], f2[k]):
                    own.append(cid[k]), sets.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *columns(sets)], names=["cid", *names])

    return run


def _set_column(sets):
    return [pa.array([s.tobytes() for s in sets], pa.binary())]


def _wide_columns(sets):
    words = np.array([wide_signature(s) for s in sets], np.int64).reshape(-1, len(_WORD))
    return [pa.array(np.ascontiguousarray(w)) for w in words.T]


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return run


class NearDuplicates:
    """The steps of one run; tables are written to the shared folder between them."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT):
        if percent < PERCENT:
            raise ValueError(f"the signatures are laid out for {PERCENT} percent and more")
        self.size, self.percent = size, percent
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "near-dedup")
        self.rows = docs.select(F.col(id_col).alias("doc_id"), F.encode(text_col, "UTF-8").alias("text")).withColumn("hash", F.xxhash64("doc_id", "text"))
        kind = self.rows.schema["doc_id"].dataType.simpleString()
        longs = ", ".join(f"{c} long" for c in ("n_shingles", "f1", "f2", *_CHUNK))
        with bounded_batches(self.spark):
            self.docs = self.scratch.save(self.rows.mapInArrow(_describe(size), f"doc_id {kind}, hash long, {longs}"), "docs")
        classes = (
            self.docs.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2")
            .agg(F.min("doc_id").alias("rep_id"), F.min("hash").alias("rep"), F.count(F.lit(1)).alias("members"), *(F.first(c).alias(c) for c in _CHUNK))
            .withColumn("cid", F.monotonically_increasing_id())
        )
        self.classes = self.scratch.save(classes, "classes")

    def _listed(self) -> DataFrame:
        """(key, cid, rep): classes under keys that several have, with the key's smallest class."""
        keys = spread(self.classes).select(_keys(), "cid")
        several = keys.groupBy("key").agg(F.min("cid").alias("rep"), F.max("cid").alias("last")).where("rep < last")
        return self.scratch.save(keys.join(several.select("key", "rep"), "key"), "listed")

    def _side(self, prefix: str) -> DataFrame:
        return self.classes.select(*(F.col(c).alias(prefix + c) for c in ("cid", "n_shingles", *_CHUNK)))

    def _from_texts(self, ids: DataFrame, names: list[str], types: str, columns, name: str) -> DataFrame:
        """(cid, columns) of the classes listed in ids, made from the text of one document of each."""
        wanted = self.classes.join(ids.select("cid").distinct(), "cid").select("rep", "cid", "n_shingles", "f1", "f2")
        wanted = self.scratch.save(wanted, f"{name}-wanted")
        texts = joined(self.rows.select(F.col("hash").alias("rep"), "text"), wanted, ["rep"], "inner", BROADCAST_ROWS)
        with bounded_batches(self.spark):
            made = texts.select("cid", "n_shingles", "f1", "f2", "text").mapInArrow(_over_sets(self.size, names, columns), f"cid long, {types}")
            # Repeated rows give a class the same columns several times; that does no harm.
            made = self.scratch.save(made, name)
        self.scratch.drop(f"{name}-wanted")
        return made

    def _confirmed(self, pairs: DataFrame, name: str, *used: str) -> DataFrame:
        """The pairs (u, v) of classes whose full sets are similar enough; used: tables that only the pairs are made of."""
        pairs = self.scratch.save(pairs, f"{name}-pairs")
        self.scratch.drop(*used)
        ids = pairs.select(F.col("u").alias("cid")).unionAll(pairs.select(F.col("v").alias("cid")))
        sets = self._from_texts(ids, ["shingles"], "shingles binary", _set_column, f"{name}-sets")
        u = sets.select(F.col("cid").alias("u"), F.col("shingles").alias("su"))
        v = sets.select(F.col("cid").alias("v"), F.col("shingles").alias("sv"))
        # With repeated rows pairs may repeat here; edges are made distinct later.
        with bounded_batches(self.spark):
            checked = pairs.join(v, "v").join(u, "u").select("u", "v", "su", "sv").mapInArrow(_confirm(self.percent), "u long, v long")
            edges = self.scratch.save(checked, f"{name}-edges")
        self.scratch.drop(f"{name}-sets", f"{name}-pairs")
        return edges

    def _near(self, pairs: DataFrame) -> DataFrame:
        """The distinct pairs (u, v) whose sizes and signatures allow the similarity."""
        pairs = pairs.distinct().join(self._side("a_"), F.col("u") == F.col("a_cid")).join(self._side("b_"), F.col("v") == F.col("b_cid"))
        return pairs.where(_sizes_allow(self.percent) & _within_radius()).select("u", "v")

    def _mixed(self, listed: DataFrame, edges: DataFrame, name: str) -> DataFrame:
        """(key, cid, rep, root, home) under keys that hold several components of edges; home is the largest of the key."""
        roots = components(edges, self.scratch, f"{name}-stars")
        rows = listed.join(roots, listed.cid == roots.node, "left").select("key", "cid", "rep", F.coalesce("root", "cid").alias("root"))
        rows = self.scratch.save(rows, f"{name}-rooted")
        by_root = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
        home = by_root.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("home"), F.count(F.lit(1)).alias("roots"))
        mixed = self.scratch.save(rows.join(home.where("roots > 1").select("key", "home"), "key"), f"{name}-mixed")
        self.scratch.drop(f"{name}-rooted")
        return mixed

    @staticmethod
    def _many(mixed: DataFrame) -> bool:
        """Whether the last round would compare more than PER_ROW pairs for each row under its keys."""
        by_key = mixed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("root") != F.col("home")).alias("outside"))
        rows, pairs = by_key.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("outside"))).first()
        return bool(rows) and pairs > PER_ROW * rows

    def _untested(self, mixed: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
        """Pairs under a key of a class outside its home and one of another component that the stars haven't compared, with columns of both."""
        outside = mixed.where("root <> home").select("key", F.col("cid").alias("a_cid"), F.col("root").alias("a_root"), "rep").join(a, "a_cid")
        others = mixed.select("key", F.col("cid").alias("b_cid"), F.col("root").alias("b_root"), (F.col("root") == F.col("home")).alias("b_home")).join(b, "b_cid")
        untested = (
            (F.col("l.key") == F.col("r.key")) & (F.col("a_root") != F.col("b_root"))
            & (F.col("b_home") | (F.col("a_cid") < F.col("b_cid"))) & (F.col("a_cid") != F.col("rep")) & (F.col("b_cid") != F.col("rep"))
        )
        return outside.alias("l").join(others.alias("r"), untested)

    def _rest(self, mixed: DataFrame) -> DataFrame:
        """The last round where it compares few pairs."""
        ids = self.classes.select("cid")
        pairs = self._untested(mixed, ids.withColumnRenamed("cid", "a_cid"), ids.withColumnRenamed("cid", "b_cid"))
        return self._near(pairs.select(F.least("a_cid", "b_cid").alias("u"), F.greatest("a_cid", "b_cid").alias("v")))

    def _wide_rest(self, mixed: DataFrame) -> DataFrame:
        """The last round behind a wide signature."""
        wide = self._from_texts(mixed, _WORD, ", ".join(f"{w} long" for w in _WORD), _wide_columns, "wide").dropDuplicates(["cid"])
        wide = self.scratch.save(self.classes.select("cid", "n_shingles", *_CHUNK).join(wide, "cid"), "wide-sides")
        a, b = (wide.select(*(F.col(c).alias(p + c) for c in wide.columns)) for p in ("a_", "b_"))
        near = _sizes_allow(self.percent) & _within_radius() & _within_wide_radius() & _first_shared(F.col("l.key"))
        return self._untested(mixed, a, b).where(near).select(F.least("a_cid", "b_cid").alias("u"), F.greatest("a_cid", "b_cid").alias("v")).distinct()

    def links(self) -> DataFrame:
        """(u, v): confirmed links between classes, enough of them to connect every two linked classes."""
        listed = self._listed()
        stars = listed.where("cid <> rep").select(F.col("rep").alias("u"), F.col("cid").alias("v"))
        edges = self._confirmed(self._near(stars), "star")
        mixed = self._mixed(listed, edges, "first")
        self.scratch.drop("listed")
        if self._many(mixed):
            home = mixed.where("root = home").groupBy("key").agg(F.min_by("cid", F.xxhash64("cid", "key")).alias("centre"))
            stars = mixed.where("root <> home").join(home, "key").select(F.least("cid", "centre").alias("u"), F.greatest("cid", "centre").alias("v"))
            edges = edges.unionAll(self._confirmed(self._near(stars), "home"))
            mixed = self._mixed(mixed.select("key", "cid", "rep"), edges, "second")
            self.scratch.drop("first-mixed")
            rest = self._wide_rest(mixed)
        else:
            rest = self._rest(mixed)
        return edges.unionAll(self._confirmed(rest, "rest", "first-mixed", "second-mixed", "wide", "wide-sides"))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept of every row."""
        roots = components(self.links(), self.scratch, "last")
        of = self.classes.join(roots, self.classes.cid == roots.node, "left").select(
            "n_shingles", "f1", "f2", "rep_id", "members", F.coalesce("root", "cid").alias("root"), F.col("root").isNotNull().alias("linked")
        )
        smallest = of.groupBy("root").agg(F.min("rep_id").alias("component_id"))
        named = of.where("linked or members > 1").join(smallest, "root").select("n_shingles", "f1", "f2", "component_id")
        named = self.scratch.save(named, "named")
        out = self.docs.select("doc_id", "n_shingles", "f1", "f2").join(small(named, BROADCAST_ROWS), ["n_shingles", "f1", "f2"], "left")
        out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        return self.scratch.result(out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest id reachable), kept."""
    return NearDuplicates(docs, id_col, text_col, size, percent).result()
