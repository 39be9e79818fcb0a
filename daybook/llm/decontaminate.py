"""Benchmark decontamination by a prefix-filtered set join with exact verification over item-sized windows.

A window is `window` consecutive words of a benchmark item (an item with fewer words is one window). A document's
word is hit if it lies in an occurrence of a window.

1. Items become a table of distinct windows, each with the hashes of its 5-word shingles (one shingle of all its words
   if it has fewer). A document can hold a window only if it holds every one of them.
2. One scan of the documents keeps what can matter: runs of words covered by shingles that a Bloom filter of all item
   shingles lets pass, in chunks of CHUNK positions with enough words around them to verify any window. The filter is
   bounded, whatever the number of items (see listed.py); past its bound more chunks pass, none is lost.
3. Rarity: occurrences of each item shingle in those chunks, which are all its occurrences. For exact containment a
   prefix of one shingle is necessary: each window keeps its rarest, and is gone if that occurs nowhere.
4. Join: chunk positions meet the prefixes by hash. A match at position p with offset o proposes the window at p - o, if
   it begins inside the chunk (positional bound) and ends inside it (length bound); its words are then compared.

The windows' tables are broadcast where counts of their rows and bytes prove them small; otherwise the same joins are
shuffled, chunk positions without their words, which are joined back to what is proposed. The driver holds the filter
only, and documents are scanned once in either way.

Defined cases: null text has no words and is never hit; null items likewise; a null item id counts as the empty
text; equal ids count once; repeated documents are rows like others; empty tables give no hits. Texts are whole, and
batches are cut between documents by size, so that long ones only make their own batch larger.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import bounded_batches, parts_of
from daybook.llm.listed import filter_of, passes
from daybook.scratch import Scratch

WINDOW, SHINGLE = 10, 5
#: Positions of a chunk.
CHUNK = 64
#: Rows and bytes of a table of windows that may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 1 << 25
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Bytes to words: A-Z become lower-case, other ASCII but 0-9 and a-z separates, all else belongs to words.
_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of so many words; runs of different sizes differ too."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = (out + hashes[i : i + n]) * _FACTOR
        out ^= out >> np.uint64(29)
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(32))


_WINDOWS_SQL = "item string, window string, length int, hashes array<long>"


def _windows(window: int, shingle: int):
    """The windows of items (id, text) with their shingles."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text or b"")
                if not words:
                    continue
                length, size = min(window, len(words)), min(shingle, len(words))
                hashes, each = shingle_hashes(word_hashes(words), size).view(np.int64), length - size + 1
                for a in range(0, len(words) - length + 1, 10_000):
                    starts = range(a, min(a + 10_000, len(words) - length + 1))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * len(starts), pa.string()), pa.array([b" ".join(words[i : i + length]).decode() for i in starts], pa.string()),
                            pa.array([length] * len(starts), pa.int32()), pa.array([hashes[i : i + each] for i in starts], pa.list_(pa.int64())),
                        ],
                        names=["item", "window", "length", "hashes"],
                    )

    return run


_SCANNED = ("row", "doc_id", "n_words", "first", "words", "at", "hashes")


def _scan(shared, sizes: list[int], window: int):
    """A row for each document with its words, and one for each chunk with its words, positions and shingles."""

    def run(batches):
        filter_, reach = shared.value, window - 1
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in parts_of([t or b"" for t in texts]):
                words, begin = [], [0]
                for text in texts[a:b]:
                    words += words_of(text) if text else ()
                    words.append(b"")  # between texts, so that no run goes over two of them
                    begin.append(len(words))
                begin = np.array(begin, np.int64)
                hashes = word_hashes(words)
                gaps = np.zeros(len(words) + 1, np.int32)
                gaps[begin[1:]] = 1
                gaps = np.cumsum(gaps)
                covered, at, of = np.zeros(len(words) + 1, np.int32), [], []
                for size in sizes:
                    h = shingle_hashes(hashes, size)
                    # A shingle may not hold the gap behind its text.
                    found = np.flatnonzero(passes(filter_, h))
                    found = found[gaps[found] == gaps[found + size]]
                    covered[found] += 1
                    covered[found + size] -= 1
                    at.append(found), of.append(h[found])
                at, of = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((at, np.int64), (of, np.uint64)))
                order = np.argsort(at, kind="stable")
                at, of = at[order], of[order].view(np.int64)
                turn = np.diff(np.concatenate(([0], (np.cumsum(covered[:-1]) > 0).astype(np.int8), [0])))
                doc, first, said, places, held = [], [], [], [], []
                for s, e in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True):
                    d = int(np.searchsorted(begin, s, "right")) - 1
                    for c in range(s, e, CHUNK):
                        i, j = np.searchsorted(at, (c, min(c + CHUNK, e)))
                        if i < j:
                            low = max(s, c - reach)
                            doc.append(a + d), first.append(low - int(begin[d]))
                            said.append(b" ".join(words[low : min(e, c + CHUNK + reach)]).decode())
                            places.append(at[i:j] - low), held.append(of[i:j])
                n, k = b - a, len(doc)
                rows = pa.array([*range(a, b), *doc], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows), pa.array([*(np.diff(begin) - 1), *[None] * k], pa.int64()),
                        pa.array([*[None] * n, *first], pa.int32()), pa.array([*[None] * n, *said], pa.string()),
                        pa.array([*[None] * n, *places], pa.list_(pa.int32())), pa.array([*[None] * n, *held], pa.list_(pa.int64())),
                    ],
                    names=list(_SCANNED),
                )

    return run


def _few(df: DataFrame, text: str) -> bool:
    """Whether df may be broadcast by its rows and the bytes of its text column."""
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def _spans(found: DataFrame) -> DataFrame:
    """row, spans: the union of the intervals [start, end) of each row, those that overlap or touch made one."""
    order = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.select("row", "start", "end").distinct().withColumn("apart", F.when(F.col("start") <= reach, 0).otherwise(1))
    runs = runs.withColumn("run", F.sum("apart").over(order)).groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """doc_id, n_words, spans (of hit words), items (their ids as sorted text) of every row of docs."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    listed = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.encode(item_text_col, "UTF-8").alias("text")).distinct()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.encode(text_col, "UTF-8").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    with bounded_batches(spark):
        held = scratch.save(listed.mapInArrow(_windows(window, shingle), _WINDOWS_SQL), "held")
        windows = scratch.save(held.groupBy("window", "length").agg(F.first("hashes").alias("hashes")), "windows")
        hashes = scratch.save(windows.select(F.explode("hashes").alias("hash")).distinct(), "hashes")
        sizes = sorted({min(shingle, r[0]) for r in windows.select("length").distinct().collect()})
        shared = spark.sparkContext.broadcast(filter_of(hashes, hashes.count()))
        scanned = scratch.save(
            rows.mapInArrow(
                _scan(shared, sizes, window),
                f"row long, doc_id {kind}, n_words long, first int, words string, at array<int>, hashes array<long>",
            ),
            "scanned",
        )
        shared.unpersist()
    chunks = scanned.where("first is not null")
    rarity = chunks.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    each = windows.select("window", "length", F.posexplode("hashes").alias("offset", "hash")).join(rarity, "hash", "left")
    rarest = each.groupBy("window", "length").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "offset")).alias("r"))
    prefixes = scratch.save(rarest.where("r.n > 0").select("window", "length", "r.hash", "r.offset"), "prefixes")
    listed_at = F.inline(F.arrays_zip("at", "hashes")).alias("at", "hash")
    if _few(prefixes, "window"):
        proposed = chunks.select("row", "first", "words", listed_at).join(F.broadcast(prefixes), "hash")
    else:
        proposed = chunks.select("row", "first", listed_at).join(prefixes, "hash").join(chunks.select("row", "first", "words"), ["row", "first"])
    begin, said = F.col("at") - F.col("offset"), F.split("words", " ")
    inside = (begin >= 0) & (begin + F.col("length") <= F.size(said))
    same = F.array_join(F.slice(said, begin + 1, F.col("length")), " ") == F.col("window")
    found = proposed.where(F.when(inside, same).otherwise(F.lit(False)))
    start = F.col("first") + begin
    found = scratch.save(found.select("row", start.alias("start"), (start + F.col("length")).alias("end"), "window"), "found")
    holders = scratch.save(held.select("window", "item").distinct().join(found.select("window").distinct(), "window", "left_semi"), "holders")
    holders = F.broadcast(holders) if _few(holders, F.concat("window", "item")) else holders
    of = found.select("row", "window").distinct().join(holders, "window").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    every = scanned.where("first is null").select("row", "doc_id", "n_words")
    out = every.join(_spans(found), "row", "left").join(of, "row", "left")
    return scratch.result(
        out.select(
            "doc_id", "n_words", F.coalesce("spans", F.expr("cast(array() AS array<struct<start:int,end:int>>)")).alias("spans"),
            F.coalesce("items", F.expr("cast(array() AS array<string>)")).alias("items"),
        )
    )


def digest_columns(found: DataFrame) -> DataFrame:
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + (s.end - s.start))")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
