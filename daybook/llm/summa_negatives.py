"""Hard negatives by a block matrix product on a two-dimensional grid.

Anchors times rows is one large matrix product, which is laid out as a grid: blocks of ANCHORS anchors by blocks of ROWS
rows, and the dimensions in chunks of CHUNK. A place of the coarse grid is a panel of up to PANEL blocks of anchors and a
group of up to TOGETHER blocks of rows. The pieces (block by chunk) of both go there in one shuffle, without a join, so that
nothing is broadcast. There the pieces of the rows pass by one after another while the anchors' are held: every meeting adds
a partial product to a score tile of int64 numbers, which is reduced at the last chunk to the best few of each anchor. So
tiles never leave the task that makes them, and no table ever holds the scores.

It takes two passes. Rows are in blocks by label, so only the tiles whose blocks share a label are made for the positives;
the second pass makes the others (and the few mixed ones), each anchor bringing the window of scores that each of its
positives allows. What the places leave is merged by a ranking with a limit, which Spark applies before and after its shuffle.

Blocks have a fixed number of rows whatever labels they hold, so a label with a third of all rows, or equal vectors in any
number, make no block or task larger. Positions in blocks come from counts by partition of a written table.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; shorter vectors count
as filled up with zeros; of equal scores the smaller id comes first, null ids last; a null id is no anchor; rows that share
an id are rows of their own, and an anchor is no positive of itself only; empty tables and anchors without positives give no
rows. Scores are exact; components so large that they might not be raise an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import bounded_batches
from daybook.scratch import Scratch

#: Anchors and rows of a block, dimensions of a chunk, and blocks of rows in a group at most.
ANCHORS, ROWS, CHUNK, TOGETHER = 128, 1024, 32, 64
#: Blocks of anchors in a panel at most, and bytes of their components; groups that there are at least, if there are so many
#: blocks of rows; partitions at most.
PANEL, PANEL_BYTES, GROUPS, PARTITIONS = 32, 32 << 20, 24, 10_000
#: Components are floor(SCALE * x).
SCALE = 256
#: Beyond all scores, which stay under 2**62.
_FAR, _LAST = 2**62, np.iinfo(np.int64).max
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass
class Rule:
    """Which rows are anchors, how many positives and negatives each has, and between which percentages of the positive's score."""

    every: int = 100
    positives: int = 5
    negatives: int = 10
    least: int = 30
    most: int = 90


def narrow(numbers: np.ndarray) -> bytes:
    """int64 numbers in as few bytes as hold them; the first byte says how many."""
    low, high = (int(numbers.min()), int(numbers.max())) if numbers.size else (0, 0)
    for kind in (np.int16, np.int32, np.int64):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return bytes([np.dtype(kind).itemsize]) + numbers.astype(kind).tobytes()
    raise ValueError("numbers of more than 64 bits")


def wide(data: bytes) -> np.ndarray:
    """What narrow() wrote, as int64."""
    return np.frombuffer(data, f"<i{data[0]}", offset=1).astype(np.int64)


def _pack(chunks: int, width: int, more: list[str]):
    """A step from the rows of a block to its pieces, one for each chunk of dimensions; the first carries what isn't a number of the product."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids = group["vec_id"].to_pandas()
        order = np.lexsort((group["row"].to_numpy(), ids.fillna(0).to_numpy().astype(np.int64), ids.isna().to_numpy()))
        group = group.take(pa.array(order))
        lists, n = group["values"].combine_chunks(), group.num_rows
        lengths = lists.value_lengths().to_numpy()
        matrix = np.zeros((n, chunks * width), np.int64)
        matrix[np.arange(chunks * width) < lengths[:, None]] = lists.flatten().to_numpy()
        labels = group["label"].to_numpy()
        first = {c: [group[c].to_pylist(), *[None] * (chunks - 1)] for c in ("vec_id", "label", "row", *more)}
        return pa.table(
            {
                "block": [group["block"][0].as_py()] * chunks, "chunk": list(range(chunks)), "low": [labels.min()] * chunks, "high": [labels.max()] * chunks,
                "piece": [narrow(matrix[:, k * width : (k + 1) * width]) for k in range(chunks)], **first,
            },
            schema=pa.schema([("block", pa.int64()), ("chunk", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("piece", pa.binary()), *((c, _KINDS[c]) for c in first)]),
        )

    return run


_WINDOWS = pa.list_(pa.list_(pa.list_(pa.int64())))
_KINDS = {"vec_id": pa.list_(pa.int64()), "label": pa.list_(pa.int64()), "row": pa.list_(pa.int64()), "windows": _WINDOWS}
_PIECE = "block long, chunk int, low long, high long, piece binary, vec_id array<long>, label array<long>, row array<long>"


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact partial tile of two pieces."""
    exact = np.float64 if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53 else np.int64
    return (a.astype(exact) @ b.T.astype(exact)).astype(np.int64)


class _Best:
    """The best few rows of each window of one block of anchors: the largest scores, of equal ones the smallest ids.

    A window has a key, the place of its anchor in the block, and its ends; least is what a score must reach to come in yet.
    """

    def __init__(self, most: int, of: np.ndarray, key: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.most, self.of, self.key, self.least, self.high = most, of, key, low, high
        self.found = np.zeros((5, 0), np.int64)  # window, score, id, whether it is null, row

    def bounds(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each of n anchors: the least and the largest score that any of its windows takes."""
        least, most = np.full((n, 1), _LAST), np.full((n, 1), -_LAST)
        np.minimum.at(least[:, 0], self.of, self.least)
        np.maximum.at(most[:, 0], self.of, self.high)
        return least, most

    def add(self, window: np.ndarray, score: np.ndarray, at: np.ndarray, b: dict) -> None:
        found = np.concatenate([self.found, [window, score, b["id"][at], b["none"][at], b["row"][at]]], axis=1)
        found = found[:, np.lexsort((found[4], found[2], found[3], -found[1], found[0]))]
        n = np.bincount(found[0], minlength=len(self.key))
        nth = np.arange(found.shape[1]) - np.repeat(np.cumsum(n) - n, n)
        self.found = found[:, nth < self.most]
        full, n = n >= self.most, np.minimum(n, self.most)
        self.least[full] = self.found[1, np.cumsum(n)[full] - 1]


def _ids(values: list) -> tuple[np.ndarray, np.ndarray]:
    return np.array([0 if v is None else v for v in values], np.int64), np.array([v is None for v in values], np.int64)


def _windows(a: dict) -> list[np.ndarray]:
    """Of a block of anchors' windows: anchor, key, low, high; one without ends for each anchor where they have none."""
    if "windows" not in a:
        n = len(a["row"])
        return [np.arange(n), a["row"], np.full(n, -_FAR), np.full(n, _FAR)]
    return list(np.array([(i, *w) for i, windows in enumerate(a["windows"]) for w in windows], np.int64).reshape(-1, 4).T.copy())


def _choose(tile: np.ndarray, allowed: np.ndarray, b: dict, best: _Best) -> None:
    """The best few scores of a tile for each window. Only those that may come in yet are sorted, soon a few of each anchor."""
    least, most = best.bounds(len(tile))
    anchor, column = np.nonzero(allowed & (tile >= least) & (tile <= most))
    if not len(anchor):
        return
    n = np.bincount(anchor, minlength=len(tile))
    nth = np.arange(len(anchor)) - np.repeat(np.cumsum(n) - n, n)
    negated, columns = np.full((len(tile), n.max()), _LAST), np.zeros((len(tile), n.max()), np.int64)
    negated[anchor, nth], columns[anchor, nth] = -tile[anchor, column], column
    # Equal ones stay in the order of columns, which is that of ids.
    order = np.argsort(negated, axis=1, kind="stable")
    negated, columns = (np.take_along_axis(x, order, axis=1) for x in (negated, columns))
    own = negated[best.of]
    start, end = (own < -best.high[:, None]).sum(axis=1), (own <= -best.least[:, None]).sum(axis=1)
    nth = start[:, None] + np.arange(best.most)
    window, k = np.nonzero(nth < end[:, None])
    if len(window):
        of, nth = best.of[window], nth[window, k]
        best.add(window, -negated[of, nth], columns[of, nth], b)


def _positives(a: dict, b: dict) -> np.ndarray:
    return (a["label"][:, None] == b["label"]) & (a["row"][:, None] != b["row"])


def _negatives(a: dict, b: dict) -> np.ndarray:
    return a["label"][:, None] != b["label"]


def _share_a_label(a: dict, b: dict) -> bool:
    return a["low"] <= b["high"] and b["low"] <= a["high"]


def _several_labels(a: dict, b: dict) -> bool:
    return not a["low"] == a["high"] == b["low"] == b["high"]


def _meet(chunks: int, width: int, most: int, wanted, allowed):
    """A step over the pieces of one place of the coarse grid after another: the anchors' first, then the rows' by block and chunk."""

    def emit(best: _Best):
        window, score, ids, none, row = best.found
        return pa.RecordBatch.from_arrays(
            [pa.array(best.key[window]), pa.array(score), pa.array(ids, mask=none.astype(bool)), pa.array(row)], names=["key", "score", "vec_id", "row"]
        )

    def block(batch: pa.RecordBatch, k: int) -> dict:
        out = {n: batch.column(n)[k].as_py() for n in ("low", "high", "vec_id", "label", "row", "windows") if n in batch.schema.names}
        out["id"], out["none"] = _ids(out.pop("vec_id"))
        return out | {n: np.array(out[n], np.int64) for n in ("label", "row")}

    def run(batches):
        place, anchors = None, []
        for batch in batches:
            panel, group, side, chunk = (batch.column(n).to_pylist() for n in ("panel", "group", "side", "chunk"))
            for k in range(batch.num_rows):
                if place != (panel[k], group[k]):
                    yield from (emit(a["best"]) for a in anchors)
                    place, anchors = (panel[k], group[k]), []
                piece = wide(batch.column("piece")[k].as_py()).reshape(-1, width)
                if side[k] == 0:
                    if chunk[k] == 0:
                        anchors.append((a := block(batch, k)) | {"pieces": [], "best": _Best(most, *_windows(a))})
                    anchors[-1]["pieces"].append(piece)
                    continue
                if chunk[k] == 0:
                    b = block(batch, k)
                    tiles = [(a, np.zeros((len(a["row"]), len(b["row"])), np.int64)) for a in anchors if wanted(a, b)]
                for a, tile in tiles:
                    tile += _product(a["pieces"][chunk[k]], piece)
                    if chunk[k] == chunks - 1:
                        _choose(tile, allowed(a, b), b, a["best"])
        yield from (emit(a["best"]) for a in anchors)

    return run


class Mining:
    """The steps of one run; tables are written to the shared folder between them."""

    def __init__(self, rows: DataFrame, rule: Rule, id_col: str, vector_col: str, label_col: str):
        self.spark, self.rule = rows.sparkSession, rule
        self.scratch = Scratch(self.spark, "negatives")
        x = F.col(vector_col).cast("array<double>")
        unfit = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
        plain = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), x.alias("x"))
        plain = plain.where(F.col("label").isNotNull() & F.col("x").isNotNull() & ~unfit)
        largest, self.dims = plain.agg(
            F.max(F.aggregate("x", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v)))), F.coalesce(F.max(F.size("x")), F.lit(0))
        ).first()
        if (SCALE * (largest or 0.0) + 1) ** 2 * max(1, self.dims) >= 2**62:
            raise ValueError("components are too large for exact scores of 64 bits")
        self.chunks = max(1, -(-self.dims // CHUNK))
        moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
        values = F.transform("x", lambda v: F.floor(v * SCALE))
        self.rows, self.row_blocks = self._in_blocks(plain.select("vec_id", moved.alias("label"), values.alias("values")), ROWS, "rows")
        anchors = self.rows.where(F.col("vec_id") % rule.every == 0).select("vec_id", "label", "values", F.col("row").alias("own"))
        anchors, self.anchor_blocks = self._in_blocks(anchors, ANCHORS, "anchors")
        # What identifies an anchor is its place among all rows.
        self.anchors = anchors.drop("row").withColumnRenamed("own", "row")
        self.panels = -(-self.anchor_blocks // max(1, min(PANEL, PANEL_BYTES // (8 * ANCHORS * CHUNK * self.chunks))))
        self.groups = max(min(GROUPS, self.row_blocks), -(-self.row_blocks // TOGETHER))

    def _in_blocks(self, rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
        """rows with a number (row) and a block of so many rows, of few labels each; and how many blocks there are."""
        rows = rows.withColumn("mixed", F.xxhash64("vec_id", "values")).repartitionByRange("label", "mixed").sortWithinPartitions("label", "mixed").drop("mixed")
        stored = self.scratch.save(rows.withColumn("row", F.monotonically_increasing_id()), name)
        part, nth = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
        # One number for each partition.
        sizes = sorted((r[0], r[1]) for r in stored.groupBy(part).agg(F.count(F.lit(1))).collect())
        ends = np.cumsum([n for _, n in sizes]).tolist() or [0]
        starts = self.spark.createDataFrame([(p, e - n) for (p, n), e in zip(sizes, ends, strict=False)], "part long, start long")
        placed = stored.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("block", F.floor((F.col("start") + nth) / size)).drop("part", "start")
        return placed, -(-ends[-1] // size)

    def _pieces(self, rows: DataFrame, *more: str) -> DataFrame:
        schema = _PIECE + "".join(f", {c} array<array<array<long>>>" for c in more)
        return rows.select("block", "vec_id", "label", "row", "values", *more).groupBy("block").applyInArrow(_pack(self.chunks, CHUNK, list(more)), schema)

    def _best(self, a: DataFrame, b: DataFrame, most: int, wanted, allowed) -> DataFrame:
        """The best few of each key, from the allowed scores of the wanted tiles of blocks of anchors and of rows."""
        of = lambda blocks, parts: F.floor(F.col("block") * parts / blocks)
        every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>"))
        a = a.withColumns({"side": F.lit(0), "panel": of(self.anchor_blocks, self.panels)}).withColumn("group", every(self.groups))
        b = b.withColumns({"side": F.lit(1), "group": of(self.row_blocks, self.groups)}).withColumn("panel", every(self.panels))
        # Twice as many partitions as places, so that few get several.
        met = a.unionByName(b, allowMissingColumns=True).repartition(min(PARTITIONS, 2 * self.panels * self.groups), "panel", "group")
        met = met.sortWithinPartitions("panel", "group", "side", "block", "chunk")
        found = met.mapInArrow(_meet(self.chunks, CHUNK, most, wanted, allowed), "key long, score long, vec_id long, row long")
        order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)

    def result(self) -> DataFrame:
        if not self.row_blocks or not self.anchor_blocks:
            return self.scratch.result(self.spark.createDataFrame([], RESULT))
        rule = self.rule
        with bounded_batches(self.spark):
            rows = self.scratch.save(self._pieces(self.rows), "pieces")
            found = self._best(self._pieces(self.anchors), rows, rule.positives, _share_a_label, _positives)
            # A key for each anchor and positive; places of rows leave room for it.
            key = F.col("key") * rule.positives + F.col("rank") - 1
            found = found.select(F.col("key").alias("anchor"), key.alias("key"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
            positives = self.scratch.save(found, "positives")
            low, high = (F.expr(f"cast({f}(positive_score * {p} / cast(100 AS decimal(3))) AS bigint)") for f, p in (("ceil", rule.least), ("floor", rule.most)))
            windows = positives.select("anchor", F.array("key", low, high).alias("window")).groupBy("anchor").agg(F.collect_list("window").alias("windows"))
            # Tables that grow with the anchors are merged, never broadcast, however small their files are.
            anchors = self.anchors.join(windows.hint("merge"), F.col("row") == F.col("anchor"))
            found = self._best(self._pieces(anchors, "windows"), rows, rule.negatives, _several_labels, _negatives)
            found = self.scratch.save(found, "negatives")
        named = positives.join(self.anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")).hint("merge"), "anchor")
        return self.scratch.result(
            found.join(named.hint("merge"), "key").select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
        )


def mine(rows: DataFrame, rule: Rule | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive."""
    return Mining(rows, rule or Rule(), id_col, vector_col, label_col).result()
