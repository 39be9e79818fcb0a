"""Best-fit packing of documents into token sequences with several capacities.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths). A piece of
n tokens takes the vector (n, 1, n * n), so pieces of one length are alike, and the packing of any number of pieces
is decided by how many there are of each length:

1. Tasks encode their documents, cut those that are too long, and number the pieces of each length. Those rows, which
   hold no text, are written once.
2. The counts by length (at most `tokens` of them) go to the driver, which packs lengths in decreasing order. Open
   sequences with equal residuals form one class, so that a step places a whole run of equal pieces. Among the
   classes in which a piece fits every capacity, either the weighted norm of the residual after placing is least
   (`norm`), or the weighted dot product of the piece with the used share is greatest (`dot`). The work depends on the
   number of lengths, not of documents.
3. A piece finds its place from its length and its number among the pieces of that length.

A weight is the share of sequences that its capacity would need by itself, so a capacity weighs as much as it is
scarce. That holds too for capacities that the token capacity implies (as many documents as tokens, the square of the
tokens), which can't bind: sequences that have used much of their attention cost are then filled sooner.

Tokens are those of the tokenizers library with its defaults, special strings inside a text included. Where the file
proves to be byte-level BPE whose merges are in the order of their ids, texts of settled characters without special
strings are encoded with the same ranks by tiktoken, which is four times as fast; all others by tokenizers itself.

Defined cases: a null text is empty and holds just the separator; equal texts and repeated rows are pieces each; an
empty table gives no rows; a text of any length is encoded whole and then cut.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daybook.llm.common import bounded_batches, parts_of
from daybook.scratch import Scratch

#: How byte-level BPE cuts a text into pre-tokens (a fixed value of the library).
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that both libraries put in the same classes (tests hold them against each other one by one).
_SETTLED = (
    "\x00-\u0220\u0222-\u0233\u0391-\u03a1\u03a3-\u03ce\u0400-\u0481\u048a-\u04c4\u05d0-\u05ea\u0621-\u063a\u0641-\u064a"
    "\u2010-\u2027\u2030-\u2046\u20a0-\u20af\u3041-\u3094\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
)
_OTHER = re.compile(f"[^{_SETTLED}]")
#: White space so long that a backtracking matcher could give up; only looked for in texts this long.
_LONG, _LONG_RUN = 500_000, re.compile("\\s{4096}")


class Encoder:
    """Token ids of texts as little-endian 32-bit words; one per worker process."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.fast = self._same_ranks(spec)

    @staticmethod
    def _same_ranks(spec: dict):
        """A faster encoder with the same ids, if the file proves to be one that merges in the order of ids."""
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        by_bytes = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        if spec.get("normalizer") or not by_bytes or model.get("type") != "BPE" or not plain:
            return None
        # Byte-level files write printable bytes as themselves and the others as the characters from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = (b for b in range(256) if b not in printable)
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in k): v for k, v in model["vocab"].items() if k not in special}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        in_order = all(model["vocab"].get("".join(m)) == 256 + i for i, m in enumerate(merges))
        if not in_order or len(ranks) != 256 + len(model["merges"]) or sorted(ranks.values()) != list(range(len(ranks))):
            return None
        import tiktoken

        return tiktoken.Encoding("same-ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        settled = self.fast and not _OTHER.search(text) and not any(s in text for s in self.special)
        if settled and (len(text) < _LONG or not _LONG_RUN.search(text)):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        words = array("I", ids)
        if sys.byteorder == "big":
            words.byteswap()
        return words.tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(tokenizer_file: str) -> Encoder:
    if tokenizer_file not in _encoders:
        _encoders[tokenizer_file] = Encoder(tokenizer_file)
    return _encoders[tokenizer_file]


def pieces(ids: bytes, tokens: int, separator: int = 0) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of a document's pieces, the separator included; only the first may be shorter."""
    ids += separator.to_bytes(4, "little")
    n = len(ids) // 4
    ends = range(n % tokens or tokens, n + 1, tokens) if n > tokens else [n]
    out, start = [], 0
    for end in ends:
        out.append((start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
        start = end
    return out


def _cut(tokenizer_file: str, tokens: int):
    def run(batches):
        encode, task = encoder(tokenizer_file).encode, TaskContext.get().partitionId()
        seen = np.zeros(tokens + 1, np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in parts_of(texts, 1 << 21):
                doc, number, start, length, crc, rank = [], [], [], [], [], []
                for i in range(a, b):
                    for k, (s, n, c) in enumerate(pieces(encode(texts[i]), tokens)):
                        doc.append(i), number.append(k), start.append(s), length.append(n), crc.append(c)
                        rank.append(seen[n])
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(doc), pa.int32()),
                        pa.array(rank, pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"],
                )

    return run


def plan(
    counts: dict[int, int], tokens: int, documents: int, cost: int, rule: str = "norm"
) -> tuple[np.ndarray, int]:
    """Placements of pieces counted by length, and the number of sequences.

    A placement is (length, first number, per sequence, first sequence, sequences, offset): pieces of that length
    from that number on go to these sequences in turn, so many to each, from that offset. Sorted by its first two.
    """
    capacity = np.array([tokens, documents, cost], np.float64)
    need = np.array([sum(n * c for n, c in counts.items()), sum(counts.values()), sum(n * n * c for n, c in counts.items())]) / capacity
    weight = need / max(need.max(), 1e-300)
    #: Residual (tokens, documents, cost) to [first sequence, sequences] runs.
    open_: dict[tuple[int, int, int], list[list[int]]] = {}
    out, made = [], 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, number = counts[length], 0
        vector = np.array([length, 1, length * length], np.int64)
        keys = list(open_)
        residual = np.array(keys, np.int64).reshape(-1, 3)
        fits = np.flatnonzero((residual >= vector).all(axis=1))
        if len(fits):
            r = residual[fits]
            part = ((r - vector) / capacity) ** 2 if rule == "norm" else -(vector / capacity) * (1 - r / capacity)
            # A sequence that has taken a piece is, for more of the same, at least as good as before: fill each in turn.
            queue = [keys[fits[i]] for i in np.lexsort((r[:, 2], r[:, 1], r[:, 0], (weight * part).sum(axis=1)))]
        else:
            queue = []
        fresh = (tokens, documents, cost)
        if length > tokens or length * length > cost or documents < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        for key in [*queue, fresh]:
            most = min(key[0] // length, key[1], key[2] // (length * length))
            while left:
                each = min(most, left)
                runs = open_.get(key) if key != fresh else None
                if key == fresh:
                    run = [made, max(1, left // each)]
                    made += run[1]
                elif runs:
                    run = runs.pop()
                    used = min(run[1], max(1, left // each))
                    if used < run[1]:
                        runs.append([run[0] + used, run[1] - used])
                    run = [run[0], used]
                else:
                    break
                out.append((length, number, each, run[0], run[1], tokens - key[0]))
                number += each * run[1]
                left -= each * run[1]
                after = (key[0] - each * length, key[1] - each, key[2] - each * length * length)
                if after[0] > 0 and after[1] > 0 and after[2] > 0:
                    open_.setdefault(after, []).append(run)
            if key != fresh and not open_.get(key):
                open_.pop(key, None)
            if not left:
                break
    return np.array(sorted(out), np.int64).reshape(-1, 6), made


def _place(shared):
    def run(batches):
        placements = shared.value
        keys = placements[:, 0] * (1 << 42) + placements[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            p = placements[np.searchsorted(keys, length * (1 << 42) + rank, "right") - 1]
            nth = rank - p[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(p[:, 3] + nth // p[:, 2]), pa.array(p[:, 5] + nth % p[:, 2] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return run


def pack(
    docs: DataFrame, tokenizer_file: str, tokens: int = 2048, documents: int | None = None, cost: int | None = None,
    rule: str = "norm", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    documents and cost: capacities besides the tokens; by default what the tokens imply. cost must allow one piece of
    `tokens` tokens. tokenizer_file is opened where the tasks run.
    """
    spark = docs.sparkSession
    documents, cost = documents or tokens, cost or tokens * tokens
    if rule not in ("norm", "dot"):
        raise ValueError(rule)
    scratch = Scratch(spark, "packing")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    with bounded_batches(spark):
        cut = scratch.save(
            rows.mapInArrow(
                _cut(tokenizer_file, tokens),
                f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, rank long",
            ),
            "pieces",
        )
    by_task = scratch.save(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    based = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row for each length: at most `tokens`.
    counts = {r[0]: r[1] for r in by_task.groupBy("length").agg(F.sum("n")).collect()}
    placements, _ = plan(counts, tokens, documents, cost, rule)
    # The bases grow with the number of tasks, so they are never broadcast.
    ranked = cut.join(based.hint("merge"), ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("rank")).alias("rank")
    )
    shared = spark.sparkContext.broadcast(placements)
    placed = scratch.result(
        ranked.mapInArrow(
            _place(shared), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
        )
    )
    shared.unpersist()
    return placed
