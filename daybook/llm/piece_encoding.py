"""Exact encoding by a SentencePiece BPE model, by backtracking, and decoding.

The library merges the best pair of neighbours again and again. Here tokens are found from left to right instead:

- An Aho-Corasick automaton of all pieces gives the pieces that begin at each position; the longest is tried first.
- A piece may follow another only if merging the two pieces' characters alone gives these two pieces again. Which merges
  happen inside a stretch doesn't depend on what lies outside, as long as nothing merges across its ends. So a sequence
  of pieces in which all neighbours fit, and whose first piece merges to itself, is the library's result, and the only one.
- If nothing fits, the last piece is taken back for the next shorter one. Of any prefix there is at most one sequence, so
  a position from which nothing led on never will: a bitfield holds these positions, and work grows with the text's length.

A text is cut before each run of word marks if the vocabulary proves that no merge crosses there (no piece has a mark after
another character, and the mark is a piece). Each part is then encoded by itself, and remembered by the worker. Characters
outside the vocabulary are symbols that may fit too; in the end they become their bytes, or unknowns, one for each run.

Decoding joins the pieces' texts, marks as spaces; the first piece's first mark goes. Bytes that are no UTF-8 become one
replacement character each.

Defined cases: null counts as the empty text, which has the end id only; texts are read whole; special strings inside a
text are ordinary text; repeated rows are encoded each. Models that change texts before encoding, or that have pieces
defined by users or marked as unused, are refused.
"""

from __future__ import annotations

import codecs
import re
import struct
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches
from daybook.llm.token_counts import MARK, model_fields, words_are_independent
from daybook.scratch import Scratch

#: Parts that a worker remembers (two generations of this many), the longest of them, and pairs of pieces.
REMEMBERED, LONGEST, PAIRS = 500_000, 64, 500_000
# Kinds of pieces in the model file, fields of its trainer's specification, what an unknown is decoded to.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_TRAINER, _BYTE_FALLBACK, _END_PIECE, _UNKNOWN_SURFACE = 2, 35, 47, 44


class Vocabulary:
    """What a model file says."""

    def __init__(self, model: bytes):
        if not words_are_independent(model):
            raise ValueError("the model isn't BPE, or changes texts before it encodes them")
        trainer = next((dict(model_fields(v)) for n, v in model_fields(model) if n == _TRAINER), {})
        pieces = [dict(model_fields(v)) for n, v in model_fields(model) if n == 1]
        self.texts = [p[1].decode() for p in pieces]
        self.kinds = np.array([p.get(3, _NORMAL) for p in pieces])
        if not np.isin(self.kinds, (_NORMAL, _UNKNOWN, _CONTROL, _BYTE)).all():
            raise ValueError("the model has pieces defined by users, or unused ones")
        scores = [struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces]
        self.score = {self.texts[i]: scores[i] for i in np.flatnonzero(self.kinds == _NORMAL)}
        self.id = {self.texts[i]: int(i) for i in np.flatnonzero(self.kinds == _NORMAL)}
        self.unknown = int(np.flatnonzero(self.kinds == _UNKNOWN)[0])
        self.byte = {int(self.texts[i][3:5], 16): int(i) for i in np.flatnonzero(self.kinds == _BYTE)} if trainer.get(_BYTE_FALLBACK) else {}
        self.end = self.texts.index(trainer.get(_END_PIECE, b"</s>").decode())
        self.unknown_surface = trainer.get(_UNKNOWN_SURFACE, " ⁇ ".encode())


class _Symbols(dict):
    """Characters that are pieces, to their ids; other characters are symbols that no id names, ~(code point)."""

    def __missing__(self, character: str) -> int:
        return ~ord(character)


class _Remembered(dict):
    """The ids of parts as 32-bit numbers: two generations of at most REMEMBERED parts."""

    def __init__(self, made):
        super().__init__()
        self.made, self.older = made, {}

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part) or array("i", self.made(part)).tobytes()
        if len(part) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[part] = found
        return found


class Encoder:
    """Encodes texts; one per worker process. A token is a piece's id, or a symbol without one (negative)."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.symbols = _Symbols((text, i) for text, i in vocabulary.id.items() if len(text) == 1)
        self.automaton = ahocorasick.Automaton()
        self.sizes = [len(text) for text in vocabulary.texts]
        #: Of each piece, the longest of its prefixes that is a piece or a symbol; none of those of one character.
        self.shorter: list[int | None] = [None] * len(self.sizes)
        for text, i in vocabulary.id.items():
            if len(text) > 1:
                self.automaton.add_word(text, (i, len(text) - 1))
                prefixes = (vocabulary.id.get(text[:n]) for n in range(len(text) - 1, 1, -1))
                self.shorter[i] = next((x for x in prefixes if x is not None), self.symbols[text[0]])
        self.automaton.make_automaton()
        self.cuts = MARK in vocabulary.id and not any(MARK in t.lstrip(MARK) for t in vocabulary.id)
        self.parts = re.compile(f"{MARK}+[^{MARK}]*")
        self.pairs: dict[tuple[int | None, int], bool] = {}
        self.known = _Remembered(self.ids_of)

    def text_of(self, token: int) -> str:
        return self.vocabulary.texts[token] if token >= 0 else chr(~token)

    def merged(self, text: str) -> list[str]:
        """The symbols of a short text, by merging; of equal pairs the first."""
        symbols, score = list(text), self.vocabulary.score
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                s = score.get(symbols[i] + symbols[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def fits(self, before: int | None, token: int) -> bool:
        """Whether a token may stand behind another one (None: at the start)."""
        symbols = [self.text_of(token)] if before is None else [self.text_of(before), self.text_of(token)]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        found = self.pairs[before, token] = self.merged("".join(symbols)) == symbols
        return found

    def tokens(self, part: str) -> list[int]:
        """The tokens of a part, by backtracking."""
        # What to try next at each position: the longest match, then the next shorter ones. No position is entered twice.
        options: list[int | None] = list(map(self.symbols.__getitem__, part))
        for last, (token, rest) in self.automaton.iter(part):
            options[last - rest] = token
        known, sizes, shorter, length = self.pairs.get, self.sizes, self.shorter, len(part)
        failed = None
        tokens: list[int] = []
        at, before = 0, None
        while at < length:
            token = options[at]
            if token is None:
                if failed is None:
                    failed = bytearray((length >> 3) + 1)
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= sizes[token] if token >= 0 else 1
                before = tokens[-1] if tokens else None
                continue
            if token >= 0:
                end = at + sizes[token]
                options[at] = shorter[token]
            else:
                end = at + 1
                options[at] = None
            if failed is not None and failed[end >> 3] >> (end & 7) & 1:
                continue
            fits = known((before, token))
            if fits is None:
                fits = self.fits(before, token)
            if fits:
                tokens.append(token)
                at = end
                before = token
        return tokens

    def ids_of(self, part: str) -> list[int]:
        tokens, v = self.tokens(part), self.vocabulary
        if min(tokens) >= 0:
            return tokens
        out: list[int] = []
        for token in tokens:
            if token >= 0:
                out.append(token)
            elif v.byte:
                out += [v.byte[b] for b in chr(~token).encode("utf-8")]
            elif not out or out[-1] != v.unknown:
                out.append(v.unknown)
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as 32-bit numbers."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        return b"".join(map(self.known.__getitem__, self.parts.findall(marked) if self.cuts else (marked,)))


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        self.control = v.kinds == _CONTROL
        self.marked = np.array([k == _NORMAL and t.startswith(MARK) for k, t in zip(v.kinds, v.texts, strict=True)])
        byte = {i: bytes([b]) for b, i in v.byte.items()}
        plain = [
            b"" if k == _CONTROL else v.unknown_surface if k == _UNKNOWN else byte.get(i, b"") if k == _BYTE else t.replace(MARK, " ").encode()
            for i, (k, t) in enumerate(zip(v.kinds, v.texts, strict=True))
        ]
        self.table, self.lengths = pa.array(plain, pa.binary()), np.array([len(p) for p in plain])

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of several lists of ids, which are given end to end."""
        # The taken pieces lie end to end in one buffer.
        joined = self.table.take(pa.array(ids)).buffers()[2]
        data = joined.to_pybytes() if joined else b""
        bounds = np.concatenate([[0], np.cumsum(self.lengths[ids])]).tolist()
        stops = np.flatnonzero(self.control[ids])
        inside = np.searchsorted(stops, offsets).tolist()
        out = []
        for k, (first, last) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            # Characters don't go on across a control piece.
            text, at = "", first
            for stop in (*stops[inside[k] : inside[k + 1]].tolist(), last):
                if at < stop:
                    skipped = int(not text and self.marked[ids[at]])
                    text += data[bounds[at] + skipped : bounds[stop]].decode("utf-8", "daybook-each")
                at = stop + 1
            out.append(text)
        return out


codecs.register_error("daybook-each", lambda error: ("�", error.start + 1))

_loaded: dict[str, tuple[Encoder, Decoder]] = {}


def loaded(model_file: str) -> tuple[Encoder, Decoder]:
    if model_file not in _loaded:
        with open(model_file, "rb") as f:
            vocabulary = Vocabulary(f.read())
        _loaded[model_file] = Encoder(vocabulary), Decoder(vocabulary)
    return _loaded[model_file]


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True) -> DataFrame:
    """doc_id, ids of every row, with the end id if wanted; one scan, no shuffle.

    model_file is opened where the tasks run, so it must be at the same place on every machine.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        encoder, _ = loaded(model_file)
        last = np.array([encoder.vocabulary.end] if end else [], np.int32).tobytes()
        for batch in batches:
            found = [encoder.encode(t) + last for t in batch.column(1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(rows: DataFrame, model_file: str) -> DataFrame:
    """rows (doc_id, ids) with the text that each list of ids stands for; a null list gives null."""

    def run(batches):
        _, decoder = loaded(model_file)
        for batch in batches:
            lists = batch.column(1)
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            texts = decoder.decode(lists.flatten().to_numpy(), offsets)
            texts = pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, texts], names=["doc_id", "ids", "decoded"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded with an end id, and decoded again."""
    there_and_back = decode(encode(docs, model_file), model_file)
    made = there_and_back.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
    with bounded_batches(docs.sparkSession):
        return Scratch(docs.sparkSession, "pieces").result(made)
