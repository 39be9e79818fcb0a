"""Token counts of whole texts with a whole-token shortcut, for sentencepiece BPE models.

Two facts are proved from the model itself before any text is read:

- Cuts. The model's own specification says that it is BPE, that its normaliser has no character map, keeps all white
  space, writes spaces as the word mark and puts one before the text. If no piece of the vocabulary holds the mark after
  another character, no merge can then ever join what stands before a space to what stands after it; and if the mark is a
  piece, it isn't one with an unknown before it either. A text's tokens are then those of its words (each with the mark).
- Whole tokens. A vocabulary string is in the shortcut only if encoding it alone gives exactly one token.

A word in the shortcut counts 1 at once; the others are merged by the library, once while the worker remembers them.
If the proof of the cuts fails, every text is encoded whole: slower, never wrong. Texts whose spaces are doubled, leading, or mixed with the mark itself are cut before runs of marks.

Defined cases: null counts as the empty text, which has no tokens; nothing is truncated; special strings inside a
text are ordinary text, as is the library's default; repeated rows are counted each.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded_batches
from daybook.scratch import Scratch

MARK = "▁"
#: Words that a worker remembers (two generations of this many); longer words are not remembered.
REMEMBERED, LONGEST = 200_000, 64


def model_fields(message: bytes):
    """(number, value) of the fields of a protocol-buffers message: an int, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield number, message[at : at + size]
        at += size


# Fields of the model file, their defaults, and the values under which words are independent.
_TRAINER, _NORMALIZER = 2, 3
_BPE = {3: (1, 2), 24: (0, 0)}  # model_type: BPE; treat_whitespace_as_suffix: no
_PLAIN = {2: (b"", b""), 3: (1, 1), 4: (1, 0), 5: (1, 1), 6: (b"", b"")}  # charsmap; dummy prefix; extra spaces; escaping; rules


def words_are_independent(model: bytes) -> bool:
    """Whether the specification in a model file lets words be tokenised one by one, as far as the vocabulary allows."""
    parts = {n: dict(model_fields(v)) for n, v in model_fields(model) if n in (_TRAINER, _NORMALIZER)}
    wanted = ((parts.get(_TRAINER, {}), _BPE), (parts.get(_NORMALIZER, {}), _PLAIN))
    return all(found.get(n, default) == want for found, rules in wanted for n, (default, want) in rules.items())


class WholeTokens:
    """The offline proofs for one model."""

    def __init__(self, processor):
        pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
        ordinary = [
            i for i in range(len(pieces))
            if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i) or processor.is_unused(i))
        ]
        crossing = any(MARK in pieces[i].lstrip(MARK) for i in ordinary)
        marks = any(pieces[i] == MARK for i in ordinary)
        self.cuts = marks and not crossing and words_are_independent(processor.serialized_model_proto())
        self.whole: dict[str, int] = {}
        if self.cuts:
            marked = [(i, pieces[i][1:]) for i in ordinary if pieces[i].startswith(MARK) and MARK not in pieces[i][1:]]
            words = [w for _, w in marked if w]
            alone = processor.encode(words, num_threads=1)
            self.whole = {w: 1 for (i, w), ids in zip([m for m in marked if m[1]], alone, strict=True) if ids == [i]}


class Counter:
    """Counts tokens of texts; one per worker process."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_file)
        proved = WholeTokens(self.processor)
        self.cuts = proved.cuts
        self.words = _Remembered(self.processor, proved.whole)
        self.runs = re.compile(f"{MARK}+[^{MARK}]*")

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.processor.encode(text))
        if text[0] != " " and "  " not in text and MARK not in text:
            return sum(map(self.words.__getitem__, text.split(" ")))
        # The library puts one mark before the text, so each cut part is encoded without its first mark.
        parts = self.runs.findall(MARK + text.replace(" ", MARK))
        return sum(self.words[p[1:]] for p in parts)


class _Remembered(dict):
    """Tokens of a word with a mark before it: the proved ones for good, others while there is room."""

    def __init__(self, processor, whole: dict[str, int]):
        super().__init__(whole)
        # A mark that nothing follows; the library returns nothing for the empty text.
        self[""] = len(processor.encode("a ")) - len(processor.encode("a"))
        self.processor, self.fixed, self.older = processor, dict(self), {}

    def __missing__(self, word: str) -> int:
        n = self.older.get(word)
        if n is None:
            n = len(self.processor.encode(word))
        if len(word) <= LONGEST:
            if len(self) > len(self.fixed) + REMEMBERED:
                self.older = dict(self)
                self.clear()
                self.update(self.fixed)
            self[word] = n
        return n


_counters: dict[str, Counter] = {}


def counter(model_file: str) -> Counter:
    if model_file not in _counters:
        _counters[model_file] = Counter(model_file)
    return _counters[model_file]


def token_counts(
    docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; one scan, no shuffle.

    model_file is opened where the tasks run, so it must be at the same place on every machine.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")

    def run(batches):
        count = counter(model_file).count
        for batch in batches:
            n = [count(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
    with bounded_batches(docs.sparkSession):
        return Scratch(docs.sparkSession, "token-counts").result(counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
