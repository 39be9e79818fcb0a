"""Pieces by backtracking: the library's own ids and texts."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from brute import message  # noqa: E402

from daybook.llm import piece_encoding as pe  # noqa: E402
from daybook.llm.common import table  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "▁", "\n", "a", "th", "é", "漢", "\t", "the", "<s>", "🙂", "\x00", "ing", "</s>", "<unk>", "<0x0A>", "　", "\x85", "'s", "12", "!", "ɐ", "ﬁ", "aaaa", "abab"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), np.int32).tolist()


def text_of(decoder, found):
    return decoder.decode(np.array(found, np.int32), np.array([0, len(found)]))[0]


def same(library, texts):
    encoder, decoder = pe.loaded(PIECES)
    for text, theirs in zip(texts, library.encode(texts), strict=True):
        assert ids(encoder, text) == theirs
        assert text_of(decoder, [*theirs, 2]) == library.decode([*theirs, 2])


def test_ids_and_texts_are_the_librarys(library):
    rng = random.Random(1)
    some = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(4000)]
    some += ["".join(rng.choice("abcdeinrst ") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    same(library, [*some, "", " ", "▁", " lead", "trail ", "word " * 3000])


def test_long_parts(library):
    same(library, ["x" * 20_000, "ab" * 9000 + "漢" * 5000, "".join(random.Random(3).choice("abcdeinrst") for _ in range(15_000))])


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=40))
def test_any_text(library, text):
    same(library, [text])


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(0, 31_999) | st.integers(0, 260), max_size=9))
def test_any_ids_are_decoded_as_by_the_library(library, found):
    assert text_of(pe.loaded(PIECES)[1], found) == library.decode(found)


def toy(pieces, **scores):
    """An encoder of a small vocabulary without bytes."""
    v = object.__new__(pe.Vocabulary)
    v.texts = ["<unk>", *pieces]
    v.kinds = np.array([pe._UNKNOWN] + [pe._NORMAL] * len(pieces))
    v.id = {p: i + 1 for i, p in enumerate(pieces)}
    v.score = {p: scores.get(p, -i) for i, p in enumerate(pieces)}
    v.byte, v.unknown = {}, 0
    return pe.Encoder(v)


def test_backtracking_takes_back_longest_matches():
    # Merging makes b c first, so the longest match a b c at the start can't stand.
    encoder = toy(["a", "b", "c", "d", "bc", "ab", "abc", "cd"], bc=-1.0, ab=-2.0, abc=-9.0, cd=-0.5)
    symbols = {i: t for t, i in encoder.vocabulary.id.items()}
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("abcdz") for _ in range(rng.randint(1, 12)))
        assert [encoder.text_of(t) for t in encoder.tokens(text)] == encoder.merged(text)
    assert [symbols.get(i, "?") for i in encoder.ids_of("abcdzzab")] == ["ab", "cd", "?", "ab"]
    assert not encoder.cuts


def test_ties_are_merged_from_the_left():
    encoder = toy(["a", "aa", "aaa"], aa=-1.0, aaa=-1.0)
    for n in range(1, 12):
        assert [encoder.text_of(t) for t in encoder.tokens("a" * n)] == encoder.merged("a" * n)


def test_models_that_change_texts_are_refused():
    with pytest.raises(ValueError, match="changes"):
        pe.Vocabulary(message((2, message((3, 2))), (3, message((4, 1)))))
    plain = ((2, message((3, 2))), (3, message((4, 0))))
    with pytest.raises(ValueError, match="users"):
        pe.Vocabulary(message((1, message((1, b"x"), (3, 4))), *plain))


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(pe, "REMEMBERED", 50), monkeypatch.setattr(pe, "PAIRS", 30)
    encoder = pe.Encoder(pe.loaded(PIECES)[0].vocabulary)
    some = [f"qz{i}x{i % 7} qz{i % 90}" for i in range(300)]
    assert [ids(encoder, t) for t in some] == library.encode(some)
    assert len(encoder.known) <= 50 and len(encoder.pairs) <= 31


def brute(library, text):
    found = library.encode(text or "", add_eos=True)
    return len(found), hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest(), hashlib.sha256(library.decode(found).encode()).hexdigest()


def test_the_query_over_the_whole_table(spark, library):
    from daybook.llm.queries import QUERIES

    rows = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in QUERIES["op11_piece_backtracking"](spark, "/root/testdata/sf0.01").collect()}
    assert found == {doc: brute(library, text) for doc, text in rows.items()}


def test_rows(make, library):
    rows = [(1, None), (2, ""), (2, ""), (None, "two words"), (5, "a\x00b"), (6, "long " * 20_000), (6, " x")]
    docs = make([(*r, "k", [1]) for r in rows], "doc_id long, text string, ids string, decoded array<int>")
    found = pe.digests(docs, PIECES).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == sorted((d or 0, *brute(library, t)) for d, t in rows)
    assert pe.digests(make([]), PIECES).count() == 0
    plain = {r["doc_id"]: r["ids"] for r in pe.encode(make([(1, "end"), (2, None)]), PIECES, end=False).collect()}
    assert plain == {1: library.encode("end"), 2: []}
    lists = make([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in pe.decode(lists, PIECES).collect()} == {1: None, 2: ""}
