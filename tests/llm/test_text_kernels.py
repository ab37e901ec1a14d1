import numpy as np
import pytest
import sentencepiece

from veilspark.llm import ngram_jaccard, quality_rules, sentencepiece_codec, substring_dedup
from veilspark.llm.text_kernels import SPACED, placed, split_words
from tests.llm.cases import table


def thue_morse(n, zero, one):
    """Strings whose polynomial hashes modulo 2^64 are equal to those with the letters exchanged."""
    return "".join(one if bin(i).count("1") % 2 else zero for i in range(n))


@pytest.mark.parametrize("n", [512, 1024, 2048, 4096])
def test_words_that_cancel_in_a_polynomial(n):
    letters = "abcdefgh"
    words = [thue_morse(n, x, y) for x in letters for y in letters if x != y]
    data = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
    w = split_words(data, np.array([0, len(data)]), SPACED)
    assert len(set(w.hash.tolist())) == len(words)


def test_values_near_and_far_come_from_one_rule():
    data, place = np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.int32)
    assert len(set(placed(np.repeat(data, 256), np.tile(place, 256)).tolist())) == 256 * 256


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_operators_tell_them_apart(spark, n):
    a, b = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
    rest = " ".join(f"w{i}" for i in range(19))
    out = {r.doc_id: r.n_removed for r in substring_dedup.dedup_substrings(table(spark, [(1, f"{a} {rest}", "en"), (2, f"{b} {rest}", "en"), (3, f"{a} {rest}", "en")])).collect()}
    assert out == {1: 0, 2: 0, 3: 20}
    linked = {r.doc_id: r.component_id for r in ngram_jaccard.jaccard_components(table(spark, [(1, a, "en"), (2, b, "en"), (3, a, "en")])).collect()}
    assert linked == {1: 1, 2: 2, 3: 1}
    text = np.frombuffer(f"{a}\n{b}\n{a}".encode(), dtype=np.uint8)
    assert quality_rules.statistics(text, np.array([0, len(text)]))["n_dup_lines"].tolist() == [1]


@pytest.mark.parametrize("n", [256, 512, 1023])
def test_units_are_compared_by_bytes(spark, n):
    a, b = thue_morse(n, "a", "b"), thue_morse(n, "b", "a")
    model = sentencepiece_codec.default_model()
    given = sentencepiece.SentencePieceProcessor(model_file=model)
    texts = [f"{a} {b}", b, a, f"x {b} {a} x"]
    got = {r.doc_id: r.ids for r in sentencepiece_codec.encode(table(spark, [(i, t, "en") for i, t in enumerate(texts)]), sentencepiece_codec.load_pieces(model)).collect()}
    assert got == {i: given.encode(t) for i, t in enumerate(texts)}


def test_units_whose_hashes_are_equal(monkeypatch):
    """Where all units of a length have one hash, the bytes still decide."""
    monkeypatch.setattr(sentencepiece_codec, "placed", lambda data, place: np.zeros(len(data), dtype=np.uint64))
    model = sentencepiece_codec.default_model()
    given = sentencepiece.SentencePieceProcessor(model_file=model)
    m = sentencepiece_codec.Matcher(sentencepiece_codec.load_pieces(model))
    for words in (["the", "cat", "sat", "the", "tea"], ["cat", "dog", "the"]):
        units = [f" {w}" for w in words]
        buffer = np.frombuffer("".join(units).encode(), dtype=np.uint8)
        first = np.cumsum([0] + [len(u) for u in units])[:-1]
        ids, begin, count = sentencepiece_codec._units(m, buffer, first, np.array([len(u) for u in units]))
        assert [ids[s : s + n].tolist() for s, n in zip(begin, count, strict=True)] == [given.encode(w) for w in words]


def test_long_pieces_that_begin_alike(spark):
    """Pieces of more than 8 and 16 bytes are told apart by all of their bytes."""
    model = sentencepiece_codec.default_model()
    given, pieces = sentencepiece.SentencePieceProcessor(model_file=model), sentencepiece_codec.load_pieces(model)
    long = sorted((pieces.text[i].decode() for i in pieces.merged if len(pieces.text[i]) > 8), key=len)
    texts = ["e Население e Населення", "e населения", *["e" + t for t in long[-300:]], " ".join(long)]
    got = {r.doc_id: r.ids for r in sentencepiece_codec.encode(table(spark, [(i, t, "en") for i, t in enumerate(texts)]), pieces).collect()}
    assert got == {i: given.encode(t) for i, t in enumerate(texts)}


def test_occurrences_are_brute_force(monkeypatch):
    """Every piece at every place of every unit, in segments of any size."""
    pieces = sentencepiece_codec.load_pieces(sentencepiece_codec.default_model())
    m = sentencepiece_codec.Matcher(pieces)
    units = [" Население", " international", "x", " the\0the", " administration", " населения"]
    data = np.frombuffer("".join(units).encode(), dtype=np.uint8)
    stop = np.cumsum([len(u.encode()) for u in units])
    at = np.flatnonzero((data & 0xC0) != 0x80)
    end = stop[np.searchsorted(stop, at, side="right")]
    ids = {pieces.text[i]: i for i in pieces.merged}
    want = [(a, b, ids[data[a:b].tobytes()]) for a, e in zip(at, end, strict=True) for b in range(a + 1, e + 1) if data[a:b].tobytes() in ids]
    for size in (3, 1 << 18):
        monkeypatch.setattr(sentencepiece_codec, "SEGMENT", size)
        edges = m.edges(data, at, end)
        a, b = np.array([x[0] for x in want]), np.array([x[1] for x in want])
        assert edges.pieces(a, b).tolist() == [x[2] for x in want] and len(edges.ids) == len(want)
