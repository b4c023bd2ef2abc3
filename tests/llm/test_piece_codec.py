import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from terrasift.llm import piece_codec, registry
from terrasift.llm.piece_codec import SPACE, Codec, Encoder, Memo, Model, decode, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
CODEC = Codec(PATH)
TEXTS = ["", " ", "  a  b   ", "Hello world\n\nfoo\tbar", "é́ 日本語 😀 \x00\x7f", "a" * 3000, "aaaabbb" * 500, "▁x▁ ▁▁ y", "<s> </s> <unk> <0x0A>", "The quick " * 3000, "þætti øðlast " * 40, "no_spaces_at_all" * 700]


@pytest.mark.parametrize("text", TEXTS)
def test_library(text):
    ids = CODEC.encode(text)
    assert ids.tolist() == SP.encode(text)
    assert CODEC.decode(ids.tolist()) == text.replace(SPACE, " ")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdet hin  ▁éß\n."), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_random_text(text):
    assert CODEC.encode(text).tolist() == SP.encode(text)


def test_window_is_bounded_and_parts_do_not_matter():
    """A text without any space goes through the window; spaces, runs of them and newlines may fall between parts."""
    rng = random.Random(4)
    for words in (["the", "ing", "xyz", "é", "qqq", "1", "tion"], ["the", " ", "  ", "\n", "ing", "▁", "é", " x", "a\n\nb"]):
        text = "".join(rng.choice(words) for _ in range(4000))
        e, out, rest = Encoder(CODEC.model), [], " " + text
        while rest:
            n = rng.randrange(1, 40)
            out += e.feed(rest[:n])
            rest = rest[n:]
        assert out + e.finish() == SP.encode(text)
        assert e.widest < 3 * piece_codec.SEEK
    assert Encoder(CODEC.model).finish() == []


def test_documents_are_committed_word_by_word(spark):
    """Whole documents through the encoder: a commit for each word or so, a window no wider than the longest word, ids as the library's."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if r.text]
    memo, calls, inner = Memo(300), [], Encoder._commit

    def counted(self):
        calls.append(len(self.text))
        return inner(self)

    Encoder._commit = counted
    try:
        for t in texts:
            e = Encoder(CODEC.model, memo)
            out = e.feed(" " + t) + e.finish()
            words = len(t.split())
            assert out == SP.encode(t) and (words < 2 or words <= e.commits <= 3 * len(t))
            assert e.widest <= max(map(len, t.split()), default=0) + 2 + max((len(x) for x in __import__("re").findall(" +", t)), default=0)
    finally:
        Encoder._commit = inner
    assert len(calls) > 300 and 300 <= len(memo) <= 600


def test_unigram_recurrence():
    """Against all segmentations of short texts, by score."""
    m = Model.__new__(Model)
    rng = np.random.default_rng(0)
    pieces = ["a", "b", "c", "ab", "bc", "abc", "ca", "aa", "bca"]
    m.bpe, m.bytes, m.unknown, m.longest, m.lowest, m.pairs, m.stretch = False, {}, 99, 3, -30.0, {}, None

    def whole(text):
        e = Encoder(m)
        return e.feed(text) + e.finish()

    m.pieces = {p: (i, float(-rng.random() * 3 - 1)) for i, p in enumerate(pieces)}
    m.prefixes = {p[:i]: False for p in pieces for i in range(1, len(p))} | dict.fromkeys(pieces, True)

    def best(text):
        if not text:
            return 0.0, []
        found = []
        for n in range(1, 4):
            t = text[:n]
            if len(t) == n and (t in m.pieces or n == 1):
                i, s = m.pieces.get(t, (99, -30.0))
                rest = best(text[n:])
                found.append((s + rest[0], [i, *rest[1]]))
        return max(found, key=lambda x: x[0])

    for _ in range(60):
        text = "".join(rng.choice(list("abcd"), rng.integers(1, 11)))
        assert whole(text) == best(text)[1]
    long = "abcaab" * 200
    e = Encoder(m)
    assert sum((e.feed(long[i : i + 7]) for i in range(0, len(long), 7)), []) + e.finish() == whole(long) and e.commits > 1 and e.widest < 600


def test_tables(spark):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate([None, *TEXTS, "dup", "dup"])] + [(None, "x", "", 2)], "doc_id long, text string, ids string, n_ids int")
    out = encode(docs)
    rows = {r.doc_id: r for r in out.collect()}
    for i, t in enumerate([None, *TEXTS, "dup", "dup"]):
        assert list(rows[i].ids) == SP.encode(t or "") and rows[i].n_ids == len(rows[i].ids) and rows[i].n_chars == len(t or "")
        assert rows[i].round_trip == (SPACE not in (t or ""))
    back = {r.doc_id: r.text for r in decode(out).collect()}
    assert all(back[i] == (t or "").replace(SPACE, " ") for i, t in enumerate([None, *TEXTS]))
    assert encode(docs.limit(0)).collect() == [] and decode(out.limit(0)).collect() == []


def test_ids_that_no_model_has():
    assert CODEC.decode([SP.unk_id(), 10**6, -1, None]) == CODEC.decode([SP.unk_id()] * 4)


def test_query(spark):
    rows = {r.doc_id: r for r in registry.QUERIES["op5_piece_codec"](spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        ids = SP.encode(d.text)
        assert (rows[d.doc_id].n_ids, rows[d.doc_id].first_id, rows[d.doc_id].last_id, rows[d.doc_id].round_trip) == (len(ids), ids[0], ids[-1], True)
