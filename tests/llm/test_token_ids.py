import functools
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from test_token_counts import TEXTS
from tokenizers import Tokenizer

from terrasift.llm import token_ids
from terrasift.llm.registry import QUERIES
from terrasift.llm.token_ids import Encoder, Reader, fetch_ids, manifest, read_ids, write_ids

SF = "/root/testdata/sf0.001"
ENCODER = Encoder("word_bpe_49k.json", 1)
ODD = [*TEXTS, "İstanbul İ. word", "J̌ ǰ K Å", "it's. It'S x;:. ...", "<|ENDOFTEXT|> <|endoftext|>. a<|startoftext|>,", "Hello, HELLO! hello", "日本語 テスト。 ßß ﬁ"]


@functools.cache
def tokenizer_of(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def library(name, text):
    return tokenizer_of(name).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_files_hold_what_the_library_gives(spark, tmp_path, name):
    docs = spark.createDataFrame([Row(doc_id=len(ODD) - i, text=t, n="clash", ids=1, frame="x") for i, t in enumerate(ODD)] + [Row(doc_id=None, text="null id", n=None, ids=2, frame=None)])
    write_ids(docs, str(tmp_path), tokenizer=name, file_bytes=150)
    got = read_ids(spark, str(tmp_path), docs_a_task=3).orderBy("start").collect()
    order = [(None, "null id"), *((len(ODD) - i, t) for i, t in reversed(list(enumerate(ODD))))]
    start = 0
    assert len(got) == len(order)
    for r, (i, text) in zip(got, order, strict=True):
        want = [*library(name, text), 1]
        assert (r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (i, start, len(want), want)
        start += len(want)
    assert manifest(spark, str(tmp_path)).count() > 1


def test_query_against_the_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op11_token_ids"](spark, SF).collect()}
    tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        assert tuple(got[r.doc_id]) == (r.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_one_id_for_many_rows(spark, tmp_path):
    """Rows of one id go to several files, repeated rows come back as often, and starts run through."""
    rows = [Row(doc_id=7 if i % 3 else i, text=f"text {i % 40} " * (i % 50)) for i in range(600)]
    write_ids(spark.createDataFrame(rows).repartition(5), str(tmp_path), file_bytes=1500)
    files = manifest(spark, str(tmp_path)).where("least <= 7 AND most >= 7").count()
    got = read_ids(spark, str(tmp_path)).orderBy("start").collect()
    assert files > 2 and len(got) == 600
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in rows)
    assert sorted(bytes(r.ids) for r in got) == sorted(np.array([*library("word_bpe_49k.json", r.text), 1], "<u4").tobytes() for r in rows)


def test_short_documents_are_read_alone(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    write_ids(docs, str(tmp_path))
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(texts)[:3] + [max(texts), max(texts) + 5, None]
    got = {r.doc_id: bytes(r.ids) for r in fetch_ids(spark, str(tmp_path), spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()}
    assert got == {i: np.array([*library("word_bpe_49k.json", texts[i]), 1], "<u4").tobytes() for i in ids if i in texts}
    name = manifest(spark, str(tmp_path)).first().file
    reader, read = Reader(str(tmp_path), name), []
    inner = reader._at
    monkeypatch.setattr(reader, "_at", lambda start, size: read.append(size) or inner(start, size))
    list(reader.documents(1, 2))
    assert sum(read) < 0.05 * os.path.getsize(tmp_path / name)


def test_dictionary_is_shared_checked_and_worth_it(spark, tmp_path):
    short = spark.createDataFrame([(i, f"the quick brown fox number {i % 97} jumps over the lazy dog again") for i in range(3000)], "doc_id long, text string")
    write_ids(short, str(tmp_path))
    dictionary = next(x for x in os.listdir(tmp_path) if x.endswith(".zdict"))
    size = sum(r.n_ids for r in manifest(spark, str(tmp_path)).collect()) * 2
    frames = sum(int(np.diff(Reader(str(tmp_path), r.file).bounds(0, r.n_docs)[0]).sum()) for r in manifest(spark, str(tmp_path)).collect())
    assert frames < 0.75 * size
    data = (tmp_path / dictionary).read_bytes()
    (tmp_path / dictionary).write_bytes(data[:-1] + bytes([data[-1] ^ 1]))
    (tmp_path / f".{dictionary}.crc").unlink(missing_ok=True)
    with pytest.raises(ValueError, match="dictionary"):
        Reader(str(tmp_path), manifest(spark, str(tmp_path)).first().file)


def test_files_that_the_manifest_does_not_name_are_ignored(spark, tmp_path):
    write_ids(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"), str(tmp_path))
    (tmp_path / "part-000000-left-over.ids").write_bytes(b"half a file")
    assert read_ids(spark, str(tmp_path)).count() == 2


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abAB09.,-'<|>_@#é\u0301İ \n\x1c"), max_size=30), max_size=6))
def test_random_texts(texts):
    import pyarrow as pa

    ids, at = ENCODER.serial(pa.array(texts, pa.string()))
    want = [[*library("word_bpe_49k.json", t), 1] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == want


def test_empty_table_and_memo(spark, tmp_path, monkeypatch):
    write_ids(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path))
    assert read_ids(spark, str(tmp_path)).collect() == []
    monkeypatch.setattr(token_ids, "MEMO", 2)
    import pyarrow as pa

    encoder = Encoder("word_bpe_49k.json", 1)
    for texts in (["one two three, four. five"], ["two six! ab"], ["ONE ten10 x" * 40, "", "four"], [], ["İ. ab q. ́", None][:1]):
        ids, at = encoder.serial(pa.array(texts, pa.string()))
        want = [[*library("word_bpe_49k.json", t), 1] for t in texts]
        assert ids.tolist() == [i for x in want for i in x] and at.tolist() == [0, *np.cumsum([len(x) for x in want])]
