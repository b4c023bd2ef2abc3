import re
from collections import Counter

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from test_near_dedup import brute as near
from test_quality_rules import brute as counts

import corpus_pipeline as P
from terrasift.llm.common import cut
from terrasift.llm.mixing import mix
from terrasift.llm.quality_classifier import classify

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "quality_rules", "near_dedup", "mixing", "piece_codec"]
    tables = [docs]
    for name, stage in P.STAGES:
        tables.append(cut(stage(spark, tables[-1], SF), name))
    a, b, c, d, e = (t.collect() for t in tables[1:])
    assert all(t.columns == docs.columns for t in tables[1:5])
    good = {r.doc_id for r in classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert {r.doc_id for r in a} == good and all(r == start[r.doc_id] for r in a)
    failed = set()
    for r in a:
        n, _, _, _, rep = counts(r.text)
        if n < 20 or 100 * rep > 30 * n:
            failed.add(r.doc_id)
    kept = {r.doc_id for r in b}
    assert kept <= good - failed and len(kept) > 0.9 * len(good - failed) and all(r == start[r.doc_id] for r in b)
    want = {i for i, _, _, keep in near([(r.doc_id, r.text) for r in b], 5, 80) if keep}
    assert Counter(r.doc_id for r in c) == Counter(want)
    copies = Counter(r.doc_id for r in d)
    assert set(copies) <= want and max(copies.values()) <= 2 and all(r == start[r.doc_id] for r in d)
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in c}
    total = sum(size.values())
    assert abs(sum(size[i] * n for i, n in copies.items()) - 1.5 * total) < 0.25 * total
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert Counter(r.doc_id for r in e) == copies
    assert all(list(r.ids) == sp.encode(start[r.doc_id].text) for r in e)


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []


def test_clashing_columns_nulls_and_repeats(spark):
    """Extra columns with the operators' own names come through as they are; null ids, texts, languages and repeated rows are defined."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    text = docs.where("length(text) > 400").first().text
    extra = [(None, None, None, None, None), (None, "", "en", None, 0), (9001, None, None, "web", 0), (9002, " \n", "en", "web", 0), (None, text, None, None, 1), (None, text + " more", None, None, 1), (9003, text, "en", "s", 1), (9003, text, "en", "s", 1), (9003, text + " again", "en", "s", 1)]
    names = ["score", "held_out", "predicted", "n_words", "distance", "kept", "kept_id", "own_size", "copies", "copy", "first", "key", "k0", "c0", "id", "size", "x0", "lang_", "node", "comp"]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for i, n in enumerate(names):
        docs = docs.withColumn(n, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    docs = cut(docs, "clash")
    start = {(r.doc_id, r.text) for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, cut(stage(spark, docs, SF), name)
        assert docs.schema.simpleString() == before.schema.simpleString()
        for r in docs.collect():
            assert (r.doc_id, r.text) in start and all(r[n] == f"{i}:{'none' if r.doc_id is None else r.doc_id}" for i, n in enumerate(names))
        if name == "near_dedup":
            ids = [r.doc_id for r in docs.collect()]
            assert len(ids) == len(set(ids)) and None not in ids  # the null ids' texts have copies with ids
    assert P.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_near_dedup_keeps_one_of_a_group_without_ids(spark):
    text = " ".join(f"w{i}" for i in range(200))
    rows = [(None, text, "en", "s", 1), (None, text + " x", "en", "s", 1), (None, text + " y", "en", "s", 1), (None, "other words that stand alone here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = P.near_dedup(spark, docs, SF).collect()
    assert len(out) == 2 and sum(r.text.startswith("w0") for r in out) == 1


def test_mixing_takes_rows_of_equal_id_and_size_apart(spark):
    """Different texts that share id and size are units of their own; equal rows are taken as often as all of them together."""
    rows = [(1, f"t{i} " * 7, "en", f"s{i % 3}", 1) for i in range(300)] + [(2, "same same", "en", "s1", 1)] * 60
    docs = cut(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "mixing")
    got = Counter()
    for r in P.mixing(spark, docs, SF).collect():
        got[r.source] += len(r.text.split())
    want = {}
    for r in mix(docs).select("target").distinct().collect():
        want[round(r.target)] = r.target
    assert len(got) == 3 and all(min(abs(n - t) for t in want.values()) <= 7 for n in got.values())
    assert abs(sum(got.values()) - 1.5 * (300 * 7 + 120)) <= 3 * 7
