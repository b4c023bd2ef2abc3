import zlib

import numpy as np
from pyspark.sql import functions as F

from terrasift.llm import registry
from terrasift.llm.quality_classifier import K, SHARP, _vectors, classify, fit, terms, votes

SF = "/root/testdata/sf0.01"


def test_held_out_and_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in registry.QUERIES["op9_quality_classifier"](spark, SF).collect()}
    assert len(rows) == docs.count() and all(r.predicted == (r.score >= 0.3) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    truth = {r.doc_id: r.quality for r in labels.collect()}
    out = [(q, rows[i].predicted) for i, q in truth.items() if rows[i].held_out]
    assert np.mean([p for q, p in out if q == 1]) > 0.98
    assert np.mean([1 - p for q, p in out if q == 0]) > 0.75
    idf, axes, fitted, y = fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.limit(60).collect()}
    for i, t in texts.items():
        z = _vectors(terms(t.encode())[None], idf, axes)[0]
        cos = sorted(((round(float(z.astype(np.float32) @ v), 6), -n) for n, v in enumerate(fitted)), reverse=True)[:K]
        w = [np.exp(SHARP * (c - 1)) for c, _ in cos]
        assert abs(rows[i].score - np.dot(w, [y[-n] for _, n in cos]) / sum(w)) < 2e-2


def test_cases(spark):
    texts = [None, "", "!", "é" * 30000, "A. " * 20000, "same", "same"]
    docs = spark.createDataFrame([(i if i != 2 else None, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (5, None, 1), (None, 1, 1), (4, 0, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    rows = classify(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    none = classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert classify(docs.limit(0), labels).collect() == []


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    *_, y = fit(docs, labels, sample=50)
    assert len(y) == 50
    held = fit(docs, labels.where(F.crc32(F.col("doc_id").cast("string")) % 5 == 0))
    assert len(held[-1]) == 0
    assert votes(np.zeros((2, 3)), np.eye(3), np.array([1.0, 0.0, 1.0])).tolist() == [2 / 3, 2 / 3]
