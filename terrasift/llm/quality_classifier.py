"""Operator 9, quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Terms say how a text is written, not what it says: 2- and 4-grams over classes of characters (runs of one class
count once), hashed to TERMS columns, and how often words equal the one 1 to 4 words before, as a step of a scale. Counts are damped
by log, weighted by inverse document frequency and projected on the first DIMS singular vectors. Columns such as language, source or
id are no inputs.

Fit: at most ``sample`` labelled rows, those with the smallest hash of their id, so the model that is broadcast has a bound
that does not grow with the data (sample x DIMS + TERMS x DIMS floats, about 1 MB). Every text is then compared with
every one of them, by exact cosine products in blocks; the ``k`` nearest vote with weight exp(SHARP (cosine - 1)).

A label without quality is not learnt from; of several for an id the largest counts. Without any labels the score is 0.5, and
a text without terms (null or empty) gets the mean label. Null ids are scored, are not held out and are never learnt from.
Repeated rows are each scored. Columns other than id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import table
from terrasift.llm.decl import query
from terrasift.llm.token_counts import slices

SAMPLE, TERMS, DIMS, K, SHARP, LAGS, BLOCK = 3000, 1024, 48, 15, 20.0, 4, 256
SCALE = (0.02, 0.05, 0.1, 0.2, 0.35, 0.6)
WIDTH = TERMS + LAGS * (len(SCALE) + 1)


def _classes() -> np.ndarray:
    """Class of each byte: letters, capitals, digits, kinds of space, bytes beyond ASCII, each common mark, the rest."""
    t = np.full(256, 31, np.uint32)
    t[128:] = 7
    t[97:123], t[65:91], t[48:58] = 1, 2, 3
    for i, c in enumerate(" \n\t"):
        t[ord(c)] = 4 + i
    t[[11, 12, 13]] = 6
    for i, c in enumerate(".,!?'\"-:;()#*$%&|<>/@_="):
        t[ord(c)] = 8 + i
    return t


CLASSES = _classes()


def terms(text: bytes | None) -> np.ndarray:
    """Damped term counts of a text."""
    out = np.zeros(WIDTH, np.float32)
    if not text:
        return out
    x = CLASSES[np.frombuffer(text, np.uint8)]
    x = x[np.concatenate(([True], x[1:] != x[:-1]))]
    for n in (2, 4):
        if len(x) >= n:
            h = x[: len(x) - n + 1]
            for j in range(1, n):
                h = h * np.uint32(32) + x[j : len(x) - n + 1 + j]
            out[:TERMS] += np.bincount((h * np.uint32(2654435761) + np.uint32(n)) >> np.uint32(22), minlength=TERMS)
    out = np.log1p(out)
    words = text.split()
    most = max(float(out.max()), 1.0)
    for lag in range(1, LAGS + 1):
        if len(words) > lag:
            same = sum(map(eq, words, words[lag:])) / (len(words) - lag)
            out[TERMS + (lag - 1) * (len(SCALE) + 1) + int(np.searchsorted(SCALE, same))] = most
    return out


def _vectors(x: np.ndarray, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    z = (x * idf) @ axes
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)


def votes(z: np.ndarray, fitted: np.ndarray, labels: np.ndarray, k: int = K) -> np.ndarray:
    """Similarity-weighted mean label of each row's k nearest; the mean label for rows without direction. Equal similarities are told apart by order."""
    if not len(labels):
        return np.full(len(z), 0.5)
    cos = np.round((z @ fitted.T).astype(np.float64), 6)
    near = np.argsort(-cos, axis=1, kind="stable")[:, :k]
    w = np.exp(SHARP * (np.take_along_axis(cos, near, 1) - 1))
    score = (w * labels[near]).sum(1) / w.sum(1)
    return np.where(np.abs(z).sum(1) > 0, score, labels.mean())


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> tuple[np.ndarray, ...]:
    """idf, axes, vectors and labels of the sampled rows. Their terms are counted where the texts are; the driver gets ``sample`` rows of WIDTH floats at most."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).alias("l_id")).agg(F.max(label_col).alias("label"))
    docs_of = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Labels may name rows that are not here: of those that are, the smallest hashes.
    chosen = known.join(docs_of.select(F.col("id").alias("l_id")).distinct(), "l_id", "left_semi").orderBy(F.xxhash64("l_id"), "l_id").limit(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                rows = [terms(t).tobytes() for t in pc.cast(batch.column(1), pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)], ["id", "terms", "label"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs_of.join(F.broadcast(chosen), F.col("id") == F.col("l_id")).select("id", "text", F.col("label").cast("double").alias("label"))
    # However often the texts repeat an id, the driver gets one row of it.
    rows = picked.mapInArrow(count, f"id {kind}, terms binary, label double").groupBy("id").agg(F.max("terms").alias("terms"), F.max("label").alias("label")).collect()
    rows.sort(key=lambda r: r.id)
    x = np.array([np.frombuffer(r.terms, np.float32) for r in rows], np.float32).reshape(-1, WIDTH)
    y = np.array([r.label for r in rows], np.float64)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 1).astype(np.float32)
    w = x * idf
    w /= np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)
    axes = np.linalg.eigh((w.T @ w).astype(np.float64))[1][:, ::-1][:, :DIMS].astype(np.float32)
    return idf, np.ascontiguousarray(axes), _vectors(x, idf, axes), y


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE, k: int = K, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, held_out, score, predicted; with the columns ``keep`` of docs, as they are."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample, id_col, text_col, label_col))  # its size is bounded, see above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, axes, fitted, y = model.value
        for whole in batches:
            for batch in slices(whole, 1, 4 << 20):
                texts = pc.cast(batch.column(1), pa.binary()).to_pylist()
                scores = [votes(_vectors(np.array([terms(t) for t in texts[i : i + BLOCK]]), idf, axes), fitted, y, k) for i in range(0, len(texts), BLOCK)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(np.concatenate(scores), pa.float64())], names)

    cols = [c for c in keep if c != id_col]
    names = ["id", *(f"k{i}" for i in range(len(cols))), "score"]
    kinds = ", ".join(f"k{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(cols))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(cols)))
    out = rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, {kinds + ', ' if cols else ''}score double")
    return out.select(F.col("id").alias(id_col), *(F.col(f"k{i}").alias(c) for i, c in enumerate(cols)), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
