"""Operator 12, vector codes: vectors cut into equal parts, each part coded by the nearest of up to 256 entries of its codebook.

Codebooks come from Lloyd rounds in Elkan's way. Between rounds a table in the shared folder holds, for each part of each vector, its entry, an upper bound of
the distance to it and one lower bound for each entry. A round shifts the bounds by how far entries have moved and looks at an entry only where no bound
excludes it: an entry is left out if the upper bound is strictly below its lower bound, or strictly below half the distance between it and the
part's own entry. Distances that are looked at are exact integers, and equal ones go to the lower index, so bounds never decide a tie. Bounds are
rounded outwards: upper ones are floats rounded up, lower ones the first 16 bits of floats, which cuts them towards zero.

A round is one pass over the table and one over its codes: tasks add up what falls to each entry, so that a few rows a task are shuffled, and only codebooks and their
sums (entries times dimensions, whatever the number of vectors) reach the driver. The round before's table is removed once the next is written.

Dropped, as they have no code: null vectors, those with a null or non-finite component, empty ones, and those whose length is not a multiple of ``parts`` or not that of
the first kept vector. First means smallest id, then smallest vector, null ids last; the codebooks start with the first ``entries`` vectors, or with all where there are
fewer. Repeated rows and ids are coded row by row. Scaled components beyond 2**26 are an error, as squared distances would no longer fit in 64 bits. Other columns
are ignored, whatever their names. Without any vector left the result has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import cut, release, table
from terrasift.llm.decl import query

#: Largest scaled component, and rows of a table that may be broadcast.
MOST, BROADCAST_ROWS, SALTS = 1 << 26, 100_000, 32


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and place within the part; scale is what components were multiplied by."""

    entries: np.ndarray
    scale: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _up(squared: np.ndarray) -> np.ndarray:
    """Roots as floats that are not too small."""
    root = np.nextafter(np.nextafter(np.sqrt(squared.astype(np.float64)), np.inf), np.inf)
    return np.nextafter(root.astype(np.float32), np.float32(np.inf))


def _down(squared: np.ndarray) -> np.ndarray:
    """Roots as floats that are not too large."""
    root = np.sqrt(squared.astype(np.float64)).astype(np.float32)
    return np.maximum(np.nextafter(np.nextafter(root, np.float32(-np.inf)), np.float32(-np.inf)), np.float32(0))


def _pack(lower: np.ndarray) -> np.ndarray:
    return (lower.view(np.uint32) >> np.uint32(16)).astype("<u2")


def _unpack(bits: np.ndarray) -> np.ndarray:
    return (bits.astype(np.uint32) << np.uint32(16)).view(np.float32)


def _all_squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:  # every sum is an exact double
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


@dataclass(frozen=True)
class _Round:
    """What a round knows of one part: entries, how far each has moved at most, half the distances between them at least."""

    entries: np.ndarray
    moved: np.ndarray
    half: np.ndarray
    near: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray, before: np.ndarray | None) -> _Round:
        squared = _all_squared(entries, entries)
        half = _down(squared) * np.float32(0.5)
        others = half.copy()
        np.fill_diagonal(others, np.inf)
        moved = np.zeros(len(entries), np.float32) if before is None else np.where((entries == before).all(1), np.float32(0), _up(((entries - before) ** 2).sum(1)))
        return cls(entries, moved, half, others.min(1))


def _first(x: np.ndarray, r: _Round) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry, upper and lower bounds of parts that have none yet."""
    squared = _all_squared(x, r.entries)
    own = squared.argmin(1)
    return own, _up(squared[np.arange(len(x)), own]), _down(squared)


def _next(x: np.ndarray, r: _Round, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same after entries have moved, and how many distances were looked at."""
    own = own.copy()
    upper = np.nextafter(upper + r.moved[own], np.float32(np.inf))
    lower = np.where(r.moved > 0, np.maximum(np.nextafter(lower - r.moved, np.float32(-np.inf)), np.float32(0)), lower)
    open_ = np.flatnonzero(~(upper < r.near[own]))
    looked = len(open_)
    best = np.zeros(len(x), np.int64)
    best[open_] = ((x[open_] - r.entries[own[open_]]) ** 2).sum(1)
    upper[open_] = _up(best[open_])
    lower[open_, own[open_]] = _down(best[open_])
    open_ = open_[~(upper[open_] < r.near[own[open_]])]
    for c in range(len(r.entries)):
        a, u = own[open_], upper[open_]
        rows = open_[(a != c) & ~(u < lower[open_, c]) & ~(u < r.half[a, c])]
        if not len(rows):
            continue
        looked += len(rows)
        squared = ((x[rows] - r.entries[c]) ** 2).sum(1)
        lower[rows, c] = _down(squared)
        wins = (squared < best[rows]) | ((squared == best[rows]) & (c < own[rows]))
        rows, squared = rows[wins], squared[wins]
        own[rows], best[rows], upper[rows] = c, squared, _up(squared)
    return own, upper, lower, looked


def _matrix(column: pa.Array, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), *shape)


def _rows_of(values: np.ndarray) -> pa.Array:
    raw = values.reshape(len(values), -1)
    size = raw.shape[1] * raw.itemsize
    data = raw.tobytes()
    return pa.array([data[i : i + size] for i in range(0, len(data), size)], pa.binary())


def _codable(vectors: DataFrame, parts: int) -> DataFrame:
    """Vectors without null or non-finite components that can be cut into equal parts."""
    v = F.col("v")
    fit = v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(fit, F.lit(False)))


def _integers(vectors: DataFrame, scale: int) -> DataFrame:
    """id, label and x, the scaled components as 32-bit integers, of codable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            scaled = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
            if len(scaled) and np.abs(scaled).max() > MOST:
                raise ValueError(f"scaled components beyond {MOST}: exact distances would not fit")
            data, at = scaled.astype("<i4").tobytes(), (4 * (lists.offsets.to_numpy() - lists.offsets[0].as_py())).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([data[a:b] for a, b in zip(at, at[1:], strict=False)], pa.binary())], ["id", "label", "x"])

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, x binary")


def _books(seeds: list[bytes], parts: int) -> np.ndarray:
    x = np.stack([np.frombuffer(s, "<i4") for s in seeds]).astype(np.int64)
    return np.ascontiguousarray(x.reshape(len(seeds), parts, -1).transpose(1, 0, 2))


def _pass(rows: DataFrame, rounds: list[_Round], first: bool, last: bool) -> DataFrame:
    """One look at all vectors: their codes, with bounds, or with their squared distances in the last one."""
    parts, (k, width) = len(rounds), rounds[0].entries.shape
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, " + ("code binary, error long" if last else "x binary, code binary, upper binary, lower binary, looked long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                get = dict(zip(batch.schema.names, batch.columns, strict=True))
                x = _matrix(get["x"], "<i4", (parts, width)).astype(np.int64)
                if not first:
                    own, upper = _matrix(get["code"], "u1", (parts,)).astype(np.int64), _matrix(get["upper"], "<f4", (parts,)).copy()
                    lower = _matrix(get["lower"], "<u2", (parts, k))
                found = []
                for p, r in enumerate(rounds):
                    found.append((*_first(x[:, p], r), len(x) * k) if first else _next(x[:, p], r, own[:, p], upper[:, p], _unpack(lower[:, p])))
                codes = np.stack([f[0] for f in found], 1)
                out = [get["id"], get["label"]]
                if last:
                    error = sum(((x[:, p] - r.entries[codes[:, p]]) ** 2).sum(1) for p, r in enumerate(rounds))
                    out += [_rows_of(codes.astype("u1")), pa.array(error, pa.int64())]
                else:
                    looked = np.zeros(len(x), np.int64)
                    looked[:1] = sum(f[3] for f in found)
                    out += [get["x"], _rows_of(codes.astype("u1")), _rows_of(np.stack([f[1] for f in found], 1).astype("<f4")), _rows_of(_pack(np.stack([f[2] for f in found], 1))), pa.array(looked)]
                yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks whose entries are the floors of the means of what is coded by them; entries that code nothing stay."""
    parts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, code = _matrix(batch.column(0), "<i4", (parts, width)).astype(np.int64), _matrix(batch.column(1), "u1", (parts,))
            for p in range(parts):
                np.add.at(sums[p], code[:, p], x[:, p])
                counts[p] += np.bincount(code[:, p], minlength=k)
        used = np.argwhere(counts)
        if len(used):
            p, e = used.T
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(counts[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    partial = state.select("x", "code").mapInArrow(run, "part long, entry long, n long, s array<long>")
    out = books.copy()
    for part, entry, n, *sums in partial.groupBy("part", "entry").agg(F.sum("n"), *(F.sum(F.col("s")[i]) for i in range(width))).collect():
        out[part, entry] = [s // n for s in sums]
    return out


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", looked: list[int] | None = None
) -> tuple[DataFrame, Codebooks]:
    """id, label, code (one byte a part) and error (squared distance in scaled components) of every vector that can be coded, and the codebooks.

    looked, if given, gets how many distances each round but the last assignment has worked out.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    codable = _codable(vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v")), parts)
    x = _integers(codable, scale)
    found = [bytes(r.x) for r in _integers(_first_rows(codable.withColumn("label", F.lit(0)), entries), scale).collect()]
    if not found:
        kinds = {f.name: f.dataType.simpleString() for f in x.schema}
        return vectors.sparkSession.createDataFrame([], f"id {kinds['id']}, label {kinds['label']}, code binary, error long"), Codebooks(np.zeros((parts, 0, 0), np.int64), scale)
    books = _books(found, parts)
    state, before = x.where(F.length("x") == len(found[0])), None
    for _ in range(rounds):
        after = cut(_pass(state, [_Round.of(b, None if before is None else before[p]) for p, b in enumerate(books)], before is None, False), "bounds")
        if looked is not None:
            looked.append(after.agg(F.sum("looked")).first()[0])
        if before is not None:
            release(state)
        state, before, books = after, books, _means(after, books)
    out = cut(_pass(state, [_Round.of(b, None if before is None else before[p]) for p, b in enumerate(books)], before is None, True), "codes")
    if before is not None:
        release(state)
    return out, Codebooks(books, scale)


def _first_rows(vectors: DataFrame, n: int) -> DataFrame:
    """The first n vectors that have the first one's length, in order."""
    order = [F.col("id").asc_nulls_last(), "v"]
    head = vectors.orderBy(*order).limit(1).select(F.size("v").alias("n")).collect()
    width = head[0].n if head else 0
    return vectors.where(F.size("v") == width).orderBy(*order).limit(n).coalesce(1).sortWithinPartitions(*order)


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """id and vector (array of doubles) that a code stands for. A code that is null, or not of these codebooks, has none."""
    parts, k, _ = books.entries.shape
    values = books.entries / books.scale

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if c is None or len(c) != parts or max(c, default=0) >= k else np.concatenate([values[p, e] for p, e in enumerate(c)]) for c in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], ["id", "vector"])

    return codes.select("id", "code").mapInArrow(run, f"id {codes.schema['id'].dataType.simpleString()}, vector array<double>")


def with_label_error(rows: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """label_error: error summed over rows of equal label, nulls being equal. Sums are broadcast if they are few, else joined by label and salt, as a label may hold a third of all rows."""
    sums = cut(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "labels")
    same = F.col("label").eqNullSafe(F.col("of"))
    if sums.count() <= broadcast_rows:
        return rows.join(F.broadcast(sums.withColumnRenamed("label", "of")), same).drop("of")
    dealt = sums.select(F.col("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_of"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, same & (F.col("salt") == F.col("salt_of"))).drop("of", "salt", "salt_of")


def _sql(rounds: int) -> str:
    """The same in SQL: every distance of every round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(
            f"""a{k} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := CAST(xx + cc - 2 * list_inner_product(x, c) AS BIGINT), e := e)) AS best
 FROM part JOIN book{k} USING (p) GROUP BY r, p)"""
        )
        if k < rounds:
            steps.append(
                f"""m{k} AS (SELECT p, e, list(v ORDER BY j) AS c FROM (SELECT p, a.best.e AS e, j, floor(sum(x[j]) / count(*)) AS v
 FROM a{k} a JOIN part USING (r, p), range(1, len(x) + 1) t(j) GROUP BY ALL) GROUP BY p, e),
book{k + 1} AS MATERIALIZED (SELECT p, e, c, list_inner_product(c, c) AS cc FROM (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN m{k} m USING (p, e)))"""
            )
    return f"""WITH kept AS MATERIALIZED (
SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS xx FROM (SELECT r, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM kept, range(4) t(p))),
book0 AS MATERIALIZED (SELECT p, r AS e, x AS c, xx AS cc FROM part WHERE r < 256),
{", ".join(steps)},
code AS MATERIALIZED (SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
total AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM code JOIN kept USING (r) GROUP BY label)
SELECT vec_id, code, error, label_error,
 (SELECT sha256(string_agg(CAST(CAST(c[j] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, j)) FROM book{rounds}, range(1, len(c) + 1) t(j)) AS codebooks_sha256
FROM code JOIN kept USING (r) JOIN total ON kept.label IS NOT DISTINCT FROM total.label"""


@query("op12_vector_codes", _sql(4))
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(rows).select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
