"""Operator 4, mixing sources to target weights by cube-method balanced sampling.

A source's target comes from its weight by water filling: targets stop at ``cap`` times the source's size and the excess
is shared again by weight. A document of a source with target / size = q is taken floor(q) times, and once more with
probability f = q - floor(q). Which ones get that last copy is a balanced sample: the flight phase of the cube method
moves the vector of probabilities through the null space of two constraints, the source's documents and its
tokens, so both totals stay exact while all but two probabilities of a block reach 0 or 1.

Blocks have about ``block`` rows, dealt by a hash of id, size and, among equal rows, their number, so a hot source or id is as many blocks as it needs. What is left
fractional of them is dealt into blocks again, until one block holds a source's rest; there the last two are landed on the choice
that keeps tokens nearest. Passes are few: each keeps two rows of a block. What the landing missed is repaired by exchanges: of a source's distinct sizes a taken one and
one that is not are found whose difference makes up what is missing (either may be none), and one unit of each changes places, up to REPAIRS times.

The random steps are seeded by source, block and pass, and rows are ordered by id within a block, so reruns agree. Size: number of
``[^\\x20\\x09-\\x0D]+`` in the text, 0 for null; sizes of 0 are sampled by documents' total like all others. A null source is a
source, ordered last; null ids and repeated rows are units of their own. Columns other than id, text and source are
not read. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.llm.common import cut, table, words
from terrasift.llm.decl import query

WEIGHTS, SHARE, CAP, BLOCK, CHUNK = (5, 2, 1), 1.5, 2.0, 2048, 1_000_000
EPS = 1e-9
#: Exchanges a source may get after landing, and the unit in which tokens are summed, so that sums do not hang on their order.
REPAIRS, UNIT = 3, 1 << 20


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """source, source_size, n_docs, target. Its windows run in one task over one row a source, so sources are taken to be few (thousands).

    In the order of cap * size / weight, sources are filled to the cap as long as the level that the rest
    would get is at or above it; the others get weight times that level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    fill = W.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    prior = F.coalesce(F.sum("most").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing))
    total = share * F.sum("source_size").over(W.partitionBy())
    per = per.withColumn("level", (total - prior) / rest).withColumn("full", F.col("most") <= F.col("weight") * F.col("level"))
    level = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(fill.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return per.withColumn("water", level).select("source", "source_size", "n_docs", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def flight(p: list[float], sizes: list[int], rng: np.random.Generator) -> list[float]:
    """Move p through the null space of (1, ..., 1) and sizes until two entries at most are not 0 or 1."""
    p = [0.0 if x < EPS else 1.0 if x > 1 - EPS else x for x in p]
    waiting = iter([i for i, x in enumerate(p) if 0 < x < 1])
    held: list[int] = []
    draws = iter(rng.random(3 * len(p) + 8).tolist())
    while True:
        for i in waiting:
            held.append(i)
            if len(held) == 3:
                break
        if len(held) == 3:
            a, b, c = held
            u = (sizes[c] - sizes[b], sizes[a] - sizes[c], sizes[b] - sizes[a])
            if not any(u):
                u = (1, -1, 0)
        elif len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
            u = (1, -1)
        else:
            return p
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(held, u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(held, u, strict=True) if d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(held, u, strict=True):
            x = p[i] + step * d
            p[i] = 0.0 if x < EPS else 1.0 if x > 1 - EPS else x
        held = [i for i in held if 0 < p[i] < 1]


def land(p: list[float], sizes: list[int]) -> list[float]:
    """Settle the fractional entries, two at most, so that the tokens are nearest, then the documents."""
    open_ = [i for i, x in enumerate(p) if 0 < x < 1]
    tokens, count = sum(p[i] * sizes[i] for i in open_), sum(p[i] for i in open_)
    best = min(range(1 << len(open_)), key=lambda m: (abs(sum(sizes[i] for k, i in enumerate(open_) if m >> k & 1) - tokens), abs(m.bit_count() - count), m))
    p = list(p)
    for k, i in enumerate(open_):
        p[i] = float(best >> k & 1)
    return p


def exchange(taken: np.ndarray, free: np.ndarray, over: int) -> tuple[int, int] | None:
    """A taken size to give up and a free one to take, 0 for none, that bring ``over``, in UNIT tokens, nearest to 0; the least sizes of equals. None if nothing comes nearer."""
    a, b = np.unique(np.append(taken, 0)), np.unique(np.append(free, 0))
    want = a - over / UNIT
    at = np.searchsorted(b, want)
    best = None
    for k in (at - 1, at):
        k = np.clip(k, 0, len(b) - 1)
        left = np.abs(over - (a - b[k]) * UNIT)
        i = int(left.argmin())
        if best is None or left[i] < best[0]:
            best = (int(left[i]), int(a[i]), int(b[k[i]]))
    return None if best[0] >= abs(over) else best[1:]


def repaired(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """units (source, size, p of 0 or 1, ...; no two equal) after one exchange in each source whose tokens are off. wanted: w_source, wanted (UNIT tokens).

    Rows are counted by source, size and p first; a source's group has a row for each distinct size.
    """
    own = units.columns
    mark = F.struct(F.xxhash64(*own), F.xxhash64(F.lit(1), *own))
    groups = units.groupBy("source", "size", "p").agg(F.count("*").alias("n"), F.min(mark).alias("first"))
    groups = cut(groups, "sizes")
    taken = groups.groupBy(F.col("source").alias("t_source")).agg(F.sum(F.col("p").cast("long") * F.col("size") * F.col("n")).alias("taken"))
    off = taken.join(wanted, F.col("t_source").eqNullSafe(F.col("w_source"))).select("t_source", (F.col("taken") * UNIT - F.col("wanted")).alias("over")).where("over <> 0")
    sizes = groups.join(off, F.col("source").eqNullSafe(F.col("t_source"))).select("source", "size", "p", "over", "first")

    def choose(t: pa.Table) -> pa.Table:
        size, p = t.column("size").to_numpy(), t.column("p").to_numpy()
        found = exchange(size[p == 1], size[p == 0], t.column("over")[0].as_py())
        keep = np.zeros(len(t), bool) if found is None else ((p == 1) & (size == found[0]) | (p == 0) & (size == found[1])) & (size > 0)
        return t.filter(pa.array(keep)).select(["first"])

    kind = units.sparkSession.createDataFrame([], "first struct<col1:long,col2:long>").schema
    chosen = sizes.groupBy("source").applyInArrow(choose, kind).select(F.col("first.col1").alias("m1"), F.col("first.col2").alias("m2"), F.lit(True).alias("flip"))
    marked = units.withColumns({"m1": F.xxhash64(*own), "m2": F.xxhash64(F.lit(1), *own)}).join(chosen, ["m1", "m2"], "left")
    return marked.withColumn("p", F.when(F.col("flip"), 1 - F.col("p")).otherwise(F.col("p"))).select(*own)


def cube_sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """units: source, id, size and p in (0, 1), other columns are kept; p comes back as 0 or 1."""
    names = units.columns
    # Rows that are equal in all get numbers, so that they are dealt like others; a chunk's numbers are CHUNK at most.
    counted = units.groupBy(*names).agg(F.count("*").alias("_n"))
    chunks = counted.withColumn("_chunk", F.explode(F.expr(f"sequence(0, (_n - 1) div {CHUNK})")))
    units = cut(chunks.select(*names, F.explode(F.expr(f"sequence(_chunk * {CHUNK}, least((_chunk + 1) * {CHUNK}, _n) - 1)")).alias("_same")), "units")
    own = [*names, "_same"]
    wanted = cut(units.groupBy(F.col("source").alias("w_source")).agg(F.sum(F.round(F.col("p") * F.col("size") * UNIT).cast("long")).alias("wanted")), "wanted")

    def settle(t: pa.Table) -> pa.Table:
        if not len(t):
            return t.select(own)
        t = t.sort_by([("_at", "ascending"), ("id", "ascending"), ("size", "ascending"), ("_same", "ascending")])
        p, sizes = t.column("p").to_pylist(), t.column("size").to_pylist()
        p = flight(p, sizes, np.random.default_rng(t.column("_seed")[0].as_py() & (1 << 63) - 1))
        if t.column("_blocks")[0].as_py() == 1:
            p = land(p, sizes)
        return t.set_column(t.schema.get_field_index("p"), "p", pa.array(p, pa.float64())).select(own)

    done, level = [], 0
    while True:
        counts = units.groupBy(F.col("source").alias("c_source")).agg(F.count("*").alias("n"))
        counts = counts.select("c_source", F.ceil(F.col("n") / block).cast("int").alias("_blocks"))
        dealt = units.join(counts, F.col("source").eqNullSafe(F.col("c_source"))).drop("c_source").withColumn("_at", F.xxhash64("id", "size", "_same", F.lit(level)))
        dealt = dealt.withColumn("_block", F.pmod(F.col("_at"), F.col("_blocks")).cast("int")).withColumn("_seed", F.xxhash64("source", "_block", F.lit(level)))
        out = cut(dealt.groupBy("source", "_block").applyInArrow(settle, units.schema), f"cube-{level}")
        done.append(out.where("p = 0 OR p = 1"))
        units = out.where("p > 0 AND p < 1")
        level += 1
        if not units.limit(1).count():
            break
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    for _ in range(REPAIRS):
        whole = cut(repaired(whole.select(*own), wanted), "repaired")
    return whole.select(*names)


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row: id, size, source_size, target, copies, taken."""
    sizes = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size")), "sizes")
    targets = cut(source_targets(sizes, weights, share, cap).withColumnRenamed("source", "t_source"), "targets")
    q = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).withColumn("q", q).withColumn("whole", F.floor(F.col("q") + EPS))
    rows = rows.select("id", "source", "size", "source_size", "target", "whole", F.greatest(F.col("q") - F.col("whole"), F.lit(0.0)).alias("p"))
    out = rows.where(F.col("p") <= EPS).withColumn("p", F.lit(0.0)).unionByName(cube_sample(rows.where(F.col("p") > EPS), block))
    copies = F.col("whole") + F.col("p").cast("long")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copies")
