"""Operator 3, MinHash near-dedup by a multi-index Hamming join.

A text's set is that of its distinct word shingles (64-bit hashes of their words' hashes). Its signature is CHUNKS x WIDTH
minhashes cut to SYMBOL bits. Two signatures within MOST differing places have, by the pigeonhole principle, a chunk with one
error at most, so each signature is indexed once for each chunk and each place left out of it: all pairs under that
distance share a key. At similarity 0.85 (0.8) a pair is beyond the distance with probability 2e-5 (1e-3); near_groups(exact=True) finds those too.

No group is expanded into its pairs:

1. texts with equal sets are one class, named by a 64-bit hash of the set; sets that share this name but differ in a second 64-bit hash
   get names of their own (told_apart), so 128 bits tell sets apart; classes are the nodes from here on;
2. each key links its members to its centre only, the member that shares most keys; those within the distance are confirmed on
   the full sets;
3. where a key still holds several components, members of different components are compared as well, so that no link between
   different texts is lost: an exact prefix filter on their sets names the pairs to confirm, first those with each shingle's
   centre (centre_pairs), then all that are left (prefix_pairs);
4. components are found by label propagation with pointer jumping, on tables that are cut each round.

Full sets are made a second time, from the texts of nodes that have a pair to confirm. Those texts are found by a join; before
it a bitmap with 16 bits for each of them, MOST_BITMAP words (8 MB) at most, drops most others, so that few texts are shuffled. Beyond
some ten million of them it drops fewer, and more texts are shuffled.

Words: A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``. Fewer words than a shingle: the sequence is the one shingle. Texts
without words, and null, have the empty set, are linked with nothing and are their own component. component_id is
the smallest id reached; null ids are never the smallest unless alone, and a row is kept if its id is its
component_id (both may be null). Rows that share an id are each judged by their text. Columns other than id and
text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.llm.common import cut, table
from terrasift.llm.decl import query
from terrasift.llm.token_counts import slices

CHUNKS, WIDTH, SYMBOL = 10, 5, 14
PLACES, MOST, MOST_BITMAP = CHUNKS * WIDTH, 2 * CHUNKS - 1, 1 << 20
#: Words that a worker keeps the hashes of.
MEMO = 400_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of x reaches every bit of the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SEEDS = _mix(np.arange(1, PLACES + 2, dtype=np.uint64)) | np.uint64(1)


class _Words(dict):
    """Hashes of words, found once each."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < MEMO:
            self[word] = value
        return value


def shingle_set(text: bytes | None, size: int, words: dict) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    w = (text or b"").lower().split()  # of bytes: A-Z and ASCII white space only
    n = len(w)
    if not n:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(words.__getitem__, w), np.uint64, n)
    span = min(size, n)
    h = ids[: n - span + 1]
    for j in range(1, span):
        h = _mix(h) + ids[j : n - span + 1 + j]
    return np.unique(_mix(h + np.uint64(span)))


def set_hash(s: np.ndarray) -> int:
    """64 bits that tell a set from all others: a sum, so that order does not matter."""
    return int(np.add.reduce(_mix(s * _SEEDS[PLACES])).view(np.int64))


def second_hash(s: np.ndarray) -> int:
    """64 more bits, by another mix and another sum."""
    return int(np.bitwise_xor.reduce(_mix(_mix(s ^ _SEEDS[0]) + _SEEDS[1])).view(np.int64))


def signature(s: np.ndarray) -> np.ndarray:
    """The set's minhash symbols."""
    low = np.array([np.min(s * seed) for seed in _SEEDS[:PLACES]], np.uint64)
    return _mix(low) >> np.uint64(64 - SYMBOL)


def packed(symbols: np.ndarray) -> np.ndarray:
    """Symbols in lanes of 16 bits, four to an integer."""
    lanes = np.zeros(-(-PLACES // 4) * 4, np.uint16)
    lanes[:PLACES] = symbols
    return lanes.view(np.int64)


def distance(a: Column, b: Column) -> Column:
    """Differing lanes of two packed signatures."""
    def lanes(i: int) -> Column:
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        # A lane has 14 bits: adding 2^14 - 1 sets its bit 14 if it has any.
        return F.bit_count((x + F.lit(0x3FFF3FFF3FFF3FFF)).bitwiseAND(F.lit(0x4000400040004000)))

    return reduce(add, (lanes(i) for i in range(-(-PLACES // 4))))


def index_keys(sig: Column) -> Column:
    """Keys of a packed signature: chunk and place left out, then the other symbols as they are, in one integer."""
    symbol = [F.shiftrightunsigned(F.get(sig, F.lit(p // 4)), 16 * (p % 4)).bitwiseAND(F.lit((1 << SYMBOL) - 1)) for p in range(PLACES)]

    def key(chunk: int, out: int) -> Column:
        others = [symbol[chunk * WIDTH + j] for j in range(WIDTH) if j != out]
        return reduce(Column.bitwiseOR, (F.shiftleft(x, SYMBOL * k) for k, x in enumerate(others)), F.lit((chunk * WIDTH + out) << SYMBOL * (WIDTH - 1)))

    return F.array(*(key(c, out) for c in range(CHUNKS) for out in range(WIDTH)))


def _texts(batches: Iterator[pa.RecordBatch], column: int, size: int):
    words = _Words()
    with np.errstate(over="ignore"):
        for whole in batches:
            for batch in slices(whole, column, 8 << 20):
                yield batch, [shingle_set(t, size, words) for t in pc.cast(batch.column(column), pa.binary()).to_pylist()]


def sketch(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash, n_shingles, node (the set's hash; null for the empty set), second (its other hash), sig."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _texts(batches, 2, size):
            with np.errstate(over="ignore"):
                found = [signature(s) if len(s) else None for s in sets]
                nodes = [set_hash(s) if len(s) else None for s in sets]
                others = [second_hash(s) if len(s) else None for s in sets]
                sigs = [None if x is None else packed(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array(others, pa.int64()), pa.array(sigs, pa.list_(pa.int64()))],
                ["id", "text_hash", "n_shingles", "node", "second", "sig"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, text_hash long, n_shingles long, node long, second long, sig array<long>")


def _renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows (node, second, ...) with the names of those sets that got another one."""
    to = names.select(F.col("node").alias("_from"), F.col("second").alias("_second"), F.col("name").alias("_to"))
    out = rows.join(to, (F.col("node") == F.col("_from")) & (F.col("second") == F.col("_second")), "left")
    return out.withColumn("node", F.coalesce("_to", "node")).drop("_from", "_second", "_to")


def told_apart(rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """rows in which no two sets share a name, and what was renamed (node, second, name), round by round: of n sets about n * n / 2^65 pairs."""
    rounds = []
    while True:
        shared = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("second").alias("lo"), F.max("second").alias("hi")).where("lo <> hi")
        shared = cut(shared.select(F.col("node").alias("s_node"), "lo"), "shared-names")
        if not shared.limit(1).count():
            return rows, rounds
        names = rows.join(shared, F.col("node") == F.col("s_node")).where("second <> lo").select("node", "second").distinct()
        rounds.append(cut(names.withColumn("name", F.xxhash64("node", "second", F.lit(len(rounds)))), "names"))
        rows = cut(_renamed(rows, rounds[-1]), "sketch")


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str, names: tuple[DataFrame, ...] | list[DataFrame] = ()) -> DataFrame:
    """Full sets of the wanted rows (id, text_hash): node, s; ``names`` is what told_apart renamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _texts(batches, 0, size):
            sets = [s for s in sets if len(s)]
            with np.errstate(over="ignore"):
                own, others = [set_hash(s) for s in sets], [second_hash(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(others, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["node", "second", "s"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    wanted = cut(wanted.select(F.col("id").alias("w_id"), F.col("text_hash").alias("w_hash")), "wanted")
    n_words = min(MOST_BITMAP, 1 << max(10, (wanted.count() // 4).bit_length()))
    word = lambda h: F.pmod(h, F.lit(n_words))
    bit = lambda h: F.shiftrightunsigned(h, 58)
    bitmap = wanted.groupBy(word(F.col("w_hash")).alias("word")).agg(F.collect_set(bit(F.col("w_hash"))).alias("bits"))  # 64 bits a word at most
    rows = rows.join(F.broadcast(bitmap), (word(F.col("text_hash")) == F.col("word")) & F.array_contains("bits", bit(F.col("text_hash"))), "left_semi")
    rows = rows.join(wanted, F.col("id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_hash")), "left_semi")
    out = reduce(_renamed, names, rows.select("text").mapInArrow(run, "node long, second long, s array<long>"))
    return out.select("node", "s").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    left, right = (sets.select(F.col("node").alias(x), F.col("s").alias(f"s_{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    na, nb, common = F.size("s_a"), F.size("s_b"), F.size(F.array_intersect("s_a", "s_b"))
    fits = 100 * F.least(na, nb).cast("long") >= percent * F.greatest(na, nb).cast("long")
    return both.where(F.when(fits, 100 * common.cast("long") >= percent * (na + nb - common).cast("long")).otherwise(False)).select("a", "b")


def early_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """t, node, n, rest: the shingles in which a set and any linked one can first meet, and how many of the set are left from there on.

    Each set is put in one order, rare shingles first. What two linked sets have in common is so much that the first common shingle
    stands early in both: the rest of each from there on must hold the whole intersection. Shingles that only one set has take
    places, but can't be common, so they are counted and not joined.
    """
    each = sets.select("node", F.size("s").cast("long").alias("n"), F.explode("s").alias("t"))
    often = each.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(often, "t").withColumn("of", F.count("*").over(W.partitionBy("node")))
    place = F.col("n") - F.col("of") + F.row_number().over(W.partitionBy("node").orderBy("df", "t")) - 1
    return shared.withColumn("rest", F.col("n") - place).where(100 * F.col("rest") >= percent * F.col("n")).select("t", "node", "n", "rest")


def _may_link(percent: int) -> Column:
    """Whether sizes and what is left of both sets, a and b, allow a link; it holds at the first common shingle of linked sets."""
    fits = (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
    return (F.col("comp_a") != F.col("comp_b")) & fits & ((100 + percent) * F.least("rest_a", "rest_b") >= percent * (F.col("n_a") + F.col("n_b")))


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def centre_pairs(early: DataFrame, percent: int) -> DataFrame:
    """Of pairs from different components those with a shingle's centre, the set in which it stands earliest: one pair a row at most."""
    centre = early.groupBy("t").agg(F.max_by(F.struct("node", "comp", "n", "rest"), F.struct(F.col("rest") - F.col("n"), "node")).alias("c"))
    b = early.select("t", *(F.col(c).alias(f"{c}_b") for c in ("node", "comp", "n", "rest")))
    a = centre.select("t", *(F.col(f"c.{c}").alias(f"{c}_a") for c in ("node", "comp", "n", "rest")))
    return _pairs(b.join(a, "t").where(_may_link(percent)))


def prefix_pairs(early: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) from different components that early shingles allow; none that is linked is left out."""
    x, y = (early.select("t", *(F.col(c).alias(f"{c}_{k}") for c in ("node", "comp", "n", "rest"))) for k in "ab")
    return _pairs(x.join(y, (x["t"] == y["t"]) & (F.col("comp_a") < F.col("comp_b")) & _may_link(percent)))


def components(links: DataFrame) -> DataFrame:
    """node, comp: the smallest node that links (a, b) reach, for nodes that have links."""
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "comp": "near"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))  # a node's label is a node too
        new = cut(step.join(jump, "comp").select("node", "old", F.col("far").alias("comp")), "labels")
        changed = new.where("old <> comp").limit(1).count()
        labels = new.select("node", "comp")
        if not changed:
            return labels


def near_groups(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept; text_hash and first. Texts are linked if 100 * intersection >= percent * union.

    first: rows that stand for their component. They share one id and text, also where no row of a component has an id; those without words all stay.
    exact: the prefix filter goes over all classes, not only those that share a key with another component, so that pairs beyond the signatures' distance are found too. All texts' shingles are shuffled for it.
    """
    rows, names = told_apart(cut(sketch(docs, shingle, id_col, text_col), "sketch"))
    near = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    classes = cut(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("first_id"), F.min_by(F.struct("id", "text_hash", "sig"), near).alias("of"), F.min("n_shingles").alias("n")).select("node", "first_id", "n", "of.*"), "classes")
    sig = classes.select("node", "sig", "n")
    fits = (100 * F.col("n_a") >= percent * F.col("n_b")) & (100 * F.col("n_b") >= percent * F.col("n_a"))
    close = fits & (distance(F.col("sig_a"), F.col("sig_b")) <= MOST)

    def sets_of(nodes: DataFrame) -> DataFrame:
        return cut(shingle_sets(docs, classes.join(nodes, "node", "left_semi").select("id", "text_hash"), shingle, id_col, text_col, names), "sets")

    indexed = classes.select("node", F.explode(index_keys(F.col("sig"))).alias("key"))
    shared = indexed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = cut(indexed.join(shared, "key"), "members")
    # A key's centre is its member that shares most keys with most others: nearest to a copy's original, so that one round links most of a group.
    weight = members.groupBy("node").agg(F.sum("size").alias("weight"))
    centre = members.join(weight, "node").groupBy("key").agg(F.max_by("node", F.struct("weight", "node")).alias("rep"))
    members = members.select("key", "node").join(centre, "key")
    stars = members.where("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct()
    for x in "ab":
        stars = stars.join(sig.withColumnsRenamed({"node": x, "sig": f"sig_{x}", "n": f"n_{x}"}), x)
    stars = cut(stars.where(close).select("a", "b"), "stars")
    ends = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    links = cut(confirmed(stars, sets_of(ends), percent), "links")
    labels = components(links)
    known = members.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = known.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1").select("key")
    known = classes.join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")) if exact else known.join(mixed, "key", "left_semi").select("node", "comp").distinct()
    known = cut(known, "mixed")
    sets = sets_of(known)
    early = cut(early_shingles(sets, percent), "early")
    for pairs_of in (centre_pairs, prefix_pairs):
        now = known.select("node").join(labels, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"))
        more = cut(confirmed(cut(pairs_of(early.join(now, "node"), percent), "crossing"), sets, percent), "more")
        if more.limit(1).count():
            links = cut(links.unionByName(more), "links")
            labels = components(links)
    first = classes.select("node", "first_id", F.col("id").alias("of_id"), F.col("text_hash").alias("of_hash"))
    in_comp = cut(first.select("node", "first_id").join(labels, "node"), "in-comp")
    smallest = in_comp.groupBy("comp").agg(F.min("first_id").alias("comp_id"), F.expr("min_by(node, struct(first_id IS NULL, first_id, node))").alias("comp_node"))
    found = in_comp.join(smallest, "comp").select("node", "comp_id", "comp_node")
    found = first.join(found, "node", "left").select("node", "of_id", "of_hash", F.coalesce("comp_id", "first_id").alias("component_id"), F.coalesce("comp_node", "node").alias("comp_node"))
    out = rows.select("id", "text_hash", "n_shingles", "node").join(found, "node", "left")
    comp = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    is_first = F.expr("node IS NULL OR (node = comp_node AND id <=> of_id AND text_hash = of_hash)")
    return out.select(F.col("id").alias(id_col), "n_shingles", comp.alias("component_id"), F.col("id").eqNullSafe(comp).alias("kept"), "text_hash", is_first.alias("first"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept."""
    return near_groups(docs, shingle, percent, id_col, text_col, exact).drop("text_hash", "first")


ORACLE = """
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda e: e <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 1, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.n + y.n - p.c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS c FROM r GROUP BY doc_id) m USING (doc_id)
"""


@query("op3_near_dedup", ORACLE)
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
