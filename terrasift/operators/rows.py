"""Deduplication, choice within groups, counts and group order. Everything that keeps "the first" has an explicit order column.

First and last by key are aggregates with min_by and max_by: they combine within tasks, so that a hot key is one
row a task, where a window would sort all its rows in one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.operators.lineage import cut


def first_by_key(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """Each key's first row; rows with a null among the keys are never merged."""
    known = reduce(lambda a, b: a & b, (k.isNotNull() for k in keys))
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    one = df.where(known).groupBy(*(k.alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")
    return one.unionByName(df.where(~known))


def last_wins_first_place(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with one key the last one's values, at the first one's place."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_r"), F.min(order).alias("place")).select("_r.*", "place")


def best_by_key(df: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """Each key's row of the highest rank; a last, unique rank column decides ties."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*rank)).alias("_r")).select("_r.*")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """Each key's first k rows, with their rank."""
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def distinct_in_order(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each combination once, with the place where it first stands."""
    return df.groupBy(*keys).agg(F.min(order).alias("place")).orderBy("place")


def placed(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Each row's place within its group; the order needs a last, unique column."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "place") -> DataFrame:
    """As placed, from 0, for keys that may hold a large part of the rows: rows are dealt by ranges of key and order, so a key is many tasks, and numbered by range; what stands in the ranges before is added."""
    ranges = df.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *(F.col(k) for k in keys), *order)
    dealt = cut(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = counts.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_range").alias("_r"), (F.sum("_n").over(W.partitionBy(*keys).orderBy("_range")) - F.col("_n")).alias("_before"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)), F.col("_range") == F.col("_r"))
    own = dealt.withColumn("_own", F.row_number().over(W.partitionBy("_range", *keys).orderBy(*order)) - 1)
    return own.join(before, same).select(*df.columns, (F.col("_own") + F.col("_before")).alias(name))


def counts_with_zeros(df: DataFrame, classes: DataFrame, key: str, *more: Column) -> DataFrame:
    """How many rows each class has, and further aggregates; classes without rows have 0, as they were asked for, and no other value."""
    n = df.groupBy(key).agg(F.count("*").alias("n"), *more)
    return classes.join(n, key, "left").select(*classes.columns, F.coalesce("n", F.lit(0)).alias("n"), *n.columns[2:])


def bucketize(df: DataFrame, candidates: list[str], most: int = 80, blank: str = "(blank)") -> tuple[str | None, DataFrame]:
    """Counts by the first candidate that is not all blank and has few enough labels (blank is one).

    One pass counts every candidate's labels; numbers come first, from large to small, then texts, blank last (``place``).
    """
    label = lambda c: F.coalesce(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")), F.lit(blank))
    seen = df.agg(*(F.count_distinct(label(c)).alias(f"n{i}") for i, c in enumerate(candidates)), *(F.count_if(label(c) != blank).alias(f"m{i}") for i, c in enumerate(candidates))).first()
    by = next((c for i, c in enumerate(candidates) if seen[f"m{i}"] and seen[f"n{i}"] <= most), None)
    if by is None:
        return None, df.groupBy(F.lit("").alias("bucket")).agg(F.count("*").alias("n")).withColumn("place", F.lit(1))
    number = F.col("bucket").try_cast("double")
    kind = F.when(F.col("bucket") == blank, 2).when(number.isNull(), 1).otherwise(0)
    counts = df.groupBy(label(by).alias("bucket")).agg(F.count("*").alias("n"))
    return by, counts.withColumn("place", F.row_number().over(W.orderBy(kind, F.desc_nulls_last(number), "bucket")))


def shared_groups(df: DataFrame, keys: list[str], what: str, least: int = 2) -> DataFrame:
    """Keys with several rows, with the distinct values of a column; ``contested`` if those differ."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sort_array(F.collect_set(what)).alias("values"))
    return g.where(F.col("n") >= least).withColumn("contested", F.size("values") > 1)


def key_histogram(df: DataFrame, tags: str, top: int = 40) -> DataFrame:
    """The most frequent keys of a map column."""
    return df.select(F.explode(F.map_keys(tags)).alias("key")).groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key").limit(top)


def contained_sets(df: DataFrame, owner: str, item: str) -> DataFrame:
    """Owners whose items are a strict subset of another owner's, with the first such one.

    Owners of equal sets are one set, named by the smallest of them. A superset has a set's two rarest items, so sets meet on those two alone, and pairs
    are dropped in the join unless sizes and four words of hashed items allow a subset; items themselves are compared for what is left. Of a superset only such pairs of items
    are made as are the two rarest of some set, so a large set does not become all its pairs.
    """
    items = df.select(F.col(owner).alias("o"), F.col(item).alias("i")).where(F.col("i").isNotNull()).distinct()
    sets = items.groupBy("o").agg(F.array_sort(F.collect_list("i")).alias("s"))
    named = cut(sets.groupBy("s").agg(F.min("o").alias("id"), F.collect_list("o").alias("owners")))
    word = lambda k: f"aggregate(s, 0L, (a, i) -> IF(xxhash64(i) & 3 = {k}, a | shiftleft(1L, CAST(pmod(shiftright(xxhash64(i), 2), 64) AS INT)), a)) AS w{k}"
    marked = cut(named.selectExpr("id", "s", "size(s) AS n", *(word(k) for k in range(4))), "sets")
    often = items.groupBy("i").agg(F.count("*").alias("often"))
    each = marked.select("id", F.explode("s").alias("i"))
    ranked = each.join(often, "i").groupBy("id").agg(F.slice(F.array_sort(F.collect_list(F.struct("often", "i"))), 1, 2).alias("r"))
    rare = cut(ranked.select("id", F.get("r", F.lit(0)).i.alias("i"), F.get("r", F.size("r") - 1).i.alias("j")), "rare")
    inner = marked.drop("s").join(rare, "id")
    inner = inner.withColumnsRenamed({c: f"in_{c}" for c in inner.columns if c not in ("i", "j")})
    asked = rare.select("i", "j").distinct().groupBy("i").agg(F.collect_set("j").alias("js"))
    outer = marked.select("id", "n", "s", "w0", "w1", "w2", "w3", F.explode("s").alias("i")).join(asked, "i")
    outer = outer.select("id", "n", "w0", "w1", "w2", "w3", "i", F.explode(F.array_intersect("s", "js")).alias("j"))
    may = F.expr("in_n < n AND " + " AND ".join(f"in_w{k} & ~w{k} = 0" for k in range(4)))
    pairs = inner.join(outer, ["i", "j"]).where(may).select("in_id", "id")
    pairs = pairs.join(named.select(F.col("id").alias("in_id"), F.col("s").alias("in_s")), "in_id").join(named.select("id", "s"), "id")
    first = pairs.where("size(array_except(in_s, s)) = 0").groupBy("in_id").agg(F.min("id").alias("outer"))
    return named.select(F.col("id").alias("in_id"), F.explode("owners").alias("inner")).join(first, "in_id").select("inner", "outer")


def ngrams(text: Column, sizes: tuple[int, ...] = (2, 3)) -> Column:
    """Distinct word n-grams of a text; words have letters, digits or apostrophes, two at least."""
    w = F.filter(F.split(F.lower(text), "[^a-z0-9']+"), lambda x: F.length(x) > 1)
    return F.array_distinct(F.concat(*(_grams(w, n) for n in sizes)))


def _grams(w: Column, n: int) -> Column:
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


def term_frequency(df: DataFrame, text: Column, group: str, least: int = 2) -> DataFrame:
    """In how many groups each n-gram occurs."""
    grams = df.select(group, F.explode(ngrams(text)).alias("term")).distinct()
    return grams.groupBy("term").agg(F.count(group).alias("groups")).where(F.col("groups") >= least)


def prune_terms(rows: list[tuple[str, int]], top: int = 8) -> list[str]:
    """A13's end: terms by groups and length, without those that a chosen one contains or is contained in; a short list, after top-k."""
    chosen: list[str] = []
    for term, _ in sorted(rows, key=lambda r: (-r[1], -len(r[0]), r[0])):
        if not any(term in c or c in term for c in chosen):
            chosen.append(term)
        if len(chosen) == top:
            break
    return chosen
