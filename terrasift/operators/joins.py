"""Joins of the feeds: three-table registration, upsert, gaps, fuzzy words, label lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def registrations(ra: DataFrame, en: DataFrame, co: DataFrame, states: list[str], statuses: list[str]) -> DataFrame:
    """Filtered registrations (usi; the last row wins), their first non-empty owner, one row for each of their coordinates.

    ra: usi, ord, state, status, ...; en: usi, ord, contact_type, owner; co: usi, ord, lon, lat.
    """
    from terrasift.operators.rows import best_by_key

    kept = best_by_key(ra.where(F.upper(F.trim("state")).isin(*states) & F.upper(F.trim("status")).isin(*statuses)), ["usi"], [F.col("ord")]).drop("ord")
    owner = en.where(F.coalesce(F.trim("contact_type"), F.lit("")).isin("O", "") & (F.trim("owner") != "")).groupBy("usi").agg(F.min_by("owner", "ord").alias("owner"))
    return co.join(kept, "usi").join(owner, "usi", "left")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], overwrite: bool = False) -> DataFrame:
    """The union in which existing rows win, or new ones if ``overwrite``."""
    wins, gives = (new, old) if overwrite else (old, new)
    return wins.unionByName(gives.join(wins.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def lookup(code: Column, labels: dict[str, str]) -> Column:
    """A code's label; an unknown code stays."""
    pairs = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))
    return F.coalesce(pairs[code], code)


def gaps(areas: DataFrame, records: DataFrame, chosen: DataFrame, fetched: DataFrame, key: str, name: str) -> DataFrame:
    """Areas without a choice, each in one class: notfetched, empty (no record), unnamed (records without name), unmatched."""
    seen = records.groupBy(key).agg(F.count("*").alias("n"), F.count(F.nullif(F.trim(name), F.lit(""))).alias("named"))
    out = areas.join(chosen.select(key).distinct(), key, "left_anti").join(seen, key, "left").join(fetched.select(key).distinct().withColumn("asked", F.lit(True)), key, "left")
    kind = F.when(F.col("asked").isNull(), "notfetched").when(F.col("n").isNull(), "empty").when(F.col("named") == 0, "unnamed").otherwise("unmatched")
    return out.select(*areas.columns, kind.alias("gap"), F.coalesce("n", F.lit(0)).alias("n_records"))


def _deletions(word: Column, most: int) -> Column:
    """A word and all that is left of it when up to ``most`` characters are taken out."""
    without = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    every = last = F.array(word)
    for _ in range(most):
        last = F.array_distinct(F.flatten(F.transform(last, without)))
        every = F.concat(every, last)
    return F.array_distinct(every)


def near_words(words: DataFrame, vocabulary: DataFrame, most: int = 2, least_length: int = 6) -> DataFrame:
    """Pairs of a word and a vocabulary word within ``most`` edits, the word not being in the vocabulary.

    Two words within ``most`` edits become equal when up to ``most`` characters are taken out of each. So both sides meet on what is left, by
    hash, and only such pairs are measured. Only words that are near each other share a key, however many begin or end alike.
    """
    w = words.select(F.col("word")).distinct().where(F.length("word") >= least_length).join(vocabulary.select(F.col("word")), "word", "left_anti")
    v = vocabulary.select(F.col("word").alias("ref")).distinct().where(F.length("ref") >= least_length)
    keys = lambda c: F.explode(F.array_distinct(F.transform(_deletions(F.col(c), most), lambda x: F.xxhash64(x)))).alias("key")
    pairs = w.select("word", keys("word")).join(v.select("ref", keys("ref")), "key").select("word", "ref").distinct()
    return pairs.withColumn("edits", F.levenshtein("word", "ref", most)).where("edits >= 0")


def overlapping_boxes(a: DataFrame, b: DataFrame, cell: float) -> DataFrame:
    """a_id, b_id of boxes (id, xmin, ymin, xmax, ymax) that overlap, closed; an equi-join on cells, tested after."""

    def dealt(df: DataFrame, t: str) -> DataFrame:
        span = lambda p, q: F.sequence(F.floor(F.col(p) / cell), F.floor(F.col(q) / cell))
        cols = [F.col("id").alias(f"{t}_id"), *(F.col(c).alias(f"{t}_{c}") for c in ("xmin", "ymin", "xmax", "ymax"))]
        return df.withColumn("cx", F.explode(span("xmin", "xmax"))).withColumn("cy", F.explode(span("ymin", "ymax"))).select(*cols, "cx", "cy")

    j = dealt(a, "a").join(dealt(b, "b"), ["cx", "cy"])
    return j.where("a_xmin <= b_xmax AND a_xmax >= b_xmin AND a_ymin <= b_ymax AND a_ymax >= b_ymin").select("a_id", "b_id").distinct()
