"""Inventories of packs and fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions.scalar import squash_name, tone_kind, tone_note

#: Order of problems; any other kind comes after.
SEVERITY = {"BROKEN": 0, "DUPLICATE": 1, "STALE": 2, "EMPTY": 3, "NO SOURCE": 4}
#: Words of a hint on which names meet it.
HEAD_WORDS = 4


def field_fill(df: DataFrame, fields: str, source: str) -> DataFrame:
    """How many values of each key are not empty, by source and over all (source null)."""
    each = df.select(source, F.explode(fields).alias("key", "value")).where(F.trim("value") != "")
    return each.groupBy(F.col("key"), F.col(source)).agg(F.count("*").alias("n")).unionByName(each.groupBy("key").agg(F.count("*").alias("n")).select("key", F.lit(None).cast("string").alias(source), "n"))


def coverage(df: DataFrame, candidates: dict[str, list[Column]]) -> DataFrame:
    """A10: of all rows, how many have a value in the first of each field's columns that has one; in one pass."""
    full = {k: F.coalesce(*(F.nullif(F.trim(c.cast("string")), F.lit("")) for c in cs)) for k, cs in candidates.items()}
    row = df.agg(F.count("*").alias("n_rows"), *(F.count(v).alias(k) for k, v in full.items()))
    return row.select(F.explode(F.array(*(F.struct(F.lit(k).alias("field"), F.col(k).alias("n"), F.col("n_rows")) for k in full))).alias("r")).select("r.*", F.when(F.col("r.n_rows") > 0, F.round(100 * F.col("r.n") / F.col("r.n_rows"), 1)).alias("percent"))


def missing_fields(columns: list[str], mapping: dict[str, list[str]]) -> list[str]:
    """mapped keys none of whose candidates is a column, by letters and digits."""
    there = {squash_name(c) for c in columns}
    return [k for k, cs in mapping.items() if not any(squash_name(c.lstrip("!").split("@")[0]) in there for c in cs)]


def newest_editions(files: DataFrame) -> DataFrame:
    """Each family's newest file, null where two share the latest time; how many others there are. files: family, path, mtime, size."""
    at = files.groupBy("family", "mtime").agg(F.count("*").alias("k"), F.min("path").alias("path"), F.sum("size").alias("size"))
    last = at.groupBy("family").agg(F.sum("k").alias("n"), F.sum("size").alias("size"), F.max_by(F.struct("k", "path"), "mtime").alias("r"))
    return last.select("family", F.when(F.col("r.k") == 1, F.col("r.path")).alias("newest"), (F.col("n") - 1).alias("others"), "size")


def pack_problems(packs: DataFrame, contained: DataFrame) -> DataFrame:
    """Path, kind, detail in order of severity. packs: path, family, mtime, sha, n_placemarks, provenance, error."""
    bad = lambda rows, kind, detail: rows.select("path", F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))
    fine = packs.where("error IS NULL")
    twice = fine.groupBy("sha").agg(F.count("*").alias("n"), F.min("path").alias("first")).where("n > 1").withColumnRenamed("sha", "d_sha")
    newest = fine.groupBy("family").agg(F.max("mtime").alias("latest")).withColumnRenamed("family", "n_family")
    dup = fine.join(twice, F.col("sha") == F.col("d_sha")).where("path <> first")
    old = fine.join(newest, F.col("family") == F.col("n_family")).where("mtime < latest")
    out = bad(packs.where("error IS NOT NULL"), "BROKEN", F.col("error")).unionByName(bad(dup, "DUPLICATE", F.col("first"))).unionByName(bad(old, "STALE", F.col("family")))
    out = out.unionByName(bad(fine.where("n_placemarks = 0"), "EMPTY", F.lit(""))).unionByName(bad(fine.where("provenance IS NULL"), "NO SOURCE", F.lit("")))
    out = out.unionByName(contained.select(F.col("inner").alias("path"), F.lit("CONTAINED").alias("kind"), F.col("outer").alias("detail")))
    rank = F.coalesce(F.create_map(*(F.lit(x) for kv in SEVERITY.items() for x in kv))[F.col("kind")], F.lit(9))
    return out.withColumn("rank", rank).orderBy("rank", "path")


def legacy_of(files: DataFrame, families: DataFrame, least: int = 3) -> DataFrame:
    """Files without an edition whose name begins with a family's. A name meets families as each of its beginnings, by equality, so names that begin alike make no pairs."""
    f = families.select("family").where(F.length("family") >= least).distinct()
    heads = F.explode(F.transform(F.sequence(F.lit(least), F.length("name") - 1), lambda n: F.substring("name", F.lit(1), n)))
    return files.select("name").distinct().where(F.length("name") > least).select("name", heads.alias("family")).join(f, "family").select("name", "family")


def widening(records: DataFrame, hints: DataFrame, group: str = "geoid", name: str = "name") -> DataFrame:
    """For each hint, in how many groups some record's name has it as words, of whatever length. Hints without a word are in none.

    Hints of up to HEAD_WORDS words are runs of a name's words, met by equality, each run once a group. Longer ones meet names on the hints' first words, then the whole hint is looked for.
    Neither side is broadcast: names grow into all their runs, which Spark's estimate of their size does not know.
    """
    from terrasift.operators.rows import _grams

    cut = lambda c: F.filter(F.split(F.lower(c), "[^a-z0-9']+"), lambda w: w != "")
    spaced = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    each = records.select(group, cut(F.col(name)).alias("words")).where("size(words) > 0").distinct()
    runs = each.select(group, F.explode(F.concat(*(_grams(F.col("words"), n) for n in range(1, HEAD_WORDS + 1)))).alias("run")).distinct()
    heads = each.where(F.size("words") > HEAD_WORDS).select(group, spaced(F.array_join("words", " ")).alias("whole"), F.explode(F.array_distinct(_grams(F.col("words"), HEAD_WORDS))).alias("run"))
    asked = hints.select("hint").distinct().withColumn("own", cut(F.col("hint"))).where("size(own) > 0")
    asked = asked.select("hint", F.size("own").alias("n"), F.array_join("own", " ").alias("own"), F.array_join(F.slice("own", 1, HEAD_WORDS), " ").alias("run"))
    short = asked.where(F.col("n") <= HEAD_WORDS).join(runs.hint("merge"), "run")
    long = asked.where(F.col("n") > HEAD_WORDS).join(heads.hint("merge"), "run").where(F.contains("whole", spaced(F.col("own"))))
    found = short.select("hint", group).unionByName(long.select("hint", group))
    none = hints.select("hint", F.lit(None).cast(records.schema[group].dataType).alias(group))
    return none.unionByName(found).groupBy("hint").agg(F.count_distinct(group).alias("groups"))


def two_way_missing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of only one side, and which."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("only", F.lit("a")).unionByName(y.join(x, key, "left_anti").withColumn("only", F.lit("b")))


def names_of_county(records: DataFrame, counties: DataFrame) -> DataFrame:
    """Records whose county's name is not in their own. records: geoid, name; counties: geoid, county."""
    return records.join(counties, "geoid").where(~F.contains(F.lower("name"), F.lower("county")))


def tone_report(records: DataFrame, tone: str, name: str) -> DataFrame:
    """Kind, value, note, n, example: how many records have each kind of tone; those that are none by value (null for the other kinds), with a note and the first name."""
    kind = tone_kind(F.col(tone))
    value = F.when(kind == "unrecognised", F.trim(tone))
    return records.groupBy(kind.alias("kind"), value.alias("value")).agg(F.count("*").alias("n"), F.min(F.when(value.isNotNull(), F.col(name))).alias("example")).select("kind", "value", tone_note(F.col("value")).alias("note"), "n", "example")
