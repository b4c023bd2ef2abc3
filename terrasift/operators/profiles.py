"""What tables nobody has described hold: figures by column from one pass of mergeable sketches, candidate keys, and columns whose values are another table's keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A column may be a key if its sketch tells at least this share of its rows apart (the sketch is off by 2 percent or so); that it is one is counted then.
LIKELY = 0.9


def _text(c: str) -> Column:
    return F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))


def profile(df: DataFrame) -> DataFrame:
    """Column, kind, n_rows, n (values that are there), about (distinct ones, by a sketch), shortest, longest, least and most as numbers (null if some value is none), top and top_n (the most frequent value, by a sketch).

    One pass over the rows: tasks fill sketches that are merged, whatever the number of columns or values.
    """
    cols = df.columns
    whole = lambda c: _text(c).try_cast("double")
    one = lambda i, c: [
        F.count(_text(c)).alias(f"n{i}"),
        F.approx_count_distinct(_text(c), 0.02).alias(f"d{i}"),
        F.min(F.length(_text(c))).alias(f"s{i}"),
        F.max(F.length(_text(c))).alias(f"l{i}"),
        F.when(F.count(whole(c)) == F.count(_text(c)), F.min(whole(c))).alias(f"a{i}"),
        F.when(F.count(whole(c)) == F.count(_text(c)), F.max(whole(c))).alias(f"z{i}"),
        F.expr(f"approx_top_k(nullif(trim(CAST(`{c}` AS STRING)), ''), 1, 1000)").alias(f"t{i}"),
    ]
    row = df.agg(F.count("*").alias("rows"), *(m for i, c in enumerate(cols) for m in one(i, c)))
    top = lambda i: F.get(F.filter(F.col(f"t{i}"), lambda t: t.item.isNotNull()), F.lit(0))
    told = F.array(
        *(
            F.struct(
                F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("kind"), F.col("rows").alias("n_rows"), F.col(f"n{i}").alias("n"), F.col(f"d{i}").alias("about"), F.col(f"s{i}").alias("shortest"),
                F.col(f"l{i}").alias("longest"), F.col(f"a{i}").alias("least"), F.col(f"z{i}").alias("most"), top(i).item.alias("top"), top(i)["count"].alias("top_n"),
            )
            for i, c in enumerate(cols)
        )
    )
    return row.select(F.explode(told).alias("r")).select("r.*")


def candidate_keys(df: DataFrame) -> DataFrame:
    """Column, n_rows, serial: the columns that have a value in every row, none of them twice. serial tells numbers that only count the rows: a key within its table, but one that names nothing anywhere else.

    The profile's sketches leave few columns; for those the values are counted exactly, all in one pass.
    """
    likely = [r for r in profile(df).collect() if r.n == r.n_rows and r.n and r.about >= LIKELY * r.n]
    if not likely:
        return df.sparkSession.createDataFrame([], "column string, n_rows long, serial boolean")
    each = df.select(F.explode(F.array(*(F.struct(F.lit(r.column).alias("column"), F.xxhash64(_text(r.column)).alias("h"), _text(r.column).alias("v")) for r in likely))).alias("x")).select("x.*")
    twice = each.groupBy("column", "h", "v").agg(F.count("*").alias("n")).where("n > 1").select("column").distinct()
    serial = lambda r: r.least is not None and r.least in (0.0, 1.0) and r.most - r.least + 1 == r.n_rows
    rows = df.sparkSession.createDataFrame([(r.column, r.n_rows, bool(serial(r))) for r in likely], "column string, n_rows long, serial boolean")
    return rows.join(twice, "column", "left_anti")


def references(tables: dict[str, DataFrame], keys: list[tuple[str, str]]) -> DataFrame:
    """Table, column, key_table, key_column, n_values, n_found: for columns that share a value with a key of another column, how many distinct values they have and how many of them are the key's.

    All columns of all tables meet all keys in one join on values; a value meets as many rows as there are columns that have it, so pairs grow with the schema, not with the rows. What has all its values found
    refers to that key, as far as the rows tell; whether a serial key is meant cannot be told from values.
    """
    parts = [
        df.select(F.lit(t).alias("table"), F.explode(F.array(*(F.struct(F.lit(c).alias("column"), _text(c).alias("v")) for c in df.columns))).alias("x")).select("table", "x.*").where("v IS NOT NULL").distinct()
        for t, df in tables.items()
    ]
    values = reduce(DataFrame.unionByName, parts)
    of = reduce(lambda a, b: a | b, ((F.col("table") == t) & (F.col("column") == c) for t, c in keys), F.lit(False))
    known = values.where(of).select(F.col("table").alias("key_table"), F.col("column").alias("key_column"), "v")
    found = values.join(known, "v").where("table <> key_table OR column <> key_column").groupBy("table", "column", "key_table", "key_column").agg(F.count("*").alias("n_found"))
    return found.join(values.groupBy("table", "column").agg(F.count("*").alias("n_values")), ["table", "column"]).select("table", "column", "key_table", "key_column", "n_values", "n_found")
