"""Operator 8, license scans by diagonal voting, in DataFrame functions only.

Every rolling k-gram of a text's words is joined to the positions that it has in the templates. A hit at word p
of the text and word q of a template votes for the diagonal p - q. Diagonals at most ``gap`` apart (a few
words put in or left out) are merged to one span, and a span counts if its hits, compared as words
and not as hashes only, cover at least ``coverage`` of the template's words.

Templates are a fixed table of this module or the caller's argument, so broadcasting them is bounded; one over
MAX_TEMPLATE_WORDS words in all is refused. Everything else is grouped by document.

Null and empty texts have no words and no labels (score 0). Rows with the same id and text are one document,
each row gets its result; rows with one id and different texts are told apart. Null ids are kept. Columns other
than id and text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.llm.common import table
from terrasift.llm.decl import query

#: Phrases whose places count, with their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices that this module labels by itself, from the licences' own published instructions for use.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by-4.0": ["licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0"],
    "gpl-3.0": [
        "licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    ],
    "mit-notice": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
}
MAX_TEMPLATE_WORDS = 100_000

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(text: Column) -> Column:
    """A to Z in lower case. Other letters may change as well, but only to word characters beyond ASCII, so that no word of ASCII letters comes or goes.

    The one other letter whose lower case is ASCII, the sign for Kelvin, is taken out of the way first.
    """
    return F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("\u212a"), F.lit("\ue000")))


def license_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return F.filter(F.split(_lower(text), _BREAK), lambda w: w != "")


def _template_rows(templates: dict[str, list[str]], k: int) -> list[tuple[str, int, int, int, str]]:
    """label, template, its words, position, k-gram. A template of fewer than k words can't vote and is refused."""
    rows, total = [], 0
    texts = [(label, t) for label, several in sorted(templates.items()) for t in several]
    for n, (label, text) in enumerate(texts):
        words = [w for w in re.split(_BREAK, text.lower()) if w]
        total += len(words)
        if len(words) < k or total > MAX_TEMPLATE_WORDS:
            raise ValueError(f"template {n} of {label!r}: {len(words)} words; k is {k}, all may have {MAX_TEMPLATE_WORDS}")
        rows += [(label, n, len(words), q, " ".join(words[q : q + k])) for q in range(len(words) - k + 1)]
    return rows


def template_table(spark: SparkSession, templates: dict[str, list[str]], k: int) -> DataFrame:
    rows = ", ".join(f"('{label}', {n}, {size}, {q}, '{gram}')" for label, n, size, q, gram in _template_rows(templates, k))
    return spark.sql(f"SELECT label, tpl, tpl_words, q, gram AS t_gram, xxhash64(gram) AS t_hash FROM VALUES {rows} AS t(label, tpl, tpl_words, q, gram)")


def diagonal_spans(docs: DataFrame, templates: dict[str, list[str]] | None = None, k: int = 4, gap: int = 2, coverage: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verified spans: id, text_hash, label, tpl, first_word, last_word (the span's), votes, covered (0 to 1)."""
    spark = docs.sparkSession
    tpl = template_table(spark, TEMPLATES if templates is None else templates, k)
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), license_words(F.col(text_col)).alias("w"))
    grams = base.where(F.size("w") >= k).select(
        "id", "text_hash", F.posexplode(F.transform(F.sequence(F.lit(1), F.size("w") - (k - 1)), lambda i: F.array_join(F.slice("w", i, k), " "))).alias("p", "gram")
    )
    hits = grams.withColumn("hash", F.xxhash64("gram")).join(F.broadcast(tpl), (F.col("hash") == F.col("t_hash")) & (F.col("gram") == F.col("t_gram")))
    doc = ["id", "text_hash", "label", "tpl", "tpl_words"]
    # Repeated rows vote again; sets of positions keep that without effect.
    votes = hits.groupBy(*doc, (F.col("p") - F.col("q")).alias("diagonal")).agg(F.min("p").alias("p0"), F.max("p").alias("p1"), F.collect_set("q").alias("qs"))
    along = W.partitionBy(*doc).orderBy("diagonal")
    opened = votes.withColumn("opens", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > gap, F.lit(True)).cast("int"))
    merged = opened.withColumn("span", F.sum("opens").over(along)).groupBy(*doc, "span").agg(F.min("p0").alias("first_word"), (F.max("p1") + k - 1).alias("last_word"), F.array_distinct(F.flatten(F.collect_list("qs"))).alias("qs"))
    spread = F.array_distinct(F.flatten(F.transform("qs", lambda q: F.sequence(q, q + (k - 1)))))
    return merged.select(*doc[:4], "first_word", "last_word", F.size("qs").alias("votes"), (F.size(spread) / F.col("tpl_words")).alias("covered")).where(F.col("covered") >= coverage)


def _starts(parts: list[str]) -> Callable[[Column], Column]:
    """Whether a phrase stands at a word."""
    return lambda i: reduce(and_, (F.get("w", i + j) == part for j, part in enumerate(parts)))


def scan_licenses(docs: DataFrame, templates: dict[str, list[str]] | None = None, k: int = 4, gap: int = 2, coverage: float = 0.6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: places of PHRASES, their labels, and all labels with those of verified spans. score: the best covered share, 1 for a phrase."""
    found = diagonal_spans(docs, templates, k, gap, coverage, id_col, text_col)
    of_doc = found.groupBy(F.col("id").alias("v_id"), F.col("text_hash").alias("v_hash")).agg(F.collect_set("label").alias("v_labels"), F.max("covered").alias("v_score"))
    text = _lower(F.col(text_col))
    base = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), text.alias("low"), license_words(F.col(text_col)).alias("w"))
    places = {}
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        there = F.lit(True)
        for part in sorted(parts, key=len):
            there = there & F.contains("low", F.lit(part))
        places[label] = F.when(there, F.filter(F.sequence(F.lit(0), F.size("w")), _starts(parts))).otherwise(F.array().cast("array<int>"))
    base = base.select("id", "text_hash", F.size("w").cast("long").alias("n_words"), *(p.alias(f"at_{label}") for label, p in places.items()))
    every = F.concat(*(F.col(f"`at_{label}`") for label in places))
    b_labels = F.filter(F.array(*(F.when(F.size(f"`at_{label}`") > 0, F.lit(label)) for label in places)), lambda x: x.isNotNull())
    joined = base.join(of_doc, F.col("id").eqNullSafe(F.col("v_id")) & (F.col("text_hash") == F.col("v_hash")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(b_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(b_labels, F.coalesce("v_labels", F.array().cast("array<string>")))), ",").alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce("v_score", F.lit(0.0))).alias("score"),
    )


def _oracle(k: int = 4, gap: int = 2, coverage: float = 0.6) -> str:
    rows = ", ".join(f"('{label}', {n}, {size}, {q}, '{gram}')" for label, n, size, q, gram in _template_rows(TEMPLATES, k))
    phrase = lambda p: " AND ".join(f"w[i + {j}] = '{x}'" if j else f"w[i] = '{x}'" for j, x in enumerate(p.split()))
    at = " UNION ALL ".join(f"SELECT doc_id, h, '{label}' AS label, i - 1 AS p FROM x, unnest(range(1, len(w) + 1)) AS u(i) WHERE {phrase(p)}" for p, label in PHRASES.items())
    return f"""
    WITH d AS (SELECT doc_id, md5(coalesce(text, '')) AS h,
                      list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda e: e <> '') AS w FROM documents),
    x AS (SELECT DISTINCT * FROM d),
    t(label, tpl, tpl_words, q, gram) AS (VALUES {rows}),
    g AS (SELECT doc_id, h, i - 1 AS p, array_to_string(w[i:i + {k - 1}], ' ') AS gram FROM x, unnest(range(1, len(w) - {k - 2})) AS u(i)),
    v AS (SELECT doc_id, h, label, tpl, tpl_words, p - q AS diagonal, list(DISTINCT q) AS qs FROM g JOIN t USING (gram) GROUP BY ALL),
    o AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER a > {gap} THEN 1 ELSE 0 END AS opens FROM v WINDOW a AS (PARTITION BY doc_id, h, label, tpl ORDER BY diagonal)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, h, label, tpl ORDER BY diagonal) AS span FROM o),
    k AS (SELECT doc_id, h, label, tpl, tpl_words, span, count(DISTINCT q + e) AS n FROM s, unnest(qs) AS u(q), range(0, {k}) AS r(e) GROUP BY ALL),
    c AS (SELECT *, n / tpl_words AS covered FROM k WHERE n / tpl_words >= {coverage}),
    m AS (SELECT doc_id, h, max(covered) AS v_score, list(DISTINCT label) AS v_labels FROM c GROUP BY ALL),
    b AS ({at}),
    n AS (SELECT doc_id, h, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS b_labels FROM b GROUP BY ALL)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(b_labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b_labels, []), coalesce(v_labels, [])))), ','), '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(v_score, 0.0::DOUBLE) END AS score
    FROM d LEFT JOIN n ON n.doc_id IS NOT DISTINCT FROM d.doc_id AND n.h = d.h LEFT JOIN m ON m.doc_id IS NOT DISTINCT FROM d.doc_id AND m.h = d.h
    """


@query("op8_license_scan", _oracle())
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
