"""Operator 10, WARC: not-modified revisits get the latest earlier full response of their canonical URL.

The as-of join works in two levels, so that a URL with a third of all captures is no single task's: time is cut
into slots that hold about as many captures each, SLOT_ROWS or so of all URLs together; within a URL and slot a window looks back, and what a
slot's first revisits need comes from the last full response of the URL's earlier slots, which is a window over
one row for each slot that the URL has. Captures without a URL are dealt by id. Both levels carry ids, validators and headers only; bodies stay where they are and are found by resolved_id.

Verdicts on validators: ``etag`` (weak comparison) decides if both sides have one: match or mismatch; else
``modified``: Last-Modified, or a digest that both name; ``unchecked`` if nothing is comparable; ``orphan`` if there is
no earlier full response. Only matches and unchecked ones are resolved. Headers of a 304 that HTTP permits to
update a stored response (UPDATES) replace the stored ones, by lower-case name; all others stay as stored.

Full responses resolve to themselves. Earlier means a smaller (time, id); captures without time come first of
all, and a null URL never matches anything. Of equal time the smaller id is earlier; rows that repeat an
id are each resolved, to the same response. Null headers are empty. Other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.llm.common import table
from terrasift.llm.decl import query

#: Header fields that a 304 response carries and that replace the stored ones.
UPDATES = ("cache-control", "content-location", "date", "etag", "expires", "vary", "last-modified", "age")
#: Captures that a slot is to hold; least and most slots. The result does not depend on them.
SLOT_ROWS, LEAST_SLOTS, MOST_SLOTS = 200_000, 64, 1000


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, fragment, ``utm_`` parameters and ``ref``, order of parameters, default ports, a final slash and letter case of the host don't count."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)", 1)), "^www[.]|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(u, "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*([^?]*)", 1), "/+$", "")
    given = F.split(F.regexp_extract(u, "[?](.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(given, lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref)(=|$)"))), "&")
    return F.concat(host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept)))


def _bare(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolve_revisits(captures: DataFrame, id_col: str = "record_id", url_col: str = "url", time_col: str = "ts", status_col: str = "status", headers_col: str = "headers", slots: int | None = None) -> DataFrame:
    """Per capture: its id, canonical_url, is_revisit, verdict, resolved_id and merged headers. headers: map of strings with lower-case names; a status of 304 is a revisit, 200 a full response, others are neither."""
    rows = captures.select(
        F.col(id_col).alias("id"), canonical_url(F.col(url_col)).alias("u"), F.col(time_col).alias("t"),
        F.coalesce(F.col(status_col) == 304, F.lit(False)).alias("revisit"), F.coalesce(F.col(status_col) == 200, F.lit(False)).alias("full"),
        F.coalesce(F.col(headers_col), F.create_map().cast("map<string,string>")).alias("h"),
    )
    # Slots end where time's quantiles lie: a bounded number of values, whatever the input's size.
    grid = MOST_SLOTS if slots is None else slots
    seen = rows.agg(F.count("*").alias("n"), F.percentile_approx(F.col("t").cast("double"), F.array(*(F.lit((i + 1) / grid) for i in range(max(1, grid - 1)))), F.lit(10 * grid)).alias("e")).first()
    if slots is None:
        slots = min(MOST_SLOTS, max(LEAST_SLOTS, seen.n // SLOT_ROWS))
    ends = [(seen.e or [])[i * grid // slots - 1] for i in range(1, slots)] if seen.e else []
    edges = F.array(*(F.lit(float(x)) for x in sorted(set(ends)))) if ends else F.array().cast("array<double>")
    slot = F.when(F.col("t").isNull(), -1).otherwise(F.size(F.filter(edges, lambda e: e < F.col("t").cast("double"))))
    rows = rows.withColumn("slot", slot)
    mine = F.when(F.col("full"), F.struct("id", "h"))
    order = [F.asc_nulls_first("t"), F.asc_nulls_first("id")]
    alone = F.when(F.col("u").isNull(), F.pmod(F.xxhash64("id"), F.lit(4096)))  # what has no URL is never resolved and need not meet
    near = W.partitionBy("u", "slot", alone).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    # One row for each slot that a URL has: its last response, and whether anything in it may look further back.
    response = F.when(F.col("full"), F.struct(F.col("t").isNotNull(), "t", F.col("id").isNotNull(), "id"))
    ended = rows.where("u IS NOT NULL").groupBy("u", "slot").agg(F.max_by(mine, response).alias("end"), F.bool_or("revisit").alias("asks"))
    far = F.last("end", ignorenulls=True).over(W.partitionBy("u").orderBy("slot").rowsBetween(W.unboundedPreceding, -1))
    reach = ended.withColumn("far", far).where("asks AND far IS NOT NULL").select(F.col("u").alias("c_u"), F.col("slot").alias("c_slot"), "far")
    joined = rows.withColumn("near", F.last(mine, ignorenulls=True).over(near)).join(reach, (F.col("u") == F.col("c_u")) & (F.col("slot") == F.col("c_slot")), "left")
    stored = F.when(F.col("u").isNotNull() & F.col("revisit"), F.coalesce("near", "far"))
    joined = joined.withColumn("stored", stored)
    said, held = (lambda k: F.col("h")[k]), (lambda k: F.col("stored.h")[k])
    same = lambda k: said(k) == held(k)
    verdict = (
        F.when(~F.col("revisit"), F.when(F.col("full"), "full").otherwise("other"))
        .when(F.col("stored").isNull(), "orphan")
        .when(said("etag").isNotNull() & held("etag").isNotNull(), F.when(_bare(said("etag")) == _bare(held("etag")), "etag").otherwise("mismatch"))
        .when(said("last-modified").isNotNull() & held("last-modified").isNotNull(), F.when(same("last-modified"), "modified").otherwise("mismatch"))
        .when(said("warc-payload-digest").isNotNull() & held("warc-payload-digest").isNotNull(), F.when(same("warc-payload-digest"), "modified").otherwise("mismatch"))
        .otherwise("unchecked")
    )
    joined = joined.withColumn("verdict", verdict)
    taken = F.col("verdict").isin("etag", "modified", "unchecked")
    merged = F.map_from_entries(
        F.array_sort(
            F.concat(
                F.map_entries(F.map_filter("h", lambda k, _: k.isin(*UPDATES))),
                F.map_entries(F.map_filter("stored.h", lambda k, _: ~(k.isin(*UPDATES) & F.map_contains_key("h", k)))),
            )
        )
    )
    return joined.select(
        F.col("id").alias(id_col), F.col("u").alias("canonical_url"), F.col("revisit").alias("is_revisit"), "verdict",
        F.when(F.col("full"), F.col("id")).when(taken, F.col("stored.id")).alias("resolved_id"),
        F.when(taken, merged).otherwise(F.col("h")).alias("headers"),
    )


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Two captures of each page, told by its columns alone: the page itself at time page_id, and a conditional request for it later.

    The page's ETag is a digest of its html. The later request, page_id % 977 + 1 steps on, asks by another spelling
    of the URL and names the ETag, as a weak one if page_id is even; every 5th names only Last-Modified, every 7th a stale ETag, every 11th nothing.
    """
    key = F.col("page_id")
    etag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 12), F.lit('"'))
    day = F.concat(F.lit("day "), F.col("page_id") % 365)
    first = pages.select((key * 2).alias("record_id"), "url", (key * 10).alias("ts"), F.lit(200).alias("status"), F.map_from_arrays(F.array(*map(F.lit, ("content-type", "etag", "last-modified"))), F.array(F.lit("text/html"), etag, day)).alias("headers"))
    weak = F.when(key % 2 == 0, F.concat(F.lit("W/"), etag)).otherwise(etag)
    tag = F.when((key % 5 == 0) | (key % 11 == 0), F.lit(None)).when(key % 7 == 0, F.lit('"stale"')).otherwise(weak)
    entries = F.array(
        F.struct(F.lit("content-type").alias("k"), F.lit("text/plain").alias("v")),
        F.struct(F.lit("date").alias("k"), F.concat(F.lit("day "), key % 365 + 1).alias("v")),
        F.struct(F.lit("etag").alias("k"), tag.alias("v")),
        F.struct(F.lit("last-modified").alias("k"), F.when(key % 5 == 0, day).alias("v")),
    )
    asked = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))
    again = pages.select((key * 2 + 1).alias("record_id"), asked.alias("url"), (key * 10 + (key % 977) * 10 + 5).alias("ts"), F.lit(304).alias("status"), F.map_from_entries(F.filter(entries, lambda e: e.v.isNotNull())).alias("headers"))
    return first.unionByName(again)


_CANON = """
    regexp_replace(lower(regexp_extract(s, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)', 1)), '^www[.]|:(80|443)$', '', 'g')
    || regexp_replace(regexp_extract(s, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(ps) = 0 THEN '' ELSE '?' || array_to_string(ps, '&') END"""

ORACLE = f"""
WITH p AS (SELECT page_id, url, '"' || substr(md5(coalesce(html, '')), 1, 12) || '"' AS e, 'day ' || (page_id % 365) AS d FROM pages),
c AS (SELECT page_id * 2 AS record_id, url, page_id * 10 AS ts, 200 AS status, 'text/html' AS ct, CAST(NULL AS VARCHAR) AS dt, e AS etag, d AS lm FROM p
      UNION ALL
      SELECT page_id * 2 + 1, url, page_id * 10 + (page_id % 977) * 10 + 5, 304, 'text/plain', 'day ' || (page_id % 365 + 1),
             CASE WHEN page_id % 5 = 0 OR page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN '"stale"' WHEN page_id % 2 = 0 THEN 'W/' || e ELSE e END,
             CASE WHEN page_id % 5 = 0 THEN d END FROM p),
u AS (SELECT *, regexp_replace(trim(url), '#.*$', '') AS s FROM c),
q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(s, '[?](.*)$', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref)(=|$)'))) AS ps FROM u),
k AS (SELECT *, {_CANON} AS canon FROM q),
a AS (SELECT *, last_value(CASE WHEN status = 200 THEN record_id END IGNORE NULLS) OVER w AS prior
      FROM k WINDOW w AS (PARTITION BY canon ORDER BY ts, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
j AS (SELECT a.*, f.etag AS f_etag, f.lm AS f_lm, f.ct AS f_ct FROM a LEFT JOIN k f ON a.status = 304 AND f.record_id = a.prior),
v AS (SELECT *, CASE WHEN status = 200 THEN 'full' WHEN f_etag IS NULL THEN 'orphan'
                     WHEN etag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = f_etag THEN 'etag' ELSE 'mismatch' END
                     WHEN lm IS NOT NULL THEN CASE WHEN lm = f_lm THEN 'modified' ELSE 'mismatch' END ELSE 'unchecked' END AS verdict FROM j)
SELECT record_id, canon AS canonical_url, status = 304 AS is_revisit, verdict,
       CASE WHEN status = 200 THEN record_id WHEN verdict IN ('etag', 'modified', 'unchecked') THEN prior END AS resolved_id,
       CASE WHEN verdict IN ('etag', 'modified', 'unchecked') THEN 'content-type=' || f_ct || coalesce(';date=' || dt, '') || ';etag=' || coalesce(etag, f_etag) || ';last-modified=' || coalesce(lm, f_lm)
            ELSE 'content-type=' || ct || coalesce(';date=' || dt, '') || coalesce(';etag=' || etag, '') || coalesce(';last-modified=' || lm, '') END AS merged_headers
FROM v
"""


@query("op10_warc_revisits", ORACLE)
def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resolve_revisits(captures_of_pages(table(spark, sf_dir, "pages")))
    merged = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e.key, F.lit("="), e.value)), ";")
    return out.select("record_id", "canonical_url", "is_revisit", "verdict", "resolved_id", merged.alias("merged_headers"))
