"""Queries over attributes: normalising, filters, classes, names (scalar operators and predicates)."""

from pyspark.sql import functions as F

from terrasift.functions import scalar as X
from terrasift.operators import predicates as P
from terrasift.plans.registry import query, table


@query("attr_in_filter", "SELECT p_partkey, p_brand FROM part WHERE upper(trim(p_brand)) IN ('BRAND#12', 'BRAND#23', 'BRAND#34')")
def attr_in_filter(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(P.in_values(F.col("p_brand"), [" brand#12", "Brand#23 ", "BRAND#34"])).select("p_partkey", "p_brand")


_DIRTY = "CASE WHEN s_suppkey % 5 = 0 THEN '-999.0' WHEN s_suppkey % 7 = 0 THEN ' not available ' WHEN s_suppkey % 11 = 0 THEN '' WHEN s_suppkey % 13 = 0 THEN '-1e30' ELSE CAST(s_suppkey AS VARCHAR) END"


@query("null_sentinels", f"SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR s_suppkey % 11 = 0 OR s_suppkey % 13 = 0 THEN NULL ELSE {_DIRTY} END AS height FROM supplier")
def null_sentinels(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", X.present(F.expr(_DIRTY.replace("VARCHAR", "STRING"))).alias("height"))


@query(
    "unit_parse",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size * 1.0::DOUBLE WHEN 1 THEN p_size / 1000.0::DOUBLE WHEN 2 THEN greatest(p_size, 7) / 1000000.0::DOUBLE ELSE NULL END AS capacity_mw,
              CASE WHEN p_partkey % 4 = 3 THEN NULL WHEN p_partkey % 4 = 2 THEN greatest(p_size, 7) ELSE p_size END AS generators FROM part""",
)
def unit_parse(spark, sf_dir):
    text = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat(p_size, ' MW') WHEN 1 THEN concat(p_size, ',000 W') WHEN 2 THEN concat(p_size, ';7') ELSE 'n/a' END")
    whole = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat(p_size, '') WHEN 1 THEN concat(p_size, '.2') WHEN 2 THEN concat(p_size, '|7') ELSE 'unknown' END")
    p = table(spark, sf_dir, "part").select("p_partkey", text.alias("t"), whole.alias("g"))
    return p.select("p_partkey", F.round(X.parse_number(F.col("t"), "W") / 1e6, 9).alias("capacity_mw"), X.convert(F.col("g"), "count", whole=True).cast("int").alias("generators"))


@query("canonical_coalesce", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_type ELSE p_name END AS name FROM part")
def canonical_coalesce(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, " N/A ").otherwise(F.col("p_name")).alias("Plant Name"), F.col("p_type").alias("TYPE"))
    found = X.resolve_column(p.columns, ["!type", "PLANT_NAME", "type"])
    assert found == ["TYPE", "Plant Name"]
    return p.select("p_partkey", F.coalesce(*(X.present(F.col(f"`{c}`")) for c in reversed(found))).alias("name"))


@query("format_headline", "SELECT o_orderkey, format('{:,.1f}', o_totalprice) || ' MW' AS capacity, format('{:,.0f}', round_even(o_totalprice / 7, 0)) AS people FROM orders")
def format_headline(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", X.format_unit(F.col("o_totalprice"), 1, "MW").alias("capacity"), X.format_unit(F.bround(F.col("o_totalprice") / 7, 0), 0).alias("people"))


@query(
    "style_rule_case",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 40 AND l_returnflag = 'R' THEN 'r0' WHEN l_discount < 0.05 THEN 'r1' WHEN l_linestatus <> 'O' THEN 'r2' ELSE 'base' END AS style FROM lineitem""",
)
def style_rule_case(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    field = lambda k: F.col(k) if k in li.columns else None
    rules = ["l_quantity >= 40 and l_returnflag = r", "l_discount < 0.05", "l_linestatus != o", "missing > 3", "not a condition"]
    return li.select("l_orderkey", "l_linenumber", F.coalesce(X.classify([(f"r{i}", P.condition(r, field)) for i, r in enumerate(rules)]), F.lit("base")).alias("style"))


@query(
    "selector_match",
    """SELECT event_id FROM events WHERE (event_type = 'view' AND try_cast(json_extract_string(props, '$.k') AS DOUBLE) >= 50) OR (regexp_matches(event_type, '^(sign|err)') AND coalesce(json_extract_string(props, '$.k'), '') <> '3')""",
)
def selector_match(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tags = F.map_concat(F.transform_values(F.from_json("props", "map<string,string>"), lambda _, v: v), F.create_map(F.lit("type"), F.col("event_type")))
    return e.where(P.any_selector(["type=view;k>=50", "type~^(sign|err);k!=3"], tags)).select("event_id")


@query(
    "selector_units",
    """WITH p AS (SELECT *, CASE p_partkey % 5 WHEN 0 THEN p_size || ' ft' WHEN 1 THEN p_size || 'k;7 V' WHEN 2 THEN '0.0' || p_size || ' GW,3/1 MW' WHEN 3 THEN p_size || ' m' ELSE p_name END AS tag FROM part),
    e AS (SELECT p_partkey, lower(unnest(string_split_regex(tag, '[;,/]'))) AS part FROM p),
    n AS (SELECT p_partkey, try_cast(nullif(regexp_extract(part, '^ *(-?[0-9.]+)', 1), '') AS DOUBLE) AS v, regexp_extract(part, '^ *-?[0-9.]+ *([a-z]*)', 1) AS unit FROM e),
    m AS (SELECT p_partkey, max(v * coalesce(map(['k', 'kv', 'kw', 'mv', 'mw', 'mwh', 'g', 'gw', 'm', 'ft'], [1e3::DOUBLE, 1e3, 1e3, 1e6, 1e6, 1e6, 1e9, 1e9, 1, 0.3048])[unit], 1)) AS v FROM n GROUP BY 1)
    SELECT p_partkey, coalesce(v >= 9.144, false) AS tall, coalesce(v < 20000, false) AS small, coalesce(v > 30000000, false) AS huge FROM m""",
)
def selector_units(spark, sf_dir):
    """tags whose numbers have units, several parts, or none."""
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    tag = F.when(k == 0, F.concat(size, F.lit(" ft"))).when(k == 1, F.concat(size, F.lit("k;7 V"))).when(k == 2, F.concat(F.lit("0.0"), size, F.lit(" GW,3/1 MW"))).when(k == 3, F.concat(size, F.lit(" m"))).otherwise(F.col("p_name"))
    tags = F.create_map(F.lit("h"), tag)
    return table(spark, sf_dir, "part").select("p_partkey", P.selector("h>=9.144", tags).alias("tall"), P.selector("h<20000", tags).alias("small"), P.selector("h>30000000", tags).alias("huge"))


@query("first_match_classify", "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'large' WHEN p_type LIKE '%STEEL%' THEN 'steel' WHEN p_brand LIKE 'Brand#1%' THEN 'one' END AS class FROM part WHERE p_size >= 40 OR p_type LIKE '%STEEL%' OR p_brand LIKE 'Brand#1%'")
def first_match_classify(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    c = X.classify([("large", F.col("p_size") >= 40), ("steel", F.col("p_type").contains("STEEL")), ("one", F.col("p_brand").startswith("Brand#1"))])
    return p.select("p_partkey", c.alias("class")).where("class IS NOT NULL")


@query("min_capacity", "SELECT c_custkey FROM customer WHERE nullif(c_nationkey % 4, 0) IS NULL OR c_acctbal >= 5000")
def min_capacity(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("mw", F.when(F.col("c_nationkey") % 4 != 0, F.col("c_acctbal")))
    return c.where(P.at_least_or_unknown(F.col("mw"), 5000)).select("c_custkey")


@query(
    "name_keys",
    """SELECT n_nationkey, trim(regexp_replace(lower(n_name || ' -- No. ' || n_nationkey), '[^a-z0-9]+', '-', 'g'), '-') AS slug, lower(n_name) AS county, replace(lower(n_name), '_', ' ') || ' x' AS folded, n_name AS family, CASE WHEN n_nationkey % 2 = 0 THEN '2024-01__x' ELSE '' END AS edition FROM nation""",
)
def name_keys(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    name = F.col("n_name")
    pack = F.concat(name, F.when(F.col("n_nationkey") % 2 == 0, "__2024-01__x.KMZ").otherwise(".kml"))
    return n.select(
        "n_nationkey",
        X.slug(F.concat(name, F.lit(" -- No. "), F.col("n_nationkey"))).alias("slug"),
        X.county_name(F.concat(F.lit(" "), name, F.lit(" County"))).alias("county"),
        X.fold_name(F.concat(F.lit("<b>The</b> "), F.translate(name, ",", " "), F.lit(" X County, MN"))).alias("folded"),
        X.family(pack).alias("family"),
        X.family_edition(pack).alias("edition"),
    )


@query(
    "tone_classes",
    """WITH t AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '114.8' WHEN 1 THEN CASE WHEN p_size % 3 = 0 THEN 'D023' WHEN p_size % 3 = 1 THEN 'd 47' ELSE 'D172n' END WHEN 2 THEN CASE WHEN p_size % 2 = 0 THEN 'CC15' ELSE 'cc 3' END WHEN 3 THEN '23.0' WHEN 4 THEN ' ' ELSE CAST(p_size AS VARCHAR) || '.3' END AS tone FROM part)
    SELECT p_partkey, CASE WHEN trim(tone) = '' THEN 'none' WHEN tone IN ('114.8', '69.3', '77.3') AND tone <> '77.3' THEN 'ctcss' WHEN tone IN ('D023', 'd 47', 'D172n') THEN 'dcs' WHEN tone IN ('CC15', 'cc 3') THEN 'colour-code' ELSE 'unrecognised' END AS kind,
              CASE WHEN tone = '23.0' THEN 'not a CTCSS tone - looks like DCS 023 read as a number' WHEN p_partkey % 6 = 5 AND tone <> '69.3' THEN
                  CASE WHEN length(tone) < 4 THEN 'not a CTCSS tone, DCS code or DMR colour code' ELSE 'not a CTCSS tone - looks like a frequency' END ELSE '' END AS note FROM t JOIN part USING (p_partkey)""",
)
def tone_classes(spark, sf_dir):
    t = F.expr("CASE p_partkey % 6 WHEN 0 THEN '114.8' WHEN 1 THEN CASE WHEN p_size % 3 = 0 THEN 'D023' WHEN p_size % 3 = 1 THEN 'd 47' ELSE 'D172n' END WHEN 2 THEN CASE WHEN p_size % 2 = 0 THEN 'CC15' ELSE 'cc 3' END WHEN 3 THEN '23.0' WHEN 4 THEN ' ' ELSE concat(p_size, '.3') END")
    return table(spark, sf_dir, "part").select("p_partkey", X.tone_kind(t).alias("kind"), X.tone_note(t).alias("note"))


@query("dms_decimal", "SELECT s_suppkey, CAST(round((CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END) * (s_suppkey % 90 + (s_suppkey % 60) / 60.0::DOUBLE + 30 / 3600.0::DOUBLE) * 1e6) AS BIGINT) AS micro FROM supplier")
def dms_decimal(spark, sf_dir):
    k = F.col("s_suppkey")
    v = X.dms(k % 90, (k % 60).cast("string"), F.lit("30"), F.when(k % 2 == 0, " w").otherwise("E"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(v * 1e6).cast("long").alias("micro"))


@query("label_template", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_brand || ' / ' || p_size END AS label FROM part")
def label_template(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    made = X.label_all_or_none("{brand} / {size}", {"brand": F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).otherwise(" "), "size": F.col("p_size")})
    return p.select("p_partkey", F.coalesce(made, F.col("p_name")).alias("label"))


@query("edition_digest", "SELECT doc_id, '2024-01_' || substr(sha256(text), 1, 6) AS edition FROM documents WHERE text IS NOT NULL")
def edition_digest(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", X.edition(F.lit("2024-01"), F.col("text")).alias("edition"))


@query("xml_text", "SELECT doc_id, length(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')) AS n FROM documents WHERE text IS NOT NULL")
def xml_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.length(X.xml_escape(F.col("text"))).cast("long").alias("n"))
