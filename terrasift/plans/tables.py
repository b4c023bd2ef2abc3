"""Queries over rows: deduplication, choice, counts, order, sets and joins."""

from pyspark.sql import functions as F

from terrasift.functions import scalar as X
from terrasift.operators import inventory as I
from terrasift.operators import joins as J
from terrasift.operators import packs as K
from terrasift.operators import rows as R
from terrasift.plans.registry import query, table
from terrasift.reconcile import line_layers


@query("dedupe_first", "SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def dedupe_first(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return R.first_by_key(e, [F.col("user_id"), F.col("event_type")], [F.col("ts"), F.col("event_id")]).select("event_id", "user_id", "event_type")


_KEY = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


@query("dedupe_squash", f"SELECT doc_id FROM documents WHERE text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY doc_id) = 1")
def dedupe_squash(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2(X.squash_space(F.col("text")), 256).alias("key"))
    return R.first_by_key(d, [F.col("key")], [F.col("doc_id")]).select("doc_id")


@query("argmax_group", "SELECT o_custkey, o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority = '1-URGENT' DESC, o_totalprice DESC, o_orderkey) = 1")
def argmax_group(spark, sf_dir):
    best = R.best_by_key(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"), -F.col("o_orderkey")])
    return best.select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))


@query("first_per_group", "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1")
def first_per_group(spark, sf_dir):
    return R.first_by_key(table(spark, sf_dir, "events"), [F.col("user_id")], [F.col("event_id")]).select("user_id", "event_id")


@query(
    "bucketize_fallback",
    """WITH c AS (SELECT CAST(p_size AS VARCHAR) AS bucket, count(*) AS n FROM part GROUP BY 1)
    SELECT bucket, n, CAST(row_number() OVER (ORDER BY CAST(bucket AS INT) DESC) AS INT) AS place FROM c""",
)
def bucketize_fallback(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("blank", F.lit(" "))
    return R.bucketize(p, ["blank", "p_partkey", "p_size"])[1]


@query("class_counts_zero", "WITH k(class) AS (VALUES ('view'), ('signup'), ('purchase'), ('error'), ('click'), ('refund')) SELECT class, count(event_id) AS n FROM k LEFT JOIN events ON event_type = class GROUP BY class")
def class_counts_zero(spark, sf_dir):
    classes = spark.sql("SELECT * FROM VALUES ('view'), ('signup'), ('purchase'), ('error'), ('click'), ('refund') AS t(class)")
    return R.counts_with_zeros(table(spark, sf_dir, "events").withColumnRenamed("event_type", "class"), classes, "class")


_STATUS = "CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE 9 END"


@query("status_rank_sort", f"SELECT o_orderkey, {_STATUS} AS rank, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY {_STATUS}, o_orderkey) AS INT) AS place FROM orders")
def status_rank_sort(spark, sf_dir):
    return R.placed(table(spark, sf_dir, "orders").withColumn("rank", X.rank_of(F.col("o_orderstatus"), ["O", "F"], 9)), ["o_custkey"], [F.col("rank"), F.col("o_orderkey")]).select("o_orderkey", "rank", "place")


@query("status_rank_sort_all", f"SELECT o_orderkey, {_STATUS} AS rank FROM orders")
def status_rank_sort_all(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", X.rank_of(F.col("o_orderstatus"), ["O", "F"], 9).alias("rank")).orderBy("rank", "o_orderkey")


@query(
    "numeric_label_sort",
    """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 0 ELSE 1 END AS is_text, CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE ELSE 0 END AS number,
              CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey % 2, CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' kv' ELSE lower(p_name) END, p_partkey) AS INT) AS place FROM part""",
)
def numeric_label_sort(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    label = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.col("p_size"), F.lit(" kV"))).otherwise(F.col("p_name"))
    return R.placed(p.withColumn("k", X.numeric_first(label)), ["p_brand"], [F.col("k"), F.col("p_partkey")]).select("p_partkey", F.col("k.text").alias("is_text"), F.col("k.number").alias("number"), "place")


@query("topk_per_group", "SELECT l_suppkey, l_orderkey, l_linenumber, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS INT) AS rank FROM lineitem QUALIFY rank <= 3")
def topk_per_group(spark, sf_dir):
    return R.top_k(table(spark, sf_dir, "lineitem"), ["l_suppkey"], [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber")], 3).select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@query("keyed_union_last_wins", "WITH u AS (SELECT user_id, event_id, event_id AS ord FROM events WHERE event_id % 3 < 2 UNION ALL SELECT user_id, event_id, event_id + 1000000 FROM events WHERE event_id % 3 > 0) SELECT user_id, arg_max(event_id, ord) AS event_id, min(ord) AS place FROM u GROUP BY user_id")
def keyed_union_last_wins(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_id")
    u = e.where("event_id % 3 < 2").withColumn("ord", F.col("event_id")).unionByName(e.where("event_id % 3 > 0").withColumn("ord", F.col("event_id") + 1000000))
    return R.last_wins_first_place(u, ["user_id"], "ord").select("user_id", "event_id", "place")


@query("priority_upsert", "SELECT c_custkey, 'old' AS origin, c_name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new', upper(c_name) FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0")
def priority_upsert(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("old").alias("origin"), "c_name")
    new = c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("origin"), F.upper("c_name").alias("c_name"))
    return J.upsert(old, new, ["c_custkey"])


@query("left_enrich", "SELECT c_custkey, CASE WHEN n_nationkey % 5 <> 0 THEN n_name END AS nation FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey")
def left_enrich(spark, sf_dir):
    n = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("geoid"), F.col("n_name").alias("nation"))
    return K.enriched(table(spark, sf_dir, "customer").withColumn("geoid", F.col("c_nationkey")), n).select("c_custkey", "nation")


@query(
    "gap_classes",
    """WITH r AS (SELECT s_nationkey AS k, count(*) AS n, count(*) FILTER (s_suppkey % 4 = 1) AS named FROM supplier WHERE s_nationkey % 3 <> 0 GROUP BY 1)
    SELECT n_nationkey AS k, CASE WHEN n_nationkey % 4 = 3 THEN 'notfetched' WHEN r.n IS NULL THEN 'empty' WHEN named = 0 THEN 'unnamed' ELSE 'unmatched' END AS gap, coalesce(r.n, 0) AS n_records
    FROM nation LEFT JOIN r ON r.k = n_nationkey WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000)""",
)
def gap_classes(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").withColumn("k", F.col("s_nationkey"))
    areas = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"))
    records = s.where("s_nationkey % 3 <> 0").withColumn("name", F.when(F.col("s_suppkey") % 4 == 1, F.col("s_name")).otherwise(" "))
    return J.gaps(areas, records, s.where("s_acctbal > 9000"), areas.where("k % 4 <> 3"), "k", "name")


@query(
    "set_containment",
    """WITH i AS (SELECT DISTINCT o_custkey AS o, o_orderpriority || o_orderstatus AS i FROM orders), z AS (SELECT o, count(*) AS n FROM i GROUP BY o),
    p AS (SELECT a.o AS inner_, b.o AS outer_ FROM i a JOIN i b ON a.i = b.i AND a.o <> b.o JOIN z x ON x.o = a.o JOIN z y ON y.o = b.o WHERE x.n < y.n GROUP BY a.o, b.o, x.n HAVING count(*) = x.n)
    SELECT inner_ AS "inner", min(outer_) AS "outer" FROM p GROUP BY 1""",
)
def set_containment(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", F.concat("o_orderpriority", "o_orderstatus").alias("item"))
    return R.contained_sets(o, "o_custkey", "item")


@query("contested_groups", """SELECT c_nationkey, c_mktsegment, count(*) AS n, array_to_string(list_sort(list(DISTINCT CAST(c_custkey % 3 AS VARCHAR))), ',') AS "values", count(DISTINCT c_custkey % 3) > 1 AS contested FROM customer GROUP BY 1, 2 HAVING count(*) >= 2""")
def contested_groups(spark, sf_dir):
    c = table(spark, sf_dir, "customer").withColumn("city", (F.col("c_custkey") % 3).cast("string"))
    return R.shared_groups(c, ["c_nationkey", "c_mktsegment"], "city").withColumn("values", F.array_join("values", ","))


@query("duplicate_groups", "SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.sha2("text", 256).alias("digest"))
    return R.shared_groups(d, ["digest"], "doc_id").select("digest", "n", F.get("values", F.lit(0)).alias("first_id"))


@query(
    "term_mining",
    """WITH w AS (SELECT p_brand AS g, list_filter(regexp_split_to_array(lower(p_name || ' ' || p_type), '[^a-z0-9'']+'), lambda x: len(x) > 1) AS w FROM part),
    t AS (SELECT DISTINCT g, array_to_string(w[i:i + k - 1], ' ') AS term FROM w, (VALUES (2), (3)) AS s(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS u(i))
    SELECT term, count(*) AS "groups" FROM t GROUP BY 1 HAVING count(*) >= 2""",
)
def term_mining(spark, sf_dir):
    return R.term_frequency(table(spark, sf_dir, "part"), F.concat_ws(" ", "p_name", "p_type"), "p_brand")


_TYPED = "SELECT DISTINCT substr(w, 1, length(w) - 1) || CASE WHEN length(w) % 2 = 0 THEN 'zz' ELSE '' END AS word FROM b"


@query(
    "fuzzy_words",
    f"""WITH b AS (SELECT DISTINCT unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS w FROM part), a AS ({_TYPED})
    SELECT word, w AS ref, CAST(levenshtein(word, w) AS INT) AS edits FROM a, b WHERE levenshtein(word, w) <= 2 AND word NOT IN (SELECT w FROM b) AND length(word) >= 6 AND length(w) >= 6""",
)
def fuzzy_words(spark, sf_dir):
    """All words of parts' names and types, as typed with an error, against all of them."""
    b = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("w")).distinct()
    typed = F.concat(F.expr("substr(w, 1, length(w) - 1)"), F.when(F.length("w") % 2 == 0, "zz").otherwise(""))
    return J.near_words(b.select(typed.alias("word")), b.select(F.col("w").alias("word")))


@query("fuzzy_words_all")
def fuzzy_words_all(spark, sf_dir):
    """All words of one table's texts against all of another's; in SQL this would compare each with each."""
    words = lambda name: table(spark, sf_dir, name).select(F.explode(F.split(F.lower("text"), "\\s+")).alias("word"))
    return J.near_words(words("conversations"), words("benchmark"))


@query("family_newest", "SELECT o_custkey, count(*) AS n, CASE WHEN count(*) FILTER (d = m) = 1 THEN max(o_orderkey) FILTER (d = m) END AS newest FROM (SELECT *, o_orderdate AS d, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) GROUP BY 1")
def family_newest(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("family"), F.col("o_orderkey").alias("path"), F.col("o_orderdate").alias("mtime"), F.lit(0).alias("size"))
    return I.newest_editions(files).select(F.col("family").alias("o_custkey"), (F.col("others") + 1).alias("n"), "newest")


@query("key_histogram", "SELECT key, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY 1 ORDER BY n DESC, key LIMIT 40")
def key_histogram(spark, sf_dir):
    return R.key_histogram(table(spark, sf_dir, "events").withColumn("tags", F.from_json("props", "map<string,string>")), "tags")


@query("share_line_layer", "SELECT l_returnflag, avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END) > 0.5 AS is_line FROM lineitem GROUP BY 1")
def share_line_layer(spark, sf_dir):
    kind = F.when(F.col("l_linestatus") == "O", "MultiLineString").otherwise("Point")
    return line_layers(table(spark, sf_dir, "lineitem").withColumn("geom_type", kind), "l_returnflag")


@query("prov_distinct_order", "SELECT source, lang, min(doc_id) AS place FROM documents GROUP BY ALL")
def prov_distinct_order(spark, sf_dir):
    return R.distinct_in_order(table(spark, sf_dir, "documents"), ["source", "lang"], "doc_id")


@query(
    "asr_three_way",
    """WITH ra AS (SELECT o_orderkey % 4000 AS usi, o_orderkey AS ord, o_orderstatus AS status, o_custkey AS reg FROM orders),
    r AS (SELECT * FROM ra WHERE status IN ('O', 'F') QUALIFY row_number() OVER (PARTITION BY usi ORDER BY ord DESC) = 1),
    e AS (SELECT c_custkey AS usi, arg_min(c_name, c_acctbal) AS owner FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1)
    SELECT l_orderkey, l_linenumber, r.reg, owner FROM lineitem JOIN r ON r.usi = l_orderkey % 4000 AND l_linenumber = 1 LEFT JOIN e ON e.usi = r.usi""",
)
def asr_three_way(spark, sf_dir):
    o, c, li = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    ra = o.select(F.expr("o_orderkey % 4000").alias("usi"), F.col("o_orderkey").alias("ord"), F.lit(" wi ").alias("state"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("reg"))
    en = c.select(F.col("c_custkey").alias("usi"), F.col("c_acctbal").alias("ord"), F.when(F.col("c_custkey") % 3 == 0, "R").when(F.col("c_custkey") % 3 == 1, "O").alias("contact_type"), F.col("c_name").alias("owner"))
    co = li.where("l_linenumber = 1").select(F.expr("l_orderkey % 4000").alias("usi"), "l_orderkey", "l_linenumber")
    return J.registrations(ra, en, co, ["WI"], ["O", "F"]).select("l_orderkey", "l_linenumber", "reg", "owner")
