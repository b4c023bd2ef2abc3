"""Where values come from: trees of layers climbed by doubling, vintages of services, values with source and vintage, county records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions.scalar import xml_escape
from terrasift.operators.lineage import cut, release

#: What is said of a layer whose service groups older ones, and of one about which nothing is said.
CURRENT, UNKNOWN = "Current", "unknown"
#: Fixed value: the colour of what is less important than a value.
GREY = "#888888"


def climbed(nodes: DataFrame, tree: str = "tree", node: str = "id", parent: str = "parent", most_rounds: int = 40) -> DataFrame:
    """Each node's root, the child of the root on its way (itself if it is a root) and how many steps up the root is; all null for nodes on or below a loop.

    nodes: tree, id, parent, each (tree, id) once. A parent that is null, itself or no node of the tree is none. Ways double in each round: whoever stands where a way ends hands on where its own
    ends, so a chain of n nodes takes log n joins. Loops are what never ends: their nodes are told after as many rounds as the number of nodes has bits.
    """
    own = nodes.select(F.col(tree).alias("tree"), F.col(node).alias("id"), F.col(parent).alias("up"))
    known = own.select(F.col("tree").alias("k_tree"), F.col("id").alias("k_id"))
    there = own.join(known, F.col("tree").eqNullSafe(F.col("k_tree")) & (F.col("up") == F.col("k_id")), "left")
    up = F.when(F.col("k_id").isNotNull() & (F.col("up") != F.col("id")), F.col("up"))
    ways = cut(there.select("tree", "id", F.coalesce(up, F.col("id")).alias("at"), F.col("id").alias("under"), up.isNotNull().cast("long").alias("steps"), up.isNull().alias("done")), "ways")
    bits = max(1, ways.count().bit_length())
    for _ in range(min(bits, most_rounds)):
        if not ways.where("NOT done").limit(1).count():
            break
        ends = ways.select(F.col("tree").alias("e_tree"), F.col("id").alias("e_id"), F.col("at").alias("e_at"), F.col("under").alias("e_under"), F.col("steps").alias("e_steps"), F.col("done").alias("e_done"))
        met = ways.join(ends, F.col("tree").eqNullSafe(F.col("e_tree")) & (F.col("at") == F.col("e_id")))
        # A way that reaches a root has been told below which node it came; one that reaches a node goes on as that node's way does.
        under = F.when(F.col("done"), F.col("under")).when(F.col("e_steps") > 0, F.col("e_under")).otherwise(F.col("under"))
        longer = cut(met.select("tree", "id", F.col("e_at").alias("at"), under.alias("under"), (F.col("steps") + F.when(F.col("done"), 0).otherwise(F.col("e_steps"))).alias("steps"), (F.col("done") | F.col("e_done")).alias("done")), "ways")
        release(ways)
        ways = longer
    told = lambda c: F.when(F.col("done"), F.col(c))
    return ways.select(F.col("tree").alias(tree), F.col("id").alias(node), told("at").alias("root"), told("under").alias("under"), told("steps").alias("steps"))


def layer_vintages(layers: DataFrame, services: DataFrame) -> DataFrame:
    """Service, id and vintage of each layer: the name of the group that it stands in; else Current where the service has groups; else the first year that the service's own words name; else unknown.

    layers: service, id, name, parent (-1 or null: none); services: service and texts in the order in which they are looked through.
    """
    parent = layers.select(F.col("service").alias("g_service"), F.col("id").alias("g_id"), F.nullif(F.trim("name"), F.lit("")).alias("group"), F.lit(True).alias("grouped"))
    of = layers.join(parent, F.col("service").eqNullSafe(F.col("g_service")) & (F.col("parent") == F.col("g_id")), "left")
    grouping = of.groupBy(F.col("service").alias("s_service")).agg(F.bool_or(F.coalesce("grouped", F.lit(False))).alias("has_groups"))
    years = [F.nullif(F.regexp_extract(F.col(c).cast("string"), r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")) for c in services.columns if c != "service"]
    said = services.select(F.col("service").alias("y_service"), (F.coalesce(*years) if years else F.lit(None).cast("string")).alias("year")).dropDuplicates(["y_service"])
    every = of.join(grouping, F.col("service").eqNullSafe(F.col("s_service"))).join(said, F.col("service").eqNullSafe(F.col("y_service")), "left")
    vintage = F.when(F.col("grouped"), F.coalesce("group", F.lit(UNKNOWN))).when(F.col("has_groups"), CURRENT).otherwise(F.coalesce("year", F.lit(UNKNOWN)))
    return every.select("service", "id", vintage.alias("vintage"))


def sourced(value: Column, source: Column, vintage: Column) -> Column:
    """A value with where it comes from, or null if there is none: no source without a value."""
    text = F.nullif(value.cast("string"), F.lit(""))
    return F.when(text.isNotNull(), F.struct(text.alias("value"), F.coalesce(source, F.lit("")).alias("source"), F.coalesce(vintage.cast("string"), F.lit("")).alias("vintage")))


def tag(s: Column) -> Column:
    """Source and vintage in words; empty for an absent value."""
    return F.coalesce(F.concat_ws(" ", F.nullif(s.source, F.lit("")), F.nullif(s.vintage, F.lit(""))), F.lit(""))


def rendered(s: Column) -> Column:
    """``value  [source vintage]``; nothing for an absent value."""
    return F.when(s.isNull(), "").otherwise(F.concat(s.value, F.when(tag(s) != "", F.concat(F.lit("  ["), tag(s), F.lit("]"))).otherwise("")))


def best_sourced(rows: DataFrame, keys: list[str], rank: list[Column]) -> DataFrame:
    """For each key the value of the best rank that is one, with its source and vintage, and how many sources said something else. rows: keys, value, source, vintage. Keys without a value have null, not a row less."""
    own = rows.withColumn("s", sourced(F.col("value"), F.col("source"), F.col("vintage")))
    best = own.groupBy(*keys).agg(F.min_by("s", F.when(F.col("s").isNotNull(), F.struct(*rank, "s"))).alias("best"), F.collect_set("s.value").alias("values"))
    return best.select(*keys, "best", F.greatest(F.size("values") - 1, F.lit(0)).alias("others"))


def county_record(rows: list[tuple[str, Column]]) -> Column:
    """struct(body, missing): a line for each label with a value, the value bold and its source grey; labels without one are listed apart, never shown as zero. Whole numbers come with thousands apart."""
    grey = lambda x: F.concat(F.lit(f'<font color="{GREY}">'), x, F.lit("</font>"))
    number = lambda v: F.when(v.rlike(r"^-?[0-9]{1,18}$"), F.format_number(v.try_cast("long"), 0)).otherwise(v)
    line = lambda label, s: F.concat(xml_escape(F.lit(label)), F.lit(": <b>"), xml_escape(number(s.value)), F.lit("</b>"), F.when(tag(s) != "", F.concat(F.lit(" "), grey(F.concat(F.lit("["), xml_escape(tag(s)), F.lit("]"))))).otherwise(""), F.lit("<br/>"))
    body = reduce(F.concat, (F.when(s.isNotNull(), line(label, s)).otherwise("") for label, s in rows), F.lit(""))
    missing = F.filter(F.array(*(F.when(s.isNull(), F.lit(label)) for label, s in rows)), lambda x: x.isNotNull())
    tail = F.when(F.size(missing) > 0, F.concat(F.lit("<br/>"), grey(F.concat(F.lit("<i>No data for: "), xml_escape(F.array_join(missing, ", ")), F.lit("</i>"))), F.lit("<br/>"))).otherwise("")
    return F.struct(F.concat(body, tail).alias("body"), missing.alias("missing"))


_SERVICE = "struct<name:string,description:string,serviceDescription:string,copyrightText:string,layers:array<struct<id:long,name:string,parentLayerId:long,fields:array<struct<name:string>>>>>"


def service_tables(answers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Services (service and its texts), layers (service, id, name, parent) and a listing (service, layer, field) from answers: service, value (its JSON, with its layers, which may have their fields)."""
    a = answers.select("service", F.from_json("value", _SERVICE).alias("a")).where("a IS NOT NULL")
    services = a.select("service", "a.name", "a.description", "a.serviceDescription", "a.copyrightText")
    each = a.select("service", F.explode("a.layers").alias("l"))
    layers = each.select("service", "l.id", F.col("l.name").alias("name"), F.when(F.col("l.parentLayerId") >= 0, F.col("l.parentLayerId")).alias("parent")).where("id IS NOT NULL").dropDuplicates(["service", "id"])
    listing = each.select("service", F.coalesce("l.name", F.lit("")).alias("layer"), F.explode_outer("l.fields.name").alias("field")).select("service", "layer", F.coalesce("field", F.lit("")).alias("field"))
    return services, layers, listing
