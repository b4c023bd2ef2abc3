"""Operators of state packs: records for popups, styles, dimension lookups, unions with conflicts (P06, P13, P24, P26, P33, P34, P50, P51, P57-P59, J04, J16, J19, D04, A05, A06, A14, A20, O05, O06, U05, U06, F13, F20, F22, F25, K09)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrasift.functions.scalar import county_name, xml_escape
from terrasift.operators.rows import first_by_key, placed

#: Columns of a plant's capacity by fuel, with the fuel's name; the channels of weather radio.
FUELS = {
    "Nuclear_MW": "nuclear", "Coal_MW": "coal", "NG_MW": "natural gas", "Hydro_MW": "hydro", "HydroPS_MW": "pumped storage", "Wind_MW": "wind",
    "Solar_MW": "solar", "Bio_MW": "biomass", "Crude_MW": "petroleum", "Bat_MW": "battery", "Geo_MW": "geothermal", "Other_MW": "other",
}
CHANNELS = ("162.400", "162.425", "162.450", "162.475", "162.500", "162.525", "162.550")


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def with_canonical(raw: Column, canonical: Column) -> Column:
    """Raw attributes under the canonical ones; a raw value that would be lost stays as ``src_<key>``. Both are maps of strings; null canonical values count for nothing."""
    canon = F.map_filter(canonical, lambda k, v: v.isNotNull())
    kept = F.map_filter(raw, lambda k, v: ~F.map_contains_key(canon, k))
    moved = F.map_filter(raw, lambda k, v: F.map_contains_key(canon, k) & ~v.eqNullSafe(canon[k]))
    moved = F.transform_keys(moved, lambda k, v: F.concat(F.lit("src_"), k))
    there = F.map_keys(moved)
    return F.map_concat(F.map_filter(kept, lambda k, v: ~F.array_contains(there, k)), canon, moved)


_PARTS = {"LineString": 0, "MultiPoint": 0, "MultiLineString": 1, "Polygon": 1, "MultiPolygon": 2}


def _lines(kind: Column, coordinates: Column, outer_only: bool = False) -> Column:
    """All runs of points of a geometry, as array<array<array<double>>>."""
    point, line, lines, polygons = (F.from_json(coordinates, t) for t in ("array<double>", "array<array<double>>", "array<array<array<double>>>", "array<array<array<array<double>>>>"))
    first = (lambda rings: F.slice(rings, 1, 1)) if outer_only else (lambda rings: rings)
    out = F.when(kind == "Point", F.array(F.array(point))).when(kind.isin("MultiPoint", "LineString"), F.array(line)).when(kind == "MultiLineString", lines)
    return out.when(kind == "Polygon", first(lines)).when(kind == "MultiPolygon", F.flatten(F.transform(polygons, first)))


def sample_points(kind: Column, coordinates: Column) -> Column:
    """Points that stand for a shape: its own, of polygons those of outer rings."""
    return F.flatten(_lines(kind, coordinates, outer_only=True))


def segments(kind: Column, coordinates: Column) -> Column:
    """A shape's edges as pairs of points; points have none."""
    pair = lambda r: F.when(F.size(r) > 1, F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda a, b: F.array(a, b))).otherwise(F.array().cast("array<array<array<double>>>"))
    return F.when(kind.isin("Point", "MultiPoint"), F.array().cast("array<array<array<double>>>")).otherwise(F.flatten(F.transform(_lines(kind, coordinates), pair)))


def rings(kind: Column, coordinates: Column) -> Column:
    """Every ring of every part of a polygon, holes too; other shapes have none."""
    return F.when(kind.isin("Polygon", "MultiPolygon"), F.filter(_lines(kind, coordinates), lambda r: F.size(r) > 0)).otherwise(F.array().cast("array<array<array<double>>>"))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """even-odd rule for one row's own ring, for polygons that are columns; J07 joins points to polygon tables."""
    n = F.size(ring)

    def crosses(p: Column, k: Column) -> Column:
        q = F.get(ring, F.when(k == 0, n - 1).otherwise(k - 1))
        (xi, yi), (xj, yj) = (F.get(p, F.lit(0)), F.get(p, F.lit(1))), (F.get(q, F.lit(0)), F.get(q, F.lit(1)))
        return F.when((yi > y) != (yj > y), (x < (xj - xi) * (y - yi) / (yj - yi) + xi).cast("int")).otherwise(0)

    return F.aggregate(F.transform(ring, crosses), F.lit(0), lambda a, v: a + v) % 2 == 1


def rescaled(df: DataFrame, x: str, y: str, box: tuple[float, float, float, float], margin: float = 0.06) -> DataFrame:
    """Points moved into a box by one factor for both axes, about its middle. Their own box, four numbers, is found by an aggregate."""
    x0, y0, x1, y1 = df.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    if x0 is None or y0 is None:
        return df
    west, south, east, north = box
    k = (1 - 2 * margin) * min((east - west) / ((x1 - x0) or 1e-9), (north - south) / ((y1 - y0) or 1e-9))
    move = lambda c, own, mid: F.round(F.lit(mid) + (F.col(c) - own) * k, 6)
    return df.withColumns({x: move(x, (x0 + x1) / 2, (west + east) / 2), y: move(y, (y0 + y1) / 2, (south + north) / 2)})


def megawatts(value: Column) -> Column:
    """A capacity, null if it is none: columns may hold texts."""
    return F.nullif(F.trim(value.cast("string")), F.lit("")).try_cast("double")


def plant_record(fields: dict[str, Column]) -> Column:
    """A plant's popup, rows without a value left out: both capacities apart, then what the source says, then the fuels of a mixed plant."""
    mw = lambda c: F.when(megawatts(fields[c]).isNotNull(), F.concat(F.format_number(megawatts(fields[c]), 1), F.lit(" MW"))).otherwise("") if c in fields else F.lit("")
    said = lambda c: _text(fields[c]) if c in fields else F.lit("")
    labels = {"Nameplate capacity": mw("Install_MW"), "Max summer capacity": mw("Total_MW"), "Primary fuel": said("PrimSource"), "Technology": said("tech_desc"), "Operator": said("Utility_Na"), "Sector": said("sector_nam"), "County": said("County"), "EIA plant code": said("Plant_Code")}
    split = [F.struct(F.lit(name).alias("label"), F.coalesce(megawatts(fields[c]), F.lit(0.0)).alias("mw")) for c, name in FUELS.items() if c in fields]
    mixed = F.filter(F.array(*split), lambda s: s.mw != 0) if split else F.array().cast("array<struct<label:string,mw:double>>")
    fuels = F.when(F.size(mixed) > 1, F.transform(mixed, lambda s: F.struct(s.label.alias("label"), F.concat(F.format_number(s.mw, 1), F.lit(" MW")).alias("value")))).otherwise(F.array().cast("array<struct<label:string,value:string>>"))
    own = F.array(*(F.struct(F.lit(k).alias("label"), v.alias("value")) for k, v in labels.items()))
    return F.concat(F.filter(own, lambda r: r.value != ""), fuels)


def same_pairs(counties: Column) -> Column:
    """A transmitter's (same, county, st) in the source's order, without those that have no code. Codes of parts of a county stand beside the whole one's."""
    clean = F.transform(F.coalesce(counties, F.array().cast("array<struct<same:string,county:string,st:string>>")), lambda c: F.struct(_text(c.same).alias("same"), _text(c.county).alias("county"), _text(c.st).alias("st")))
    return F.filter(clean, lambda c: c.same != "")


def station_record(state: str, freq: Column, power: Column, status: Column, name: Column, place: Column, office: Column, counties: Column) -> Column:
    """A transmitter's popup; a site's name and place are told once if they are the same in any case."""
    n, p = _text(name), _text(place)
    site = F.when((n != "") & (p != "") & (F.lower(n) != F.lower(p)), F.concat(n, F.lit(" ("), p, F.lit(")"))).otherwise(F.coalesce(F.nullif(n, F.lit("")), p))
    unit = lambda c, u: F.when(_text(c) != "", F.concat(_text(c), F.lit(f" {u}"))).otherwise("")
    pairs = same_pairs(counties)
    here = F.size(F.filter(pairs, lambda c: F.upper(c.st) == state)).cast("string")
    rows = {"Listen": unit(freq, "MHz"), "Power": unit(power, "W"), "Status": _text(status), "Site": site, "NWS office": F.replace(_text(office), F.lit("|"), F.lit(", ")), f"Counties alerted in {state}": F.when(F.size(pairs) > 0, here).otherwise("")}
    return F.array(*(F.struct(F.lit(k).alias("label"), v.alias("value")) for k, v in rows.items()))


def off_channel(freq: Column) -> Column:
    """whether a frequency is no channel of weather radio; reported, never a reason to drop a row."""
    return ~_text(freq).isin(*CHANNELS)


def is_sheriff(name: Column) -> Column:
    """names of sheriffs, a common misspelling included."""
    return F.coalesce(name.rlike("(?i)sherr?if"), F.lit(False))


def visible(layer: Column, off: set[str] | None = None, on: set[str] | None = None) -> Column:
    """by an explicit list of what starts switched off, or of what starts switched on."""
    return F.coalesce(layer.isin(*sorted(on)), F.lit(False)) if on is not None else ~F.coalesce(layer.isin(*sorted(off or {"\0"})), F.lit(False))


def styled(df: DataFrame, dimension: DataFrame, overrides: dict[str, str] | None = None, default: dict[str, str] | None = None) -> DataFrame:
    """A layer's symbol and colours: the specification's before the table's, the default's for an unknown layer. dimension: layer, glyph, color, fill, width."""
    cols = [c for c in dimension.columns if c != "layer"]
    d = dimension.select(F.col("layer").alias("_layer"), *(F.col(c).alias(f"_{c}") for c in cols))
    out = df.join(F.broadcast(d), F.col("layer") == F.col("_layer"), "left")
    value = lambda c: F.lit((overrides or {})[c]) if c in (overrides or {}) else F.coalesce(f"_{c}", F.lit((default or {}).get(c)))
    return out.select(*df.columns, *(value(c).alias(c) for c in cols))


def style_key(key: str, rules: list[Column]) -> Column:
    """``key_r<i>`` of the first rule that holds, else the key."""
    return reduce(lambda w, r: w.when(r[1], f"{key}_r{r[0]}"), enumerate(rules), F.when(F.lit(False), "")).otherwise(key)


def provenance_text(name: Column, url: Column, license_: Column, retrieved: Column, notes: Column) -> Column:
    """What a document says of its source."""
    said = F.concat(F.lit("source: "), xml_escape(name), F.lit("<br/>url: "), xml_escape(url), F.lit("<br/>license: "), xml_escape(license_), F.lit("<br/>retrieved: "), xml_escape(retrieved))
    return F.concat(F.lit("<![CDATA["), said, F.when(_text(notes) != "", F.concat(F.lit("<br/>note: "), xml_escape(notes))).otherwise(""), F.lit("]]>"))


def state_code(value: Column, states: dict[str, tuple[str, str]]) -> Column:
    """The two-digit code for an abbreviation, a full name or a code; null if unknown, for the caller to refuse. states: abbreviation to (code, name)."""
    s = F.upper(F.trim(value))
    by = {a: c for a, (c, _) in states.items()} | {n.upper(): c for c, n in states.values()} | {c: c for c, _ in states.values()}
    pairs = F.create_map(*(F.lit(x) for kv in by.items() for x in kv))
    return F.coalesce(pairs[s], pairs[F.lpad(s, 2, "0")])


def enriched(counties: DataFrame, *tables: DataFrame) -> DataFrame:
    """Counties with what tables know of them by geoid; what a table does not have stays null."""
    return reduce(lambda df, t: df.join(t, "geoid", "left"), tables, counties)


def without_known(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not there yet."""
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def find_counties(wanted: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Geoid of each wanted (state_code, county) by its folded name, the first in the gazetteer (state_code, county_code, name, ord) if several have it; null if none has."""
    g = gazetteer.select(F.col("state_code"), county_name(F.col("name")).alias("_key"), F.concat("state_code", F.lpad("county_code", 3, "0")).alias("geoid"), F.col("ord").alias("_ord"))
    g = g.groupBy("state_code", "_key").agg(F.min_by("geoid", "_ord").alias("geoid"))
    return wanted.withColumn("_key", county_name(F.col("county"))).join(g, ["state_code", "_key"], "left").drop("_key")


def distinct_elements(elements: DataFrame) -> DataFrame:
    """Each element once, the first by tile, and its place in the order of kind and number within its kind."""
    return placed(first_by_key(elements, [F.col("type"), F.col("id")], [F.col("ord")]), ["type"], [F.col("id")])


def named_order(df: DataFrame, group: list[str], name: str = "name", ident: str = "osm_id") -> DataFrame:
    """Place by the name in lower case, then by the identity as text."""
    return placed(df, group, [F.lower(F.coalesce(name, F.lit(""))), F.col(ident).cast("string")])


def status_summary(rows: DataFrame, statuses: list[str]) -> DataFrame:
    """One row: how many sources have each status, and how many were recovered by an alternate."""
    return rows.agg(*(F.count_if(F.col("status") == s).alias(s) for s in statuses), F.count_if(F.coalesce("recovered", F.lit(False))).alias("recovered"))


def merged_boundary(shapes: DataFrame, key: str) -> DataFrame:
    """All polygons of a key as one MultiPolygon, in order, nothing dissolved. shapes: key, ord, geom_type, coordinates."""
    parts = F.when(F.col("geom_type") == "Polygon", F.array(F.from_json("coordinates", "array<array<array<double>>>"))).when(F.col("geom_type") == "MultiPolygon", F.from_json("coordinates", "array<array<array<array<double>>>>"))
    own = shapes.withColumn("_p", parts).where("_p IS NOT NULL")
    return own.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "_p"))).alias("_l")).select(key, F.lit("MultiPolygon").alias("geom_type"), F.to_json(F.flatten("_l._p")).alias("coordinates"))


def sizes(df: DataFrame, group: str, size: str) -> DataFrame:
    """Rows, known sizes and their sum by group; a sum of nothing known is null, not 0."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.count(size).alias("n_known"), F.sum(size).alias("total"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and their count, which is known once an action has run, without another pass."""
    o = Observation(name)
    return df.observe(o, F.count("*").alias("features")), o


def common_values(a: Column, b: Column) -> Column:
    """What two sets share, in order."""
    return F.array_sort(F.array_intersect(a, b))


def union_first_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Each key's first value, and whether another source has a different one."""
    return rows.groupBy(key).agg(F.min_by(value, order).alias(value), (F.count_distinct(value) > 1).alias("conflict"))


def class_folders(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """A folder's head for every class, those without rows too, with their number. classes: layer, label, place; rows: layer."""
    n = rows.groupBy("layer").agg(F.count("*").alias("n"))
    out = classes.join(n, "layer", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("head", F.concat(F.lit("<Folder><name>"), xml_escape(F.col("label")), F.lit(" ("), F.col("n").cast("string"), F.lit(")</name>")))
