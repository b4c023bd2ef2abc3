"""Feeds as DataFrames: files by their format, census shapes and tables, plants, contacts, seats, packs."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.catalog import Aoi
from terrasift.functions.scalar import dms, fold_name, valid_lonlat
from terrasift.operators.joins import lookup, registrations, upsert
from terrasift.operators.packs import rings
from terrasift.sources import files

#: Words in a pack that tell where it comes from.
PROVENANCE = ("source", "licence", "license", "retrieved", "fetched", "openstreetmap", "census", "tiger", "attribution")
#: Labels of a registration's status and of kinds of structure.
STATUS = {"C": "Constructed", "G": "Granted", "T": "Terminated", "D": "Dismantled", "A": "Application", "P": "Pending", "I": "Incomplete"}
STRUCTURES = {
    "B": "Building", "BANT": "Building with antenna", "BMAST": "Building with mast", "BPIPE": "Building with pipe", "BPOLE": "Building with pole", "BRIDG": "Bridge",
    "BTWR": "Building with tower", "GTOWER": "Guyed tower", "LTOWER": "Lattice tower", "MAST": "Mast", "MTOWER": "Monopole", "NNGTANN": "Guyed tower array",
    "NNLTANN": "Lattice tower array", "NNMTANN": "Monopole array", "PIPE": "Pipe", "POLE": "Pole", "RIG": "Oil rig", "SIGN": "Sign", "SILO": "Silo",
    "STACK": "Smoke stack", "TANK": "Tank", "TOWER": "Tower", "TREE": "Tree", "UPOLE": "Utility pole",
}
#: Columns of the three registration tables by place.
RA = {"usi": 4, "reg": 3, "status": 8, "date_constructed": 12, "structure_code": 22, "ground_elev_m": 24, "height_agl_m": 25, "height_amsl_m": 26, "address": 27, "city": 28, "state": 29, "zip": 30, "faa_study": 36, "paint_light": 39}
EN = {"usi": 4, "contact_type": 5, "owner": 7}
CO = {"usi": 4, "lat_d": 6, "lat_m": 7, "lat_s": 8, "lat_h": 9, "lon_d": 11, "lon_m": 12, "lon_s": 13, "lon_h": 14, "array_pos": 16, "array_total": 17}


def read_file(spark: SparkSession, path: str, kind: str | None = None, **options) -> DataFrame:
    """A file by its format, given or told from its name and first bytes; a web page is an error (files.NotData)."""
    if kind in (None, "auto"):
        head = spark.read.format("binaryFile").load(path).select("path", F.substring("content", 1, 512).alias("head")).orderBy("path").first()
        if head is None:
            raise files.NotData(f"nothing at {path}")
        kind = files.sniff(head.path, bytes(head["head"]))
    readers: dict[str, Callable[..., DataFrame]] = {"csv": files.delimited, "geojson": files.geojson, "gpkg": files.gpkg, "xlsx": files.xlsx, "kml": files.kml, "shp": files.shp}
    if kind not in readers:
        raise files.NotData(f"no reader for {kind}")
    return readers[kind](spark, path, **options)


def to_lonlat(x: Column, y: Column, crs: str) -> tuple[Column, Column]:
    """Coordinates of a reference system as longitude and latitude: geographic ones as they are, Web Mercator by its formula; any other is refused, never guessed."""
    code = re.sub(r"^.*[:/]", "", str(crs).strip())
    if code in ("4326", "4269", "CRS84"):
        return x, y
    if code in ("3857", "900913", "102100", "102113"):
        radius = 6378137.0
        return F.degrees(x / radius), F.degrees(2 * F.atan(F.exp(y / radius)) - math.pi / 2)
    raise files.NotData(f"no conversion from reference system {crs!r}")


def tiger_files(product: str, aoi: Aoi, year: int, state_codes: dict[str, str], base: str = "https://www2.census.gov/geo/tiger/TIGER{year}") -> list[str]:
    """The files that hold a product for an area; an area that a product does not cover is refused."""
    if aoi.kind == "world" or not aoi.states and aoi.kind != "bbox":
        raise ValueError("these files cover the United States only")
    root, codes = base.format(year=year), [state_codes[s] for s in aoi.states]
    if product == "roads":
        if aoi.kind != "county":
            raise ValueError("roads come by county")
        return [f"{root}/ROADS/tl_{year}_{aoi.fips}_roads.zip"]
    if product == "cousub":
        return [f"{root}/COUSUB/tl_{year}_{c}_cousub.zip" for c in codes]
    if product in ("county", "state"):
        return [f"{root}/{product.upper()}/tl_{year}_us_{product}.zip"]
    raise ValueError(f"no product {product!r}")


def tiger_rows(rows: DataFrame, product: str, aoi: Aoi, state_codes: dict[str, str], fields: str = "properties") -> DataFrame:
    """Rows of those files that belong to the area, by their codes."""
    of = lambda k: F.coalesce(F.col(fields)[k], F.lit(""))
    codes = [state_codes[s] for s in aoi.states]
    if product == "cousub" and aoi.kind == "county":
        return rows.where(F.lpad(of("COUNTYFP"), 3, "0") == aoi.fips[2:])
    if product == "county" and aoi.kind == "county":
        return rows.where(F.concat(of("STATEFP"), of("COUNTYFP")) == aoi.fips)
    if product in ("county", "state") and aoi.kind != "bbox":
        return rows.where(of("STATEFP").isin(*codes))
    return rows


def file_order() -> Column:
    """A row's place among the files that are read: by file, then by the part of the file, then within it. Tasks read files in any order, so a number of the row alone would not tell."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _positions(spark: SparkSession, path: str, at: dict[str, int]) -> DataFrame:
    """Columns of a table without header by their place; ord is the line's place, by file and offset."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "").schema("value string").csv(path)
    parts = lines.withColumn("ord", file_order()).withColumn("p", F.split("value", r"\|"))
    return parts.where(F.size("p") > max(v for k, v in at.items() if k in ("usi", "state", "lon_h", "owner"))).select("ord", *(F.trim(F.coalesce(F.get("p", F.lit(k)), F.lit(""))).alias(c) for c, k in at.items()))


def towers(spark: SparkSession, ra: str, en: str, co: str, states: list[str], statuses: list[str]) -> DataFrame:
    """Registered towers of some states: three tables joined (J01), places from degrees, labels for codes; rows without a usable place go."""
    found = registrations(_positions(spark, ra, RA), _positions(spark, en, EN).withColumn("contact_type", F.upper("contact_type")), _positions(spark, co, CO).drop("ord"), states, statuses)
    lat, lon = (dms(*(F.col(f"{c}_{k}") for k in "dmsh")) for c in ("lat", "lon"))
    out = found.withColumns({"lat": lat, "lon": lon}).where(valid_lonlat(F.col("lon"), F.col("lat")))
    array = F.when(~F.col("array_total").isin("", "0", "1"), F.concat("array_pos", F.lit(" of "), "array_total"))
    metres = {c: F.nullif(F.col(c), F.lit("")).try_cast("double") for c in ("height_agl_m", "height_amsl_m", "ground_elev_m")}
    code = F.upper("structure_code")
    out = out.withColumns({"status": lookup(F.upper("status"), STATUS), "structure_code": code, "structure_type": lookup(code, STRUCTURES), "array_position": array, **metres})
    return out.drop(*(f"{c}_{k}" for c in ("lat", "lon") for k in "dmsh"), "array_pos", "array_total")


def of_state(features: DataFrame, state_code: str, geoid: str = "GEOID", fields: str = "properties") -> DataFrame:
    """Features whose five-digit code begins with the state's: the server's own filter is checked, not trusted."""
    code = F.trim(F.col(fields)[geoid])
    return features.where(code.rlike("^[0-9]{5}$") & code.startswith(state_code)).withColumn("geoid", code)


def county_rings(features: DataFrame) -> DataFrame:
    """A row for each ring of each county that has a name or not: geoid, name (null if unnamed), ring_ord, ring."""
    name = F.nullif(F.trim(F.col("properties")["NAME"]), F.lit(""))
    return features.select("geoid", name.alias("name"), F.posexplode(rings(F.col("geom_type"), F.col("coordinates"))).alias("ring_ord", "ring"))


def acs_table(text: DataFrame, variables: dict[str, str], source: str, vintage: str) -> DataFrame:
    """County tables of the census API: rows of texts under a header row. geoid, then each variable as a number, or null where it is suppressed (negative) or none.

    text: one row with ``value``. Anything but such a table (a web page that says the key is wrong, another shape) gives no rows, so that a pack is built without.
    """
    table = text.select(F.from_json("value", "array<array<string>>").alias("t")).where("t IS NOT NULL AND size(t) > 0")
    head = F.get("t", F.lit(0))
    need = [*variables.values(), "state", "county"]
    table = table.where(reduce_and([F.array_contains(head, c) for c in need]))
    rows = table.select(head.alias("h"), F.explode(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))).alias("r"))
    value = lambda c: F.get("r", F.array_position("h", c).cast("int") - 1)
    number = lambda c: value(c).try_cast("long")
    return rows.select(F.concat(value("state"), value("county")).alias("geoid"), *(F.when(number(c) >= 0, number(c)).alias(k) for k, c in variables.items()), F.lit(source).alias("source"), F.lit(vintage).alias("vintage"))


def reduce_and(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def plants(features: DataFrame, state_name: str) -> DataFrame:
    """Plants whose own column names the state, with their attributes; pages are the service source's business."""
    return features.where(F.col("properties")["State"] == state_name)


def lower_keys(features: DataFrame, fields: str = "properties") -> DataFrame:
    """Attributes under lower-case names, points only."""
    return features.where("geom_type = 'Point'").withColumn(fields, F.map_from_entries(F.transform(F.map_entries(fields), lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value")))))


def seats(answer: DataFrame) -> DataFrame:
    """Geoid and seat of each county from a query service's answer (``value``: JSON): five-digit codes, no unresolved ``Q...`` labels, the first seat of several."""
    kind = "struct<results:struct<bindings:array<struct<fips:struct<value:string>,seatLabel:struct<value:string>>>>>"
    each = answer.select(F.posexplode(F.from_json("value", kind)["results"]["bindings"]).alias("ord", "b"))
    rows = each.select("ord", F.trim("b.fips.value").alias("geoid"), F.trim("b.seatLabel.value").alias("seat")).where("length(geoid) = 5 AND seat <> '' AND NOT startswith(seat, 'Q')")
    return rows.groupBy("geoid").agg(F.min_by("seat", "ord").alias("seat"))


def keyed_table(spark: SparkSession, shipped: str, local: str | None = None, key: str = "geoid") -> DataFrame:
    """A table with ``#`` comments; rows of the local file replace the shipped ones of the same key."""

    def read(path: str) -> DataFrame:
        raw = spark.read.option("header", True).option("comment", "#").option("escape", '"').csv(path)
        rows = raw.select(*(F.trim(F.coalesce(F.col(f"`{c}`"), F.lit(""))).alias(c) for c in raw.columns), file_order().alias("_o")).where(F.col(key) != "")
        return rows.groupBy(key).agg(*(F.max_by(c, "_o").alias(c) for c in raw.columns if c != key))

    return upsert(read(local), read(shipped), [key]) if local else read(shipped)


def services(listing: DataFrame, pattern: str) -> DataFrame:
    """Services, layers and fields (a row each: service, layer, field) whose name fits a pattern, in any case."""
    names = F.concat_ws(" ", "service", "layer", "field")
    return listing.where(names.rlike(f"(?i){pattern}"))


def pack_files(spark: SparkSession, folder: str, part: str = "") -> DataFrame:
    """KML and KMZ files below a folder, each real file once (links that lead to one file are one, by the first path), filtered by name before any is opened: path, name, size, mtime."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[kK][mM][lzLZ]").load(folder).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    wanted = rows.where(F.contains(F.lower("name"), F.lit(part.lower())))

    def real(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(real=[os.path.realpath(unquote(urlsplit(p).path)) if p.startswith("file:") else p for p in f["path"]])

    found = wanted.mapInPandas(real, "path string, name string, size long, mtime timestamp, real string")
    return found.groupBy("real").agg(*(F.min_by(c, "path").alias(c) for c in ("path", "name", "size", "mtime"))).drop("real")


def pack_contents(spark: SparkSession, folder: str) -> DataFrame:
    """What each pack holds: path, size, mtime, n_placemarks, names (folded, distinct), folders (the first eight), provenance (words that tell), error. A bad file is a row with an error.

    Packs are walked as kml_rows walks them, a file a row; a pack's folders and words are few.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path, content in zip(f["path"], f["content"], strict=True):
                rows = list(files.kml_rows(path, bytes(content)))
                error = next((r["error"] for r in rows if "error" in r), None)
                marks = [] if error else rows
                text = "" if error else files.kml_text(bytes(content)).decode("utf-8", "replace").lower()
                out.append((len(marks), [r["name"] for r in marks if r["name"]], list(dict.fromkeys(r["folder"] for r in marks if r["folder"]))[:8], [w for w in PROVENANCE if w in text], error))
            yield pd.DataFrame(out, columns=["n_placemarks", "raw", "folders", "provenance", "error"], dtype=object).assign(path=f["path"], size=f["length"], mtime=f["modificationTime"])[["path", "size", "mtime", "n_placemarks", "raw", "folders", "provenance", "error"]]

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[kK][mM][lzLZ]").load(folder)
    found = raw.select("path", "length", "modificationTime", "content").mapInPandas(run, "path string, size long, mtime timestamp, n_placemarks int, raw array<string>, folders array<string>, provenance array<string>, error string")
    names = F.array_distinct(F.filter(F.transform("raw", fold_name), lambda n: n != ""))
    return found.select("path", "size", "mtime", "n_placemarks", names.alias("names"), "folders", "provenance", "error")
