"""Map packs, GeoJSON and manifests. Texts of rows are made in the JVM; ``archives`` writes them without gathering them. folders, documents and write_kmz are for documents of a few thousand rows."""

from __future__ import annotations

import io
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrasift.functions.scalar import xml_escape
from terrasift.sinks.archives import archive, plain_member

COORD = "array<array<double>>"


def coordinate_text(pairs: Column) -> Column:
    """P25: ``x,y,0`` with six places; pairs that are not finite are left out."""
    ok = F.filter(pairs, lambda p: p.isNotNull() & F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull() & ~F.isnan(F.get(p, F.lit(0))) & ~F.isnan(F.get(p, F.lit(1))))
    number = lambda v: F.regexp_replace(F.format_number(v, 6), ",", "")
    return F.array_join(F.transform(ok, lambda p: F.concat(number(F.get(p, F.lit(0))), F.lit(","), number(F.get(p, F.lit(1))), F.lit(",0"))), " ")


def geometry_xml(kind: Column, coordinates: Column) -> Column:
    """KML of points, lines and polygons (GeoJSON's type and coordinates as JSON); empty if there is nothing to draw."""
    point = coordinate_text(F.array(F.from_json(coordinates, "array<double>")))
    line = F.from_json(coordinates, COORD)
    rings = F.from_json(coordinates, f"array<{COORD}>")
    polygons = F.from_json(coordinates, f"array<array<{COORD}>>")
    tag = lambda name, x: F.concat(F.lit(f"<{name}>"), x, F.lit(f"</{name}>"))

    def polygon(rs: Column) -> Column:
        ring = lambda r: tag("LinearRing", tag("coordinates", coordinate_text(r)))
        holes = F.array_join(F.transform(F.slice(rs, 2, F.greatest(F.size(rs) - 1, F.lit(0))), lambda r: tag("innerBoundaryIs", ring(r))), "")
        return tag("Polygon", F.concat(tag("outerBoundaryIs", ring(F.get(rs, F.lit(0)))), holes))

    string = lambda pts: tag("LineString", tag("coordinates", coordinate_text(pts)))
    many = lambda parts, f: tag("MultiGeometry", F.array_join(F.transform(parts, f), ""))
    out = (
        F.when((kind == "Point") & (point != ""), tag("Point", tag("coordinates", point)))
        .when((kind == "LineString") & (F.size(line) >= 2), string(line))
        .when((kind == "MultiPoint") & (F.size(line) > 0), many(line, lambda p: tag("Point", tag("coordinates", coordinate_text(F.array(p))))))
        .when((kind == "MultiLineString") & (F.size(rings) > 0), many(F.filter(rings, lambda r: F.size(r) >= 2), string))
        .when((kind == "Polygon") & (F.size(rings) > 0), polygon(rings))
        .when((kind == "MultiPolygon") & (F.size(polygons) > 0), many(polygons, polygon))
    )
    return F.coalesce(out, F.lit(""))


def placemarks(df: DataFrame, name: Column, fields: Column, style: Column, most: int = 80) -> DataFrame:
    """Xml of each row; fields is an array of struct(label, value), of which ``most`` are shown. Rows without a drawable geometry go."""
    data = F.transform(F.slice(fields, 1, most), lambda x: F.concat(F.lit('<Data name="'), xml_escape(x.label), F.lit('"><value>'), xml_escape(x.value), F.lit("</value></Data>")))
    shape = geometry_xml(F.col("geom_type"), F.col("coordinates"))
    xml = F.concat(F.lit("<Placemark><name>"), xml_escape(name), F.lit("</name><styleUrl>#"), xml_escape(style), F.lit("</styleUrl><ExtendedData>"), F.array_join(data, ""), F.lit("</ExtendedData>"), F.col("_shape"), F.lit("</Placemark>"))
    return df.withColumn("_shape", shape).where("_shape <> ''").withColumn("xml", xml).drop("_shape")


def folders(rows: DataFrame, doc: str = "doc", bucket: str = "bucket", place: str = "place", order: str = "ord") -> DataFrame:
    """One row for each document and folder: its placemarks that render, in order, and their count."""
    g = rows.groupBy(doc, bucket, place).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(order, "xml"))).alias("p"))
    xml = F.concat(F.lit("<Folder><name>"), xml_escape(F.concat(F.col(bucket), F.lit(" ("), F.col("n"), F.lit(")"))), F.lit("</name>"), F.array_join("p.xml", ""), F.lit("</Folder>"))
    return g.select(doc, bucket, place, "n", xml.alias("xml"))


def documents(parts: DataFrame, doc: str = "doc", hidden: Column | None = None) -> DataFrame:
    """One KML document a layer; hidden only if all of its parts are."""
    g = parts.withColumn("_hidden", hidden if hidden is not None else F.lit(False)).groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("place", "xml"))).alias("f"), F.sum("n").alias("n"), F.bool_and("_hidden").alias("hidden"))
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>'), xml_escape(F.col(doc)), F.lit("</name><visibility>"), F.when(F.col("hidden"), "0").otherwise("1"), F.lit("</visibility>"), F.array_join("f.xml", ""), F.lit("</Document></kml>"))
    return g.select(doc, "n", "hidden", body.alias("kml"))


def kmz(kml: str, members: dict[str, bytes] | None = None) -> bytes:
    """Doc.kml and its icons in one archive, the same bytes for the same content."""
    out = io.BytesIO()
    archive(out, [plain_member(name, data) for name, data in [("doc.kml", kml.encode()), *sorted((members or {}).items())]])
    return out.getvalue()


def write_kmz(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One archive for each document, made where its row is: doc, kmz (binary), n."""
    import pandas as pd

    def run(frames):
        for f in frames:
            yield pd.DataFrame({doc: f[doc], "n": f["n"], "kmz": [kmz(x) for x in f["kml"]]})

    return docs.select(doc, "n", "kml").mapInPandas(run, f"{doc} string, n long, kmz binary")


def geojson_lines(df: DataFrame, properties: Column) -> DataFrame:
    """One Feature a row as text; rows without a finite place are counted by the caller as those missing."""
    feature = F.concat(F.lit('{"type":"Feature","geometry":{"type":"'), F.col("geom_type"), F.lit('","coordinates":'), F.col("coordinates"), F.lit('},"properties":'), F.to_json(properties), F.lit("}"))
    usable = F.col("coordinates").rlike("-?[0-9]") & ~F.col("coordinates").rlike("NaN|Infinity") & F.col("geom_type").isNotNull()
    return df.where(usable).select(feature.alias("value"))


def attribution(layers: DataFrame) -> DataFrame:
    """Licences in order, each with its layers; whether one asks for the open database notice."""
    g = layers.groupBy(F.coalesce(F.nullif(F.trim("license"), F.lit("")), F.lit("unspecified")).alias("license")).agg(F.sort_array(F.collect_set("layer")).alias("layers"))
    return g.withColumn("odbl", F.lower("license").contains("odbl")).orderBy("license")


def manifest(stats: list[dict], files: list[str], box: tuple[float, ...] | None) -> str:
    """A build's rows, files and area; a short list, one entry a source."""
    return json.dumps({"sources": stats, "files": sorted(files), "bbox": box}, indent=1, sort_keys=True)


def merge_packs(packs: DataFrame, label: Column | None = None, folder_by: str | None = None) -> DataFrame:
    """Placemarks of several packs (read by kml): equal ones once, relabelled where the label has all its fields, in folders by a field or by file."""
    key = F.sha2(F.to_json(F.struct("name", "lon", "lat", F.array_sort(F.map_entries("fields")).alias("f"))), 256)
    rows = packs.where("error IS NULL").withColumn("key", key)
    from terrasift.operators.rows import first_by_key

    one = first_by_key(rows, [F.col("key")], [F.col("path"), F.col("ord")]).drop("key")
    bucket = F.coalesce(F.nullif(F.trim(F.col("fields")[folder_by]), F.lit("")), F.lit("(not recorded)")) if folder_by else F.col("path")
    return one.withColumn("label", F.coalesce(label, F.col("name")) if label is not None else F.col("name")).withColumn("bucket", bucket)
