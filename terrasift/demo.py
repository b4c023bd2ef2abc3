"""Invented layers that walk every path of a build without a network (S29, C12). Nothing in them is a real place."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.functions.scalar import format_unit, present
from terrasift.operators.packs import rescaled, style_key
from terrasift.sinks.packs import documents, folders, placemarks, write_kmz

SCHEMA = "layer string, ord int, geom_type string, coordinates string, properties map<string,string>"
#: layer: kind of shape, how many, attributes that vary with the place in the row.
LAYERS = {
    "substations": ("Point", 8, lambda i: {"NAME": f"Station {i}", "VOLTAGE": ("345000", "115000;34500", "-999999", "NOT AVAILABLE")[i % 4]}),
    "lines": ("LineString", 6, lambda i: {"OWNER": f"Owner {i % 2}", "VOLTAGE": str((345, 115, 69)[i % 3]), "STATUS": "IN SERVICE" if i % 2 else "N/A"}),
    "dams": ("Point", 5, lambda i: {"Dam Name": f"Dam {i}", "NID HEIGHT": str(10 * i)}),
    "plants": ("Point", 6, lambda i: {"Plant_Name": f"Plant {i}", "Total_MW": f"{i * 120.5:,.1f}", "PrimSource": ("wind", "coal", "solar")[i % 3]}),
    "towers": ("Point", 7, lambda i: {"REG": str(1000 + i), "HEIGHT": f"{30 + i} m"}),
    "hospitals": ("Point", 4, lambda i: {"NAME": f"Hospital {i}", "BEDS": "" if i == 2 else str(i * 50)}),
    "schools": ("Point", 6, lambda i: {"NAME": f"School {i}"}),
    "rail": ("MultiLineString", 3, lambda i: {"OWNER": ("A", "B", " ")[i]}),
    "airports": ("Polygon", 3, lambda i: {"IDENT": f"X{i}"}),
    "parcels": ("Polygon", 6, lambda i: {"PIN": str(i), "CITY": ("North", "South", "")[i % 3]}),
    "boundary": ("MultiPolygon", 1, lambda i: {"NAME": "Sample County"}),
    "lakes": ("Polygon", 5, lambda i: {"NAME": f"Lake {i}"}),
    "trails": ("LineString", 8, lambda i: {"NAME": f"Trail {i}", "SURFACE": ("gravel", "paved")[i % 2]}),
}


def _shape(kind: str, x: float, y: float) -> list:
    ring = [[x, y], [x + 0.02, y], [x + 0.02, y + 0.02], [x, y + 0.02], [x, y]]
    line = [[x, y], [x + 0.03, y + 0.01], [x + 0.05, y]]
    return {"Point": [x, y], "LineString": line, "MultiLineString": [line, [[x, y + 0.04], [x + 0.02, y + 0.05]]], "Polygon": [ring], "MultiPolygon": [[ring], [[[px + 0.1, py] for px, py in ring]]]}[kind]


def layers(spark: SparkSession) -> DataFrame:
    """68 features in 13 layers, on a small grid; a fixed table."""
    rows = []
    for row, (layer, (kind, n, fields)) in enumerate(LAYERS.items()):
        rows += [(layer, i, kind, json.dumps(_shape(kind, round(-93.0 + 0.06 * i, 4), round(45.3 + 0.04 * row, 4))), fields(i)) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def pack(spark: SparkSession, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """The layers as map packs: doc, n, kmz. Points are moved into ``box`` if one is given."""
    df = layers(spark)
    if box is not None:
        xy = F.from_json("coordinates", "array<double>")
        points = df.where("geom_type = 'Point'").withColumns({"x": F.get(xy, F.lit(0)), "y": F.get(xy, F.lit(1))})
        df = rescaled(points, "x", "y", box).withColumn("coordinates", F.to_json(F.array("x", "y"))).select(*df.columns)
    volts = present(F.col("properties")["VOLTAGE"]).try_cast("double")
    style = style_key("base", [volts >= 345, volts >= 100])
    bucket = F.when(F.col("layer") == "lines", F.concat(format_unit(volts, 0), F.lit(" kV"))).otherwise(F.coalesce(F.nullif(F.trim(F.col("properties")["CITY"]), F.lit("")), F.lit("(all)")))
    name = F.coalesce(F.col("properties")["NAME"], F.concat("layer", F.lit(" "), F.col("ord")))
    fields = F.transform(F.array_sort(F.map_entries("properties")), lambda e: F.struct(e.key.alias("label"), e.value.alias("value")))
    marks = placemarks(df.withColumns({"doc": F.col("layer"), "bucket": bucket, "place": F.lit(0)}), name, fields, style)
    return write_kmz(documents(folders(marks)))
