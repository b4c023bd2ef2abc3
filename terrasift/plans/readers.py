"""Queries over files that are made from the tables and read back: quoted text, GeoPackages and zipped shapefiles."""

import io
import sqlite3
import struct
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from terrasift.operators.lineage import scratch_folder
from terrasift.plans.geo import SQL_LAT, SQL_LON, places
from terrasift.plans.registry import query, table
from terrasift.sources import files


@query("quoted_files", """SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)) || '",' || coalesce(lang, '')) AS text_md5, coalesce(lang, '') AS lang FROM documents WHERE doc_id IS NOT NULL""")
def quoted_files(spark, sf_dir):
    """Whole documents, whose texts have line breaks, quotes and separators, as quoted files that are split within them."""
    d = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL")
    path = scratch_folder(spark, "quoted")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "\r\n?", "\n")
    rows = d.select("doc_id", F.concat(text, F.lit('",'), F.coalesce("lang", F.lit(""))).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return files.delimited(spark, path).select("doc_id", F.md5("text").alias("text_md5"), "lang")


def _package(rows: pd.DataFrame) -> bytes:
    """A GeoPackage of points, with a spatial index."""
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE gpkg_geometry_columns (table_name, column_name, srs_id)")
    con.execute("INSERT INTO gpkg_geometry_columns VALUES ('p', 'geom', 4326)")
    con.execute("CREATE TABLE p (fid INTEGER PRIMARY KEY, name, other, geom)")
    con.execute("CREATE VIRTUAL TABLE rtree_p_geom USING rtree(id, minx, maxx, miny, maxy)")
    for r in rows.itertuples(index=False):
        con.execute("INSERT INTO p VALUES (?, ?, 'x', ?)", (r.id, r.c_name, b"GP\0\1" + struct.pack("<i", 4326) + struct.pack("<BIdd", 1, 1, r.lon, r.lat)))
        con.execute("INSERT INTO rtree_p_geom VALUES (?, ?, ?, ?, ?)", (r.id, r.lon, r.lon, r.lat, r.lat))
    con.commit()
    return con.serialize()


def _shapefile(rows: pd.DataFrame) -> bytes:
    """A zipped shapefile of points."""
    shp = bytearray(b"\0" * 100)
    dbf = bytearray(struct.pack("<4BIHH20x", 3, 0, 0, 0, len(rows), 32 + 64 + 1, 1 + 12 + 30))
    for name, width in (("ID", 12), ("NAME", 30)):
        dbf += name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([width]) + b"\0" * 15
    dbf += b"\r"
    for i, r in enumerate(rows.itertuples(index=False), 1):
        shp += struct.pack(">2i", i, 10) + struct.pack("<idd", 1, r.lon, r.lat)
        dbf += (b"*" if r.id % 11 == 0 else b" ") + str(r.id).encode().ljust(12) + r.c_name.encode().ljust(30)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in (("a.shp", shp), ("a.dbf", dbf), ("a.prj", b"GEOGCS[]")):
            z.writestr(name, bytes(data))
    return out.getvalue()


def _made(spark, sf_dir, make):
    """A container for each thousand customers: path, content."""
    rows = places(spark, sf_dir, "customer", "c_custkey", "c_name").withColumn("part", F.expr("id div 1000"))
    return rows.groupBy("part").applyInPandas(lambda f: pd.DataFrame({"path": [str(f["part"].iloc[0])], "content": [make(f.sort_values("id"))]}), "path string, content binary")


_BOX = (-95.0, 44.0, -91.0, 48.0)
_POINTS = f"WITH p AS (SELECT c_custkey AS id, c_name, {SQL_LON.format(k='c_custkey')} AS lon, {SQL_LAT.format(k='c_custkey')} AS lat FROM customer) SELECT id, c_name AS name, CAST(round(lon * 10000) AS BIGINT) AS lon4, CAST(round(lat * 10000) AS BIGINT) AS lat4 FROM p"


def _points(df, key):
    at = F.from_json("coordinates", "array<double>")
    place = [F.round(F.get(at, F.lit(i)) * 10000).cast("long").alias(n) for i, n in enumerate(("lon4", "lat4"))]
    return df.select(F.col("properties")[key].cast("long").alias("id"), F.col("properties")["name" if key == "fid" else "NAME"].alias("name"), *place)


@query("geopackage_rows", f"{_POINTS} WHERE lon BETWEEN {_BOX[0]} AND {_BOX[2]} AND lat BETWEEN {_BOX[1]} AND {_BOX[3]}")
def geopackage_rows(spark, sf_dir):
    """Points of a box from GeoPackages, by their index, without the column that is not wanted."""
    found = files.gpkg(spark, _made(spark, sf_dir, _package), columns=["fid", "name"], box=_BOX)
    return _points(found.where(~F.map_contains_key("properties", "other")), "fid").where(F.col("lon4").between(_BOX[0] * 10000, _BOX[2] * 10000) & F.col("lat4").between(_BOX[1] * 10000, _BOX[3] * 10000))


@query("shapefile_rows", f"{_POINTS} WHERE id % 11 <> 0 AND id % 3 = 1")
def shapefile_rows(spark, sf_dir):
    """Rows of zipped shapefiles that a predicate keeps; deleted ones are left out."""
    return _points(files.shp(spark, _made(spark, sf_dir, _shapefile), keep=lambda r: int(r["ID"]) % 3 == 1, keep_by=("ID",)), "ID")
