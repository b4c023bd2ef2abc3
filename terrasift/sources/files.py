"""File sources as DataFrames. Text formats are Spark's own readers; containers (zip, xlsx, gpkg, kmz) are read whole, one file a row, on the executors; rows of GeoPackages and shapefiles are decoded by many tasks."""

from __future__ import annotations

import csv
import io
import json
import re
import sqlite3
import struct
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Iterator
from typing import IO

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.functions.scalar import dms, valid_lonlat


class NotData(ValueError):
    """A file that is a web page, or that no reader knows."""


def sniff(name: str, head: bytes) -> str:
    """A format by extension, else by its first bytes; a web page is an error."""
    start = head.lstrip()[:15].lower()
    if start.startswith((b"<!doctype html", b"<html")):
        raise NotData(f"{name} is a web page")
    known = {"csv": "csv", "tsv": "csv", "txt": "csv", "geojson": "geojson", "json": "geojson", "gpkg": "gpkg", "xlsx": "xlsx", "kml": "kml", "kmz": "kml"}
    ext = name.rsplit(".", 1)[-1].lower()
    if ext in known:
        return known[ext]
    if head.startswith(b"PK"):
        return "shp"
    if head.startswith(b"SQLite format 3"):
        return "gpkg"
    return "geojson" if start[:1] in (b"{", b"[") else "csv"


#: A part of a delimited file has at most two to the power of this many lines.
PART_BITS = 14


def _in_quotes(line: Column, sep: str) -> Column:
    """Whether a line that begins outside quotes ends inside: a field opens with a quote that nothing closes. Quotes within other fields mean nothing."""
    opens = f"(^|\\Q{sep}\\E)\""
    left = F.regexp_replace(line, f'{opens}(?:[^"]|"")*+"', "$1")
    return F.when(F.contains(line, F.lit('"')), left.rlike(opens)).otherwise(False)


def quoted_records(spark: SparkSession, path: str, sep: str = ",", skip_lines: int = 0) -> DataFrame:
    """File, ord (its place), first (whether it is its file's first) and text of each record of delimited files, whose quoted fields may hold line breaks. Large files are split.

    A line tells, for both cases, whether it ends inside quotes if it begins inside or outside; so it keeps, turns or fixes the state. The parts of a file that Spark splits it into, cut into some thousand lines each, are told
    by how they change it, one row each, and put in order; so each part knows how it begins, and each line too. Lines that are records by themselves, nearly all, stay where they are; those of longer
    records are brought together, also across parts. skip_lines: lines at a file's beginning that are no table.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    # Spark's parts of a file are cut further, so that a window, which one task has whole, holds 2 ** PART_BITS lines at most.
    lines = lines.select("value", "file", F.struct("start", F.shiftright("row", PART_BITS).alias("nth")).alias("part"), "row")
    inside = _in_quotes(F.concat(F.lit('"'), "value"), sep)
    within, over = W.partitionBy("file", "part").orderBy("row"), W.partitionBy("file").orderBy("part")
    known = lines.withColumn("out_in", _in_quotes(F.col("value"), sep)).withColumn("in_in", inside)
    if skip_lines:
        sizes = lines.groupBy("file", "part").agg(F.count("*").alias("n"))
        sizes = sizes.select(F.col("file").alias("s_file"), F.col("part").alias("s_part"), (F.sum("n").over(over) - F.col("n")).alias("before")).where(F.col("before") < skip_lines)
        known = known.withColumn("nth", F.row_number().over(within)).join(sizes, (F.col("file") == F.col("s_file")) & (F.col("part") == F.col("s_part")), "left")
        known = known.where(F.col("before").isNull() | (F.col("before") + F.col("nth") > skip_lines)).drop("nth", "s_file", "s_part", "before")

    def running(df: DataFrame, window) -> DataFrame:
        """turns: how often the state was turned before a row; fixed: what the last row that fixed it left, turned back to the beginning (null: none did)."""
        before, turn = window.rowsBetween(W.unboundedPreceding, -1), F.col("out_in") & ~F.col("in_in")
        df = df.withColumn("turns", F.coalesce(F.sum(turn.cast("int")).over(before), F.lit(0)))
        fix = F.when(F.col("out_in") == F.col("in_in"), (F.col("out_in").cast("int") + F.col("turns")) % 2)
        return df.withColumn("fix", fix).withColumn("fixed", F.last("fix", ignorenulls=True).over(before))

    state = lambda begin: (F.coalesce("fixed", begin) + F.col("turns")) % 2 == 1
    own = running(known, within)
    last = F.struct("out_in", "in_in", "turns", "fix", "fixed")
    parts = own.groupBy("file", "part").agg(F.max_by(last, "row").alias("z"), F.min("row").alias("top")).select("file", "part", "top", "z.*")
    total = (F.col("turns") + (F.col("out_in") & ~F.col("in_in")).cast("int")) % 2
    end = lambda begin: (F.coalesce("fix", "fixed", F.lit(begin)) + total) % 2 == 1
    parts = parts.select("file", "part", F.min(F.struct("part", F.col("top").alias("row"))).over(W.partitionBy("file")).alias("first_at"), end(0).alias("out_in"), end(1).alias("in_in"))
    parts = running(parts, over).select(F.col("file").alias("p_file"), F.col("part").alias("p_part"), "first_at", state(F.lit(0)).cast("int").alias("begins"))
    each = own.join(parts, (F.col("file") == F.col("p_file")) & (F.col("part") == F.col("p_part"))).withColumn("open", state(F.col("begins")))
    each = each.withColumn("starts", ~F.col("open")).withColumn("ends", F.when(F.col("open"), ~F.col("in_in")).otherwise(~F.col("out_in")))
    first = F.struct("part", "row") == F.col("first_at")
    each = each.select("file", "part", "row", "value", "starts", "ends", first.alias("first"), F.sum(F.col("starts").cast("int")).over(within).alias("nth"))
    alone = each.where("starts AND ends").select("file", F.struct("part", "row").alias("ord"), "first", F.col("value").alias("text"))
    rest = each.where("NOT (starts AND ends)")
    # Lines before a part's first record go on with the last record of the nearest part before that begins one.
    begun = each.groupBy("file", "part").agg(F.max("nth").alias("n")).withColumn("own", F.when(F.col("n") > 0, F.struct("part", "n")))
    begun = begun.withColumn("from", F.last("own", ignorenulls=True).over(over.rowsBetween(W.unboundedPreceding, -1))).select(F.col("file").alias("b_file"), F.col("part").alias("b_part"), "from")
    tied = rest.join(begun, (F.col("file") == F.col("b_file")) & (F.col("part") == F.col("b_part"))).withColumn("of", F.when(F.col("nth") > 0, F.struct("part", F.col("nth").alias("n"))).otherwise(F.col("from")))
    long = tied.groupBy("file", "of").agg(F.array_sort(F.collect_list(F.struct("part", "row", "value"))).alias("l"), F.bool_or("first").alias("first"))
    long = long.select("file", F.struct(F.get("l", F.lit(0)).part.alias("part"), F.get("l", F.lit(0)).row.alias("row")).alias("ord"), "first", F.array_join("l.value", "\n").alias("text"))
    return alone.unionByName(long).withColumn("text", F.regexp_replace(F.when(F.col("first"), F.ltrim("text", F.lit("\ufeff"))).otherwise(F.col("text")), "\r$", ""))


def delimited(spark: SparkSession, path: str, sep: str = ",", skip_lines: int = 0, header: list[str] | None = None, lat: str | None = None, lon: str | None = None, dms_fields: tuple[str, ...] | None = None, keep: Column | None = None, split_files: bool = False) -> DataFrame:
    """All columns as text, with lon and lat; rows without usable places go (F23). Short rows are filled with empty texts, blank ones skipped.

    lat, lon: decimal columns; dms_fields: eight columns, degrees to hemisphere of latitude and longitude. Quoted fields may hold
    line breaks, and files are split all the same (quoted_records); split_files, for files that are known to have none, spares finding out. All files
    of a path must have the same header.
    """
    if split_files and not skip_lines:
        csv_of = spark.read.option("sep", sep).option("escape", '"').option("quote", '"')
        names = header or csv_of.option("header", True).csv(path).columns
        rows = csv_of.option("header", header is None).option("enforceSchema", header is not None).csv(path, schema=", ".join(f"`{n}` string" for n in names))
        rows = rows.toDF(*(n.strip().lstrip("\ufeff") for n in names))
    else:
        records = quoted_records(spark, path, sep, skip_lines)
        names = header
        if names is None:
            top = spark.read.text(path).limit(skip_lines + 1000).select("value").collect()
            names = next(csv.reader([r.value + "\n" for r in top[skip_lines:]], delimiter=sep), [])
            names = [n.strip().lstrip("\ufeff").rstrip("\r") for n in names]
            records = records.where(~F.col("first"))
        fields = F.from_csv("text", ", ".join(f"`{n}` string" for n in names), {"sep": sep, "escape": '"', "quote": '"', "mode": "PERMISSIVE"})
        rows = records.where(F.trim("text") != "").select(fields.alias("r")).select(*(F.col(f"r.`{n}`") for n in names))
    filled = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns]
    rows = rows.select(*filled).where(F.trim(F.concat(*(F.col(f"`{c}`") for c in rows.columns))) != "")
    if keep is not None:
        rows = rows.where(keep)
    if dms_fields:
        a, b = dms_fields[:4], dms_fields[4:]
        rows = rows.withColumn("lat", dms(*(F.col(f"`{c}`") for c in a))).withColumn("lon", dms(*(F.col(f"`{c}`") for c in b)))
    elif lat and lon:
        rows = rows.withColumn("_y", F.trim(F.col(f"`{lat}`")).try_cast("double")).withColumn("_x", F.trim(F.col(f"`{lon}`")).try_cast("double"))
        rows = rows.withColumn("lat", F.col("_y")).withColumn("lon", F.col("_x")).drop("_x", "_y")
    else:
        return rows
    return rows.where(valid_lonlat(F.col("lon"), F.col("lat")))


def asr(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A registration table: ``|`` between columns, no header, no quotes, Latin-1."""
    raw = spark.read.option("encoding", "ISO-8859-1").csv(path, sep="|", quote="", schema=", ".join(f"c{i} string" for i in range(len(columns))))
    return raw.select(*(F.coalesce(F.col(f"c{i}"), F.lit("")).alias(c) for i, c in enumerate(columns)))


GEOJSON = "features array<struct<id:string, geometry:struct<type:string, coordinates:string, geometries:string>, properties:map<string,string>>>"


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """One row for each feature: ord, geom_type, coordinates (as JSON), properties."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", GEOJSON).alias("r"))
    return whole.select(F.posexplode("r.features").alias("ord", "f")).select("ord", F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("coordinates"), F.col("f.properties").alias("properties"))


def _per_file(spark: SparkSession, path: str, schema: str, rows: Callable[[str, bytes], Iterator[dict]]) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in re.split(r",\s*(?![^<]*>)", schema)]
        for frame in frames:
            for p, content in zip(frame["path"], frame["content"], strict=True):
                part = []
                for r in rows(p, bytes(content)):
                    part.append([r.get(n) for n in names])
                    if len(part) == 5000:  # rows of a large file leave in parts
                        yield pd.DataFrame(part, columns=names, dtype=object)
                        part = []
                yield pd.DataFrame(part, columns=names, dtype=object)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, schema)


def column_index(ref: str) -> int:
    """``AA7`` is column 26."""
    n = 0
    for c in ref:
        if c.isalpha():
            n = n * 26 + ord(c.upper()) - 64
    return n - 1


def xlsx_rows(data: bytes, sheet: int = 1, header_row: int = 1) -> Iterator[dict[str, str]]:
    """Rows of a sheet by their header; everything is text, columns without a name are left out."""
    ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
        header: dict[int, str] = {}
        for _, row in ET.iterparse(z.open(f"xl/worksheets/sheet{sheet}.xml")):
            if row.tag != f"{ns}row":
                continue
            cells = {}
            for c in row.iter(f"{ns}c"):
                if c.get("t") == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{ns}t"))
                else:
                    v = c.find(f"{ns}v")
                    value = "" if v is None else v.text or ""
                    value = shared[int(value)] if c.get("t") == "s" and value else value
                cells[column_index(c.get("r", ""))] = value
            number = int(row.get("r", 0))
            if number == header_row:
                header = {i: v.strip() for i, v in cells.items() if v.strip()}
            elif number > header_row and any(cells.values()):
                yield {n: cells.get(i, "") for i, n in header.items()}
            row.clear()


def xlsx(spark: SparkSession, path: str, sheet: int = 1, header_row: int = 1) -> DataFrame:
    return _per_file(spark, path, "path string, ord long, properties map<string,string>", lambda p, b: ({"path": p, "ord": i, "properties": r} for i, r in enumerate(xlsx_rows(b, sheet, header_row))))


def read_wkb(data: bytes, at: int = 0) -> tuple[dict, int]:
    """A geometry as GeoJSON's type and coordinates, in two dimensions, and where it ends."""
    order = "<" if data[at] else ">"
    (kind,) = struct.unpack_from(order + "I", data, at + 1)
    at += 5
    if kind & 0x20000000:
        at += 4
    dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
    kind &= 0x0FFFFFFF
    if kind >= 1000:
        dims, kind = {1: 3, 2: 3, 3: 4}[kind // 1000], kind % 1000

    def count() -> int:
        nonlocal at
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        return n

    def points(n: int) -> list:
        nonlocal at
        flat = struct.unpack_from(f"{order}{n * dims}d", data, at)
        at += 8 * n * dims
        return [list(flat[i : i + 2]) for i in range(0, n * dims, dims)]

    names = {1: "Point", 2: "LineString", 3: "Polygon", 4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon", 7: "GeometryCollection"}
    if kind == 1:
        return {"type": "Point", "coordinates": points(1)[0]}, at
    if kind == 2:
        return {"type": "LineString", "coordinates": points(count())}, at
    if kind == 3:
        return {"type": "Polygon", "coordinates": [points(count()) for _ in range(count())]}, at
    parts = []
    for _ in range(count()):
        part, at = read_wkb(data, at)
        parts.append(part)
    if kind == 7:
        return {"type": names[7], "geometries": parts}, at
    return {"type": names[kind], "coordinates": [p["coordinates"] for p in parts]}, at


def read_gpkg_blob(blob: bytes | None) -> dict | None:
    """GeoPackage's header before WKB; empty geometries are null."""
    if not blob or blob[:2] != b"GP" or blob[3] & 0x10:
        return None
    envelope = (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    return read_wkb(blob, 8 + envelope)[0]


def gpkg_raw(data: bytes, layer: str | None = None, columns: list[str] | None = None, box: tuple[float, float, float, float] | None = None) -> Iterator[tuple[int, bytes | None, dict]]:
    """Place, geometry as it is stored, and attributes of rows of the named feature table, or of the first. Only geographic coordinates (4326, 4269) are taken: no others are guessed at.

    The database reads the columns that are wanted and, with a box, the rows that its spatial index finds; without an index all rows come.
    """
    con = sqlite3.connect(":memory:")
    con.deserialize(data)
    con.row_factory = sqlite3.Row
    found = con.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY rowid").fetchall()
    pick = next((r for r in found if layer in (None, r["table_name"])), None)
    if pick is None:
        raise NotData(f"no layer {layer!r}")
    if pick["srs_id"] not in (4326, 4269, 0, -1):
        raise NotData(f"coordinates of EPSG:{pick['srs_id']} are not geographic")
    quoted = lambda name: '"' + name.replace('"', '""') + '"'
    table, geom = pick["table_name"], pick["column_name"]
    names = [r["name"] for r in con.execute(f"PRAGMA table_info({quoted(table)})") if r["name"] != geom and (columns is None or r["name"] in columns)]
    index = f"rtree_{table}_{geom}"
    indexed = box and con.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (index,)).fetchone()[0]
    where = f" WHERE rowid IN (SELECT id FROM {quoted(index)} WHERE minx <= ? AND maxx >= ? AND miny <= ? AND maxy >= ?)" if indexed else ""
    rows = con.execute(f"SELECT rowid, {', '.join(map(quoted, [geom, *names]))} FROM {quoted(table)}{where} ORDER BY rowid", (box[2], box[0], box[3], box[1]) if indexed else ())
    for i, (_, shape, *values) in enumerate(rows):
        yield i, shape, {k: None if v is None else str(v) for k, v in zip(names, values, strict=True)}
    con.close()


FEATURE = "path string, ord long, geom_type string, coordinates string, properties map<string,string>"
_RAW = "path string, ord long, shape binary, record binary, head string"


def _opened(contents: DataFrame, rows: Callable[[str, bytes], Iterator[tuple]]) -> DataFrame:
    """Rows of containers (path, content) as they are stored, dealt to many tasks. Opening a container is one task's, which only cuts it into rows; what costs, decoding, comes after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.string())
        names = [c.split()[0] for c in _RAW.split(", ")]
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part, held = [], 0
                for row in rows(path, content.as_buffer().to_pybytes()):
                    part.append((path, *row))
                    held += len(row[1] or b"") + len(row[2] or b"")
                    if len(part) == 5000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)
                        part, held = [], 0
                if part:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names)

    return contents.select("path", "content").mapInArrow(run, _RAW).repartition(int(contents.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _decoded(raw: DataFrame, one: Callable[[bytes | None, bytes, str], tuple | None]) -> DataFrame:
    """Features of raw rows; ``one`` gives kind, coordinates and attributes, or None for a row that is not wanted."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path, i, shape, record, head in f.itertuples(index=False):
                got = one(shape, record, head)
                if got is not None:
                    out.append((path, i, got[0], None if got[1] is None else json.dumps(got[1]), got[2]))
            yield pd.DataFrame(out, columns=["path", "ord", "geom_type", "coordinates", "properties"], dtype=object)

    return raw.mapInPandas(run, FEATURE)


def contents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def gpkg(spark: SparkSession, path: str | DataFrame, layer: str | None = None, columns: list[str] | None = None, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Features of GeoPackages at a path (or of a DataFrame of path and content): of the wanted columns, in the box of the index if one is given. Geometries are decoded by many tasks, also those of one file."""
    of = path if isinstance(path, DataFrame) else contents(spark, path)
    raw = _opened(of, lambda p, b: ((i, shape, json.dumps(values).encode(), "") for i, shape, values in gpkg_raw(b, layer, columns, box)))

    def one(shape: bytes | None, record: bytes, head: str) -> tuple:
        g = read_gpkg_blob(shape)
        return (None, None, json.loads(record)) if g is None else (g["type"], g.get("coordinates", g.get("geometries")), json.loads(record))

    return _decoded(raw, one)


def prj_is_geographic(text: str | None) -> bool:
    """No .prj is NAD83, as the files of that kind are; projected systems are refused."""
    return not text or not text.lstrip().upper().startswith("PROJCS")


def shp_raw(data: bytes) -> Iterator[tuple[int, bytes, bytes, str]]:
    """Place, geometry's record, attributes' record and the attributes' layout of a zipped shapefile's rows, but for deleted ones. Both members are inflated as they are read."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        by = {n.rsplit(".", 1)[-1].lower(): n for n in z.namelist() if not n.startswith("__MACOSX")}
        if "shp" not in by or "dbf" not in by:
            raise NotData("no .shp and .dbf in the archive")
        if not prj_is_geographic(z.read(by["prj"]).decode("latin-1") if "prj" in by else None):
            raise NotData("projected coordinates are not read")
        with z.open(by["shp"]) as shp, z.open(by["dbf"]) as dbf:
            start = dbf.read(32)
            n, head, size = struct.unpack_from("<IHH", start, 4)
            described = start + dbf.read(head - 32)
            layout = json.dumps([(described[o : o + 11].split(b"\0")[0].decode("latin-1"), described[o + 16]) for o in range(32, head - 1, 32) if described[o] != 13])
            shp.read(100)
            for i in range(n):
                record = dbf.read(size)
                (length,) = struct.unpack_from(">I", shp.read(8), 4)
                shape = shp.read(2 * length)
                if record[:1] != b"*":
                    yield i, shape, record, layout


def dbf_row(record: bytes, layout: list[tuple[str, int]], names: frozenset[str] | None = None) -> dict[str, str]:
    """The attributes of a record, or those of some names."""
    row, o = {}, 1
    for name, width in layout:
        if names is None or name in names:
            row[name] = record[o : o + width].decode("utf-8", "replace").strip()
        o += width
    return row


def shp_geometry(shape: bytes) -> tuple[str | None, object]:
    """A record's geometry as GeoJSON's type and coordinates."""
    (kind,) = struct.unpack_from("<I", shape, 0)
    if kind in (1, 11, 21):
        return "Point", list(struct.unpack_from("<2d", shape, 4))
    if kind in (8, 18, 28):
        (m,) = struct.unpack_from("<I", shape, 36)
        return "MultiPoint", [list(struct.unpack_from("<2d", shape, 40 + 16 * k)) for k in range(m)]
    if kind in (3, 5, 13, 15, 23, 25):
        parts, m = struct.unpack_from("<2I", shape, 36)
        starts = [*struct.unpack_from(f"<{parts}I", shape, 44), m]
        flat = struct.unpack_from(f"<{2 * m}d", shape, 44 + 4 * parts)
        rings = [[list(flat[2 * k : 2 * k + 2]) for k in range(a, b)] for a, b in zip(starts, starts[1:], strict=False)]
        return rings_to_polygons(rings) if kind in (5, 15, 25) else ("LineString", rings[0]) if len(rings) == 1 else ("MultiLineString", rings)
    return None, None


def shp(spark: SparkSession, path: str | DataFrame, keep: Callable[[dict], bool] | None = None, keep_by: tuple[str, ...] | None = None) -> DataFrame:
    """Features of zipped shapefiles at a path (or of a DataFrame of path and content). keep is asked with the attributes of keep_by (all if none are named) before anything else of a row is decoded. Rows are decoded by many tasks, also those of one file."""
    of = path if isinstance(path, DataFrame) else contents(spark, path)
    first = None if keep_by is None else frozenset(keep_by)

    def one(shape: bytes, record: bytes, head: str) -> tuple | None:
        layout = json.loads(head)
        if keep is not None and not keep(dbf_row(record, layout, first)):
            return None
        return (*shp_geometry(shape), dbf_row(record, layout))

    return _decoded(_opened(of, lambda p, b: shp_raw(b)), one)


def rings_to_polygons(rings: list[list]) -> tuple[str | None, object]:
    """Clockwise rings are outer, others holes of the outer ring before them; rings are closed, those under four clean points go."""
    polygons: list[list] = []
    for ring in rings:
        clean = [[float(p[0]), float(p[1])] for p in ring if len(p) >= 2 and all(isinstance(v, (int, float)) and not isinstance(v, bool) and v == v and abs(v) != float("inf") for v in p[:2])]
        if clean and clean[0] != clean[-1]:
            clean.append(clean[0])
        if len(clean) < 4:
            continue
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(clean, clean[1:], strict=False))
        if area <= 0 or not polygons:
            polygons.append([clean])
        else:
            polygons[-1].append(clean)
    return (None, None) if not polygons else ("Polygon", polygons[0]) if len(polygons) == 1 else ("MultiPolygon", polygons)


def esri_geometry(g: dict | None) -> tuple[str | None, object]:
    """Esri's x/y, points, paths and rings as GeoJSON."""
    if not g:
        return None, None
    if "x" in g:
        ok = all(isinstance(g.get(k), (int, float)) and g[k] == g[k] for k in "xy")
        return ("Point", [float(g["x"]), float(g["y"])]) if ok else (None, None)
    if g.get("points"):
        return "MultiPoint", [p[:2] for p in g["points"]]
    if g.get("paths"):
        return ("LineString", [p[:2] for p in g["paths"][0]]) if len(g["paths"]) == 1 else ("MultiLineString", [[p[:2] for p in line] for line in g["paths"]])
    return rings_to_polygons(g.get("rings") or [])


def kml_stream(data: bytes) -> IO[bytes]:
    """The document of a KML file, or of an archive: its doc.kml, else its first one; inflated as it is read."""
    if data[:2] != b"PK":
        return io.BytesIO(data)
    z = zipfile.ZipFile(io.BytesIO(data))
    found = sorted((n for n in z.namelist() if n.lower().endswith(".kml")), key=lambda n: (n.lower().rpartition("/")[2] != "doc.kml", n.count("/"), n))
    if not found:
        raise LookupError("no document in the archive")
    return z.open(found[0])


def kml_text(data: bytes) -> bytes:
    """That document, whole."""
    with kml_stream(data) as f:
        return f.read()


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


class _Folders:
    """Names of a document's folders in the order of their beginnings, null for those without; what is in placemarks is passed over. No element is kept."""

    def __init__(self) -> None:
        self.names: list[str | None] = []
        self.stack: list[int | None] = []
        self.within, self.reading = 0, None

    def start(self, tag: str, attrib: dict) -> None:
        self.reading, kind = None, _local(tag)
        if self.within or kind == "Placemark":
            self.within += 1
            return
        above = self.stack[-1] if self.stack else None
        if kind == "Folder":
            self.names.append(None)
        elif kind == "name" and above is not None and self.names[above] is None:
            self.names[above], self.reading = "", above
        self.stack.append(len(self.names) - 1 if kind == "Folder" else None)

    def data(self, text: str) -> None:
        if self.reading is not None:
            self.names[self.reading] += text

    def end(self, tag: str) -> None:
        self.reading = None
        if self.within:
            self.within -= 1
        else:
            self.stack.pop()

    def close(self) -> list[str | None]:
        return [None if n is None else n.strip() for n in self.names]


def kml_rows(path: str, data: bytes) -> Iterator[dict]:
    """Placemarks with name, first coordinates, all data fields and folder; a bad file is one row with its error.

    The document is read twice, a block at a time: first whether it is whole and what its folders are called, then its placemarks, of which one is held at once.
    """
    try:
        check = ET.XMLParser(target=_Folders())
        with kml_stream(data) as f:
            while block := f.read(1 << 16):
                check.feed(block)
        names = iter(check.close())
    except (ET.ParseError, zipfile.BadZipFile, LookupError, OSError, RuntimeError) as e:
        yield {"path": path, "ord": 0, "error": str(e) or type(e).__name__}
        return
    text = lambda e, tag: next(((x.text or "").strip() for x in e if _local(x.tag) == tag), None)
    found, within, above = 0, 0, []
    with kml_stream(data) as f:
        for event, e in ET.iterparse(f, ("start", "end")):
            kind = _local(e.tag)
            if event == "start":
                if within or kind == "Placemark":
                    within += 1
                if within < 2:
                    above.append((e, next(names) if kind == "Folder" else above[-1][1] if above else None))
                continue
            if within > 1:
                within -= 1
                continue
            _, folder = above.pop()
            if within:
                within = 0
                fields = {}
                for x in e.iter():
                    if _local(x.tag) == "Data":
                        fields[x.get("name", "")] = text(x, "value") or ""
                    elif _local(x.tag) == "SimpleData":
                        fields[x.get("name", "")] = (x.text or "").strip()
                where = next((x.text.split() for x in e.iter() if _local(x.tag) == "coordinates" and x.text and x.text.strip()), None)
                lon, lat = (float(v) for v in where[0].split(",")[:2]) if where else (None, None)
                yield {"path": path, "ord": found, "name": text(e, "name"), "folder": folder, "lon": lon, "lat": lat, "fields": fields}
                found += 1
            if above:
                above[-1][0].remove(e)


def kml(spark: SparkSession, path: str) -> DataFrame:
    return _per_file(spark, path, "path string, ord long, name string, folder string, lon double, lat double, fields map<string,string>, error string", kml_rows)


def nwr_stations(spark: SparkSession, path: str) -> DataFrame:
    """The list that a script assigns to ``var cclData``."""
    schema = "array<struct<callsign:string, freq:string, power:string, lat:string, lon:string, status:string, sitename:string, siteloc:string, sitestate:string, wfo:string, counties:array<struct<same:string, county:string, st:string>>>>"
    text = spark.read.text(path, wholetext=True)
    body = F.regexp_extract("value", r"(?sm)^\s*var\s+cclData\s*=\s*(\[.*?\])\s*;", 1)
    return text.select(F.explode(F.from_json(body, schema)).alias("r")).select("r.*")
