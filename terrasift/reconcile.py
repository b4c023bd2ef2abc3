"""Cross-matching of layers of one entity, and builds over several sources to their files."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyarrow.fs import FileSelector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.catalog import Aoi, Catalog, fetch_first
from terrasift.operators.lineage import cut, release
from terrasift.operators.packs import observed
from terrasift.operators.rows import first_by_key
from terrasift.operators.spatial import compare_numbers, greedy_match, near_pairs
from terrasift.sinks import packs
from terrasift.sinks.archives import write_archives
from terrasift.sinks.store import store

KEYS = ("capacity_mw", "voltage_kv", "max_voltage_kv", "height_ft", "beds")


def line_layers(df: DataFrame, key: str) -> DataFrame:
    """For each layer, whether over half of the geometries that are there are lines."""
    return df.groupBy(key).agg(F.coalesce(F.avg(F.col("geom_type").contains("Line").cast("int")) > 0.5, F.lit(False)).alias("is_line"))


def layer_pairs(specs: list[dict], lines: frozenset[str] | set[str] = frozenset()) -> list[tuple[dict, dict]]:
    """Pairs of layers of one entity, in order, unless the first one's spec says no. Layers of lines (``lines`` has their names) are left out: a line has no one place to match by."""
    of = [s for s in specs if s.get("entity") and s.get("layer") not in lines]
    return [(a, b) for i, a in enumerate(of) for b in of[i + 1 :] if a["entity"] == b["entity"] and a.get("reconcile", True)]


def cross_match(specs: list[dict], layers: dict[str, DataFrame], radius: float = 800.0, percent: float = 5.0) -> list[tuple[dict, dict, DataFrame]]:
    """What reconcile finds for every pair of layers; which are layers of lines is told by one pass over all of them."""
    wanted = [s for s in specs if s.get("entity") and s["layer"] in layers]
    if not wanted:
        return []
    kinds = [layers[s["layer"]].select(F.lit(s["layer"]).alias("layer"), "geom_type") for s in wanted]
    lines = {r.layer for r in line_layers(reduce(DataFrame.unionByName, kinds), "layer").where("is_line").collect()}
    return [(a, b, reconcile(layers[a["layer"]], layers[b["layer"]], radius, percent)) for a, b in layer_pairs(wanted, lines)]


def reconcile(a: DataFrame, b: DataFrame, radius: float = 800.0, percent: float = 5.0) -> DataFrame:
    """One row for each row of both: side, a_id, b_id, metres, n_compared, n_diffs, diffs. Rows: id, lon, lat, shape and numbers among KEYS.

    n_compared tells an agreement in fact from one in which nothing could be compared.
    """
    usable = lambda d: d.where("lon IS NOT NULL AND lat IS NOT NULL AND (shape IS NULL OR shape <> 'marker')")
    a, b = usable(a), usable(b)
    found = greedy_match(near_pairs(a, b, radius))
    keys = [k for k in KEYS if k in a.columns and k in b.columns]
    x, y = a.select(F.col("id").alias("a_id"), *(F.col(k).alias(f"a_{k}") for k in keys)), b.select(F.col("id").alias("b_id"), *(F.col(k).alias(f"b_{k}") for k in keys))
    both = found.join(x, "a_id").join(y, "b_id")
    pct = lambda k: compare_numbers(F.col(f"a_{k}"), F.col(f"b_{k}"), percent)
    diffs = F.filter(F.array(*(F.when(pct(k).isNotNull(), F.concat(F.lit(f"{k} "), F.round(pct(k)).cast("long"), F.lit("%"))) for k in keys)).cast("array<string>"), lambda d: d.isNotNull())
    compared = sum((((F.col(f"a_{k}") != 0) & (F.col(f"b_{k}") != 0)).cast("int") for k in keys), F.lit(0))
    matched = both.select(F.lit("both").alias("side"), "a_id", "b_id", F.col("d").alias("metres"), F.coalesce(compared, F.lit(0)).alias("n_compared"), F.size(diffs).alias("n_diffs"), F.array_join(diffs, "; ").alias("diffs"))
    none = lambda d, side, mine, other: d.join(found, d["id"] == found[mine], "left_anti").select(F.lit(side).alias("side"), F.col("id").alias(mine), F.lit(None).cast("long").alias(other), F.lit(None).cast("double").alias("metres"), F.lit(0).alias("n_compared"), F.lit(0).alias("n_diffs"), F.lit("").alias("diffs"))
    only_a, only_b = none(a, "only_a", "a_id", "b_id"), none(b, "only_b", "b_id", "a_id")
    return matched.unionByName(only_a).unionByName(only_b)


def report(rows: DataFrame, most: int = 200) -> str:
    """Counts, and the first disagreements and leftovers in order of id."""
    n = {r.side: r.n for r in rows.groupBy("side").agg(F.count("*").alias("n")).collect()}
    out = [f"# matched {n.get('both', 0)}, only in a {n.get('only_a', 0)}, only in b {n.get('only_b', 0)}", ""]
    out += [f"- {r.a_id} / {r.b_id}: {r.diffs}" for r in rows.where("n_diffs > 0").orderBy("a_id").limit(most).collect()]
    for side, key in (("only_a", "a_id"), ("only_b", "b_id")):
        out += [f"- {side} {r[key]}" for r in rows.where(F.col("side") == side).orderBy(key).limit(most).collect()]
    return "\n".join(out)


def build(catalog: Catalog, aoi: Aoi, fetch: Callable[[dict], DataFrame], clip: Callable[[DataFrame], DataFrame] | None = None, **choice) -> tuple[dict[str, DataFrame], list[dict]]:
    """Each selected source fetched (or an alternate), deduplicated (D01) and clipped; results and a manifest row a source, in the catalog's order.

    A row tells how many features came in, how many were merged, how many lay outside and how many are left: counted by the passes that do the work and no others. A layer is written to the shared folder
    once deduplicated and once clipped, so neither fetching nor clipping is done again by whatever reads it. A source that fails is a row with its error, and no numbers. Without its boundary an area of that
    kind is refused rather than left unclipped.
    """
    layers, rows, names = {}, [], {}
    for spec in catalog.select(aoi, **choice):
        n = names[spec["layer"]] = names.get(spec["layer"], 0) + 1
        key = spec["layer"] if n == 1 else f"{spec['layer']}__{spec.get('provider', n)}"
        key = key if key not in layers else f"{key}_{n}"
        told = {"layer": key, "source": spec["id"], "license": spec.get("license"), "recovered_from": None, "error": None}
        try:
            df, used = fetch_first(spec, fetch)
            keys = [F.col("osm_type"), F.col("osm_id"), F.coalesce("shape", F.lit(""))] if "osm_id" in df.columns else [F.col("source_id"), F.substring("coordinates", 1, 200)]
            df, came = observed(df, f"in-{uuid.uuid4().hex}")
            df, merged = observed(first_by_key(df, keys, [F.col("ord")]), f"merged-{uuid.uuid4().hex}")
            df = cut(df, "layer")
            counts = {"rows_in": came.get["features"], "merged": came.get["features"] - merged.get["features"], "outside": 0, "features": merged.get["features"]}
            if clip and spec["layer"] != "boundary":
                inside, left = observed(clip(df), f"left-{uuid.uuid4().hex}")
                inside = cut(inside, "layer")
                release(df)
                counts |= {"outside": counts["features"] - left.get["features"], "features": left.get["features"]}
                df = inside
            layers[key] = df
            rows.append({**told, "source": used["id"], "license": used.get("license"), "recovered_from": used.get("recovered_from"), **counts})
        except Exception as e:  # noqa: BLE001  a failed source is a row of the manifest
            rows.append({**told, "error": f"{type(e).__name__}: {e}"})
            if spec["layer"] == "boundary" and clip:
                raise RuntimeError("no boundary, so nothing can be clipped") from e
    return layers, rows


def as_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A build's rows as a DataFrame; numbers of a failed source are null."""
    names = {"layer": "string", "source": "string", "license": "string", "recovered_from": "string", "error": "string", "rows_in": "long", "merged": "long", "outside": "long", "features": "long"}
    return spark.createDataFrame([tuple(r.get(k) for k in names) for r in rows], ", ".join(f"{k} {t}" for k, t in names.items()))


def publish(spark: SparkSession, layers: dict[str, DataFrame], rows: list[dict], specs: list[dict], out: str, bucket: str | None = None, box: tuple[float, ...] | None = None, radius: float = 800.0) -> list[str]:
    """A build's files below ``out``: an archive for each layer, GeoJSON lines, the licences, what cross-matching finds, and the manifest last, so that a folder with one is whole.

    layers: ord, name, geom_type, coordinates and properties (a map of strings), and for cross-matching id, lon, lat, shape and numbers. Archives and lines are written by tasks; the driver writes texts of
    a few lines a source. bucket: the property by which a layer's folders are made.
    """
    where, root = store(out)
    where.create_dir(root, recursive=True)
    files = []
    marks = []
    for key, df in layers.items():
        label = F.coalesce(F.nullif(F.trim(F.col("properties")[bucket]), F.lit("")), F.lit("(not recorded)")) if bucket else F.lit("(all)")
        fields = F.transform(F.array_sort(F.map_entries("properties")), lambda e: F.struct(e.key.alias("label"), e.value.alias("value")))
        drawn = packs.placemarks(df.withColumn("bucket", label), F.coalesce("name", F.lit("")), fields, F.lit("base"))
        marks.append(drawn.select(F.lit(key).alias("doc"), "bucket", F.lit(0).alias("place"), "ord", "xml"))
        packs.geojson_lines(df, F.col("properties")).write.text(f"{out}/geojson/{key}")
        files.append(f"geojson/{key}")
    if marks:
        every = reduce(DataFrame.unionByName, marks)
        folder = F.dense_rank().over(W.partitionBy("doc").orderBy("bucket"))
        places = every.select("doc", "bucket").distinct().withColumn("place", folder)
        same = (F.col("doc") == F.col("p_doc")) & (F.col("bucket") == F.col("p_bucket"))
        placed = every.drop("place").join(places.select(F.col("doc").alias("p_doc"), F.col("bucket").alias("p_bucket"), "place"), same).select("doc", "bucket", "place", "ord", "xml")
        write_archives(placed, f"{out}/packs")
        files += [f"packs/{f.base_name}" for f in where.get_file_info(FileSelector(f"{root}/packs")) if f.base_name.endswith(".kmz")]

    def put(name: str, text: str) -> None:
        with where.open_output_stream(f"{root}/{name}") as f:
            f.write(text.encode())
        files.append(name)

    licences = packs.attribution(as_table(spark, [r for r in rows if not r["error"]]).select("layer", "license"))
    put("ATTRIBUTION.txt", "\n".join(f"{r.license}: {', '.join(r.layers)}{' (open database notice)' if r.odbl else ''}" for r in licences.collect()) + "\n")
    by_layer = {r["layer"]: s | {"layer": r["layer"]} for r, s in ((r, s) for r in rows for s in specs if not r["error"] and s["id"] in (r["source"], r["recovered_from"]))}
    for a, b, found in cross_match(list(by_layer.values()), layers, radius):
        put(f"reconcile-{a['layer']}-{b['layer']}.md", report(cut(found, "matched")))
    put("manifest.json", packs.manifest(rows, files, box))
    return sorted(files)
