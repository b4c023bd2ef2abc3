"""Steps whose cost in one task, or in the driver, grew with the tables."""

from __future__ import annotations

import re
import tracemalloc

from pyspark.sql import functions as F

from terrasift.operators import inventory as I
from terrasift.operators import spatial as S
from terrasift.sources import files


def test_names_and_hints_meet_without_broadcast(spark, tmp_path):
    names = ["A of the Big Old Red Barn", "a OF the big", "old-red barn", "", None, "barn", "the big old red barn's", "x a of the big old red barn y"]
    hints = ["barn", "the big", "A, of the BIG", "a of the big old red barn", "of the big old red house", "old red barn", "barns", " ", None, "red barn", "a of the big old"]
    spark.createDataFrame([(g, n) for g, n in zip((1, 2, 3, 4, 5, 1, 6, 2), names, strict=True)], "geoid int, name string").write.parquet(f"{tmp_path}/names")
    asked = spark.createDataFrame([(h,) for h in [*hints, "barn"]], "hint string")
    got = I.widening(spark.read.parquet(f"{tmp_path}/names"), asked)
    words = lambda t: " " + " ".join(re.findall("[a-z0-9']+", (t or "").lower())) + " "
    want = {h: len({g for g, n in zip((1, 2, 3, 4, 5, 1, 6, 2), names, strict=True) if words(h).strip() and words(h) in words(n)}) for h in hints}
    assert {r.hint: r.groups for r in got.collect()} == want
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == len(hints)


def test_segments_of_one_cell_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 16)
    monkeypatch.setattr(S, "TASK_PAIRS", 400)
    n = 120
    a = spark.range(n).select("id", *(F.expr(e).alias(c) for c, e in (("x1", "0.1D"), ("y1", "0.1D + id / 1000"), ("x2", "0.9D"), ("y2", "0.1D + id / 1000"))))
    b = spark.range(n).select((F.col("id") + 500).alias("id"), *(F.expr(e).alias(c) for c, e in (("x1", "0.2D + id / 1000"), ("y1", "0.0D"), ("x2", "0.2D + id / 1000"), ("y2", "0.5D"))))
    b = b.unionByName(b.where("id = 503")).unionByName(spark.createDataFrame([(900, -0.5, 0.1, 2.5, 0.1), (901, 0.5, 3.0, 0.5, 4.0)], b.schema))
    got = S.crossing_segments(a, b, 1.0).withColumn("task", F.spark_partition_id())
    assert max(r["count"] for r in got.groupBy("task").count().collect()) < n * n / 8
    rows = sorted((r.a_id, r.b_id) for r in got.collect())
    # A row that stands twice is met twice, a segment over many cells once.
    assert rows == sorted([(i, j) for i in range(n) for j in [*range(500, 500 + n), 503]] + [(0, 900)])


def test_near_places_of_one_cell_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 16)
    monkeypatch.setattr(S, "TASK_PAIRS", 400)
    a = spark.range(150).selectExpr("id", "-93.005D + id / 1000000 AS lon", "45.005D + id / 1000000 AS lat")
    b = a.selectExpr("id + 1000 AS id", "lon", "lat")
    got = S.near_pairs(a, b, 1500.0)
    assert got.select("a_id", "b_id").distinct().count() == got.count() == 150 * 150
    tasks = got.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert max(r["count"] for r in tasks) < 150 * 150 / 8


def test_matching_sorts_a_bounded_number_of_rows(spark, monkeypatch):
    pairs = spark.range(60).selectExpr("id AS a_id", "explode(sequence(100, 159)) AS b_id").selectExpr("a_id", "b_id", "CAST((a_id * 7 + b_id * 13) % 31 AS double) AS d", "0 AS dx", "0 AS dy")
    taken, want = set(), {}
    for a in range(60):
        want[a] = min((b for b in range(100, 160) if b not in taken), key=lambda b: ((a * 7 + b * 13) % 31, b))
        taken.add(want[a])
    monkeypatch.setattr(S, "TASK_ROWS", 100)
    # Pairs that stand twice change nothing.
    twice = pairs.unionByName(pairs.where("b_id % 3 = 0"))
    assert {r.a_id: r.b_id for r in S.greedy_match(twice, most_rounds=2).collect()} == want
    assert S._dealt(pairs, 3600, "a_id").rdd.getNumPartitions() == 36


def test_a_large_map_document_is_read_without_holding_it():
    mark = "<Placemark><name> m{0} </name><Folder><name>no</name></Folder><ExtendedData><Data name='k'><value>{0}</value></Data></ExtendedData><Point><coordinates>1.5,{0} 7,7</coordinates></Point></Placemark>"
    many = "".join(mark.format(i) for i in range(8000))
    text = f"<kml xmlns='u'><Document><name>d</name>{mark.format(-1)}<Folder>{many}<name> late<!-- c --> r <b/>x</name><name>2</name><Folder>{mark.format(-2)}</Folder></Folder><Folder><name>b</name><Document>{mark.format(-3)}</Document></Folder></Document></kml>"
    data = text.encode()
    tracemalloc.start()
    rows = [(r["ord"], r["name"], r["folder"], r["lat"], r["fields"]["k"]) for r in files.kml_rows("p", data) if not 2 < r["ord"] < 7999]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [r[2] for r in rows] == [None, "late r", "late r", "late r", "late r", None, "b"][: len(rows)]
    assert rows[0] == (0, "m-1", None, -1.0, "-1") and rows[-1] == (8002, "m-3", "b", -3.0, "-3") and len(rows) == 7
    assert most < 2 << 20
    assert [r["error"] for r in files.kml_rows("p", data[:-10])] and len(list(files.kml_rows("p", data[:-10]))) == 1


def test_quoted_files_are_cut_into_parts_of_few_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PART_BITS", 2)
    rows = [(str(i), "\n".join(f'l{k} "q", {i}' for k in range(i % 12))) for i in range(60)]
    (tmp_path / "a.csv").write_text("id,text\n" + "".join('"{}","{}"\n'.format(i, t.replace('"', '""')) for i, t in rows))
    got = files.quoted_records(spark, str(tmp_path))
    assert got.select("ord.part").distinct().count() > 30
    read = files.delimited(spark, str(tmp_path))
    assert sorted((r.id, r.text) for r in read.collect()) == sorted(rows)
