import pandas as pd
import pytest
from pyspark.sql import functions as F

from terrasift.plans import readers as Q
from terrasift.sources import files


def rows(n):
    return pd.DataFrame({"id": range(1, n + 1), "c_name": [f"n{i}" for i in range(n)], "lon": [-93 + i / 1000 for i in range(n)], "lat": [45 + i / 1000 for i in range(n)]})


def test_one_file_is_many_tasks(spark, tmp_path):
    """Rows of a single container are decoded in several tasks, and are those of the container."""
    for name, data, read in (("a.gpkg", Q._package(rows(3000)), files.gpkg), ("a.zip", Q._shapefile(rows(3000)), files.shp)):
        (tmp_path / name).write_bytes(data)
        df = read(spark, str(tmp_path / name))
        tasks = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert len(tasks) > 1 and max(tasks) < 2000
        got = df.orderBy("ord").collect()
        want = [r for r in rows(3000).itertuples() if name == "a.gpkg" or r.id % 11]
        assert [(r.coordinates, r.properties["name" if name == "a.gpkg" else "NAME"]) for r in got] == [(f"[{w.lon}, {w.lat}]", w.c_name) for w in want]


def test_only_what_the_predicate_needs_is_decoded(spark):
    """The predicate is asked with its own columns alone; rows that it keeps come with all of them."""
    of = spark.createDataFrame([("a", bytearray(Q._shapefile(rows(50))))], "path string, content binary")
    got = files.shp(spark, of, keep=lambda r: list(r) == ["ID"] and int(r["ID"]) > 40, keep_by=("ID",)).collect()
    assert sorted(int(r.properties["ID"]) for r in got) == [41, 42, 43, 45, 46, 47, 48, 49, 50] and all(r.properties["NAME"] for r in got)


def test_box_and_columns_of_a_package():
    data = Q._package(rows(1000))
    got = list(files.gpkg_raw(data, columns=["name"], box=(-92.9, 45.0, -92.8, 46.0)))
    assert {len(v) for _, _, v in got} == {1} and 100 <= len(got) <= 103
    assert len(list(files.gpkg_raw(data))) == 1000
    with pytest.raises(files.NotData):
        list(files.gpkg_raw(data, layer="none"))


def test_empty_containers(spark):
    none = spark.createDataFrame([("a", bytearray(Q._package(rows(0)))), ("b", bytearray(Q._package(rows(1))))], "path string, content binary")
    assert [r.path for r in files.gpkg(spark, none).collect()] == ["b"] and files.shp(spark, none.limit(0)).collect() == []
