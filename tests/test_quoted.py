import csv
import random

from pyspark.sql import functions as F

from terrasift.sources import files


def table(rng, n):
    words = ["a", 'b "c"', "line\nbreak", "x,y", "", 'two\n\n"breaks"\n', "z" * 50, ",", '"', "é\r\nü"]
    return [[str(i), rng.choice(words), rng.choice(words)] for i in range(n)]


def write(path, rows, header=("id", "A", "B")):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator="\n")
        w.writerows([header, *rows])


def small_parts(spark, size, work):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        return work()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_breaks_across_parts(spark, tmp_path):
    """Files are split every 97 bytes, most often within quotes; the rows are those of one task."""
    rng, want = random.Random(6), []
    for k in range(3):
        rows = table(rng, 80)
        rows[40] = ["long", "q\n" * 200, "over several parts"]
        write(tmp_path / f"{k}.csv", rows)
        want += rows
    got = small_parts(spark, 97, lambda: [tuple(r) for r in files.delimited(spark, str(tmp_path)).collect()])
    assert sorted(got) == sorted(map(tuple, want))
    parts = small_parts(spark, 97, lambda: spark.read.text(str(tmp_path)).rdd.getNumPartitions())
    assert parts > 20
    order = small_parts(spark, 97, lambda: [r.text for r in files.quoted_records(spark, str(tmp_path / "1.csv")).orderBy("ord").collect()])
    assert [next(csv.reader(x.splitlines(True)))[0] for x in order] == ["id", *(r[0] for r in want[80:160])]


def test_stray_quotes_and_an_open_end(spark, tmp_path):
    """Quotes within fields that did not open with one are text; a quote that nothing closes takes the file's rest, and no other file's."""
    (tmp_path / "a.csv").write_text('id,A\n1,5" pipe\n2,"ok"\n3,a"b"c\n4,"open\n5,x\n')
    (tmp_path / "b.csv").write_text('id,A\n6,y\r\n7,"z"\r\n')
    got = sorted(tuple(r) for r in files.delimited(spark, str(tmp_path)).collect())
    assert got[:3] == [("1", '5" pipe'), ("2", "ok"), ("3", 'a"b"c')] and got[-2:] == [("6", "y"), ("7", "z")] and len(got) == 6 and got[3][0] == "4"


def test_skipped_lines_and_other_marks(spark, tmp_path):
    (tmp_path / "a.txt").write_text('﻿about "this\nid|A\n1|"x|\n\ny"\n\n2|z\n')
    for size in (9, 1 << 20):
        got = small_parts(spark, size, lambda: sorted(tuple(r) for r in files.delimited(spark, str(tmp_path / "a.txt"), sep="|", skip_lines=1).collect()))
        assert got == [("1", "x|\n\ny"), ("2", "z")]
    (tmp_path / "b.txt").write_text("1|2\n")
    assert [tuple(r) for r in files.delimited(spark, str(tmp_path / "b.txt"), sep="|", header=["p", "q"]).collect()] == [("1", "2")]
    (tmp_path / "c.txt").write_text("")
    assert files.quoted_records(spark, str(tmp_path / "c.txt")).collect() == []


def test_plan_has_no_whole_files(spark, tmp_path):
    write(tmp_path / "a.csv", table(random.Random(1), 5))
    plan = files.delimited(spark, str(tmp_path / "a.csv")).where(F.col("id") > 0)._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" not in plan and "Python" not in plan and "Pandas" not in plan
