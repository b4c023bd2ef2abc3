import io
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from terrasift.sinks import archives as A
from terrasift.sinks import packs as K


def marks(spark, n, docs=("a", "b & c")):
    rows = [(d, f"f{i % 3}" if d == "a" else "one", i % 3 if d == "a" else 0, i, f"<Placemark><name>{d[0]}{i} é</name></Placemark>") for d in docs for i in range(n)]
    return spark.createDataFrame(rows, "doc string, bucket string, place int, ord long, xml string")


def small(rows):
    return {r.doc: r.kml for r in K.documents(K.folders(rows), hidden=F.lit(False)).collect()}


def test_checksums_join():
    a, b = b"abc" * 77, b"\x00\x01x" * 1234
    assert A.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b) and A.joined_crc(zlib.crc32(a), 0, 0) == zlib.crc32(a) and A.joined_crc(0, zlib.crc32(b), len(b)) == zlib.crc32(b)


@pytest.mark.parametrize("partitions", [1, 7])
def test_archives_hold_the_documents(spark, tmp_path, partitions):
    """The same document as the small way makes, from one task or many; in one task the same bytes too."""
    rows = marks(spark, 400)
    A.write_archives(rows, str(tmp_path), {"i.png": b"\x89P", "a.txt": b""}, partitions=partitions)
    want = small(rows)
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["a.kmz", "b_c.kmz"]
    for doc, name in (("a", "a.kmz"), ("b & c", "b_c.kmz")):
        with zipfile.ZipFile(tmp_path / name) as z:
            assert z.testzip() is None and z.namelist() == ["doc.kml", "a.txt", "i.png"] and z.read("i.png") == b"\x89P"
            assert z.read("doc.kml").decode() == want[doc]
    if partitions == 1:
        one = marks(spark, 400, ("a",))
        A.write_archives(one, str(tmp_path / "one"), partitions=1)
        assert (tmp_path / "one" / "a.kmz").read_bytes() == K.kmz(want["a"])


def test_one_folder_is_many_tasks(spark, tmp_path, monkeypatch):
    """Rows of one folder come in several stretches, none of which is most of it; nothing is gathered by folder."""
    rows = marks(spark, 3000, ("b",))
    order = ["doc", "place", "step", "ord", "xml"]
    sizes = [r["count"] for r in A.document_rows(rows).repartitionByRange(6, *order).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 1500
    plan = A.document_rows(rows)._jdf.queryExecution().toString()
    assert "collect_list" not in plan
    A.write_archives(rows, str(tmp_path), partitions=6)
    with zipfile.ZipFile(tmp_path / "b.kmz") as z:
        assert z.read("doc.kml").decode() == small(rows)["b"]


def test_commit_counts_only_what_it_is_told(tmp_path):
    """Files of tasks that ran twice are not read, and are gone afterwards; names that would be one are an error before any archive is there."""
    import pyarrow as pa

    class Task:
        def __init__(self, p, a):
            self.p, self.a = p, a

        def partitionId(self):  # noqa: N802
            return self.p

        def taskAttemptId(self):  # noqa: N802
            return self.a

    writer = A.KmzWriter({"path": str(tmp_path), "staging": "w"})
    batch = lambda *rows: pa.RecordBatch.from_pylist([dict(zip(("doc", "step", "xml"), r, strict=True)) for r in rows])
    run = lambda p, a, *rows: (setattr(A.TaskContext, "get", staticmethod(lambda: Task(p, a))), writer.write(iter([batch(*rows)])))[1]
    get = A.TaskContext.get
    try:
        first, again, second = run(0, 1, ("d", 0, "<x>")), run(0, 2, ("d", 0, "<x>")), run(1, 3, ("d", 2, "é"), ("d", 4, "</x>"))
        assert [s.marks for s in second.stretches] == [1]
        writer.commit([second, None, again])
        assert zipfile.ZipFile(tmp_path / "d.kmz").read("doc.kml").decode() == "<x>é</x>" and [p.name for p in tmp_path.iterdir()] == ["d.kmz"] and first
        with pytest.raises(ValueError, match="name"):
            writer.commit([run(0, 1, ("a b", 0, "1"), ("a+b", 0, "2"))])
    finally:
        A.TaskContext.get = get


def test_large_sizes_have_their_field():
    """Headers of members beyond 4 GB, as zipfile reads them."""
    out = io.BytesIO()
    head = A._member(A.CENTRAL, b"doc.kml", 1, 5 << 32, 6 << 32, 7 << 32)
    out.write(head)
    end = out.tell()
    out.write(A.END64 + A.struct.pack("<QHHIIQQQQ", 44, 3 << 8 | 45, 45, 0, 0, 1, 1, end, 0) + A.LOCATOR + A.struct.pack("<IQI", 0, end, 1) + A.END + A.struct.pack("<HHHHIIH", 0, 0, 1, 1, end, 0, 0))
    [info] = zipfile.ZipFile(out).infolist()
    assert (info.compress_size, info.file_size, info.header_offset) == (5 << 32, 6 << 32, 7 << 32)


def test_no_rows(spark, tmp_path):
    A.write_archives(marks(spark, 1).limit(0), str(tmp_path))
    assert list(tmp_path.iterdir()) == []
