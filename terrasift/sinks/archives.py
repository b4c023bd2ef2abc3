"""Map packs as archives whose documents no task and no driver ever holds.

A document's rows (its head, folders' heads, placemarks, ends) are dealt to tasks by ranges of their order, so a folder of any size is many tasks. Each task deflates its stretch of
each document into a file beside the target and ends it on a byte, so that stretches can be set one after another. The commit on the driver writes
each archive's frame, copies the deflated stretches into it in their order, a block at a time, and combines their checksums; archives get their names last,
all or none of a write's parts counting. A task that ran twice leaves a file that the commit does not name and removes with the others.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from terrasift.functions.scalar import xml_escape
from terrasift.sinks.store import store

#: Bytes that the commit copies at once; fixed time stamp of all members (2000-01-01), and signatures of the archive format.
BLOCK, STAMP = 4 << 20, (0, (2000 - 1980) << 9 | 1 << 5 | 1)
LOCAL, CENTRAL, END, END64, LOCATOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_FULL = 0xFFFFFFFF
HEAD = '<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>'


def _times(m: list[int], v: int) -> int:
    out = 0
    for row in m:
        if v & 1:
            out ^= row
        v >>= 1
    return out


def joined_crc(a: int, b: int, size: int) -> int:
    """The CRC-32 of two stretches one after another, from each one's; the second has ``size`` bytes. Appending a zero bit is a linear map, which is squared for each bit of the size."""
    step = [0xEDB88320, *(1 << k for k in range(31))]
    bits = 8 * size
    while bits:
        if bits & 1:
            a = _times(step, a)
        step = [_times(step, row) for row in step]
        bits >>= 1
    return a ^ b


@dataclass
class Stretch:
    """Deflated bytes of one document in one file of a task."""

    doc: str
    file: str
    start: int
    size: int
    raw: int
    crc: int
    marks: int


def deflated(texts: Iterable[bytes]) -> Iterator[bytes]:
    """Deflated blocks that end on a byte and do not end the stream."""
    press = zlib.compressobj(wbits=-15)
    for t in texts:
        yield press.compress(t)
    yield press.flush(zlib.Z_SYNC_FLUSH)


def _extra(*values: int) -> bytes:
    """Sizes that do not fit in 32 bits, as the format's extra field."""
    large = [v for v in values if v >= _FULL]
    return struct.pack(f"<HH{len(large)}Q", 1, 8 * len(large), *large) if large else b""


def _member(sig: bytes, name: bytes, crc: int, size: int, raw: int, at: int | None) -> bytes:
    """A member's header, before its data or (``at`` given) in the directory at the archive's end."""
    extra = _extra(raw, size, *([] if at is None else [at]))
    need = 45 if extra else 20
    clip = lambda v: min(v, _FULL)
    common = struct.pack("<HHHHHIIIHH", need, 0x800, 8, *STAMP, crc, clip(size), clip(raw), len(name), len(extra))
    return sig + common + name + extra if at is None else sig + struct.pack("<H", 3 << 8 | need) + common + struct.pack("<HHHII", 0, 0, 0, 0o644 << 16, clip(at)) + name + extra


def archive(out, members: list[tuple[str, int, int, int, Iterable[bytes]]]) -> None:
    """Write an archive of deflated members: name, CRC-32, deflated and raw size, and the deflated bytes."""
    at, directory = 0, b""
    for name, crc, size, raw, blocks in members:
        head = _member(LOCAL, name.encode(), crc, size, raw, None)
        out.write(head)
        directory += _member(CENTRAL, name.encode(), crc, size, raw, at)
        for b in blocks:
            out.write(b)
        at += len(head) + size
    out.write(directory)
    n = len(members)
    if at + len(directory) >= _FULL or n > 0xFFFE:
        out.write(END64 + struct.pack("<QHHIIQQQQ", 44, 3 << 8 | 45, 45, 0, 0, n, n, len(directory), at) + LOCATOR + struct.pack("<IQI", 0, at + len(directory), 1))
    out.write(END + struct.pack("<HHHHIIH", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), len(directory), min(at, _FULL), 0))


def plain_member(name: str, data: bytes) -> tuple[str, int, int, int, Iterable[bytes]]:
    """A member whose bytes are at hand."""
    blocks = [*deflated([data]), b"\x03\x00"]
    return name, zlib.crc32(data), sum(map(len, blocks)), len(data), blocks


def document_rows(rows: DataFrame, hidden: Column | None = None, doc: str = "doc", bucket: str = "bucket", place: str = "place", order: str = "ord") -> DataFrame:
    """Doc, its rows' order (place, step, ord) and xml: heads and ends of documents and folders around the placemarks. Folders tell how many placemarks they have; a document is hidden only if all its rows are."""
    marked = rows.select(F.col(doc).cast("string").alias("doc"), F.col(bucket).alias("bucket"), F.col(place).cast("long").alias("place"), F.col(order).cast("long").alias("ord"), "xml", (hidden if hidden is not None else F.lit(False)).alias("hidden"))
    counted = marked.groupBy("doc", "place", "bucket").agg(F.count("*").alias("n"), F.bool_and("hidden").alias("hidden"))
    docs = counted.groupBy("doc").agg(F.bool_and("hidden").alias("hidden"))
    title = F.concat(F.lit(HEAD), xml_escape(F.col("doc")), F.lit("</name><visibility>"), F.when(F.col("hidden"), "0").otherwise("1"), F.lit("</visibility>"))
    folder = F.concat(F.lit("<Folder><name>"), xml_escape(F.concat("bucket", F.lit(" ("), "n", F.lit(")"))), F.lit("</name>"))

    def step(df: DataFrame, at: Column, n: int, order: Column, xml: Column) -> DataFrame:
        return df.select("doc", at.alias("place"), F.lit(n).alias("step"), order.alias("ord"), xml.alias("xml"))

    none, ends = F.lit(0).cast("long"), F.lit((1 << 63) - 1)
    parts = [
        step(docs, F.lit(-(1 << 63)), 0, none, title),
        step(counted, F.col("place"), 1, none, folder),
        step(marked, F.col("place"), 2, F.col("ord"), F.col("xml")),
        step(counted, F.col("place"), 3, none, F.lit("</Folder>")),
        step(docs, ends, 4, none, F.lit("</Document></kml>")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@dataclass
class Written(WriterCommitMessage):
    partition: int
    stretches: list[Stretch] = field(default_factory=list)


class Kmz(DataSource):
    """format("kmz"): rows of document_rows, sorted within partitions whose order is theirs; options path, staging (a name of this write's own), members (JSON: name to base64)."""

    @classmethod
    def name(cls) -> str:
        return "kmz"

    def schema(self) -> str:
        return "doc string, step int, xml string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return KmzWriter(dict(self.options))


class KmzWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.staging = options["path"], f"_{options['staging']}"
        self.members = {k: base64.b64decode(v) for k, v in json.loads(options.get("members", "{}")).items()}

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        where, root = store(self.path)
        done, out, at, now, press = Written(task.partitionId()), None, 0, None, None
        name = f"{self.staging}/{task.partitionId():06d}-{task.taskAttemptId()}"

        def put(data: bytes) -> None:
            nonlocal at
            out.write(data)
            at += len(data)
            now.size += len(data)

        for batch in iterator:
            docs, steps, texts = (batch.column(c).to_pylist() for c in ("doc", "step", "xml"))
            for doc, step, xml in zip(docs, steps, texts, strict=True):
                if out is None:
                    where.create_dir(f"{root}/{self.staging}", recursive=True)
                    out = where.open_output_stream(f"{root}/{name}")
                if now is None or doc != now.doc:
                    if now is not None:
                        put(press.flush(zlib.Z_SYNC_FLUSH))
                    now, press = Stretch(doc, name, at, 0, 0, 0, 0), zlib.compressobj(wbits=-15)
                    done.stretches.append(now)
                data = xml.encode()
                now.raw, now.crc, now.marks = now.raw + len(data), zlib.crc32(data, now.crc), now.marks + (step == 2)
                put(press.compress(data))
        if now is not None:
            put(press.flush(zlib.Z_SYNC_FLUSH))
            out.close()
        return done

    def commit(self, messages: list[Written | None]) -> None:
        """Join the stretches of each document; archives get their names once all of them are whole."""
        where, root = store(self.path)
        by: dict[str, list[Stretch]] = {}
        for m in sorted((m for m in messages if m), key=lambda m: m.partition):
            for s in m.stretches:
                by.setdefault(s.doc, []).append(s)
        names = {doc: f"{re.sub(r'[^A-Za-z0-9._-]+', '_', doc)}.kmz" for doc in by}
        if len(set(names.values())) < len(names):
            raise ValueError("two documents would have one file's name")
        for doc, stretches in by.items():
            crc = raw = 0
            for s in stretches:
                crc, raw = joined_crc(crc, s.crc, s.raw), raw + s.raw
            whole = ("doc.kml", crc, sum(s.size for s in stretches) + 2, raw, self._blocks(where, root, stretches))
            with where.open_output_stream(f"{root}/{self.staging}/{names[doc]}") as out:
                archive(out, [whole, *(plain_member(k, v) for k, v in sorted(self.members.items()))])
        for name in names.values():
            where.move(f"{root}/{self.staging}/{name}", f"{root}/{name}")
        self.abort([])

    @staticmethod
    def _blocks(where, root: str, stretches: list[Stretch]) -> Iterator[bytes]:
        for s in stretches:
            with where.open_input_file(f"{root}/{s.file}") as f:
                for k in range(0, s.size, BLOCK):
                    yield f.read_at(min(BLOCK, s.size - k), s.start + k)
        yield b"\x03\x00"  # an empty last block

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        where, root = store(self.path)
        if where.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            where.delete_dir(f"{root}/{self.staging}")


def write_archives(rows: DataFrame, path: str, members: dict[str, bytes] | None = None, hidden: Column | None = None, partitions: int | None = None) -> None:
    """An archive below ``path`` for each document of rows (doc, bucket, place, ord, xml), with the same small members in each."""
    spark = rows.sparkSession
    spark.dataSource.register(Kmz)
    order = ["doc", "place", "step", "ord", "xml"]
    every = document_rows(rows, hidden)
    dealt = every.repartitionByRange(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    packed = json.dumps({k: base64.b64encode(v).decode() for k, v in (members or {}).items()})
    dealt.select("doc", "step", "xml").write.format("kmz").option("path", path).option("staging", uuid.uuid4().hex).option("members", packed).mode("append").save()
