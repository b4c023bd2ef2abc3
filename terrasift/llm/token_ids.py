"""Operator 11, token ids in binary files: one zstandard dictionary, one frame a document, an index by offset.

``write_ids`` encodes every whole text, ends it with an id and writes files in ascending order of doc_id; ``read_ids`` reads them back in parallel
and ``fetch_ids`` reads single documents without the rest of their file.

A folder holds ``dictionary-<sha256>.zdict`` (trained once on the serialised ids of a bounded sample), ``part-*.ids`` files and ``manifest``, a table
with a row for each file. Only files that the manifest names count: a task that ran twice leaves a file that nothing reads. A file is

* 64 bytes: magic, bytes an id takes (2 where the vocabulary fits, else 4), SHA-256 of the dictionary (zeros: none could be trained);
* a zstandard frame for each document, compressed alone with the dictionary, so a short document costs one short read (frames have neither magic nor
  the dictionary's number, which would be half of a short one: the file's head says both);
* index: doc_id (int64) of n documents, 1 for a null doc_id (uint8), n + 1 offsets of frames, n + 1 counts of ids before a document (uint64);
* 40 bytes: the index's place, n, ids in all (uint64), CRC-32 of the index, magic.

Texts are encoded once, into a table of frames in the shared folder; it is dealt into files by ranges of doc_id and, within one doc_id, of further columns,
so a doc_id that holds a third of all rows spans several files. No task holds more than a slice of texts, or the index of one file.

Null and empty texts hold the end id alone. A null doc_id sorts before all others. Rows of one doc_id sort by number of ids, then by the ids' CRC-32; rows that agree
in all three are in any order, as their results are the same. Other columns are ignored, whatever their names. An empty table gives a manifest without rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import cut, release, scratch_folder, table
from terrasift.llm.decl import query
from terrasift.llm.token_counts import _drops_space, slices

MAGIC = b"TSIDS\x00\x01\n"
HEAD, FOOT = "<8sB23x32s", "<QQQII8s"
#: Bytes of text in a task's hands at once, units in a worker's memo, bytes of ids returned in a batch.
SLICE_BYTES, MEMO, BATCH_BYTES = 4 << 20, 500_000, 8 << 20
#: The dictionary's size, how many texts it is trained on, and their greatest length in code points.
DICTIONARY, SAMPLE, SAMPLE_CHARS = 64 << 10, 2000, 8192
#: Bytes of frames in a file, and in the smallest file that is made so that all cores have work.
FILE_BYTES, LEAST_FILE = 256 << 20, 4 << 20
LEVEL = 3
#: Punctuation that a pre-tokenizer parts from the letters before it, and that composes with nothing.
_TAIL = ".,!?;:"
#: What a pre-tokenizer of words makes of ASCII words in lower case: letters together, each digit, marks together.
_RUNS = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")


def _store(path: str):
    """The filesystem of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _tokenizer(name: str):
    from tokenizers import Tokenizer

    if "/" not in name:
        import public_tokenizers

        name = public_tokenizers.path(name)
    with open(name) as f:
        spec = json.load(f)
    found = Tokenizer.from_file(name)
    found.no_truncation()
    found.no_padding()
    return found, spec


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of flat that which names, one after another, and the place where each begins, and the end."""
    each = size[which]
    at = np.zeros(len(which) + 1, np.int64)
    np.cumsum(each, out=at[1:])
    kind = np.int32 if max(len(flat), int(at[-1])) < 1 << 30 else np.int64
    places = np.arange(at[-1], dtype=kind)
    places += np.repeat((first[which] - at[:-1]).astype(kind), each)
    return flat[places], at


class _Memo:
    """Ids of units, numbered as they come. When it is full it keeps the units of the slice at hand alone."""

    def __init__(self, kind: str):
        self.kind, self.number = kind, {}
        self.flat, self.first, self.size = np.zeros(0, kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def numbers(self, units: list[str], encode) -> np.ndarray:
        found = np.fromiter(map(self.number.get, units, itertools.repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(found < 0)
        if len(self.number) + len(new) > MEMO and self.number:
            old = np.flatnonzero(found >= 0)
            flat, at = _gather(self.flat, self.first, self.size, found[old])
            self.flat, self.first, self.size = flat, at[:-1], np.diff(at)
            self.number = {units[i]: k for k, i in enumerate(old.tolist())}
            found[old] = np.arange(len(old))
        if len(new):
            words = [units[i] for i in new.tolist()]
            ids, size = encode(words)
            found[new] = np.arange(len(self.size), len(self.size) + len(new))
            self.number.update(zip(words, found[new].tolist(), strict=True))
            self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
            self.flat, self.size = np.concatenate([self.flat, ids.astype(self.kind)]), np.concatenate([self.size, size])
        return found


class Encoder:
    """Serialised ids of whole texts, the end id after each, as one array with the places where texts begin.

    A tokenizer that drops white space gives a text the ids of its words one after another. So a slice's distinct words are encoded, each once, and the ids
    are gathered by word. Punctuation after letters is a unit of its own, and ASCII words of letters, digits and marks are taken apart. Units of letters alone are encoded together, told apart by the model's mark of a word's
    end; if there are not as many marks as units (some letters turn into others and marks), each unit is encoded by itself. Other tokenizers encode whole texts.
    """

    def __init__(self, name: str, end_id: int):
        self.tokenizer, spec = _tokenizer(name)
        self.by_word = _drops_space(spec)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if max(*vocabulary.values(), end_id) < 1 << 16 else "<u4"
        self.end_id, self.ends, end = end_id, None, spec["model"].get("end_of_word_suffix")
        if end:
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for w, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if w.endswith(end)]] = True
        self.memo = _Memo(self.kind)

    def _each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [np.array(x.ids, np.int32) for at in range(0, len(texts), 2000) for x in self.tokenizer.encode_batch_fast(texts[at : at + 2000], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.int32), *made]), np.array([len(x) for x in made], np.int64)

    def _units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, and how many each has."""
        letters = [i for i, u in enumerate(units) if u.isalpha()] if self.ends is not None else []
        order, ids, size = [], [], []
        for at in range(0, len(letters), 10_000):  # what the library makes for a batch is large
            groups = [letters[i : i + 100] for i in range(at, min(at + 10_000, len(letters)), 100)]
            made = [x.ids for x in self.tokenizer.encode_batch_fast([" ".join([units[i] for i in g]) for g in groups], add_special_tokens=False)]
            for group, x in zip(groups, made, strict=True):
                found = np.array(x, np.int32)
                last = np.flatnonzero(self.ends[found]) + 1
                if len(last) == len(group) and last[-1] == len(found):
                    order += group
                    ids.append(found)
                    size.append(np.diff(last, prepend=0))
        rest = sorted(set(range(len(units))).difference(order))
        found, n = self._each([units[i] for i in rest])
        flat, sizes = np.concatenate([*ids, found]), np.concatenate([*size, n])
        where = np.empty(len(units), np.int64)
        where[order + rest] = np.arange(len(units))
        return _gather(flat, np.cumsum(sizes) - sizes, sizes, where)[0], sizes[where]

    def serial(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts (null: empty) with the end id after each; where each text's begin, and the end."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            ids, size = self._each(texts.to_pylist())
            return np.insert(ids, np.cumsum(size), self.end_id).astype(self.kind), np.concatenate([[0], np.cumsum(size + 1)])
        parts = pc.ascii_split_whitespace(texts)
        at = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.flatten().dictionary_encode()
        words = coded.dictionary
        core = pc.utf8_rtrim(words, characters=_TAIL)
        plain = pc.string_is_ascii(core)
        # After NFC and in lower case the core must still be letters, else a mark at its end would stay with the tail.
        letters = pc.and_(pc.utf8_is_alpha(core), pc.or_(plain, pc.utf8_is_alpha(pc.utf8_lower(pc.utf8_normalize(core, "NFC")))))
        # ASCII words of letters, digits and marks are what runs of each give, but for contractions and special tokens.
        odd = pc.or_(pc.match_substring(words, "'"), pc.match_substring(words, "<|"))
        runs = np.flatnonzero(pc.and_not(pc.and_not(pc.string_is_ascii(words), letters), odd).to_numpy(zero_copy_only=False))
        pieces = [_RUNS.findall(w.lower()) for w in words.take(pa.array(runs)).to_pylist()]
        whole = pc.if_else(letters, pc.if_else(plain, pc.ascii_lower(core), core), words)
        if len(runs):
            whole = pc.replace_with_mask(whole, pa.array(np.isin(np.arange(len(words)), runs)), pa.scalar("", whole.type))
        head = whole.dictionary_encode()
        units = head.dictionary.to_pylist()
        known = set(units)
        units += [x for x in dict.fromkeys(itertools.chain.from_iterable(pieces)) if x not in known]
        numbers = self.memo.numbers(units, self._units)
        heads = numbers[: len(head.dictionary)]
        # Units: what the memo has, then the slice's tails, nothing, and the end id.
        tailed = np.flatnonzero(pc.and_(letters, pc.not_equal(pc.binary_length(core), pc.binary_length(words))).to_numpy(zero_copy_only=False))
        ends = [w[len(w.rstrip(_TAIL)) :] for w in words.take(pa.array(tailed)).to_pylist()]
        distinct = sorted(set(ends))
        more, size = self._units(distinct) if distinct else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        n, m = len(self.memo.size), len(self.memo.flat)
        flat = np.concatenate([self.memo.flat, more.astype(self.kind), np.array([self.end_id], self.kind)])
        first = np.concatenate([self.memo.first, m + np.cumsum(size) - size, [0, m + len(more)]])
        sizes = np.concatenate([self.memo.size, size, [0, 1]])
        place = {x: n + i for i, x in enumerate(distinct)}
        count = np.ones(len(words) + 1, np.int64)
        count[tailed], count[runs] = 2, [len(p) for p in pieces]
        begin = np.concatenate([[0], np.cumsum(count)])
        order = np.empty(begin[-1], np.int64)
        own = np.ones(len(words), bool)
        own[runs] = False
        order[begin[:-2][own]] = heads[head.indices.to_numpy()[own]]
        order[begin[tailed] + 1] = [place[x] for x in ends]
        if len(runs):
            of = dict(zip(units, numbers.tolist(), strict=True))
            sizes_of = count[runs]
            order[np.repeat(begin[runs] - (np.cumsum(sizes_of) - sizes_of), sizes_of) + np.arange(sizes_of.sum())] = [of[x] for p in pieces for x in p]
        order[begin[-2]] = n + len(distinct) + 1
        flat, bounds = _gather(flat, first, sizes, order)
        bounds = bounds[begin]
        closed = at[1:] - at[0]
        which = np.insert(coded.indices.to_numpy(), closed, len(words))
        out, starts = _gather(flat, bounds[:-1], np.diff(bounds), which)
        return out, starts[np.concatenate([[0], closed + np.arange(1, len(closed) + 1)])]


@functools.lru_cache(maxsize=1)
def _encoder(name: str, end_id: int) -> Encoder:
    """A worker's encoder: its memo serves all tasks of the worker."""
    return Encoder(name, end_id)


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, text_col: str, size: int = DICTIONARY, sample: int = SAMPLE) -> bytes:
    """A dictionary trained on the serialised ids of at most ``sample`` texts of 1 to SAMPLE_CHARS code points, those whose hashes are least; empty where they are too few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, samples = _encoder(tokenizer, end_id), []
        for batch in batches:
            ids, at = encoder.serial(batch.column(0))
            samples += [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]
        found = b""
        if len(samples) >= 16:
            try:
                found = zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples, k=200, d=8).as_bytes()
            except zstandard.ZstdError:  # too few or too much alike
                found = b""
        yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["dictionary"])

    t = F.col(text_col)
    drawn = docs.select(t.alias("text")).where(F.length(t).between(1, SAMPLE_CHARS)).orderBy(F.xxhash64("text"), "text").limit(sample)
    rows = drawn.coalesce(1).mapInArrow(run, "dictionary binary").collect()
    return bytes(rows[0].dictionary) if rows else b""


def _frames(docs: DataFrame, dictionary: bytes, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Each row's id, number of ids, CRC-32 of its serialised ids, frame, and a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        rule = zstandard.ZstdCompressionParameters.from_level(LEVEL, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_dict_id=False, write_content_size=True)
        kept = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if kept is not None:
            kept.precompute_compress(compression_params=rule)
        press = zstandard.ZstdCompressor(dict_data=kept, compression_params=rule)
        encoder, row = _encoder(tokenizer, end_id), TaskContext.get().partitionId() << 40
        for whole in batches:
            for batch in slices(whole, 1, SLICE_BYTES):
                ids, at = encoder.serial(batch.column(1))
                parts = [ids[a:b].data for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                        pa.array([press.compress(x) for x in parts], pa.binary()),
                        pa.array(np.arange(row, row + len(parts)), pa.int64()),
                    ],
                    ["id", "n", "crc", "frame", "row"],
                )
                row += len(parts)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n long, crc long, frame binary, row long")


_FILES = "piece int, file string, n_docs long, n_ids long, least long, most long, has_null boolean"


def _files(frames: DataFrame, path: str, width: int, digest: bytes) -> DataFrame:
    """Write a file for each partition of sorted frames; a row about each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _store(path)
        piece = TaskContext.get().partitionId()
        out, name = None, f"part-{piece:06d}-{uuid.uuid4().hex}.ids"
        ids: list[pa.Array] = []
        sizes, counts = [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                out = where.open_output_stream(f"{root}/{name}")
                out.write(struct.pack(HEAD, MAGIC, width, digest))
            ids.append(batch.column(0))
            counts.append(batch.column(1).to_numpy())
            sizes.append(pc.binary_length(batch.column(2)).to_numpy())
            out.write(b"".join(batch.column(2).to_pylist()))
        if out is None:
            return
        keys = pa.chunked_array(ids)
        offsets = struct.calcsize(HEAD) + np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<u8")
        before = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype("<u8")
        index = pc.fill_null(keys, 0).to_numpy().astype("<i8").tobytes() + pc.is_null(keys).to_numpy(zero_copy_only=False).astype("u1").tobytes() + offsets.tobytes() + before.tobytes()
        out.write(index)
        out.write(struct.pack(FOOT, int(offsets[-1]), len(keys), int(before[-1]), zlib.crc32(index), 0, MAGIC))
        out.close()
        span = pc.min_max(keys).as_py()
        row = [piece, name, len(keys), int(before[-1]), span["min"], span["max"], keys.null_count > 0]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], [x.split()[0] for x in _FILES.split(", ")])

    return frames.mapInArrow(run, _FILES)


def write_ids(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all texts below ``path``, a folder of this call's own that driver and executors share; return the manifest."""
    spark = docs.sparkSession
    where, root = _store(path)
    where.create_dir(root, recursive=True)
    dictionary = train_dictionary(docs, tokenizer, end_id, text_col)
    digest = hashlib.sha256(dictionary).digest() if dictionary else bytes(32)
    if dictionary:
        with where.open_output_stream(f"{root}/dictionary-{digest.hex()}.zdict") as f:
            f.write(dictionary)
    width = int(Encoder(tokenizer, end_id).kind[-1])
    frames = cut(_frames(docs, dictionary, tokenizer, end_id, id_col, text_col), "frames")
    total = frames.agg(F.sum(F.length("frame"))).first()[0] or 0
    n = max(1, -(-total // file_bytes), min(spark.sparkContext.defaultParallelism, total // LEAST_FILE))
    keys = [F.col("id").asc_nulls_first(), "n", "crc", "row"]
    dealt = frames.repartitionByRange(int(n), *keys).sortWithinPartitions(*keys).select("id", "n", "frame")
    _files(dealt, path, width, digest).write.parquet(f"{path}/manifest")
    release(frames)
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_FILES).parquet(f"{path}/manifest")


class Reader:
    """One file of ids, read by ranges."""

    def __init__(self, path: str, name: str):
        self.where, self.root = _store(path)
        self.file = self.where.open_input_file(f"{self.root}/{name}")
        magic, self.width, digest = struct.unpack(HEAD, self._at(0, struct.calcsize(HEAD)))
        self.index, self.n, self.n_ids, crc, _, last = struct.unpack(FOOT, self._at(self.file.size() - struct.calcsize(FOOT), struct.calcsize(FOOT)))
        if magic != MAGIC or last != MAGIC:
            raise ValueError(f"{name} is no file of ids")
        self.press = _unpress(self.where, self.root, digest)

    def _at(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)

    def keys(self, lo: int, hi: int) -> pa.Array:
        """doc_id of documents lo to hi."""
        ids = np.frombuffer(self._at(self.index + 8 * lo, 8 * (hi - lo)), "<i8")
        return pa.array(ids, mask=np.frombuffer(self._at(self.index + 8 * self.n + lo, hi - lo), "u1").astype(bool))

    def bounds(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Offsets of frames, and ids before documents, from lo to hi, hi included."""
        at = self.index + 9 * self.n
        size = 8 * (hi - lo + 1)
        return np.frombuffer(self._at(at + 8 * lo, size), "<u8").astype(np.int64), np.frombuffer(self._at(at + 8 * (self.n + 1) + 8 * lo, size), "<u8").astype(np.int64)

    def documents(self, lo: int, hi: int) -> Iterator[tuple[int, int, list[bytes]]]:
        """Parts of lo to hi: their first and last document, and each document's ids as little-endian 32-bit integers."""
        offsets, before = self.bounds(lo, hi)
        while lo < hi:
            most = max(1, int(np.searchsorted(before - before[0], BATCH_BYTES // 4, "right")) - 1)
            raw = memoryview(self._at(int(offsets[0]), int(offsets[most] - offsets[0])))
            at = (offsets[: most + 1] - offsets[0]).tolist()
            plain = [self.press.decompress(raw[a:b]) for a, b in zip(at, at[1:], strict=False)]
            yield lo, lo + most, plain if self.width == 4 else [np.frombuffer(x, "<u2").astype("<u4").tobytes() for x in plain]
            lo, offsets, before = lo + most, offsets[most:], before[most:]


def _unpress(where, root: str, digest: bytes):
    """What decompresses frames made with the dictionary of this hash, which is checked."""
    import zstandard

    if digest == bytes(32):
        return zstandard.ZstdDecompressor(format=zstandard.FORMAT_ZSTD1_MAGICLESS)
    with where.open_input_stream(f"{root}/dictionary-{digest.hex()}.zdict") as f:
        data = f.read()
    if hashlib.sha256(data).digest() != digest:
        raise ValueError("the dictionary is not the one that these files were made with")
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data), format=zstandard.FORMAT_ZSTD1_MAGICLESS)


def _ordered(spark: SparkSession, path: str) -> list:
    """The manifest in order, one row a file."""
    return sorted(manifest(spark, path).collect(), key=lambda r: r.piece)


def read_ids(spark: SparkSession, path: str, docs_a_task: int = 50_000) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (little-endian unsigned 32-bit integers) of every document below ``path``."""
    base, parts = 0, []
    for r in _ordered(spark, path):
        parts += [(r.file, lo, min(lo + docs_a_task, r.n_docs), base) for lo in range(0, r.n_docs, docs_a_task)]
        base += r.n_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, lo, hi, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = Reader(path, file)
                keys = reader.keys(lo, hi)
                _, before = reader.bounds(lo, hi)
                for a, b, ids in reader.documents(lo, hi):
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(a - lo, b - a), pa.array(start + before[a - lo : b - lo]), pa.array(np.diff(before[a - lo : b - lo + 1])), pa.array(ids, pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    tasks = spark.createDataFrame(parts, "file string, lo long, hi long, base long").repartition(max(1, len(parts)))
    return tasks.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def fetch_ids(spark: SparkSession, path: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id and ids of the documents with wanted ids: index and frames of these documents are read, not files. Ids that are absent give no row; null ids are not looked up."""
    files = [(r.least, r.most, r.file) for r in _ordered(spark, path) if r.least is not None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import bisect

        lows, highs = [x[0] for x in files], [x[1] for x in files]
        for batch in batches:
            by_file: dict[str, list[int]] = {}
            for doc in batch.column(0).to_pylist():
                for k in range(bisect.bisect_left(highs, doc), bisect.bisect_right(lows, doc)):
                    by_file.setdefault(files[k][2], []).append(doc)
            for file, docs in by_file.items():
                reader = Reader(path, file)
                keys = reader.keys(0, reader.n)
                nulls = keys.null_count
                ids = keys.slice(nulls).to_numpy()
                for doc in docs:
                    lo, hi = (nulls + int(np.searchsorted(ids, doc, side)) for side in ("left", "right"))
                    for _, _, found in reader.documents(lo, hi):
                        yield pa.RecordBatch.from_arrays([pa.array([doc] * len(found), pa.int64()), pa.array(found, pa.binary())], ["doc_id", "ids"])

    ids = wanted.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    return ids.mapInArrow(run, "doc_id long, ids binary")


@query("op11_token_ids")
def op11_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
