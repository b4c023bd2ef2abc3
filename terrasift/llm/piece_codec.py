"""Operator 5, SentencePiece encoding and decoding by a streaming Viterbi recurrence.

Text is fed piece by piece. At each place the recurrence keeps the backpointer of the best segmentation that ends there; a
place can be reached from at most ``longest`` characters back, so only that many are alive. When all alive backpointer
paths meet in one boundary, everything before it is final: its ids are given out and forgotten. Memory is bounded by
the window, not by the text.

* Unigram models: the backpointer maximises the sum of scores, as usual.
* BPE models, as the one at hand: a sum of scores would not give the library's ids, so the recurrence is over validity: a
  token may follow another if the model's merges of the two together leave them as they are. A text's encoding
  is the only segmentation whose neighbours are all valid, so each place has one backpointer, and ids are the library's.

Between two characters that no piece has next to each other all paths meet, whatever stands around them. Where no piece has a space after another character (checked when
the model is read) that is so before each run of spaces, and around a newline if no longer piece has one; within such a stretch it is often so before punctuation. The
stretches recur, so a worker keeps a bounded table of their ids: at a committed boundary an encoder looks the next stretch up, and goes on behind it if it is known. One that is not is looked
up by its parts; a part that is not known, or a stretch without an end in sight, goes through the window.

Spaces become U+2581 and one is put in front; characters without a piece become their UTF-8 bytes' pieces, or the unknown id.
Decoding streams too: pieces are joined, the first space is dropped, and bytes that are no UTF-8 become U+FFFD. A text that has U+2581
itself comes back with a space for it. An id that the model does not have, or that is null, is decoded as the unknown one. Models that normalise text or leave out the space in front are refused.

Null and empty texts have no ids. Rows stay as they come, repeated or with null ids. Columns other than id and text (or
ids) are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import table
from terrasift.llm.decl import query
from terrasift.llm.token_counts import slices

#: Entries of each of two generations of a worker's table of stretches, and of its table of pairs; longest stretch kept; characters after which a meeting point is sought.
MEMO, PAIRS, MEMO_CHARS, SEEK = 700_000, 1_000_000, 24, 256
SPACE = "▁"


class Model:
    """Pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n, t = m.normalizer_spec, m.trainer_spec
        if n.precompiled_charsmap or n.remove_extra_whitespaces or not n.add_dummy_prefix or t.treat_whitespace_as_suffix or t.model_type not in (1, 2):
            raise ValueError("this model normalises text or is neither BPE nor unigram")
        self.bpe = t.model_type == 2
        self.pieces = {p.piece: (i, p.score) for i, p in enumerate(m.pieces) if p.type in (1, 4)}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == 6}
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == 2)
        self.longest = max(map(len, self.pieces))
        self.lowest = min(s for _, s in self.pieces.values()) - 10
        self.lines = not any("\n" in p and len(p) > 1 for p in self.pieces)
        self.units = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.pieces)
        line = "\n" if self.lines else ""
        #: Stretches between places where all paths meet; None if a model has no such places that the text alone tells.
        self.stretch = re.compile(f"[ {SPACE}]*[^ {SPACE}{line}]+|[ {SPACE}]+" + "|\n" * self.lines) if self.units else None
        self.beside = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.texts = [bytes([int(p.piece[3:5], 16)]) if p.type == 6 else b"" if p.type == 3 else p.piece.replace(SPACE, " ").encode() for p in m.pieces]
        self.texts[self.unknown] = " ⁇ ".encode()
        self.scores = {p: score for p, (_, score) in self.pieces.items()}
        self.pairs, self.n_pairs = {}, 0  # whether the second token may follow the first
        #: Beginnings of pieces, with whether they can be tokens: not all pieces of a BPE vocabulary are results of its merges.
        self.prefixes = {p[:i]: False for p in self.pieces for i in range(1, len(p))}
        self.prefixes |= {p: not self.bpe or self.merged(p) == [p] for p in self.pieces}

    def parts(self, stretch: str) -> list[str]:
        """A stretch's parts between characters that no piece has next to each other."""
        text, beside = stretch.replace(" ", SPACE), self.beside
        cuts = [i for i, pair in enumerate(map(add, text, text[1:]), 1) if pair not in beside]
        return [stretch[a:b] for a, b in zip([0, *cuts], [*cuts, len(stretch)], strict=True)] if cuts else [stretch]

    def ids(self, token: str) -> Iterable[int]:
        found = self.pieces.get(token)
        if found:
            return (found[0],)
        return tuple(self.bytes[b] for b in token.encode()) if self.bytes else (self.unknown,)

    def merged(self, text: str) -> list[str]:
        """BPE of a short text by its definition: the neighbours whose joint piece scores best are merged, the first of equals."""
        s, score = list(text), self.scores.get
        while True:
            top = None
            for i, pair in enumerate(map(add, s, s[1:])):
                got = score(pair)
                if got is not None and (top is None or got > top):
                    top, at = got, i
            if top is None:
                return s
            s[at : at + 2] = [s[at] + s[at + 1]]

    def followers(self, a: str) -> dict[str, bool]:
        """What is known of the tokens that may follow a."""
        if self.n_pairs > PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        return self.pairs.setdefault(a, {})

    def valid(self, a: str, b: str) -> bool:
        got = self.merged(a + b) == [a, b]
        self.n_pairs += 1
        self.followers(a)[b] = got
        return got


class Memo:
    """Stretches' ids as bytes of 32-bit integers. When the younger generation is full the older one goes; what is still asked for stays. ``near`` has the latest few, which a processor's cache holds."""

    def __init__(self, most: int = MEMO, near: int = 8_192):
        self.most, self.most_near, self.young, self.old, self.near = most, near, {}, {}, {}

    def __len__(self) -> int:
        return len(self.young) + len(self.old)

    def put(self, stretch: str, ids: bytes) -> bytes:
        if len(stretch) <= MEMO_CHARS:
            if len(self.young) >= self.most:
                self.young, self.old = {}, self.young
            self.young[stretch] = ids
        return ids

    def again(self, stretch: str) -> bytes | None:
        """The ids of one that is not near."""
        found = self.young.get(stretch)
        if found is None:
            found = self.old.get(stretch)
            if found is None:
                return None
            self.put(stretch, found)
        if len(self.near) >= self.most_near:
            self.near.clear()
        self.near[stretch] = found
        return found


class Encoder:
    """One text: feed() it in parts of any size, each gives the ids that became final; finish() gives the rest. The text begins with the space that the model puts in front.

    text is the window: what lies behind the last committed boundary and has been looked at. token[i] is the last token of the best segmentation of what lies before place i of it, None if there is
    none (yet). tail is a stretch whose end has not been seen. commits counts boundaries, widest the window's characters.
    """

    def __init__(self, model: Model, memo: Memo | None = None):
        self.m, self.memo, self.tail = model, Memo() if memo is None else memo, ""
        self.commits = self.widest = 0
        self._open()

    def _open(self) -> None:
        """An empty window at a committed boundary."""
        self.text, self.token, self.best, self.place = "", [""], [0.0], 0

    def feed(self, part: str) -> list[int]:
        return np.frombuffer(b"".join(self.feed_bytes(part)), np.int32).tolist()

    def finish(self) -> list[int]:
        return np.frombuffer(b"".join(self.finish_bytes()), np.int32).tolist()

    def feed_bytes(self, part: str) -> list[bytes]:
        """As feed, ids as bytes of 32-bit integers."""
        text = self.tail + part
        *done, self.tail = (self.m.stretch.findall(text) if self.m.stretch else [text]) or [""]
        known, find = self.memo.near.get, self._find
        if done and self.text:  # the stretch in the window ends here
            out = [self._end(done[0]), *(known(u) or find(u) for u in done[1:])]
        else:
            out = [known(u) or find(u) for u in done]
        self.commits += len(done)
        while len(self.tail) > SEEK:  # no end in sight
            out.append(self._push(self.tail[:SEEK]))
            self.tail = self.tail[SEEK:]
        return out

    def finish_bytes(self) -> list[bytes]:
        last, self.tail = self.tail, ""
        if not last and not self.text:
            return []
        self.commits += 1
        return [self._end(last) if self.text else self._find(last)]

    def _find(self, stretch: str) -> bytes:
        """A whole stretch: as it is known, or by its parts."""
        known = self.memo.again(stretch)
        if known:
            return known
        parts = self.m.parts(stretch) if self.m.stretch else [stretch]
        if len(parts) == 1:
            return self._end(stretch)
        self.commits += len(parts) - 1
        return self.memo.put(stretch, b"".join([self.memo.again(p) or self._end(p) for p in parts]))

    def _push(self, part: str) -> bytes:
        """Put part into the window, and give out what lies before the boundary where the paths meet."""
        self.text += part.replace(" ", SPACE)
        self.widest = max(self.widest, len(self.text))
        self._extend(len(self.text) - self.m.longest + 1)
        ids = self._commit() if self.place > 0 else []
        self.commits += bool(ids)
        return array("i", ids).tobytes()

    def _end(self, part: str) -> bytes:
        """Put a stretch, or the rest of the one in the window, into the window: all paths meet at its end."""
        whole = not self.text
        out = b""
        for i in range(0, len(part) - SEEK, SEEK):
            out += self._push(part[i : i + SEEK])
        rest = part[max(0, -(-(len(part) - SEEK) // SEEK)) * SEEK :]
        self.text += rest.replace(" ", SPACE)
        self.widest = max(self.widest, len(self.text))
        self._extend(len(self.text))
        out += array("i", self._commit()).tobytes()
        self._open()
        return self.memo.put(part, out) if whole else out

    def _extend(self, stop: int) -> None:
        """Go on from all places before stop: the tokens that begin at them have been seen whole."""
        m, text, token, best = self.m, self.text, self.token, self.best
        known, n, bpe, longest = m.prefixes.get, len(self.text), m.bpe, m.longest
        token += [None] * (n + 1 - len(token))
        if not bpe:
            best += [None] * (n + 1 - len(best))
        for a in range(self.place, stop):
            prior = token[a]
            if prior is None:
                continue
            follows = m.followers(prior).get if bpe and prior else None
            one = a + 1
            for end in range(one, min(n, a + longest) + 1):
                t = text[a:end]
                piece = known(t)
                if piece or end == one:  # a character is a token of last resort
                    if not bpe:
                        score = best[a] + (m.pieces[t][1] if piece else m.lowest)
                        if best[end] is None or score > best[end]:
                            token[end], best[end] = t, score
                    elif token[end] is None:  # only one token can end here
                        ok = True if follows is None else follows(t)
                        if ok or (ok is None and m.valid(prior, t)):
                            token[end] = t
                if piece is None:
                    break
        self.place = max(self.place, stop)

    def _commit(self) -> list[int]:
        """Give out what lies before the boundary where all alive paths meet, if there is one."""
        alive = {i for i in range(self.place, len(self.text) + 1) if self.token[i] is not None}
        while len(alive) > 1:
            top = max(alive)
            alive.remove(top)
            alive.add(top - len(self.token[top]))
        [meet] = alive
        out = self._ids(meet)
        if out:
            self.text, self.token, self.place = self.text[meet:], self.token[meet:], self.place - meet
            self.best = self.best if self.m.bpe else [x if x is None else x - self.best[meet] for x in self.best[meet:]]
        return out

    def _ids(self, end: int) -> list[int]:
        tokens = []
        while end > 0:
            tokens.append(self.token[end])
            end -= len(self.token[end])
        return [i for t in reversed(tokens) for i in self.m.ids(t)]


@lru_cache(maxsize=2)
def load(path: str) -> Model:
    if "/" not in path:
        import public_tokenizers

        path = public_tokenizers.path(path)
    return Model(path)


class Codec:
    """A model with a bounded table of its stretches' ids, as bytes of 32-bit integers."""

    def __init__(self, path: str):
        self.model, self.memo = load(path), Memo()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        e = Encoder(self.model, self.memo)
        return np.frombuffer(b"".join([*e.feed_bytes(" " + text), *e.finish_bytes()]), np.int32)

    def _text(self, ids: Iterable[int]) -> str:
        out = b"".join(map(self.model.texts.__getitem__, ids))
        return out[out[:1] == b" " :].decode(errors="replace")

    def decode(self, ids: Iterable[int] | None) -> str:
        n, unknown = len(self.model.texts), self.model.unknown
        return self._text([i if i is not None and 0 <= i < n else unknown for i in (ids if ids is not None else ())])


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    """A worker's codec: its table of stretches serves all tasks of the worker."""
    return Codec(path)


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array<int>), n_ids, n_chars and round_trip, whether decoding the ids gives the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for whole in batches:
            for batch in slices(whole, 1, 2 << 20):
                texts = batch.column(1).to_pylist()
                found = [codec.encode(t) for t in texts]
                same = [codec._text(x.tolist()) == (t or "") for x, t in zip(found, texts, strict=True)]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int32)))
                counts = pa.array(np.diff(ends).astype(np.int64))
                chars = pc.cast(pc.fill_null(pc.utf8_length(batch.column(1)), 0), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), ids, counts, chars, pa.array(same)], ["id", "ids", "n_ids", "n_chars", "round_trip"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, n_ids long, n_chars long, round_trip boolean").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model", id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and text. Null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([codec.decode(x) for x in batch.column(1).to_pylist()], pa.string())], ["id", "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


@query("op5_piece_codec")
def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "n_ids", F.xxhash64("ids").alias("ids_hash"), F.get("ids", F.lit(0)).alias("first_id"), F.get("ids", (F.col("n_ids") - 1).cast("int")).alias("last_id"), "round_trip")
