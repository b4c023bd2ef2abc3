"""Operator 1, token counts: texts go through Arrow in batches, only lengths come back.

A text is cut into units at boundaries that no token can cross, so its count is the sum of its units'
counts. Units recur, so each worker keeps a bounded table of them and encodes the unknown ones of a batch
together. Long texts are cut by the same boundaries; a text without any is encoded as a whole.

* ``word`` tokenizers drop white space and never join text across it: boundaries are runs of ASCII white space.
* all others: a boundary lies before a single space between two characters that are not white space.
  (In byte-level BPE the space opens the next token; a SentencePiece model has no piece with a space
  after another character, and its marks are put back by the dummy prefix.)

Null and empty texts have 0 bytes and 0 tokens. Rows repeat as they come in; a null id stays null. Other
columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import table
from terrasift.llm.decl import query

#: Bytes of text that are in Python's hands at once, entries of a worker's table of units, longest unit kept there.
BATCH_BYTES, MEMO, MEMO_BYTES = 4 << 20, 400_000, 48

_SPACE = re.compile(r"(?<=\S)(?= \S)")


def _counter(path: str) -> tuple[Callable[[bytes], list], Callable[[list], list[int]]]:
    """How a tokenizer file cuts a UTF-8 text into units, and how it counts units' tokens."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def cut(text: bytes) -> list[str]:
            first, *rest = _SPACE.split(text.decode())
            return [first, *(x[1:] for x in rest)]  # the dummy prefix stands for the space

        return cut, lambda units: [len(x) for x in sp.encode(units, num_threads=1)]
    from tokenizers import Tokenizer

    with open(path) as f:
        spec = json.load(f)
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def count(units: list) -> list[int]:
        return [len(x.ids) for x in tokenizer.encode_batch_fast([u if isinstance(u, str) else u.decode() for u in units], add_special_tokens=False)]

    return (bytes.split if _drops_space(spec) else lambda text: _SPACE.split(text.decode())), count  # bytes.split knows ASCII white space only


def _drops_space(spec: dict) -> bool:
    """Whether the pre-tokenizer keeps only what a pattern without white space matches."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return bool(steps) and steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and bool(steps[0].get("invert")) and not any(x["lstrip"] or x["rstrip"] or re.search(r"\s", x["content"]) for x in spec.get("added_tokens", []))


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def count_tokens(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Each row's id, UTF-8 bytes, tokens and whether they are over ``limit``. tokenizer: a path, or a name that public_tokenizers knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer
        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(path)
        cut, count = _counter(path)
        memo: dict = {"": 0}
        for whole in batches:
            for batch in slices(whole, 1, batch_bytes):
                texts = [cut(x) if x else [] for x in pc.cast(batch.column(1), pa.binary()).to_pylist()]
                new = list({u for units in texts for u in units}.difference(memo))
                if len(memo) + len(new) > MEMO:
                    memo = {"": 0}
                    new = list({u for units in texts for u in units}.difference(memo))
                local = memo
                if new:
                    found = dict(zip(new, count(new), strict=True))
                    local = memo | found if len(found) > MEMO // 2 else memo
                    if local is memo:
                        memo.update(found)
                get = local.__getitem__
                tokens = pa.array([sum(map(get, units)) for units in texts], pa.int64())
                n_bytes = pc.cast(pc.fill_null(pc.binary_length(batch.column(1)), 0), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, tokens, pc.greater(tokens, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])
                for u in [u for u in new if len(u) > MEMO_BYTES]:
                    memo.pop(u, None)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
