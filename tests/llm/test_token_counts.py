import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import Row
from tokenizers import Tokenizer

from terrasift.llm.token_counts import count_tokens

TEXTS = [
    None,
    "",
    " ",
    "\n\t\x0b",
    "Hello   world",
    "it's 12 o'clock now <|endoftext|>x<|startoftext|> <| endoftext|>",
    "é ́a ΑΣ Σ b \x1c\x1d x\x85y",
    "a" * 5000,
    "ünïcode " * 3000,
    "  two  spaces\n\n lines \n x",
    "Éou <s> </s> ▁ x ▁▁y",
    "dup dup",
    "dup dup",
]


def want(name, text):
    if name.endswith(".model"):
        return len(sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name)).encode(text or ""))
    return len(Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_matches_library(spark, name):
    docs = spark.createDataFrame([Row(doc_id=i, text=t, n_tokens="clash", id=1) for i, t in enumerate(TEXTS)] + [Row(doc_id=None, text="x", n_tokens=None, id=2)])
    got = {r.doc_id: r for r in count_tokens(docs, name, batch_bytes=1000, limit=100).collect()}
    assert len(got) == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        n = want(name, t)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 100), (i, t[:30] if t else t)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []
