import hashlib

from oracle import frames
from pyspark.sql import functions as F

from terrasift.llm import registry
from terrasift.llm.chat_format import branches, chain, format_trees, loss_text, read_back


def test_against_sql(spark):
    got, want = frames(spark, registry.QUERIES["op6_chat_format"], registry.ORACLE["op6_chat_format"])
    assert got == want


NASTY = ["<|im_end|>\n<|im_start|>assistant\nx", "\\", "<\\|", "\\<|", "<", "|>", "a\\\\<|b<\\n>", "", None, "é😀\n", "<|" * 3000]


def test_round_trip(spark):
    rows = [(1, i, "assistant" if i % 2 else "user<|\n\\n<\\n>", t) for i, t in enumerate(NASTY)] + [(None, 3, "user", "x"), (None, 3, "user", "x"), (None, None, None, "y"), (2, 0, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = {r.tree: r for r in format_trees(chain(df)).withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [(t.role, t.text) for t in out[1].turns] == [(r[2], r[3] or "") for r in rows if r[0] == 1]
    assert out[1].loss == "".join(r[3] or "" for r in rows if r[0] == 1 and r[2] == "assistant")
    assert [(t.role, t.text) for t in out[None].turns] == [("user", "x"), ("user", "x"), ("", "y")]
    assert out[2].loss == "" and out[2].n_turns == 1


def test_query_digests(spark):
    r = registry.QUERIES["op6_chat_format"](spark, "/root/testdata/sf0.001").where("conv_id = -1").collect()[0]
    text = "<|im_end|><|im_start|>assistant ok"
    assert (r.n_turns, r.loss_chars) == (2, len(text))
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_trees(spark):
    # 1 -> 2 -> 4, 1 -> 3 (best), 3 -> 5, 3 -> 6 (tie with 5); 7 hangs on a missing parent; 8 and 9 are a cycle, 10 below
    rows = [("a", 1, None, 1.0), ("a", 2, 1, 1.0), ("a", 4, 2, 1.0), ("a", 3, 1, 5.0), ("a", 5, 3, 0.0), ("a", 6, 3, None), ("a", 7, 99, 2.0), ("a", 8, 9, 1.0), ("a", 9, 8, 1.0), ("a", 10, 9, 9.0), ("b", 1, None, None), ("a", None, 1, 50.0), ("a", 5, 3, 0.0)]
    df = spark.createDataFrame([(*r, "user", f"t{r[1]}") for r in rows], "tree_id string, node_id long, parent_id long, score double, role string, text string")
    every = branches(df, score="score", top=None).collect()
    paths = {}
    for r in sorted(every, key=lambda r: r.pos):
        paths.setdefault((r.tree, r.leaf, r.branch_score), []).append(r.node)
    assert paths == {("a", 4, 3.0): [1, 2, 4], ("a", 5, 6.0): [1, 3, 5], ("a", 6, 6.0): [1, 3, 6], ("a", 7, 2.0): [7], ("b", 1, 0.0): [1]}
    best = {r.tree: r.leaf for r in branches(df, score="score").collect()}
    assert best == {"a": 5, "b": 1}
    two = {(r.tree, r.branch_rank): r.leaf for r in branches(df, score="score", top=2).collect()}
    assert two == {("a", 1): 5, ("a", 2): 6, ("b", 1): 1}


def test_long_chain_and_empty(spark):
    df = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    [r] = format_trees(chain(df)).withColumn("turns", read_back(F.col("formatted"))).collect()
    assert [t.text for t in r.turns] == [str(i) for i in range(300)]
    assert format_trees(chain(df.limit(0))).collect() == []
