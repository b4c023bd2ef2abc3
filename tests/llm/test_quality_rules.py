import re

import numpy as np
from pyspark.sql import functions as F

from terrasift.llm import registry
from terrasift.llm.quality_rules import C_75, C_975, CHI_975, D, FLOORS, X, _same_group, base_rules, distances, fit_mcd, least_determinant, quality_rules

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    hit = {i + k for s in at.values() if len(s) > 1 for i in s for k in range(8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


TEXTS = [None, "", " \n\t ", "a b c d e f g h", "a b c d e f g h " * 3, "x " * 5000, "a\x0bb\x0cc\x1cd\r\ne \n \n# $|é😀\ne \nf\nf", " ".join(map(str, range(100))) + " " + " ".join(map(str, range(50, 70))), "\n\n", "a  b\n a  b\na  b", "word " * 19, " ".join(f"w{i % 300}" for i in range(20000))]


def test_base(spark):
    docs = spark.createDataFrame([(i, t, None, None, "clash") for i, t in enumerate(TEXTS)] + [(None, "x", "en", None, ""), (None, "x", "en", None, "")], "doc_id long, text string, lang string, source string, n_words string")
    rows = base_rules(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        n, chars, symbols, dup, rep = brute(TEXTS[r.id] if r.id is not None else "x")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), r
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)


def test_query_base_columns(spark):
    got = {r.doc_id: r for r in registry.QUERIES["op2_quality_rules"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(d.text)
        assert not (r.base_failed and r.kept)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [got[i] for i, q in quality.items() if q == 1 and not got[i].base_failed]
    bad = [got[i] for i, q in quality.items() if q == 0]
    assert np.mean([r.kept for r in good]) > 0.99
    assert np.mean([not r.kept for r in bad]) > 0.5


def mahalanobis(x, m, cov):
    return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(cov), x - m)


def brute_mcd(x, rng, tries=150):
    """Least log-determinant over many random starts with exact subsets, and the distances after reweighting."""
    floor, h, best = np.diag(np.square(FLOORS)), int(np.ceil(0.75 * len(x))), (np.inf, None)
    for _ in range(tries):
        near = x[rng.choice(len(x), D + 1, replace=False)]
        last = np.inf
        while True:
            m, cov = near.mean(0), C_75 * np.cov(near.T, bias=True) + floor
            now = np.linalg.slogdet(cov)[1] if len(near) == h else np.inf
            if now >= last - 1e-9 and len(near) == h:
                break
            last, near = now, x[np.argsort(mahalanobis(x, m, cov), kind="stable")[:h]]
        best = min(best, (last, near), key=lambda b: b[0])
    m, cov = best[1].mean(0), C_75 * np.cov(best[1].T, bias=True) + floor
    inner = x[mahalanobis(x, m, cov) <= CHI_975]
    return best[0], mahalanobis(x, inner.mean(0), C_975 * np.cov(inner.T, bias=True) + floor)


def frame(spark, groups):
    rows = [(g, "s", i, *map(float, v)) for g, x in groups.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "lang string, source string, i int, " + ", ".join(f"{c} double" for c in X))


def test_mcd_against_random_starts(spark):
    """Contaminated groups, correlated ones, and one whose medians and spreads mislead: the least determinant and the distances of an independent search."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(D, D)))[0]
    clean = lambda n: rng.normal(size=(n, D)) * [0.1, 0.2, 0.3, 0.15, 0.4]
    groups = {None: clean(300), "far": clean(300), "correlated": (clean(300) * [1, 1, 8, 1, 8]) @ turn, "split": clean(300)}
    groups["far"][:60] += 4
    groups["correlated"][:70] = groups["correlated"][:70] * 0.2 + 3 * turn[:, 0]
    groups["split"][:72, 0] += rng.choice([-3, 3], 72)
    df = frame(spark, groups)
    dets = {r.lang: r.logdet for r in least_determinant(df).collect()}
    got = {(r.lang, r.i): r.d2 for r in distances(_same_group(df, fit_mcd(df, prior=0.0))).select("lang", "i", "d2").collect()}
    for g, x in groups.items():
        det, want = brute_mcd(x, rng)
        mine = np.array([got[g, i] for i in range(len(x))])
        assert dets[g] < det + 0.05, (g, dets[g], det)
        assert np.corrcoef(np.log(mine), np.log(want))[0, 1] > 0.99
        assert ((mine > 42) == (want > 42)).mean() > 0.99
    for g, n in (("far", 60), ("correlated", 70), ("split", 72)):
        assert min(got[g, i] for i in range(n)) > 42


def test_small_groups(spark):
    """One rule for all sizes: groups of a few rows, of one and of like rows are judged by what they and the others are."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, D)) * [0.1, 0.2, 0.3, 0.15, 0.4]
    df = frame(spark, {"many": x, "few": x[:6], "one": x[:1], "same": np.repeat(x[:1], 40, 0), "odd": x[:1] + 9})
    got = {(r.lang, r.i): r.d2 for r in distances(_same_group(df, fit_mcd(df))).select("lang", "i", "d2").collect()}
    assert len(got) == 548 and got["odd", 0] > 42
    assert max(v for k, v in got.items() if k[0] != "odd") < 42


def test_groups_without_names_and_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30).withColumn("lang", F.lit(None).cast("string"))
    rows = quality_rules(docs).collect()
    assert len(rows) == 30 and all((r.distance is None) == r.base_failed for r in rows)
    assert quality_rules(docs.limit(0)).collect() == []
    assert quality_rules(docs.withColumn("text", F.lit(None).cast("string"))).where("kept OR NOT base_failed OR distance IS NOT NULL").count() == 0


def test_texts_are_counted_once(spark):
    """A filter on the verdict must not be pushed below the counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = quality_rules(docs, keep=("text", "source")).where("kept").select("doc_id", "text", "source")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "xxhash64" not in plan
    want = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    assert all(want[r.doc_id] == (r.text, r.source) for r in out.collect())
