"""Operator 2, quality rules with robust multivariate outliers, in DataFrame functions only.

Base rules count words, symbols, repeated lines and repeated 8-word windows. Of the rest, each language and
source gets a minimum-covariance-determinant (MCD) estimate of five transformed statistics, and a document is
rejected if its squared Mahalanobis distance from that estimate is over ``cutoff``.

Statistics: log of the mean word length, and square roots of the shares of symbols, A-Z capitals, repeated lines
and repeated words. FLOORS holds each one's least standard deviation, added to the covariance, so that a group in which
a statistic hardly varies does not reject small departures. Symbols hardly occur in good texts, so that alone they reject from about 7 % of
the characters. Repeats do occur in labelled-good texts: smaller floors for them, or a chi-square limit of 0.999, reject those texts too.

MCD: of the ``share`` of each group's rows that lie together, the covariance with the least determinant. It is looked for from several starts: the
median with the spreads alone, with the correlations of squashed values, with those of directions only, the plain mean and covariance, and those of
RANDOM sets of about PICKED rows, picked by hash. All are moved by two concentration steps (mean and covariance of the rows nearest to the last
estimate); the BEST of a group go on until none's determinant gets smaller by more than ``tol`` of its logarithm; the smallest wins, and one
reweighting step takes the rows inside the chi-square limit. FLOORS are part of each covariance (a regularised MCD), so determinants compare and never vanish.
Each step is one aggregation of sums by group, start and distance bin (sixteenths of a doubling; the bin in which the share ends counts in part),
so it merges within tasks, no group is ever gathered, a hot group costs no more than others, and groups that have settled are not read on.

Small groups need no other rule: to every group's moments PRIOR rows with the moments of all groups' inner rows together are added, which
hardly move a group of thousands and decide for a group of a few. Null language or source is a group like any other.

Null text: no words, fails the base rules. Empty texts too. Each row has its own result, repeated or not; null ids
are kept. Only id, text, language and source are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrasift.llm.common import cut, table, words
from terrasift.llm.decl import query

WINDOW = 8
#: Rows' worth of all groups' moments that each group's estimate is held by.
PRIOR = 50.0
FLOORS = (0.08, 0.04, 0.08, 0.12, 0.12)
D = len(FLOORS)
#: Chi-square with five degrees of freedom: the limits of 0.75, 0.975 and 0.99999994.
CHI_75, CHI_975, CHI_FAR = 6.6257, 12.8325, 42.1
#: Consistency: the covariance of the inner 0.75 (0.975) of a normal sample is too small by these factors, the divisors being chi-square shares with seven degrees.
C_75, C_975 = 0.75 / 0.53114, 0.975 / 0.92370


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value worked out once and not at each of its uses."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def _only(text: Column, chars: str) -> Column:
    """How many of these characters a text has."""
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words that stand in a window found twice or more in the text, the first included; windows are compared by 64-bit hash."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))

    def starts(s: Column) -> Column:
        """Starts of windows whose hash has an equal neighbour, in order."""
        twice = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1).h == x.h)) | F.coalesce(F.get(s, j + 1).h == x.h, F.lit(False)))
        return F.array_sort(F.transform(twice, lambda x: x.i))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_let(pairs, lambda s: _let(starts(s), covered)))

    return F.when(F.size(w) <= window, F.lit(0)).otherwise(_let(hashes, count)).cast("long")


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts and the base verdict: id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and x, the statistics; kept columns as k0, k1, ..."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), *(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), text.alias("text"), words(text).alias("w"), F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"))
    counted = rows.select(
        "id", "lang", "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", "")).cast("long").alias("word_chars"),
        _only(F.col("text"), "#*$%&|<>").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        _only(F.col("text"), "A-Z").alias("capitals"),
        F.size("lines").alias("n_lines"),
        *(f"k{i}" for i in range(len(keep))),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    x = [F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))), share("n_symbols", "word_chars"), share("capitals", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    return counted.select("id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), *(v.alias(f"x{i}") for i, v in enumerate(x)), *(f"k{i}" for i in range(len(keep))))


X = [f"x{i}" for i in range(D)]
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]
GROUP = ["lang", "source"]
M, A = [f"m{i}" for i in range(D)], [f"a{i}{j}" for i, j in PAIRS]
SUMS = ["n", *(f"s{i}" for i in range(D)), *(f"q{i}{j}" for i, j in PAIRS)]
#: Starts by about PICKED rows each, and how many starts of all go on after two steps.
RANDOM, PICKED, BEST = 16, D + 1, 4


def _same_group(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on GROUP, where null is a value like any other; b's columns of it go."""
    b = b.withColumnsRenamed({c: f"b_{c}" for c in GROUP})
    return a.join(b, F.expr(" AND ".join(f"{c} <=> b_{c}" for c in GROUP)), how).drop(*(f"b_{c}" for c in GROUP))


def distances(rows: DataFrame) -> DataFrame:
    """d2, the squared Mahalanobis distance of x from m by the inverse covariance a; one flat sum, as nested steps would multiply in the plan."""
    return rows.withColumn("d2", F.expr(" + ".join(f"{1 if i == j else 2} * a{i}{j} * (x{i} - m{i}) * (x{j} - m{j})" for i, j in PAIRS)))


def _inverted(rows: DataFrame, cell: Callable[[int, int], str], *keep: str) -> DataFrame:
    """Kept columns, m, and of the covariance whose cells (i >= j) are SQL: the inverse a and logdet, by the sweep operator; logdet sums its pivots."""
    start = ", ".join(f"array({', '.join(f'CAST({cell(max(i, j), min(i, j))} AS DOUBLE)' for j in range(D))})" for i in range(D))
    swept = f"""
        aggregate(sequence(0, {D - 1}), named_struct('m', array({start}), 'logdet', 0D), (s, k) -> named_struct(
            'm', transform(s.m, (row, i) -> transform(row, (x, j) -> CASE
                WHEN i = k AND j = k THEN -1 / x
                WHEN i = k OR j = k THEN x / get(get(s.m, k), k)
                ELSE x - get(get(s.m, i), k) * get(get(s.m, k), j) / get(get(s.m, k), k) END)),
            'logdet', s.logdet + ln(get(get(s.m, k), k))))"""
    return rows.selectExpr(*keep, *M, f"{swept} AS swept").selectExpr(*keep, *M, *(f"-swept.m[{i}][{j}] AS a{i}{j}" for i, j in PAIRS), "swept.logdet AS logdet")


def _estimate(sums: DataFrame, factor: float, *keep: str) -> DataFrame:
    """Mean, inverse and logdet of each row's covariance, times factor, plus the floors."""

    def cell(i: int, j: int) -> str:
        c = f"{factor!r}D * (q{i}{j} / n - m{i} * m{j})"
        return f"greatest({c}, 0D) + {FLOORS[i] ** 2!r}D" if i == j else c

    return _inverted(sums.selectExpr("*", *(f"s{i} / n AS m{i}" for i in range(D))), cell, *keep)


def _sums(x: str = "x") -> list[Column]:
    return [F.expr(e) for e in ("count(*) AS n", *(f"sum({x}{i}) AS s{i}" for i in range(D)), *(f"sum({x}{i} * {x}{j}) AS q{i}{j}" for i, j in PAIRS))]


def _starts(rows: DataFrame) -> DataFrame:
    """One row for each group and start: where concentration begins."""
    mid = rows.groupBy(*GROUP).agg(F.expr("count(*) AS rows"), *(F.expr(f"percentile_approx({x}, array(0.25D, 0.5D, 0.75D), 1000) AS p{i}") for i, x in enumerate(X)))
    mid = cut(mid.selectExpr(*GROUP, "rows", *(f"p{i}[1] AS c{i}" for i in range(D)), *(f"sqrt(pow((p{i}[2] - p{i}[0]) / 1.349D, 2) + {FLOORS[i] ** 2!r}D) AS w{i}" for i in range(D))), "mcd")
    z = _same_group(rows, mid).selectExpr(*GROUP, "rows", *X, *(f"(x{i} - c{i}) / w{i} AS z{i}" for i in range(D)))
    z = z.withColumn("norm", F.expr(f"greatest(sqrt({' + '.join(f'z{i} * z{i}' for i in range(D))}), 1e-9D)"))
    struct = lambda start, v: f"named_struct('start', {start}, " + ", ".join(f"'v{i}', {v.format(i)}" for i in range(D)) + ")"
    always = [struct("'squashed'", "tanh(z{0})"), struct("'directions'", "z{0} / norm"), struct("'plain'", "x{0}")]
    picked = f"transform(filter(sequence(1, {RANDOM}), r -> pmod(xxhash64({', '.join(X)}, r), rows) < {PICKED}), r -> {struct("concat('random ', r)", 'x{0}')})"
    each = z.selectExpr(*GROUP, f"inline(concat(array({', '.join(always)}), {picked}))")
    sums = cut(_same_group(each.groupBy(*GROUP, "start").agg(*_sums("v")), mid), "mcd")

    def correlated(i: int, j: int) -> str:
        size = f"sqrt(q{i}{i} * q{j}{j})"
        return f"w{i} * w{i} + {FLOORS[i] ** 2!r}D" if i == j else f"coalesce(try_divide(q{i}{j}, {size}), 0D) * w{i} * w{j}"

    alone = mid.selectExpr(*GROUP, "'spreads' AS start", *(f"c{i} AS m{i}" for i in range(D)), *(f"{f'1 / (w{i} * w{i})' if i == j else '0D'} AS a{i}{j}" for i, j in PAIRS), f"2 * ({' + '.join(f'ln(w{i})' for i in range(D))}) AS logdet")
    about = F.col("start").isin("squashed", "directions")  # the median
    centred = sums.where(about).withColumnsRenamed({f"c{i}": f"m{i}" for i in range(D)})
    plain = _estimate(sums.where(~about), 1.0, *GROUP, "start")
    return cut(alone.unionByName(_inverted(centred, correlated, *GROUP, "start")).unionByName(plain), "mcd")


def _concentrated(rows: DataFrame, est: DataFrame, share: float) -> DataFrame:
    """One concentration step of each group and start: the estimate by the ``share`` of the group's rows nearest to the last one."""
    binned = distances(_same_group(rows, est)).withColumn("bin", F.expr("floor(16 * log2(greatest(d2, 1e-6D)))"))
    bins = binned.groupBy(*GROUP, "start", "bin").agg(*_sums())
    within = W.partitionBy(*GROUP, "start")
    bins = bins.withColumn("before", F.sum("n").over(within.orderBy("bin")) - F.col("n")).withColumn("all", F.sum("n").over(within))
    kept = bins.withColumn("part", F.expr(f"least(1D, (ceil({share!r}D * all) - before) / n)")).where("part > 0")
    return _estimate(kept.groupBy(*GROUP, "start").agg(*(F.expr(f"sum({c} * part) AS {c}") for c in SUMS)), C_75, *GROUP, "start")


def least_determinant(rows: DataFrame, share: float = 0.75, tol: float = 1e-3) -> DataFrame:
    """One row a group: m, a and logdet of its MCD, before reweighting, and the start that led there. rows: GROUP and X."""
    est = _starts(rows)
    for _ in range(2):
        est = cut(_concentrated(rows, est, share), "mcd")
    place = F.row_number().over(W.partitionBy(*GROUP).orderBy("logdet", "start"))  # over one row a start
    moving, settled = cut(est.withColumn("place", place).where(F.col("place") <= BEST).drop("place"), "mcd"), []
    result = F.struct(*M, *A, "logdet").alias("r")
    while True:
        old = moving.select(*GROUP, "start", result).withColumnsRenamed({"r": "r0", "start": "start0"})
        new = cut(_same_group(_concentrated(rows, moving, share).select(*GROUP, "start", result), old).where("start = start0").drop("start0"), "mcd")
        smaller = F.expr(f"r.logdet < r0.logdet - {tol!r}D")
        # A step that makes the determinant no smaller is not taken.
        settled.append(new.where(~smaller).select(*GROUP, "start", F.expr("IF(r.logdet < r0.logdet, r, r0) AS r")))
        moving = new.where(smaller).select(*GROUP, "start", "r.*")
        if not moving.limit(1).count():
            break
    least = reduce(DataFrame.unionByName, settled).groupBy(*GROUP).agg(F.expr("min_by(struct(start, r), struct(r.logdet, start)) AS s"))
    return least.select(*GROUP, "s.start", "s.r.*")


def fit_mcd(rows: DataFrame, share: float = 0.75, prior: float = PRIOR) -> DataFrame:
    """One row a group: mean and inverse covariance, reweighted and held by ``prior`` rows of all groups' moments. rows: GROUP and X."""
    inner = distances(_same_group(rows, least_determinant(rows, share))).where(F.col("d2") <= CHI_975)
    sums = cut(inner.groupBy(*GROUP).agg(*_sums()), "mcd")
    every = sums.agg(*(F.expr(f"sum({c}) AS {c}") for c in SUMS)).first()  # one row of moments
    held = sums.select(*GROUP, *((F.col(c) + prior * (every[c] or 0.0) / (every["n"] or 1)).alias(c) for c in SUMS))
    return cut(_estimate(held, C_975, *GROUP), "mcd")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CHI_FAR, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row's base counts, base_failed, distance (null if base_failed) and kept; with the columns ``keep`` of docs.

    Every text is counted once, into a table that also carries the kept columns; the passes that fit read its few narrow columns. The table also
    ends the counts' plan: a filter on the verdict that were pushed below them would work them out again for each word.
    """
    base = cut(base_rules(docs, id_col, text_col, lang_col, source_col, keep), "quality")
    est = fit_mcd(base.where(~F.col("base_failed")).select(*GROUP, *X))
    judged = distances(_same_group(base, est, "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    kept = ~F.col("base_failed") & (distance <= cutoff)
    return judged.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), distance.alias("distance"), *(F.col(f"k{i}").alias(c) for i, c in enumerate(keep)))


@query("op2_quality_rules")
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
