"""Robust multivariate outliers among text statistics, by minimum covariance determinant estimates.

Rousseeuw and Van Driessen's concentration steps (1999) from six deterministic starts (after Hubert, Rousseeuw,
Verdonck 2012), one estimate per language and source: of the rows at hand, those with the least Mahalanobis
distances give the next mean and covariance, whose determinant never grows. After a few steps the starts of least
determinant go on until it no longer falls, the least one wins, and the rows near it give the reweighted estimate.
All of it is DataFrame code over one narrow table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leakscope.llm.common import WORD_CHAR, stored, words

SYMBOLS = "[#*$%&|<>]+"
# One line said twice in a short text is a large share of it and says little: shares of repeated lines and words
# count this many more that are not repeated.
PRIOR_LINES, PRIOR_WORDS = 8, 100
FEATURES = ("log_words", "word_length", "symbol_root", "dup_line_root", "repeat_root")


@dataclass(frozen=True)
class McdParams:
    """``share`` of a group that the estimate rests on; all starts take ``trial_steps``, the best ``finalists`` of each
    group go on until no log determinant falls by ``tolerance`` (``most_steps`` at most); groups below ``least_rows``
    are pooled by language, then overall; ``floors`` are standard deviations added to those of each feature, so that
    one that is constant in a group still has a scale: with 0.1, a third of the lines or words of a long text is beyond
    ``cut`` on its own. The rows within ``near`` (97.5 % of five degrees of freedom) give the reweighted estimate; rows
    whose squared distance from it is beyond ``cut`` (once in 100,000) are rejected. Distances are scaled down where
    their median is above that of five degrees of freedom, never up."""

    share: float = 0.75
    trial_steps: int = 2
    finalists: int = 2
    most_steps: int = 20
    tolerance: float = 1e-2
    least_rows: int = 100
    floors: tuple[float, ...] = (1.0, 0.5, 0.05, 0.1, 0.1)
    near: float = 12.83
    cut: float = 30.86


# Median of the chi-squared distribution with five degrees of freedom.
CHI2_MEDIAN = 4.351
BINS_PER_E = 20
K = len(FEATURES)
PAIRS = tuple((i, j) for i in range(K) for j in range(i + 1))
ESTIMATE = ("grp", "start", "logdet", *[f"m_{i}" for i in range(K)], *[f"l_{i}{j}" for i, j in PAIRS])
# Ranks are read off this many quantiles of a feature.
RANKS = 40


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(w: Column, size: int = 3) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the array, first ones included.

    Windows are compared by a 64-bit hash of their words.
    """
    hashes = F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(1), F.size(w) - (size - 1)),
        lambda i: F.xxhash64(*[F.element_at(w, i + k) for k in range(size)]))).otherwise(F.array().cast("array<bigint>"))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def places(s: Column) -> Column:
            same = lambda x, other: F.coalesce(x["h"] == F.get(s, other)["h"], F.lit(False))
            return F.transform(F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["at"])

        def shifted(p: Column, k: int) -> Column:
            return F.transform(p, lambda x: x + k)

        def spread(p: Column) -> Column:
            return F.size(F.array_distinct(F.concat(*[shifted(p, k) for k in range(size)])))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(let(ranked, places), spread))

    return let(hashes, covered)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
               source_col: str = "source") -> DataFrame:
    """Counts and transformed statistics of every row; a null text has no words.

    ``base_failed``: under 50 words, or more than half of the words in repeated three-word windows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    counts = F.struct(
        let(words(text), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        F.char_length(text).alias("chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
                       F.coalesce(F.col(source_col), F.lit("")).alias("source"), counts.alias("c"))
    n, r = F.col("c.w.n_words"), F.col("c.w.n_repeat_words")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return rows.select(
        "doc_id", "lang", "source", n.alias("n_words"), F.col("c.w.word_chars").alias("word_chars"), "c.n_symbols",
        F.col("c.l.dup").alias("n_dup_lines"), r.alias("n_repeat_words"),
        ((n < 50) | (100 * r > 50 * n)).alias("base_failed"),
        F.log1p(n).alias("log_words"), share(F.col("c.w.word_chars"), n).alias("word_length"),
        F.sqrt(share(F.col("c.n_symbols"), F.col("c.chars"))).alias("symbol_root"),
        F.sqrt(F.col("c.l.dup") / (F.col("c.l.n") + PRIOR_LINES)).alias("dup_line_root"),
        F.sqrt(r / (n + PRIOR_WORDS)).alias("repeat_root"))


def _grouped(rows: DataFrame, least: int) -> DataFrame:
    """Rows with the group their estimate is made in: language and source, the small sources of a language
    together, or the rest of all."""
    n = rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n"))
    small = F.sum(F.when(F.col("n") < least, F.col("n")).otherwise(0)).over(Window.partitionBy("lang"))
    named = stored(n.withColumn("small", small).select(
        "lang", "source", F.when(F.col("n") >= least, F.concat_ws("\0", "lang", "source"))
        .when(F.col("small") >= least, F.col("lang")).otherwise("\0").alias("grp")), "quality_groups")
    return rows.join(_sized(named), ["lang", "source"])


def _sized(table: DataFrame, most: int = 20_000) -> DataFrame:
    """A table of one short row per group: broadcast while it has at most ``most`` rows (some 6 MB)."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def _distance() -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor in columns l_ij."""
    solved: list[Column] = []
    for i in range(K):
        y = F.col(FEATURES[i]) - F.col(f"m_{i}")
        for j, done in enumerate(solved):
            y = y - F.col(f"l_{i}{j}") * done
        solved.append(y / F.col(f"l_{i}{i}"))
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


def _factored(table: DataFrame, mean, cov) -> DataFrame:
    """Estimates from expressions for the means and covariances: means, Cholesky factor, log determinant."""
    out = table.select("*", *[mean(i).alias(f"m_{i}") for i in range(K)])
    for j in range(K):
        inner = cov(j, j)
        for p in range(j):
            inner = inner - F.col(f"l_{j}{p}") * F.col(f"l_{j}{p}")
        out = out.withColumn(f"l_{j}{j}", F.sqrt(F.greatest(inner, F.lit(1e-9))))
        for i in range(j + 1, K):
            inner = cov(i, j)
            for p in range(j):
                inner = inner - F.col(f"l_{i}{p}") * F.col(f"l_{j}{p}")
            out = out.withColumn(f"l_{i}{j}", inner / F.col(f"l_{j}{j}"))
    logs = [2 * F.log(f"l_{i}{i}") for i in range(K)]
    return out.withColumn("logdet", sum(logs[1:], logs[0])).select(*ESTIMATE)


def _sums(values) -> list[Column]:
    """Count, sums and sums of products of the features, given by number."""
    return [F.count("*").cast("double").alias("n"), *[F.sum(values(i)).alias(f"s_{i}") for i in range(K)],
            *[F.sum(values(i) * values(j)).alias(f"q_{i}{j}") for i, j in PAIRS]]


MOMENTS = ("n", *[f"s_{i}" for i in range(K)], *[f"q_{i}{j}" for i, j in PAIRS])


def _mean(i: int) -> Column:
    return F.col(f"s_{i}") / F.col("n")


def _cov(i: int, j: int) -> Column:
    return F.col(f"q_{i}{j}") / F.col("n") - _mean(i) * _mean(j)


def _from_moments(moments: DataFrame, floors: tuple[float, ...]) -> DataFrame:
    return _factored(moments, _mean, lambda i, j: _cov(i, j) + (floors[i] ** 2 if i == j else 0.0))


def _scales(fitted: DataFrame, p: McdParams) -> DataFrame:
    """Median, robust scale and quantiles of each feature per group that has enough rows."""
    points = [(r + 0.5) / RANKS for r in range(RANKS)]
    quart = fitted.groupBy("grp").agg(F.count("*").alias("rows"), *[
        F.percentile_approx(f, [0.25, 0.5, 0.75, *points], 1000).alias(f"p_{i}") for i, f in enumerate(FEATURES)])
    scale = lambda i: F.sqrt(((F.col(f"p_{i}")[2] - F.col(f"p_{i}")[0]) / 1.349) ** 2 + p.floors[i] ** 2)
    return quart.filter(F.col("rows") >= p.share * p.least_rows).select(
        "grp", *[F.col(f"p_{i}")[1].alias(f"med_{i}") for i in range(K)], *[scale(i).alias(f"sc_{i}") for i in range(K)],
        *[F.slice(f"p_{i}", 4, RANKS).alias(f"pts_{i}") for i in range(K)])


def _starts(fitted: DataFrame, scales: DataFrame, p: McdParams) -> DataFrame:
    """Six estimates per group: correlations of hyperbolic tangents, ranks, normal scores and spatial signs of the
    scaled features, robust pairwise correlations, and the half of the rows nearest to the medians."""
    z = [(F.col(f) - F.col(f"med_{i}")) / F.col(f"sc_{i}") for i, f in enumerate(FEATURES)]
    # a value equal to several quantiles takes the middle of them
    below = lambda i: (F.size(F.filter(f"pts_{i}", lambda x: x < F.col(FEATURES[i])))
                       + F.size(F.filter(f"pts_{i}", lambda x: x <= F.col(FEATURES[i])))) / 2
    ranked = [(below(i) + 0.5) / (RANKS + 1) for i in range(K)]
    met = fitted.join(_sized(scales), "grp").select(
        "grp", *[x.alias(f"z_{i}") for i, x in enumerate(z)], *[r.alias(f"r_{i}") for i, r in enumerate(ranked)])
    zs, rs = [F.col(f"z_{i}") for i in range(K)], [F.col(f"r_{i}") for i in range(K)]
    length = F.sqrt(sum((x * x for x in zs[1:]), zs[0] * zs[0]) + 1e-12)
    forms = {"tanh": [F.tanh(x) for x in zs], "ranks": rs,
             # the logistic curve stands for the normal one
             "normal": [F.log(r / (1 - r)) / 1.702 for r in rs], "signs": [x / length for x in zs]}
    each = met.select("grp", F.explode(F.array(*[
        F.struct(F.lit(name).alias("start"), F.array(*values).alias("v")) for name, values in forms.items()])).alias("f"))
    scored = each.groupBy("grp", F.col("f.start").alias("start")).agg(*_sums(lambda i: F.col("f.v")[i]))
    related = scored.select("grp", "start", *[
        F.when((_cov(i, i) > 1e-12) & (_cov(j, j) > 1e-12), _cov(i, j) / F.sqrt(_cov(i, i) * _cov(j, j)))
        .otherwise(0.0).alias(f"c_{i}{j}") for i, j in PAIRS if i != j])
    # sums and differences of two scaled features have different widths where the two are related
    width = lambda x: F.percentile_approx(x, [0.25, 0.75], 1000)
    pairs = met.groupBy("grp").agg(*[
        f(zs[i], zs[j]).alias(f"{name}_{i}{j}") for i, j in PAIRS if i != j
        for name, f in (("u", lambda a, b: width(a + b)), ("v", lambda a, b: width(a - b)))])
    sq = lambda c: (F.col(c)[1] - F.col(c)[0]) ** 2
    pairwise = pairs.select("grp", F.lit("pairs").alias("start"), *[
        F.when(sq(f"u_{i}{j}") + sq(f"v_{i}{j}") > 0, (sq(f"u_{i}{j}") - sq(f"v_{i}{j}")) / (sq(f"u_{i}{j}") + sq(f"v_{i}{j}")))
        .otherwise(0.0).alias(f"c_{i}{j}") for i, j in PAIRS if i != j])
    # 0.98 keeps a table of estimated correlations clear of the singular ones
    cov = lambda i, j: F.col(f"sc_{i}") * F.col(f"sc_{j}") * (F.lit(1.0) if i == j else 0.98 * F.col(f"c_{i}{j}"))
    correlated = _factored(related.unionByName(pairwise).join(scales, "grp"), lambda i: F.col(f"med_{i}"), cov)
    plain = _factored(scales.withColumn("start", F.lit("half")), lambda i: F.col(f"med_{i}"),
                      lambda i, j: F.col(f"sc_{i}") ** 2 if i == j else F.lit(0.0))
    half = _from_moments(_nearest(_binned(fitted, stored(plain, "quality_estimate")), 0.5), p.floors)
    return correlated.unionByName(half)


def _binned(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Rows, once per start of their group, with their squared distance and its bin on a log scale."""
    met = rows.join(_sized(estimate.drop("logdet")), "grp").withColumn("d2", _distance())
    return met.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS_PER_E).cast("int"))


def _nearest(binned: DataFrame, share: float) -> DataFrame:
    """Moments of the nearest ``share`` of each group; the bin that completes it counts in part, so all starts rest on
    equal weight and their determinants compare.

    Sums per group and bin are partial aggregates, so a group with a third of all rows arrives as a few
    hundred of them.
    """
    per_bin = binned.groupBy("grp", "start", "bin").agg(*_sums(lambda i: F.col(FEATURES[i])))
    group = Window.partitionBy("grp", "start")
    before = F.coalesce(F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    part = per_bin.withColumn("missing", share * F.sum("n").over(group) - before).filter("missing > 0").withColumn(
        "part", F.least(F.lit(1.0), F.col("missing") / F.col("n")))
    return part.groupBy("grp", "start").agg(*[F.sum(F.col(c) * F.col("part")).alias(c) for c in MOMENTS])


def _scaled(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The estimate with ``scale``: how far the median distance is above that of five degrees of freedom, 1 at least."""
    per_bin = _binned(rows, estimate).groupBy("grp", "bin").agg(F.count("*").alias("n"))
    before = Window.partitionBy("grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    marked = per_bin.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "all", F.sum("n").over(Window.partitionBy("grp")))
    at = F.max(F.when(2 * F.col("before") < F.col("all"), F.col("bin")))
    scale = marked.groupBy("grp").agg(F.greatest(F.exp((at + 0.5) / BINS_PER_E) / CHI2_MEDIAN, F.lit(1.0)).alias("scale"))
    return stored(estimate.join(scale, "grp"), "quality_estimate")


def _best(estimate: DataFrame, n: int) -> DataFrame:
    """The ``n`` starts of least determinant of each group."""
    order = Window.partitionBy("grp").orderBy(F.round("logdet", 9), "start")
    return estimate.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n).drop("place")


def least_determinants(fitted: DataFrame, params: McdParams | None = None) -> DataFrame:
    """The estimate of least determinant per ``grp``: ``start`` it came from, ``logdet``, means m_i, Cholesky factor l_ij."""
    p = params or McdParams()
    scales = stored(_scales(fitted, p), "quality_scales")
    step = lambda e: stored(_from_moments(_nearest(_binned(fitted, e), p.share), p.floors), "quality_estimate")
    estimate = stored(_starts(fitted, scales, p), "quality_estimate")
    for _ in range(p.trial_steps):
        estimate = step(estimate)
    estimate = stored(_best(estimate, p.finalists), "quality_estimate")
    for _ in range(p.most_steps):
        last, estimate = estimate, step(estimate)
        fell = last.select("grp", "start", F.col("logdet").alias("was")).join(estimate, ["grp", "start"]).agg(
            F.max(F.col("was") - F.col("logdet"))).first()[0]
        if fell is None or fell < p.tolerance:
            break
    return stored(_best(estimate, 1), "quality_estimate")


def robust_outliers(docs: DataFrame, params: McdParams | None = None, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Base counts of every row, ``base_failed``, its ``distance`` (squared, scaled) and ``kept``.

    Estimates rest on the rows that pass the base rules. A null language or source counts as an empty one.
    Where even the last group has under ``least_rows`` rows, distances are null and the base rules decide.
    """
    p = params or McdParams()
    measured = stored(statistics(docs, id_col, text_col, lang_col, source_col), "quality_rows")
    rows = _grouped(measured, p.least_rows)
    fitted = rows.filter(~F.col("base_failed"))
    raw = _scaled(fitted, least_determinants(fitted, p))
    close = fitted.join(_sized(raw), "grp").filter(_distance() <= p.near * F.col("scale"))
    moments = close.groupBy("grp", "start").agg(*_sums(lambda i: F.col(FEATURES[i])))
    final = _scaled(fitted, stored(_from_moments(moments, p.floors), "quality_estimate"))
    judged = rows.join(_sized(final), "grp", "left").withColumn("distance", _distance() / F.col("scale"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= p.cut, F.lit(True))).alias("kept"))
