"""Minimum covariance determinant estimates against an exact search in numpy, and planted bad texts."""

import brute
import numpy as np
import pytest

from leakscope.llm import quality

SCHEMA = "doc_id long, text string, lang string, source string"


def features(rows, grp):
    return np.array([[r[f] for f in quality.FEATURES] for r in rows if r.grp == grp])


@pytest.fixture(scope="module")
def mixed(spark):
    """Two groups of correlated features; a quarter of the first lies apart, in a clump of its own."""
    rng = np.random.default_rng(5)
    mix = np.eye(5) + np.tril(rng.normal(0, 0.6, (5, 5)), -1)
    rows = []
    for grp, n, bad in (("a", 900, 200), ("b", 400, 0)):
        x = rng.normal(size=(n, 5)) @ mix.T * [1, 0.6, 0.1, 0.2, 0.3] + [5, 5, 0.2, 0.3, 0.3]
        x[:bad] = rng.normal(size=(bad, 5)) * 0.05 + [5, 5, 1.5, 2.0, -2.0]
        rows += [(i, grp, *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "doc_id long, grp string, " + ", ".join(f"{f} double" for f in quality.FEATURES))


def test_least_determinant_of_several_starts(spark, mixed):
    p = quality.McdParams()
    rows = mixed.collect()
    got = {r.grp: r for r in quality.least_determinants(mixed, p).collect()}
    for grp in "ab":
        _, logdet = brute.mcd_distances(features(rows, grp), p.floors)
        # bins of 5 % stand for exact order
        assert got[grp].logdet == pytest.approx(logdet, abs=0.05)
    # the clump does not pull the estimate
    assert abs(got["a"].m_2 - 0.2) < 0.05 and abs(got["a"].m_4 - 0.3) < 0.1
    starts = quality._starts(mixed, quality._scales(mixed, p), p).collect()
    assert {(r.grp, r.start) for r in starts} == {(g, s) for g in "ab" for s in ("tanh", "ranks", "normal", "signs", "pairs", "half")}
    assert all(np.isfinite([v for v in r[2:]]).all() for r in starts)


def test_concentration_does_not_raise_the_determinant(spark, mixed):
    p = quality.McdParams()
    estimate = quality.stored(quality._starts(mixed, quality._scales(mixed, p), p), "q")
    last = None
    for _ in range(4):
        estimate = quality.stored(quality._from_moments(quality._nearest(quality._binned(mixed, estimate), p.share), p.floors), "q")
        now = {(r.grp, r.start): r.logdet for r in estimate.collect()}
        if last:
            assert all(now[k] <= last[k] + 0.02 for k in now)
        last = now


def test_verdicts_of_real_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = quality.McdParams()
    measured = quality._grouped(quality.stored(quality.statistics(docs), "q"), p.least_rows).filter("not base_failed").collect()
    got = {r.doc_id: r for r in quality.robust_outliers(docs).collect()}
    differ = n = 0
    for grp in {r.grp for r in measured}:
        x = features(measured, grp)
        if len(x) < p.share * p.least_rows:
            continue
        want, _ = brute.mcd_distances(x, p.floors)
        for r, d in zip([r for r in measured if r.grp == grp], want, strict=True):
            n += 1
            differ += got[r.doc_id].kept != (d <= p.cut)
    print(f"{differ} of {n} verdicts differ from exact concentration")
    assert n > 500 and differ <= 0.005 * n


def test_repeated_lines_alone_reject(spark):
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(4000)]

    def lines(n):
        return [" ".join(rng.choice(vocabulary, 12)) for _ in range(n)]

    clean = ["\n".join(lines(int(rng.integers(8, 30)))) for _ in range(300)]
    # a third of the lines repeat an earlier one; at most half of the words are in repeated windows
    bad = []
    for k in range(40):
        at = lines(24)
        bad.append("\n".join(at + at[:8] if k % 2 else at[:9] + at[:9] + at[9:]))
    # one line said twice in a short text is harmless
    clean[0] = "\n".join([*(short := lines(6)), short[1]])
    rows = [(i, t, "en", "a") for i, t in enumerate(clean + bad)]
    got = quality.robust_outliers(spark.createDataFrame(rows, SCHEMA)).collect()
    failed = {r.doc_id for r in got if r.base_failed}
    assert {r.doc_id for r in got if r.kept} == set(range(300))
    assert len(failed & set(range(300, 340))) < 40
