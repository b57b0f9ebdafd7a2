"""Statistics against brute-force formulas (scipy is not installed; the formulas are textbook)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rentalytics.operators import stats as S


def _mwu_reference(x, y, alternative):
    allv = pd.Series(np.concatenate([x, y]))
    ranks = allv.rank()
    n1, n2 = len(x), len(y)
    u1 = ranks[:n1].sum() - n1 * (n1 + 1) / 2
    t = allv.value_counts().values
    n = n1 + n2
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - (t ** 3 - t).sum() / (n * (n - 1))))
    u = u1 if alternative == "greater" else max(u1, n1 * n2 - u1)
    z = (u - n1 * n2 / 2 - 0.5) / s
    p = 0.5 * math.erfc(z / math.sqrt(2))
    return u1, z, (min(1.0, 2 * p) if alternative == "two-sided" else p)


@pytest.mark.parametrize("alternative", ["greater", "two-sided"])
def test_mann_whitney_matches_reference(spark, alternative):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 30, 400).astype(float)
    y = rng.integers(2, 32, 300).astype(float)
    pdf = pd.DataFrame({"city": "c", "v": np.concatenate([x, y]), "g": ["a"] * 400 + ["b"] * 300})
    r = S.mann_whitney(spark.createDataFrame(pdf), "v", F.col("g") == "a", F.col("g") == "b",
                       alternative=alternative).first()
    u1, z, p = _mwu_reference(x, y, alternative)
    assert r.u == pytest.approx(u1) and r.z == pytest.approx(z) and r.p_value == pytest.approx(p, rel=1e-9)
    assert r.rank_biserial == pytest.approx(1 - 2 * u1 / (400 * 300))
    assert r.n1 + r.n2 == 700


def test_u1_plus_u2(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"city": "c", "v": rng.normal(size=200).round(1), "g": rng.choice(["a", "b"], 200)})
    df = spark.createDataFrame(pdf)
    a = S.mann_whitney(df, "v", F.col("g") == "a", F.col("g") == "b").first()
    b = S.mann_whitney(df, "v", F.col("g") == "b", F.col("g") == "a").first()
    assert a.u + b.u == pytest.approx(a.n1 * a.n2)


def test_kruskal_matches_formula(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"city": "c", "g": rng.choice(list("abcd"), 900), "v": rng.integers(0, 40, 900).astype(float)})
    r = S.kruskal_wallis(spark.createDataFrame(pdf), "v", "g").first()
    ranks = pdf["v"].rank()
    n = len(pdf)
    h = 12 / (n * (n + 1)) * sum(ranks[pdf.g == g].sum() ** 2 / (pdf.g == g).sum() for g in "abcd") - 3 * (n + 1)
    t = pdf["v"].value_counts().values
    h /= 1 - (t ** 3 - t).sum() / (n ** 3 - n)
    assert r.h == pytest.approx(h) and r.k == 4
    assert r.eta_squared == pytest.approx((h - 3) / (n - 4))
    assert r.p_value == pytest.approx(S.chi2_sf(h, 3))


def test_special_functions_against_tables():
    assert S.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert S.chi2_sf(7.814727903251178, 3) == pytest.approx(0.05, rel=1e-9)
    assert S.t_sf_two_sided(2.228138851986274, 10) == pytest.approx(0.05, rel=1e-8)
    assert S.f_sf(3.4780496, 4, 10) == pytest.approx(0.05, rel=1e-5)
    assert S.f_sf(2.5 ** 2, 1, 17) == pytest.approx(S.t_sf_two_sided(2.5, 17), rel=1e-10)
    assert S.normal_sf(1.959963984540054) == pytest.approx(0.025, rel=1e-12)


def test_moments_match_pandas(spark):
    rng = np.random.default_rng(4)
    vals = rng.lognormal(size=500)
    r = S.moments(spark.createDataFrame([(float(v),) for v in vals], "v double"), "v").first()
    s = pd.Series(vals)
    assert r.skewness == pytest.approx(s.skew()) and r.kurtosis == pytest.approx(s.kurtosis())


def test_correlation_pairwise(spark):
    pdf = pd.DataFrame({"a": [1, 2, 3, 4, None, 6.0], "b": [2, 4, 5, 4, 5, None], "c": [9, 7, 6, 3, 2, 1.0]})
    rows = [tuple(None if pd.isna(v) else float(v) for v in t) for t in pdf.itertuples(index=False)]
    sdf = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.corr for r in S.correlation_pairs(sdf, ["a", "b", "c"]).collect()}
    exp = pdf.corr()
    assert got[("b", "a")] == pytest.approx(exp.loc["a", "b"]) and got[("c", "a")] == pytest.approx(exp.loc["a", "c"])


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(8)
    n = 500
    x1, x2 = rng.normal(size=n), rng.normal(size=n) + 0.5
    y = 1.0 + 2.0 * x1 - 0.5 * x2 + rng.normal(scale=0.3, size=n)
    pdf = pd.DataFrame({"city": "c", "x1": x1, "x2": x2, "y": y})
    out = {r.term: r for r in S.ols(spark.createDataFrame(pdf), "y", ["x1", "x2"]).collect()}
    X = np.column_stack([np.ones(n), x1, x2])
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    r2 = 1 - (resid ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert [out[t].coef for t in ["const", "x1", "x2"]] == pytest.approx(list(beta), rel=1e-8)
    assert out["x1"].r2 == pytest.approx(r2)
    corr = np.corrcoef(x1, x2)[0, 1]
    assert out["x1"].vif == pytest.approx(1 / (1 - corr ** 2))


def test_vif_collinear_and_constant(spark):
    rng = np.random.default_rng(9)
    n = 300
    a, b = rng.normal(size=n), rng.normal(size=n)
    pdf = pd.DataFrame({"city": "c", "a": a, "b": b, "a3": 3 * a + 1, "one": 1.0,
                        "y": a + b + rng.normal(scale=0.1, size=n)})
    out = {r.term: r.vif for r in S.ols(spark.createDataFrame(pdf), "y", ["a", "b", "a3", "one"]).collect()}
    assert out["a"] == float("inf") and out["a3"] == float("inf") and out["one"] is None
    # b is unrelated to a / a3: auxiliary R2 from the collinear pair is the same as from a alone
    assert out["b"] == pytest.approx(1 / (1 - np.corrcoef(a, b)[0, 1] ** 2))


def test_kde_matches_formula(spark):
    vals = np.array([1.0, 2.0, 2.0, 3.5, 4.0, 7.0])
    out = S.gaussian_kde(spark.createDataFrame([(float(v),) for v in vals], "v double"), "v", 11).orderBy("grid").toPandas()
    h = vals.std(ddof=1) * len(vals) ** (-0.2)
    xs = np.linspace(vals.min(), vals.max(), 11)
    exp = [np.mean(np.exp(-0.5 * ((x - vals) / h) ** 2) / (h * math.sqrt(2 * math.pi))) for x in xs]
    assert np.allclose(out["density"].values, exp) and np.allclose(out["x"].values, xs)


def _log_normal_sf(z):
    """ln of the normal tail by an asymptotic bracket's mean at large z, by erfc below."""
    if z < 25:
        return math.log(0.5 * math.erfc(z / math.sqrt(2)))
    series = 1 - 1 / z**2 + 3 / z**4 - 15 / z**6 + 105 / z**8 - 945 / z**10
    return -z * z / 2 - math.log(z * math.sqrt(2 * math.pi)) + math.log(series)


def test_normal_tail_keeps_its_digits(spark):
    zs = [-10.0, -3.2, -1.0, 0.0, 0.3, 1.96, 2.82, 2.83, 4.0, 6.0, 7.9, 9.0, 12.0, 24.0, 40.0, 100.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(S.log_normal_sf_expr(F.col("z")).alias("p")).collect()
    for r, z in zip(got, zs):
        assert math.expm1(r.p - _log_normal_sf(z)) == pytest.approx(0, abs=1e-9), z


def test_chi2_tail_keeps_its_digits(spark):
    rows = [(x, k) for x in [0.0, 0.5, 3.0, 14.0, 60.0, 300.0] for k in range(1, 20)]
    rows += [(1000.0, 1000), (900.0, 999), (1600.0, 1000), (1700.0, 1001)]
    got = spark.createDataFrame(rows, "x double, k int").select(S.log_chi2_sf_expr(F.col("x"), F.col("k")).alias("p")).collect()
    for r, (x, k) in zip(got, rows):
        assert math.exp(r.p) == pytest.approx(S.chi2_sf(x, k), rel=1e-9, abs=1e-300), (x, k)
    # far beyond a double: ln Q(500, 5000) = -x/2 + 499 ln(x/2) - lgamma(500) + ln(1 + 499/5000 + ...)
    far = spark.createDataFrame([(10000.0, 1000)], "x double, k int").select(S.log_chi2_sf_expr(F.col("x"), F.col("k"))).first()[0]
    term = total = 1.0
    for i in range(499, 0, -1):
        term *= i / 5000
        total += term
    assert far == pytest.approx(-5000 + 499 * math.log(5000) - math.lgamma(500) + math.log(total), abs=1e-8)


def test_ols_with_a_large_offset_matches_regr_slope(spark):
    rng = np.random.default_rng(3)
    x = 1e8 + np.arange(2000.0)
    df = spark.createDataFrame(pd.DataFrame({"city": "c", "x": x, "y": 0.5 * x + rng.normal(size=2000)}))
    out = {r.term: r for r in S.ols(df, "y", ["x"]).collect()}
    slope, r2 = df.select(F.regr_slope("y", "x"), F.regr_r2("y", "x")).first()
    assert out["x"].coef == pytest.approx(slope, rel=1e-9) and out["x"].r2 == pytest.approx(r2, rel=1e-9)


def test_ols_of_a_small_stratum_is_null(spark):
    rows = [("big", float(i), float(i * i % 7), float(i % 3) + i) for i in range(50)] + [("tiny", 1.0, 2.0, 3.0)] * 2 + [("flat", 1.0, 2.0, 3.0)] * 9
    out = {(r.city, r.term): r for r in S.ols(spark.createDataFrame(rows, "city string, a double, b double, y double"), "y", ["a", "b"]).collect()}
    assert len(out) == 9 and out["big", "a"].coef is not None
    assert out["tiny", "a"].n == 2 and out["tiny", "a"].coef is None and out["tiny", "const"].p_value is None
    assert out["flat", "const"].coef == 3.0 and out["flat", "a"].vif is None


def test_kde_narrow_bandwidth_keeps_every_grid_point(spark):
    # a tight cluster plus two far outliers: h ~ 2.2 against a grid step of ~10, so each value
    # reaches a few grid points and most points are reached by none
    vals = np.concatenate([np.random.default_rng(2).normal(size=10000), [-1000.0, 1000.0]])
    out = S.gaussian_kde(spark.createDataFrame([(float(v),) for v in vals], "v double"), "v", 200).orderBy("grid").toPandas()
    h = vals.std(ddof=1) * len(vals) ** (-0.2)
    xs = np.linspace(vals.min(), vals.max(), 200)
    exp = [np.mean(np.exp(-0.5 * ((x - vals) / h) ** 2) / (h * math.sqrt(2 * math.pi))) for x in xs]
    assert len(out) == 200 and np.allclose(out["density"].values, exp, rtol=1e-9, atol=1e-15)


def test_kde_expansion_equals_the_direct_sum(spark):
    """Several strata, outliers, ties, grids inside and beyond the data: equal to the sum over all kernels."""
    rng = np.random.default_rng(2)
    groups = {"a": rng.normal(100, 5, 2000), "b": np.r_[rng.lognormal(3, 1.2, 1500), 1e5, -1e5], "c": rng.integers(0, 4, 900) / 2.0, None: 1e3 + rng.normal(0, 0.1, 400), "one": [3.0] * 5}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double").repartition(4)
    for lo, hi in ((None, None), (0.0, 120.0)):
        got = S.gaussian_kde(df, "v", 50, by=["g"], lo=lo, hi=hi).toPandas()
        assert "one" not in set(got["g"])
        for g, vs in groups.items():
            if g == "one":
                continue
            vs = np.asarray(vs, dtype=float)
            rows = got[got["g"].isna() if g is None else got["g"] == g].sort_values("grid")
            h = vs.std(ddof=1) * len(vs) ** -0.2
            a, b = (vs.min(), vs.max()) if lo is None else (lo, hi)
            x = a + np.arange(50) * (b - a) / 49
            want = np.exp(-0.5 * ((x[:, None] - vs[None]) / h) ** 2).sum(1) / (len(vs) * h * np.sqrt(2 * np.pi))
            assert len(rows) == 50 and np.abs(rows["density"].to_numpy() - want).max() <= 1e-10 * max(want.max(), 1 / h)


def test_rank_biserial_conventions(spark):
    df = spark.createDataFrame([("c", True, 5.0), ("c", True, 4.0), ("c", False, 1.0), ("c", False, 4.5)], "city string, first boolean, v double")
    r = {c: S.mann_whitney(df, "v", F.col("first"), ~F.col("first"), convention=c).first() for c in ("source", "positive_first")}
    assert r["source"].rank_biserial == -0.5 and r["positive_first"].rank_biserial == 0.5 and r["source"].u == r["positive_first"].u == 3.0
    with pytest.raises(ValueError):
        S.mann_whitney(df, "v", F.col("first"), ~F.col("first"), convention="other")
