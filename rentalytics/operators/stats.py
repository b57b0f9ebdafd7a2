"""Statistical operators.

Statistics are computed by Spark aggregations into one row per stratum
(city).  The normal and chi-square tails of the rank tests are built-in
expressions in log space (positive-term series, a continued fraction and
closed finite sums inside ``aggregate``), so the test plans contain no Python
and the tails keep their digits however small they are.  The regression's
small system is solved in a task, one row of centred sums per stratum; the
pure-Python normal and chi-square tails stay as references for the tests.
"""

from __future__ import annotations

import math
from functools import reduce
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranks import midranks

# --------------------------------------------------------------------------- special functions


def _gammainc_q(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x is None or a is None or math.isnan(x) or a <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    lg = math.lgamma(a)
    if x < a + 1:
        term = s = 1.0 / a
        ap = a
        for _ in range(10000):
            ap += 1
            term *= x / ap
            s += term
            if abs(term) < abs(s) * 1e-16:
                break
        return max(0.0, 1.0 - s * math.exp(-x + a * math.log(x) - lg))
    b, c, d = x + 1 - a, 1e300, 1.0 / (x + 1 - a)
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1e-300 if abs(d) < 1e-300 else d
        c = b + an / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-16:
            break
    return math.exp(-x + a * math.log(x) - lg) * h


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1, a - 1
    c, d = 1.0, 1 - qab * x / qap
    d = 1e-300 if abs(d) < 1e-300 else d
    d = 1 / d
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1 + aa * d
        d = 1e-300 if abs(d) < 1e-300 else d
        c = 1 + aa / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1 + aa * d
        d = 1e-300 if abs(d) < 1e-300 else d
        c = 1 + aa / c
        c = 1e-300 if abs(c) < 1e-300 else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-16:
            break
    return h


def _betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def chi2_sf(x: float, k: float) -> float:
    return _gammainc_q(k / 2.0, x / 2.0)


def t_sf_two_sided(t: float, dof: float) -> float:
    return _betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if f <= 0:
        return 1.0
    return _betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


# --------------------------------------------------------------------------- tails as Spark expressions
# Terms of the series and of the continued fraction, and where the one takes over from the other.
SERIES_TERMS, FRACTION_TERMS, SERIES_END = 120, 200, 2.0


def log_add(a: Column, b: Column) -> Column:
    """ln(exp(a) + exp(b)); either may be -infinity."""
    hi, lo = F.greatest(a, b), F.least(a, b)
    return F.when(lo == F.lit(float("-inf")), hi).otherwise(hi + F.log1p(F.exp(lo - hi)))


def log_erfc_expr(x: Column) -> Column:
    """ln erfc(x) as a built-in expression, right to about 1e-12 at any x.

    Below ``SERIES_END``: erf(|x|) = 2/sqrt(pi) * exp(-x^2) * sum_n (2x^2)^n / (2n+1)!! * |x|, a series of positive
    terms.  From there on the continued fraction erfc(x) = exp(-x^2)/sqrt(pi) / (x + (1/2)/(x + (2/2)/(x + ...))),
    evaluated from its far end, with the exponent kept as a logarithm.
    """
    a = F.abs(x)
    small = F.least(a, F.lit(6.0))  # erf is 1 in double precision beyond
    two_x2 = F.lit(2.0) * small * small
    acc0 = F.struct(small.alias("t"), small.alias("s"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(SERIES_TERMS)), acc0,
                         lambda acc, n: F.struct((acc["t"] * two_x2 / (F.lit(2.0) * n + F.lit(1.0))).alias("t"),
                                                 (acc["s"] + acc["t"] * two_x2 / (F.lit(2.0) * n + F.lit(1.0))).alias("s")))
    erf = F.lit(2.0 / math.sqrt(math.pi)) * F.exp(-small * small) * series["s"]
    far = F.greatest(x, F.lit(SERIES_END))
    fraction = F.aggregate(F.sequence(F.lit(FRACTION_TERMS), F.lit(1)), far,
                           lambda t, k: far + k * F.lit(0.5) / t)
    return (F.when(x >= F.lit(SERIES_END), -far * far - F.ln(fraction) - F.lit(0.5 * math.log(math.pi)))
            .when(x >= 0, F.log1p(-erf)).otherwise(F.log1p(erf)))


def log_normal_sf_expr(z: Column) -> Column:
    """ln P(Z > z) for a standard normal, JVM-side."""
    return F.lit(math.log(0.5)) + log_erfc_expr(z / F.lit(math.sqrt(2.0)))


def log_chi2_sf_expr(x: Column, dof: Column) -> Column:
    """ln P(X > x) for chi-square with a positive integer ``dof`` (a column), JVM-side, closed forms with h = x/2:
    even dof = 2a: exp(-h) * sum_{i<a} h^i / i!;
    odd dof = 2a+1: erfc(sqrt(h)) + exp(-h) * sum_{i=1..a} h^(i-1/2) / Gamma(i+1/2).
    Terms are summed as logarithms, relative to the largest so far, so none overflows."""
    h = x / F.lit(2.0)
    k = dof.cast("int")
    half = F.floor(k / F.lit(2)).cast("int")
    even = k % 2 == 0
    shift = F.when(even, F.lit(0.0)).otherwise(F.lit(0.5))
    # the first term: h^0 / 0!, or h^(1/2) / Gamma(3/2)
    first = F.when(even, F.lit(0.0)).otherwise(F.ln(h) * F.lit(0.5) - F.lit(math.log(math.sqrt(math.pi) / 2.0)))
    start = F.struct(first.alias("t"), first.alias("top"), F.lit(1.0).alias("s"))

    def add(acc: Column, i: Column) -> Column:
        t = acc["t"] + F.ln(h) - F.ln(i.cast("double") + shift)
        top = F.greatest(acc["top"], t)
        return F.struct(t.alias("t"), top.alias("top"), (acc["s"] * F.exp(acc["top"] - top) + F.exp(t - top)).alias("s"))

    # sequences stay ascending and non-empty (Spark counts down when start > stop); the cases of one term
    # or none are masked instead
    many = F.aggregate(F.sequence(F.lit(1), F.greatest(half - 1, F.lit(1))), start, add)
    total = -h + F.when(half >= 2, many["top"] + F.ln(many["s"])).when(half == 1, first).otherwise(F.lit(float("-inf")))
    out = F.when(even, total).otherwise(log_add(log_erfc_expr(F.sqrt(h)), total))
    return F.when(x <= 0, F.lit(0.0)).otherwise(F.least(F.lit(0.0), out))


def with_tail(df: DataFrame, log_p: Column) -> DataFrame:
    """Add p_value and its base-10 logarithm, which stays exact where p_value is too small for a double."""
    return df.withColumn("log10_p", log_p / F.lit(math.log(10.0))).withColumn("p_value", F.exp(log_p))


# --------------------------------------------------------------------------- rank tests
def _materialise(df: DataFrame) -> DataFrame:
    """Per-distinct-value tables that several branches read are checkpointed (``session.materialise``)."""
    from ..session import materialise
    return materialise(df)


def mann_whitney(df: DataFrame, value: str, first: Column, second: Column, by: Sequence[str] = ("city",),
                 alternative: str = "greater", continuity: bool = True, with_p: bool = True,
                 convention: str = "source") -> DataFrame:
    """Mann-Whitney U of the first sample, tie-corrected normal approximation, rank-biserial r.

    ``first`` / ``second`` are predicates selecting the two samples.  U is
    the first sample's; ``alternative`` is ``greater``, ``less`` or
    ``two-sided`` (U = max(U1, U2)).  Output per stratum: n1, n2, u, z,
    p_value, log10_p, rank_biserial (= 1 - 2U/(n1 n2), sign as the source: negative where the first sample is larger;
    ``convention="positive_first"`` turns it round).
    """
    if convention not in ("source", "positive_first"):
        raise ValueError(f"unknown convention {convention!r}")
    by = list(by)
    v = F.col(value)
    s = df.where(v.isNotNull() & (first | second)).select(*by, v.alias("v"), F.when(first, 1).otherwise(0).alias("g1"))
    counts = _materialise(s.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("cnt"), F.sum("g1").alias("c1")))
    r = midranks(counts, "v", by)
    agg = r.groupBy(*by).agg(
        F.sum("c1").alias("n1"), (F.sum("cnt") - F.sum("c1")).alias("n2"),
        F.sum(F.col("c1") * F.col("midrank")).alias("r1"),
        F.sum(F.pow(F.col("cnt"), 3) - F.col("cnt")).alias("tie"))
    out = (mwu_from_sums if with_p else mwu_stats)(agg, by, alternative, continuity)
    return out.withColumn("rank_biserial", -F.col("rank_biserial")) if convention == "positive_first" else out


def mwu_stats(agg: DataFrame, by: Sequence[str], alternative: str = "greater", continuity: bool = True) -> DataFrame:
    """U, z and r from per-stratum sums (n1, n2, r1, tie) — SQL-expressible part."""
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    u2 = n1 * n2 - u1
    u_test = {"greater": u1, "less": u2, "two-sided": F.greatest(u1, u2)}[alternative]
    mu = n1 * n2 / 2
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("tie") / (n * (n - 1))))
    z = (u_test - mu - F.lit(0.5 if continuity else 0.0)) / sigma
    return agg.select(*by, F.col("n1").cast("long").alias("n1"), F.col("n2").cast("long").alias("n2"),
                      u1.alias("u"), z.alias("z"), (F.lit(1.0) - 2 * u1 / (n1 * n2)).alias("rank_biserial"))


def mwu_from_sums(agg: DataFrame, by: Sequence[str], alternative: str, continuity: bool) -> DataFrame:
    st = mwu_stats(agg, by, alternative, continuity)
    p = log_normal_sf_expr(F.col("z"))
    if alternative == "two-sided":
        p = F.least(F.lit(0.0), p + F.lit(math.log(2.0)))
    return with_tail(st, p)


def kruskal_wallis(df: DataFrame, value: str, group: str, by: Sequence[str] = ("city",)) -> DataFrame:
    """Kruskal-Wallis H (tie-corrected), chi-square p with k-1 dof, eta-squared.

    Rank sums per group come from the distributed mid-ranks joined to the
    (stratum, group, value) counts — every frame is per distinct value.
    """
    by = list(by)
    st = kruskal_stats(df, value, group, by)
    return with_tail(st, log_chi2_sf_expr(F.col("h"), F.col("k") - 1))


def kruskal_stats(df: DataFrame, value: str, group: str, by: Sequence[str] = ("city",)) -> DataFrame:
    by = list(by)
    v = F.col(value)
    base = df.where(v.isNotNull() & F.col(group).isNotNull()).select(*by, F.col(group).alias("grp"), v.alias("v"))
    gcounts = _materialise(base.groupBy(*by, "grp", "v").agg(F.count(F.lit(1)).alias("c")))
    vcounts = _materialise(gcounts.groupBy(*by, "v").agg(F.sum("c").alias("cnt")))
    r = midranks(vcounts, "v", by).select(*by, "v", "cnt", "midrank")
    tie = r.groupBy(*by).agg(F.sum(F.pow(F.col("cnt"), 3) - F.col("cnt")).alias("tie"))
    per_group = gcounts.join(r.select(*by, "v", "midrank"), [*by, "v"]).groupBy(*by, "grp").agg(
        F.sum("c").alias("ng"), F.sum(F.col("c") * F.col("midrank")).alias("rg"))
    s = per_group.groupBy(*by).agg(F.count(F.lit(1)).alias("k"), F.sum("ng").alias("n"),
                                   F.sum(F.pow(F.col("rg"), 2) / F.col("ng")).alias("ss")).join(tie, by)
    n = F.col("n").cast("double")
    h_raw = F.lit(12.0) / (n * (n + 1)) * F.col("ss") - 3 * (n + 1)
    h = h_raw / (F.lit(1.0) - F.col("tie") / (F.pow(n, 3) - n))
    return s.select(*by, F.col("k").cast("long").alias("k"), F.col("n").cast("long").alias("n"), h.alias("h"),
                    ((h - F.col("k") + 1) / (n - F.col("k"))).alias("eta_squared"))


def cohens_d(df: DataFrame, value: str, first: Column, second: Column, by: Sequence[str] = ("city",)) -> DataFrame:
    """(mean1 - mean2) / sqrt((s1^2 + s2^2) / 2) with sample standard deviations."""
    v = F.col(value)
    a = df.where(v.isNotNull()).groupBy(*by).agg(
        F.avg(F.when(first, v)).alias("mean1"), F.avg(F.when(second, v)).alias("mean2"),
        F.stddev_samp(F.when(first, v)).alias("sd1"), F.stddev_samp(F.when(second, v)).alias("sd2"))
    pooled = F.sqrt((F.pow("sd1", 2) + F.pow("sd2", 2)) / 2)
    return a.withColumn("cohens_d", (F.col("mean1") - F.col("mean2")) / pooled)


# --------------------------------------------------------------------------- moments, correlation
def moments(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """N, mean, sd, bias-corrected skewness and excess kurtosis (as pandas), Jarque-Bera + p."""
    v = F.col(value)
    a = df.where(v.isNotNull()).groupBy(*by).agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"),
        F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"))
    n = F.col("n").cast("double")
    skew = F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    jb = n / 6 * (F.pow("g1", 2) + F.pow("g2", 2) / 4)
    return a.select(*by, "n", "mean", "sd", skew.alias("skewness"), kurt.alias("kurtosis"),
                    jb.alias("jarque_bera"), F.exp(-jb / 2).alias("jb_p_value"))


def correlation_pairs(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of every pair (lower triangle), pairwise-complete, in one aggregate."""
    cols = [c for c in cols if c in df.columns]
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}"))
        aggs.append(F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"n{i}"))
    wide = df.groupBy(*by).agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                        F.col(f"c{i}").alias("corr"), F.col(f"n{i}").alias("n"))
                               for i, (a, b) in enumerate(pairs)])).alias("p")
    return wide.select(*by, rows).select(*by, "p.*")


# --------------------------------------------------------------------------- regression
def centred_sums(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sufficient statistics of OLS with intercept, one row per stratum: n, means, and the covariances of every two
    columns.  ``covar_pop`` merges centred sums, so large offsets cancel nothing."""
    cols = [F.col(c).cast("double") for c in [*xs, y]]
    aggs = [F.avg(c).alias(f"m_{i}") for i, c in enumerate(cols)]
    aggs += [F.covar_pop(a, b).alias(f"c_{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols[: i + 1])]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *aggs)


def _solve(row, k: int) -> dict | None:
    """OLS from centred sums: the k x k system of correlations, scaled back.  None without degrees of freedom.

    Collinear features get the coefficients of least norm among standardised ones; a constant feature gets 0.
    """
    n, dof = int(row["n"]), int(row["n"]) - k - 1
    if dof <= 0:
        return None
    mean = np.array([row[f"m_{i}"] for i in range(k + 1)])
    c = np.array([[row[f"c_{max(i, j)}_{min(i, j)}"] for j in range(k + 1)] for i in range(k + 1)])
    sd = np.sqrt(np.clip(np.diag(c), 0, None))
    ok = sd[:k] > 1e-12 * np.maximum(1.0, np.abs(mean[:k]))
    scale = np.where(ok, sd[:k], 1.0)
    r = np.where(np.outer(ok, ok), c[:k, :k] / np.outer(scale, scale), 0.0)
    inverse = np.linalg.pinv(r, hermitian=True)
    ry = np.where(ok, c[:k, k] / scale, 0.0)
    std_beta = inverse @ ry
    slope = std_beta / scale
    sse, sst = max(n * (c[k, k] - std_beta @ ry), 0.0), n * c[k, k]
    sigma2 = sse / dof
    var = sigma2 * inverse / n / np.outer(scale, scale)
    beta = np.r_[mean[k] - slope @ mean[:k], slope]
    se = np.sqrt(np.clip(np.r_[sigma2 / n + mean[:k] @ var @ mean[:k], np.diag(var)], 0, None))
    r2 = 1 - sse / sst if sst > 0 else float("nan")
    # VIF_j = 1 / (1 - R2_j), R2_j of feature j regressed on the other features and the constant: right also when
    # the others are collinear; an exactly collinear feature gets +inf, a constant feature stays null.
    vif = np.full(k, np.nan)
    idx = np.flatnonzero(ok)
    for j in idx:
        others = [i for i in idx if i != j]
        aux = float(r[others, j] @ np.linalg.pinv(r[np.ix_(others, others)], hermitian=True) @ r[others, j]) if others else 0.0
        vif[j] = np.inf if 1.0 - aux <= 1e-12 else 1.0 / (1.0 - aux)
    return {"beta": beta, "se": se, "r2": r2, "adj_r2": 1 - (1 - r2) * (n - 1) / dof,
            "f": (r2 / k) / ((1 - r2) / dof) if r2 < 1 else float("inf"), "dof": dof, "vif": vif}


def ols(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = ("city",)) -> DataFrame:
    """OLS with intercept per stratum from one distributed pass of centred sums.

    Each stratum's row is solved in a task ((k+1)^2 numbers).  Output long form: stratum, term, coef, std_err, t,
    p_value, vif (features only), r2, adj_r2, f_stat, f_p_value, n.  A stratum without degrees of freedom keeps its
    terms and n, with nulls.
    """
    by, xs = list(by), list(xs)
    k = len(xs)
    names = ["coef", "std_err", "t", "p_value", "vif", "r2", "adj_r2", "f_stat", "f_p_value"]
    schema = T.StructType([*[df.schema[b] for b in by], T.StructField("term", T.StringType()),
                           *[T.StructField(c, T.DoubleType()) for c in names], T.StructField("n", T.LongType())])

    def solve(batches):
        import pandas as pd
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                res = _solve(row, k)
                for i, term in enumerate(["const", *xs]):
                    values = [None] * len(names)
                    if res:
                        t = res["beta"][i] / res["se"][i] if res["se"][i] > 0 else float("nan")
                        values = [res["beta"][i], res["se"][i], t, t_sf_two_sided(t, res["dof"]) if t == t else None,
                                  res["vif"][i - 1] if i else None, res["r2"], res["adj_r2"], res["f"],
                                  f_sf(res["f"], k, res["dof"]) if res["f"] == res["f"] else None]
                        values = [None if v is None or v != v else float(v) for v in values]
                    out.append((*[row[b] for b in by], term, *values, int(row["n"])))
            frame = pd.DataFrame(out, columns=[*by, "term", *names, "n"])
            frame[names] = frame[names].astype("Float64")
            yield frame

    from ..session import ship_package
    ship_package(df.sparkSession)
    return centred_sums(df, y, xs, by).mapInPandas(solve, schema)


# --------------------------------------------------------------------------- density
#: Width of a cell in bandwidths, and powers kept of the distances to its middle.  With u = distance / bandwidth, at most
#: CELL / 2, the term of power k of the kernel's expansion is below 1.09 * (CELL / 2)^k / sqrt(k!): 1.3e-14 for the first left out.
CELL, POWERS = 0.5, 14


def hermite_rows(n: int) -> list[list[int]]:
    """Coefficients, from the constant up, of the first n polynomials with He(k + 1) = z He(k) - k He(k - 1)."""
    rows = [[1], [0, 1]]
    for k in range(1, n - 1):
        up, back = [0, *rows[k]], [k * c for c in rows[k - 1]]
        rows.append([x - (back[i] if i < len(back) else 0) for i, x in enumerate(up)])
    return rows[:n]


def gaussian_kde(df: DataFrame, value: str, grid_points: int = 200, by: Sequence[str] = (),
                 lo: float | None = None, hi: float | None = None) -> DataFrame:
    """X11: Gaussian KDE (Scott bandwidth h = n^(-1/5) * sd) evaluated on an even grid.

    A fast Gauss expansion: rows are summed into cells of half a bandwidth as powers of their distance to the cell's middle
    (one aggregation, partial in each task), and each cell meets the grid once.  Around a middle s, with z = (x - s) / h and
    u = (v - s) / h, exp(-(z - u)^2 / 2) is exp(-z^2 / 2) times the sum of He(k, z) u^k / k!, so a cell's sums of u^k are all that
    the grid needs of its rows.  The error is below 1e-12 of a kernel's height; the work on the grid grows with the data's
    range in bandwidths, not with distinct values.  The grid spans [lo, hi] or the data range per stratum.
    """
    by = list(by)
    if not by:
        df, by = df.withColumn("__all", F.lit(0)), ["__all"]
    v = F.col(value).cast("double")
    base = df.where(v.isNotNull()).select(*by, v.alias("__v"))
    st = base.groupBy(*by).agg(F.count("__v").alias("__n"), F.stddev_samp("__v").alias("__sd"),
                               F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    st = st.withColumn("__h", F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2)))
    st = st.withColumn("__lo", F.lit(lo) if lo is not None else F.col("__min")) \
           .withColumn("__hi", F.lit(hi) if hi is not None else F.col("__max"))
    st = st.where(F.col("__h") > 0)  # a stratum without spread has no Gaussian bandwidth
    of = {c: f"__of_{c}" for c in by}
    strata = st.select(*[F.col(c).alias(of[c]) for c in by], "__n", "__h", "__min", "__lo", "__hi")
    j = base.join(strata, [F.col(c).eqNullSafe(F.col(of[c])) for c in by])
    width = F.col("__h") * F.lit(CELL)
    j = j.withColumn("__cell", F.floor((F.col("__v") - F.col("__min")) / width))
    j = j.withColumn("__u", (F.col("__v") - F.col("__min") - (F.col("__cell") + F.lit(0.5)) * width) / F.col("__h"))
    for k in range(2, POWERS):
        j = j.withColumn(f"__u{k}", F.col("__u" if k == 2 else f"__u{k - 1}") * F.col("__u"))
    names = ["__u0", "__u1", *(f"__u{k}" for k in range(2, POWERS))]
    keys = [*by, "__n", "__h", "__min", "__lo", "__hi"]
    cells = j.withColumnsRenamed({"__u": "__u1"}).groupBy(*keys, "__cell").agg(
        F.count(F.lit(1)).cast("double").alias("__u0"), *[F.sum(c).alias(c) for c in names[1:]])
    # each cell's polynomial in z
    rows = hermite_rows(POWERS)
    terms = [reduce(lambda a, b: a + b, [F.col(names[k]) * F.lit(row[i] / math.factorial(k)) for k, row in enumerate(rows) if i < len(row) and row[i]])
             for i in range(POWERS)]
    cells = cells.select(*keys, "__cell", *[t.alias(f"__a{i}") for i, t in enumerate(terms)])
    step = (F.col("__hi") - F.col("__lo")) / F.lit(grid_points - 1)
    met = cells.withColumn("grid", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
    met = met.withColumn("__z", (F.col("__lo") + F.col("grid") * step - F.col("__min") - (F.col("__cell") + F.lit(0.5)) * width) / F.col("__h"))
    poly = F.col(f"__a{POWERS - 1}")
    for i in range(POWERS - 2, -1, -1):
        poly = poly * F.col("__z") + F.col(f"__a{i}")
    # beyond 39 bandwidths the kernel is 0 in doubles
    part = F.when(F.abs(F.col("__z")) < 39, F.exp(F.lit(-0.5) * F.col("__z") * F.col("__z")) * poly).otherwise(F.lit(0.0))
    out = met.groupBy(*keys, "grid").agg(F.greatest(F.sum(part), F.lit(0.0)).alias("__s"))
    res = out.select(*by, "grid", (F.col("__lo") + F.col("grid") * step).alias("x"),
                     (F.col("__s") / (F.col("__n") * F.col("__h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
    return res.drop("__all")
