"""Operators against brute-force pandas / numpy references on small frames."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rentalytics.operators import aggregates as A
from rentalytics.operators import filters as P
from rentalytics.operators import joins as J
from rentalytics.operators import profile as PR
from rentalytics.operators import quality as Q
from rentalytics.operators import windows as W
from rentalytics.operators.ranks import DIGIT, first_digit, midranks, next_digit, rank_values
from rentalytics.plans.model import keep_first


def test_flag_counts_null_safe(spark):
    df = spark.createDataFrame([(1, True), (1, False), (1, None), (1, False), (2, True)], "id int, a boolean")
    r = {x.id: x for x in A.flag_counts(df, ["id"], "a").collect()}
    assert (r[1].total_days, r[1].available_days, r[1].booked_days, r[1].occupancy_rate) == (3, 1, 2, 66.67)
    assert (r[2].total_days, r[2].booked_days, r[2].occupancy_rate) == (1, 0, 0.0)


def test_rate_pct_modes(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "a boolean")
    sql, pd_ = df.agg(A.rate_pct("a", "sql"), A.rate_pct("a", "pandas")).first()
    assert sql == 50.0 and pd_ == pytest.approx(200 / 3)


def test_duplicate_counts_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "y")], "k int, v string")
    r = PR.duplicate_counts(df, key=["k"]).first()
    assert (r.total_rows, r.duplicate_rows, r.duplicate_keys) == (4, 1, 2)


def test_duplicate_fingerprint_equals_grouping(spark):
    rows = [(0.0, None, "a"), (-0.0, None, "a"), (None, None, None), (None, None, None), (1.5, "x", "a"),
            (1.5, "x", "b"), (float("nan"), "x", "b"), (float("nan"), "x", "b")]
    df = spark.createDataFrame(rows, "d double, s string, t string")
    a = PR.duplicate_counts(df, key=["s"], fingerprint=True).first()
    b = PR.duplicate_counts(df, key=["s"], fingerprint=False).first()
    assert tuple(a) == tuple(b) == (8, 3, 6)


def test_keep_first_is_lowest_order(spark):
    df = spark.createDataFrame([(3, 10, "c"), (1, 10, "a"), (2, 11, "b")], "id int, host int, name string")
    got = {r.host: r.name for r in keep_first(df, ["host"], "id", ["name"]).collect()}
    assert got == {10: "a", 11: "b"}


def test_concentration_matches_pandas(spark):
    rng = np.random.default_rng(3)
    hosts = rng.zipf(1.7, 3000) % 400
    pdf = pd.DataFrame({"city": ["c"] * len(hosts), "host": hosts})
    r = A.concentration(spark.createDataFrame(pdf), "host").first()
    sizes = pdf.groupby("host").size().sort_values(ascending=False)
    top = sizes.iloc[: int(len(sizes) * 0.10)].sum()
    assert r.total_hosts == len(sizes)
    assert r.multi_hosts == (sizes > 1).sum()
    assert r.top_share_pct == pytest.approx(top / len(pdf) * 100)
    assert r.multi_item_pct == pytest.approx(sizes[sizes > 1].sum() / len(pdf) * 100)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = rng.gamma(2.0, 30.0, 5000).round(1)
    df = spark.createDataFrame(pd.DataFrame({"g": "x", "v": vals}))
    got = {r.bin: r["count"] for r in A.histogram(df, "v", 50, by=["g"]).collect()}
    exp, _ = np.histogram(vals, bins=50)
    assert [got.get(i + 1, 0) for i in range(50)] == list(exp)


def test_box_stats(spark):
    vals = [1.0, 2, 3, 4, 5, 6, 7, 8, 9, 10, 100]
    df = spark.createDataFrame([("a", float(v)) for v in vals], "c string, v double")
    r = A.box_stats(df, "v", ["c"]).first()
    s = pd.Series(vals)
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    assert (r.q1, r.median, r.q3) == (q1, s.median(), q3)
    assert r.whisker_high == s[s <= q3 + 1.5 * (q3 - q1)].max() and r.whisker_low == 1.0


def test_portfolio_distribution(spark):
    df = spark.createDataFrame([("c", h, i) for i, h in enumerate([1, 2, 2, 3, 3, 3, 4, 4, 4, 4, 4])],
                               "city string, host int, item int")
    got = {r.bucket: r.entity_count for r in
           A.portfolio_distribution(df, "host", "item", [0, 1, 2, 3, 5, 100], ["1", "2", "3", "4-5", "6+"]).collect()}
    assert got == {"1": 1, "2": 1, "3": 1, "4-5": 1}


def test_crosstab_zero_fill(spark):
    df = spark.createDataFrame([("n1", "A"), ("n1", "A"), ("n1", "B"), ("n2", "B")], "r string, c string")
    got = {(x.r, x.c): (x["count"], round(x.row_pct, 4)) for x in A.crosstab_pct(df, "r", "c").collect()}
    assert got == {("n1", "A"): (2, 66.6667), ("n1", "B"): (1, 33.3333), ("n2", "A"): (0, 0.0), ("n2", "B"): (1, 100.0)}


def test_complete_axis(spark):
    df = spark.createDataFrame([("c", 1, 5.0), ("c", 3, 7.0)], "city string, month int, v double")
    got = sorted((r.month, r.v) for r in J.complete_axis(df, "month", list(range(1, 13)), by=["city"]).collect())
    assert len(got) == 12 and got[0] == (1, 5.0) and got[1] == (2, None)


def test_lookup_default(spark):
    df = spark.createDataFrame([("Boat",), ("Nope",), (None,)], "t string")
    got = [r.g for r in J.lookup(df, "t", {"Boat": "Unique Stay"}, "g").collect()]
    assert got == ["Unique Stay", "Other", "Other"]


def test_top_k_per_group_and_plan(spark):
    df = spark.createDataFrame([("a", i, float(i % 7)) for i in range(50)], "city string, k int, v double")
    out = W.top_k_per_group(df, 3, ["v"], tie_break=["k"])
    got = [(r.k, r["rank"]) for r in out.orderBy("rank").collect()]
    assert got == [(6, 1), (13, 2), (20, 3)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_seeded_sample_is_bounded_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in P.seeded_sample(df, 20, "k", 7).collect()]
    b = [r.k for r in P.seeded_sample(df, 20, "k", 7).collect()]
    assert len(a) == 20 and a == b


def test_quantile_trim(spark):
    df = spark.createDataFrame([("c", float(v)) for v in range(1, 101)], "city string, v double")
    assert P.quantile_trim(df, "v", 0.95).count() == int((pd.Series(range(1, 101)) <= pd.Series(range(1, 101)).quantile(0.95)).sum())


def test_midranks_match_pandas(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"city": rng.choice(["a", "b"], 4000), "v": rng.integers(0, 60, 4000).astype(float)})
    ranked = rank_values(spark.createDataFrame(pdf).withColumn("rid", F.monotonically_increasing_id()), "v", ["city"])
    got = ranked.toPandas()
    exp = got.groupby("city")["v"].rank(method="average")
    assert np.allclose(got["midrank"].values, exp.values)


def test_midranks_many_slices(spark):
    counts = spark.createDataFrame([(float(v), 2) for v in range(100)], "v double, cnt int")
    r = {x.v: x.midrank for x in midranks(counts, "v", [], slice_rows=3).collect()}
    assert r[0.0] == 1.5 and r[99.0] == 199.5


def test_midranks_totals_and_null_strata(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"city": rng.choice(["a", "b", None], 500), "v": rng.integers(0, 40, 500).astype(float)})
    counts = spark.createDataFrame(pdf).groupBy("city", "v").agg(F.count(F.lit(1)).alias("cnt"))
    got = {(x.city, x.v): (x.midrank, x.group_n) for x in midranks(counts, "v", ["city"], slice_rows=4, with_total=True).collect()}
    for c, rows in pdf.groupby("city", dropna=False):
        c = None if pd.isna(c) else c
        for v, r in zip(rows["v"], rows["v"].rank()):
            assert got[c, v] == (r, len(rows))


def test_digits_rise_with_the_value(spark):
    rng = np.random.default_rng(6)
    inf = float("inf")
    values = sorted({*rng.normal(0, 50, 500), *np.exp(rng.uniform(-700, 709, 500)), *-np.exp(rng.uniform(-700, 709, 500)), 0.0, 5e-324, -5e-324,
                     1.7976931348623157e308, -1.7976931348623157e308, inf, -inf})
    values = [float(v) for v in values] + [float("nan")]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    digits = [r.d for r in df.select("i", first_digit(F.col("v")).alias("d")).orderBy("i").collect()]
    assert digits == sorted(digits) and digits[-1] == DIGIT and digits[-2] > digits[-3] and len(set(digits)) > 700
    for lo, hi in ((1.0, 1.0000000000000002), (5e-324, 1e-323), (-3.5, 900.0)):
        inner = sorted({lo, hi, *(min(max(float(lo + (hi - lo) * x), lo), hi) for x in rng.random(100))})
        rows = spark.createDataFrame([(v, lo, hi) for v in inner], "v double, lo double, hi double")
        d = [r.d for r in rows.select("v", next_digit(F.col("v"), F.col("lo"), F.col("hi")).alias("d")).orderBy("v").collect()]
        assert d == sorted(d) and d[0] == 0 and d[-1] == DIGIT - 1


def test_mann_whitney_on_many_distinct_values(spark):
    """300,000 distinct values with the carried class counts, exchange reuse off, twice: the plain rank's U."""
    from rentalytics.operators.stats import mann_whitney
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("city"),
                                     ((F.col("id") * 7919) % 300_007).cast("double").alias("v"),
                                     (F.hash("id") % 2 == 0).alias("first"))
    pdf = df.toPandas()
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        runs = [{r.city: r.u for r in mann_whitney(df, "v", F.col("first"), ~F.col("first")).collect()} for _ in range(2)]
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    for city, rows in pdf.groupby("city"):
        n1 = int(rows["first"].sum())
        u = rows["v"].rank()[rows["first"]].sum() - n1 * (n1 + 1) / 2
        assert runs[0][city] == runs[1][city] == u


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    got = {r.column: (r.null_count, r.null_pct) for r in PR.null_profile(df).collect()}
    assert got == {"a": (1, 25.0), "b": (2, 50.0)}


def test_describe_matches_pandas(spark):
    vals = [1.0, 2.5, 3.0, 10.0, 11.5]
    r = PR.describe(spark.createDataFrame([(v,) for v in vals], "x double"), ["x"]).first()
    d = pd.Series(vals).describe().round(2)
    assert (r["count"], r.mean, r.std, r["min"], r.q25, r.q50, r.q75, r["max"]) == tuple(d.values)


def test_first_values(spark):
    df = spark.createDataFrame([(i, None if i % 2 else f"v{i}") for i in range(10)], "pos int, s string")
    got = [r.value for r in PR.first_values(df, ["s"], "pos", 3).orderBy("position").collect()]
    assert got == ["v0", "v2", "v4"]


def test_key_violations(spark):
    df = spark.createDataFrame([(1, "d"), (1, "d"), (2, "d")], "id int, d string")
    assert [tuple(r) for r in Q.key_violations(df, ["id", "d"]).collect()] == [(1, "d", 2)]


def test_unknown_tenants(spark):
    from rentalytics.sources.config import config_frame
    with pytest.raises(ValueError):
        Q.reject_unknown_tenants(spark, ["bangkok", "atlantis"], config_frame(spark))
    Q.reject_unknown_tenants(spark, ["bangkok", "lisbon"], config_frame(spark))


def test_cumulative_before(spark):
    df = spark.createDataFrame([("g", "a", 10.0), ("g", "b", 30.0), ("g", "c", 60.0)], "k string, c string, v double")
    got = [r.cum for r in W.cumulative_before(df, "v", ["c"], ["k"], "cum").orderBy("c").collect()]
    assert got == [0.0, 10.0, 40.0]


def test_places_of_a_total_order(spark):
    """Places 1..n by two keys with nulls, a hot first key and many ranges; equal keys get different places."""
    rng = np.random.default_rng(4)
    rows = [(int(a) if a < 5 else None, float(b), i) for i, (a, b) in enumerate(zip(np.where(rng.random(3000) < 0.6, 1, rng.integers(0, 6, 3000)), rng.integers(0, 400, 3000)))]
    df = spark.createDataFrame(rows, "a int, b double, i int").repartition(5)
    got = W.places(df, ["a", "b", "i"], [True, False, False]).orderBy("place").collect()
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [(r.a, r.b, r.i) for r in got] == want and [r.place for r in got] == list(range(1, 3001))
    tied = W.places(df.select("a"), ["a"])
    assert sorted(r.place for r in tied.collect()) == list(range(1, 3001))
    assert W.places(df.limit(0), ["a"]).count() == 0
