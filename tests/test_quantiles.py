import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rentalytics.operators import aggregates as A
from rentalytics.operators.quantiles import exact_quantiles, merge_group_rows


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({"g": rng.choice(["hot", "b", "c"], n, p=[0.7, 0.2, 0.1]),
                        "x": rng.integers(0, 50, n).astype(float),      # many ties
                        "y": rng.normal(size=n)})                       # all distinct
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return pdf, df


@pytest.mark.parametrize("p", [0.0, 0.1, 0.25, 0.5, 0.95, 1.0])
def test_matches_pandas(frame, p):
    pdf, df = frame
    got = exact_quantiles(df, {"qx": ("x", p), "qy": ("y", p)}, ["g"]) \
        .toPandas().set_index("g").sort_index()
    exp = pdf.groupby("g")[["x", "y"]].quantile(p).sort_index()
    assert np.allclose(got["qx"], exp["x"]) and np.allclose(got["qy"], exp["y"])


def test_equals_spark_percentile_bitwise(frame):
    _, df = frame
    specs = {"a": ("y", 0.37), "b": ("x", 0.5), "c": (F.when(F.col("y") > 0, F.col("x")), 0.75)}
    got = {r.g: r for r in exact_quantiles(df, specs, ["g"]).collect()}
    ref = {r.g: r for r in df.groupBy("g").agg(*[F.percentile(e if not isinstance(e, str) else F.col(e), F.lit(p)).alias(o)
                                                   for o, (e, p) in specs.items()]).collect()}
    for g in ref:
        for o in specs:
            assert got[g][o] == ref[g][o]


def test_hot_group_spread_over_slices(spark):
    # one group holds almost every row; with 7 slices its values are numbered by several tasks
    df = spark.range(10000).select(F.when(F.col("id") < 9900, "hot").otherwise("cold").alias("g"),
                                   (F.col("id") * 7 % 10007).cast("double").alias("v"))
    got = {r.g: r.med for r in exact_quantiles(df, {"med": ("v", 0.5)}, ["g"], slice_rows=1000).collect()}
    pdf = df.toPandas()
    exp = pdf.groupby("g")["v"].median()
    assert got["hot"] == exp["hot"] and got["cold"] == exp["cold"]


def test_null_group_key_and_global(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None)], "g string, v double")
    got = {r.g: r.m for r in exact_quantiles(df, {"m": ("v", 0.5)}, ["g"]).collect()}
    assert got == {None: 2.0, "a": 2.0}
    assert exact_quantiles(df, {"m": ("v", 0.5)}).first().m == 2.0


def test_merge_group_rows_keeps_left_groups(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "g string, n int")
    right = spark.createDataFrame([("a", 1.5), (None, 2.5), ("z", 9.0)], "g string, q double")
    got = {r.g: (r.n, r.q) for r in merge_group_rows(left, right, ["g"]).collect()}
    assert got == {"a": (1, 1.5), None: (2, 2.5), "c": (3, None)}


def test_kpi_total_median(spark):
    df = spark.createDataFrame([("a", float(v), 1.0, 1.0) for v in range(10)] + [("b", 100.0, 1.0, 1.0)],
                               "city string, price double, occupancy_rate double, review_scores_rating double")
    got = {r.city: r.median_price for r in A.kpi_block(df).collect()}
    assert got == {"a": 4.5, "b": 100.0, None: 5.0}


def test_plan_holds_no_group_in_one_task(frame):
    _, df = frame
    plan = exact_quantiles(df, {"m": ("y", 0.5)}, ["g"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "percentile" not in plan.lower()


def test_targets_beyond_the_broadcast_size(frame, monkeypatch):
    from rentalytics.operators import quantiles
    pdf, df = frame
    monkeypatch.setattr(quantiles, "BROADCAST_TARGETS", 0)
    got = {r.g: r.q for r in exact_quantiles(df, {"q": ("y", 0.3)}, ["g"]).collect()}
    exp = pdf.groupby("g")["y"].quantile(0.3)
    assert all(np.isclose(got[g], exp[g]) for g in exp.index)


def test_many_distinct_values_without_exchange_reuse(spark):
    """300,000 distinct values per group, more than one level of cut points, exchange reuse off: the exact values."""
    df = spark.range(600_000).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
                                     ((F.col("id") * 7919) % 600_011).cast("double").alias("v"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r.g: (r.q, r.m) for r in exact_quantiles(df, {"q": ("v", 0.123), "m": ("v", 0.5)}, ["g"], slice_rows=1000).collect()}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    pdf = df.toPandas()
    for g, v in pdf.groupby("g")["v"]:
        assert got[g] == (pytest.approx(v.quantile(0.123)), v.quantile(0.5))


_values = st.one_of(st.none(), st.integers(-3, 3).map(float),
                    st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), _values), min_size=1, max_size=80),
       p=st.floats(0.0, 1.0))
def test_property_matches_numpy(spark, rows, p):
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q for r in exact_quantiles(df, {"q": ("v", p)}, ["g"], slice_rows=3).collect()}
    for g in {r[0] for r in rows}:
        vals = [v for k, v in rows if k == g and v is not None]
        if not vals:
            assert got.get(g) is None
        else:
            assert np.isclose(got[g], np.quantile(np.array(vals), p), rtol=1e-9, atol=1e-9)


def test_extreme_and_uneven_values(spark):
    """Values of all magnitudes, most of them in one narrow range: several digits, down to slices of two values."""
    rng = np.random.default_rng(12)
    values = [*(1.0 + rng.integers(0, 50, 400) * 2.0 ** -52), *np.exp(rng.uniform(-600, 600, 60)), *(-np.exp(rng.uniform(-600, 600, 60))), 0.0, -0.0, float("inf"), float("-inf")]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.4, 0.5, 0.6, 0.77, 0.99, 1.0]
    got = exact_quantiles(df, {f"q{i}": ("v", p) for i, p in enumerate(probs)}, slice_rows=1).first()
    want = df.select(F.percentile("v", F.array(*map(F.lit, probs))).alias("p")).first().p
    assert [got[f"q{i}"] for i in range(len(probs))] == want
