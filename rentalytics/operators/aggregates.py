"""Aggregations.

All of these are ``groupBy().agg()`` plans: Spark runs a partial
(map-side) aggregate before the shuffle, so a hot key costs one small
partial row per task instead of moving its rows.  Joins of aggregates
back onto detail rows broadcast only frames that are one row per city /
per category (bounded by construction).

Quantile operators take ``method``: ``"distributed"`` (default; exact, from
distributed ranks, no group is ever held in one task — see ``quantiles``),
``"exact"`` (Spark ``percentile``: one task merges a group's value -> count
map; fine when a group's distinct values are few) or ``"approx"``
(``percentile_approx``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import col as _c
from ..functions.buckets import bucket_right
from ..functions.numeric import round_even
from .quantiles import exact_quantiles, merge_group_rows


# --------------------------------------------------------------------------- basics
def count_by(df: DataFrame, keys: Sequence[str], out: str = "count") -> DataFrame:
    """A01."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def quantile_expr(c, q: float | Sequence[float], method: str = "exact", accuracy: int = 10000) -> Column:
    """Exact interpolated (pandas / PERCENTILE_CONT) or approximate quantile(s)."""
    qs = F.lit(q) if not isinstance(q, (list, tuple)) else F.array(*[F.lit(float(x)) for x in q])
    if method == "exact":
        return F.percentile(_c(c), qs)
    if method == "approx":
        return F.percentile_approx(_c(c), qs, accuracy)
    raise ValueError(method)


def group_quantiles(df: DataFrame, specs, by: Sequence[str] = (), method: str = "distributed") -> DataFrame:
    """Quantile columns per group: ``specs`` maps out name -> (column or Column, p)."""
    if method == "distributed":
        return exact_quantiles(df, specs, by)
    return df.groupBy(*by).agg(*[quantile_expr(c, p, method).alias(o) for o, (c, p) in specs.items()])


def agg_with_quantiles(df: DataFrame, by: Sequence[str], aggs: Sequence[Column], specs,
                       method: str = "distributed", order: Sequence[str] | None = None) -> DataFrame:
    """``groupBy(by).agg(*aggs)`` plus quantile columns (``specs``) side by side, one row per group.

    With the distributed method the quantiles come from their own
    rank-based plan and are merged per group (no join); ``order`` fixes the
    output column order.
    """
    by = list(by)
    if method == "distributed":
        base = df.groupBy(*by).agg(*aggs) if aggs else df.select(*by).distinct() if by else None
        q = exact_quantiles(df, specs, by)
        out = merge_group_rows(base, q, by) if base is not None else q
    else:
        out = df.groupBy(*by).agg(*aggs, *[quantile_expr(c, p, method).alias(o) for o, (c, p) in specs.items()])
    return out.select(*by, *order) if order else out


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond) if cond is not None else df


def median_by(df: DataFrame, keys: Sequence[str], col: str, out: str = "median",
              drop_null_keys: bool = True, method: str = "distributed") -> DataFrame:
    """A03 (pandas groupby drops null keys) / A04 (SQL keeps them: ``drop_null_keys=False``)."""
    if drop_null_keys:
        df = _drop_null_keys(df, keys)
    return group_quantiles(df, {out: (col, 0.5)}, keys, method)


def flag_counts(df: DataFrame, keys: Sequence[str], flag: str, *, total: str = "total_days",
                true_out: str = "available_days", false_out: str = "booked_days",
                rate_out: str = "occupancy_rate", rate_of: str = "false") -> DataFrame:
    """Per entity non-null / true / false counts and ``false (or true) / total * 100`` (2 dp).

    Null flags count in neither side, and the false count is null-safe.
    """
    f = F.col(flag)
    agg = df.groupBy(*keys).agg(
        F.count(f).alias(total),
        F.count_if(f).alias(true_out),
        F.count_if(~f).alias(false_out),
    )
    num = F.col(false_out) if rate_of == "false" else F.col(true_out)
    return agg.withColumn(rate_out, round_even(F.try_divide(num, F.col(total)) * F.lit(100.0), 2))


def rate_pct(flag, mode: str = "sql") -> Column:
    """Share of true as a percentage.

    ``mode="sql"``: ``AVG(CASE WHEN flag THEN 1.0 ELSE 0.0 END)*100`` (null counts as 0);
    ``mode="pandas"``: mean over non-null values only.
    """
    f = _c(flag)
    if mode == "sql":
        return F.avg(F.when(f, F.lit(1.0)).otherwise(F.lit(0.0))) * F.lit(100.0)
    if mode == "pandas":
        return F.avg(f.cast("double")) * F.lit(100.0)
    raise ValueError(mode)


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), out: str = "count") -> DataFrame:
    """Counts per value (order at the reader)."""
    return df.groupBy(*by, col).agg(F.count(F.lit(1)).alias(out))


# --------------------------------------------------------------------------- KPI / comparison
def kpi_block(df: DataFrame, by: str = "city", price: str = "price", occupancy: str = "occupancy_rate",
              rating: str = "review_scores_rating", method: str = "distributed") -> DataFrame:
    """Per-city and grand-total KPIs in one scan (ROLLUP = grouping sets (city), ()).

    The grand-total median is the largest group of all; with the distributed
    method it is computed from ranks over rows expanded to (city) and (total).
    """
    base = df.rollup(by).agg(
        F.count(F.lit(1)).alias("listing_count"),
        F.avg(occupancy).alias("mean_occupancy"),
        F.avg(rating).alias("mean_rating"),
        F.grouping(by).cast("int").alias("is_total"),
        *([F.percentile(price, 0.5).alias("median_price")] if method != "distributed" else []),
    )
    if method != "distributed":
        return base
    levels = F.explode(F.array(F.struct(F.col(by).alias("g"), F.lit(0).alias("t")),
                               F.struct(F.lit(None).cast(df.schema[by].dataType).alias("g"), F.lit(1).alias("t"))))
    expanded = df.select(levels.alias("__l"), F.col(price).alias("__p")).select(
        F.col("__l.g").alias(by), F.col("__l.t").alias("is_total"), "__p")
    med = exact_quantiles(expanded, {"median_price": ("__p", 0.5)}, [by, "is_total"])
    return merge_group_rows(base, med, [by, "is_total"]).select(
        by, "listing_count", "median_price", "mean_occupancy", "mean_rating", "is_total")


def city_comparison(df: DataFrame, metrics: Mapping[str, object], by: str = "city",
                    method: str = "distributed") -> DataFrame:
    """Metrics x cities in long form (metric, city, value): one aggregate + unpivot.

    A metric is an aggregate Column or a ``(column, p)`` quantile spec.
    """
    aggs = [e.cast("double").alias(name) for name, e in metrics.items() if isinstance(e, Column)]
    specs = {name: e for name, e in metrics.items() if not isinstance(e, Column)}
    wide = agg_with_quantiles(df, [by], aggs, specs, method, order=list(metrics))
    wide = wide.select(by, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(by, list(metrics), "metric", "value")


# --------------------------------------------------------------------------- hosts
def portfolio_distribution(df: DataFrame, entity: str, item: str, edges: Sequence[float],
                           labels: Sequence[str], by: Sequence[str] = ("city",)) -> DataFrame:
    """Items per entity -> right-closed bucket -> number of entities per bucket."""
    per = df.groupBy(*by, entity).agg(F.count(item).alias("n_items"))
    b = per.withColumn("bucket", bucket_right("n_items", edges, labels)) \
           .withColumn("bucket_order", bucket_right("n_items", edges))
    return b.where(F.col("bucket").isNotNull()).groupBy(*by, "bucket", "bucket_order") \
            .agg(F.count(F.lit(1)).alias("entity_count"))


def concentration(df: DataFrame, entity: str, by: Sequence[str] = ("city",), top_share: float = 0.10) -> DataFrame:
    """Entity count, multi-item entities, their shares, share held by the top ``int(0.1*n)`` entities.

    No window runs over the entities themselves: entities are first reduced
    to a size histogram (size -> number of entities), whose row count is the
    number of *distinct* portfolio sizes (at most sqrt(2 * items)).  The top
    m entities are then "all entities above the boundary size plus part of
    the boundary size", found with a running sum over that small histogram.
    """
    by = list(by)
    per = df.groupBy(*by, entity).agg(F.count(F.lit(1)).alias("n"))
    sizes = per.groupBy(*by, "n").agg(F.count(F.lit(1)).alias("hosts"))
    totals = sizes.groupBy(*by).agg(F.sum("hosts").alias("total_hosts"), F.sum(F.col("n") * F.col("hosts")).alias("total_items"))
    w = Window.partitionBy(*by).orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    j = sizes.join(totals, by).withColumn("before", F.coalesce(F.sum("hosts").over(w), F.lit(0)))
    m = F.floor(F.col("total_hosts") * F.lit(top_share))
    taken = F.greatest(F.lit(0), F.least(F.col("hosts"), m - F.col("before")))
    out = j.groupBy(*by).agg(
        F.first("total_hosts").alias("total_hosts"),
        F.first("total_items").alias("total_items"),
        F.sum(F.when(F.col("n") > 1, F.col("hosts")).otherwise(F.lit(0))).alias("multi_hosts"),
        F.sum(F.when(F.col("n") > 1, F.col("n") * F.col("hosts")).otherwise(F.lit(0))).alias("multi_items"),
        F.sum(taken * F.col("n")).alias("top_items"),
    )
    return out.select(
        *by, F.col("total_hosts").cast("long").alias("total_hosts"),
        F.col("total_items").cast("long").alias("total_items"), F.col("multi_hosts").cast("long").alias("multi_hosts"),
        (F.col("multi_hosts") / F.col("total_hosts") * 100).alias("multi_host_pct"),
        (F.col("multi_items") / F.col("total_items") * 100).alias("multi_item_pct"),
        (F.col("top_items") / F.col("total_items") * 100).alias("top_share_pct"),
    )


def reaggregate(df: DataFrame, keys: Sequence[str], col: str, out: str | None = None) -> DataFrame:
    """Sum counts to a coarser key."""
    return df.groupBy(*keys).agg(F.sum(col).alias(out or col))


def mean_of_rates(df: DataFrame, keys: Sequence[str], rate_col: str, out: str | None = None) -> DataFrame:
    """Unweighted mean of pre-aggregated group rates."""
    return df.groupBy(*keys).agg(F.avg(rate_col).alias(out or rate_col))


def crosstab_pct(df: DataFrame, row: str, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts with zero fill and row percentage, in long form (row, col, count, row_pct).

    A row lists every category that its group ``by`` has; counts are aggregated first, so the windows and lists
    below hold one entry per row and category, and no categories are read when the plan is built.
    """
    counts = df.groupBy(*by, row, col).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__all", F.collect_set(col).over(Window.partitionBy(*by)))
    per_row = counts.groupBy(*by, row).agg(F.first("__all").alias("__all"), F.sum("__n").alias("__total"),
                                           F.map_from_entries(F.collect_list(F.struct(col, "__n"))).alias("__by"))
    long = per_row.withColumn(col, F.explode("__all"))
    n = F.coalesce(F.try_element_at("__by", F.col(col)), F.lit(0))
    return long.select(*by, row, col, n.alias("count"), (n / F.col("__total") * 100).alias("row_pct"))


def pivot_rate(df: DataFrame, keys: Sequence[str], flag: str, split: str) -> DataFrame:
    """Rate of ``flag`` by key, split by a boolean column (conditional aggregation)."""
    f = F.col(flag).cast("double")
    s = F.col(split)
    return df.groupBy(*keys).agg(
        (F.avg(F.when(s, f)) * 100).alias(f"{flag}_rate_when_{split}"),
        (F.avg(F.when(~s, f)) * 100).alias(f"{flag}_rate_when_not_{split}"),
    )


def share_of_total(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ("city",), out: str = "share_pct") -> DataFrame:
    """Count per class / total per group * 100 (window over the small per-class frame)."""
    c = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn(out, F.col("count") / F.sum("count").over(Window.partitionBy(*by)) * 100)


# --------------------------------------------------------------------------- distributions
def histogram(df: DataFrame, col: str, bins: int, by: Sequence[str] = ("city",)) -> DataFrame:
    """Equal-width bins over each group's data range; last bin closed (as numpy).

    Output: group keys, ``bin`` (1..bins), ``bin_lo``, ``bin_hi``, ``count``.
    A group whose values are all equal spans (v-0.5, v+0.5) like numpy.
    """
    by = list(by)
    if not by:
        df, by = df.withColumn("__all", F.lit(0)), ["__all"]
    v = F.col(col)
    rng = df.where(v.isNotNull()).groupBy(*by).agg(F.min(v).alias("__mn"), F.max(v).alias("__mx"))
    rng = rng.select(*by,
                     F.when(F.col("__mx") > F.col("__mn"), F.col("__mn")).otherwise(F.col("__mn") - 0.5).alias("__lo"),
                     F.when(F.col("__mx") > F.col("__mn"), F.col("__mx")).otherwise(F.col("__mx") + 0.5).alias("__hi"))
    j = df.where(v.isNotNull()).join(rng, by)
    idx = F.least(F.floor((v - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * F.lit(bins)) + 1, F.lit(bins))
    h = j.groupBy(*by, idx.cast("int").alias("bin"), "__lo", "__hi").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("__hi") - F.col("__lo")) / F.lit(bins)
    out = h.select(*by, "bin", (F.col("__lo") + (F.col("bin") - 1) * width).alias("bin_lo"),
                   (F.col("__lo") + F.col("bin") * width).alias("bin_hi"), "count")
    return out.drop("__all")


def box_stats(df: DataFrame, col: str, by: Sequence[str], min_n: int = 0, method: str = "distributed") -> DataFrame:
    """q1, median, q3, mean and 1.5·IQR whiskers per class (groups with n <= min_n dropped)."""
    by = list(by)
    v = F.col(col)
    base = df.where(v.isNotNull())
    q = agg_with_quantiles(base, by, [F.count(v).alias("n"), F.avg(v).alias("mean")],
                           {"q1": (col, 0.25), "median": (col, 0.5), "q3": (col, 0.75)}, method,
                           order=["n", "mean", "q1", "median", "q3"])
    if min_n:
        q = q.where(F.col("n") > min_n)
    iqr = F.col("q3") - F.col("q1")
    fences = q.select(*by, (F.col("q1") - 1.5 * iqr).alias("__lf"), (F.col("q3") + 1.5 * iqr).alias("__uf"))
    w = base.join(fences, by).groupBy(*by).agg(
        F.min(F.when(v >= F.col("__lf"), v)).alias("whisker_low"),
        F.max(F.when(v <= F.col("__uf"), v)).alias("whisker_high"))
    return q.join(w, by)


def quantiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
              method: str = "distributed", prefix: str = "p") -> DataFrame:
    """Scalar quantiles per group as columns ``p05``, ``p25``, ..."""
    names = [f"{prefix}{round(p * 100):02d}" for p in probs]
    return group_quantiles(df, {n: (col, p) for n, p in zip(names, probs)}, by, method).select(*by, *names)


def range_summary(df: DataFrame, col: str, by: Sequence[str] = (), method: str = "distributed") -> DataFrame:
    """Min / max / median."""
    v = F.col(col)
    return agg_with_quantiles(df, by, [F.min(v).alias("min"), F.max(v).alias("max")], {"median": (col, 0.5)},
                              method, order=["min", "max", "median"])


def class_means(df: DataFrame, cols: Sequence[str], class_col: str, by: Sequence[str] = ("city",),
                positive=True) -> DataFrame:
    """Mean of many columns per class, in long form, with the class gap.

    Output: group keys, ``dimension``, ``mean_pos`` (class == positive),
    ``mean_neg``, ``gap`` (pos - neg).  Computed by conditional aggregation
    in one pass.
    """
    cls = F.col(class_col)
    aggs = []
    for c in cols:
        aggs.append(F.avg(F.when(cls == F.lit(positive), F.col(c))).alias(f"{c}__pos"))
        aggs.append(F.avg(F.when(cls != F.lit(positive), F.col(c))).alias(f"{c}__neg"))
    wide = df.groupBy(*by).agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(f"{c}__pos").alias("mean_pos"),
                 F.col(f"{c}__neg").alias("mean_neg")) for c in cols])).alias("s")
    long = wide.select(*by, stack).select(*by, "s.*")
    return long.withColumn("gap", F.col("mean_pos") - F.col("mean_neg"))


def filtered_mean(value, cond: Column) -> Column:
    """Mean over the rows matching a condition."""
    return F.avg(F.when(cond, _c(value)))


def with_group_total(stats: DataFrame, detail: DataFrame, col: str, by: Sequence[str] = ("city",),
                     out: str = "group_median", method: str = "distributed") -> DataFrame:
    """A per-group scalar (median of the whole group) next to finer statistics."""
    tot = group_quantiles(detail, {out: (col, 0.5)}, by, method)
    return stats.join(tot, list(by), "left")
