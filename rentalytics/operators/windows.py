"""Window-like operators, ordering and top-k.

Every window is partitioned by a grouping key (normally ``city`` or a
neighbourhood) *after* an aggregation has shrunk the rows to one per
category, so no window sorts a whole fact table in one task.  Top-k per
group shows up as ``WindowGroupLimit`` in the plan (k rows kept per
partition before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise_table


def _order(cols: Sequence, descending: bool | Sequence[bool]) -> list[Column]:
    if isinstance(descending, bool):
        descending = [descending] * len(cols)
    out = []
    for c, d in zip(cols, descending):
        c = F.col(c) if isinstance(c, str) else c
        out.append(c.desc_nulls_last() if d else c.asc_nulls_last())
    return out


def surrogate_key(df: DataFrame, order_by: Sequence[str], out: str, by: Sequence[str] = ("city",)) -> DataFrame:
    """1..n in sorted key order within each group (dimension-sized input)."""
    w = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.withColumn(out, F.row_number().over(w).cast("int"))


def top_k_per_group(df: DataFrame, k: int, order_by: Sequence, by: Sequence[str] = ("city",),
                    descending: bool | Sequence[bool] = True, rank_col: str = "rank",
                    tie_break: Sequence[str] = ()) -> DataFrame:
    """The first k rows per group with a 1..k rank label.

    ``tie_break`` columns (ascending) make ties deterministic (first-seen in
    pandas becomes smallest key here).
    """
    order = _order(list(order_by), descending) + [F.col(c).asc_nulls_last() for c in tie_break]
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("int")).where(F.col(rank_col) <= k)


def top_k(df: DataFrame, k: int, order_by: Sequence, descending: bool | Sequence[bool] = True,
          tie_break: Sequence[str] = ()) -> DataFrame:
    """Global ORDER BY ... LIMIT k (TakeOrderedAndProject: k rows per task, then merged)."""
    order = _order(list(order_by), descending) + [F.col(c).asc_nulls_last() for c in tie_break]
    return df.orderBy(*order).limit(k)


def sort(df: DataFrame, cols: Sequence, descending: bool | Sequence[bool] = False) -> DataFrame:
    """Multi-key ordering (range-partitioned sort)."""
    return df.orderBy(*_order(list(cols), descending))


def places(df: DataFrame, cols: Sequence, descending: bool | Sequence[bool] = False, out: str = "place") -> DataFrame:
    """Every row with its place 1..n in a multi-key order, without ever ordering all rows in one task.

    Rows are range-partitioned by the keys and written so, each with its place in its range; the ranges' sizes give,
    by a running sum over one row a range, how many rows come before each.  Rows with equal keys get different places,
    the same ones by whoever reads the result; a key that makes the order total makes the places repeatable too.
    """
    spark = df.sparkSession
    order = _order(list(cols), descending)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("__at", F.monotonically_increasing_id()))  # the range's number, then the row's in it
    ranged = materialise_table(ranged.withColumn("__range", F.shiftright("__at", 33)), "places")
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select(F.col("__range").alias("__of"), F.coalesce(F.sum("__n").over(
        Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # a row a range
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return (ranged.join(F.broadcast(before), F.col("__range") == F.col("__of"))
            .withColumn(out, place).drop("__at", "__range", "__of", "__before"))


RANK_METRICS = {
    "median_price": ("median_price", True),
    "listing_count": ("listing_count", True),
    "avg_occupancy": ("avg_occupancy", True),
    "avg_rating": ("avg_rating", True),
}


def rank_by_metric(stats: DataFrame, metric: str, k: int = 10, by: Sequence[str] = ("city",),
                   name_col: str = "neighbourhood_cleansed") -> DataFrame:
    """Metric-selectable ranking of per-area statistics, first k per group."""
    if metric not in RANK_METRICS:
        raise ValueError(f"unknown metric {metric!r}; choose from {sorted(RANK_METRICS)}")
    col, desc = RANK_METRICS[metric]
    return top_k_per_group(stats, k, [col], by=by, descending=desc, tie_break=[name_col])


def cumulative_before(df: DataFrame, value_col: str, order_by: Sequence[str], by: Sequence[str], out: str) -> DataFrame:
    """Running sum of earlier categories (stacking offsets), over a small per-category frame."""
    w = (Window.partitionBy(*by).orderBy(*[F.col(c) for c in order_by])
         .rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(out, F.coalesce(F.sum(value_col).over(w), F.lit(0)))
