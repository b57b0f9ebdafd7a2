"""Distributed average ranks with ties.

``rank() over (order by v)`` without a partition key runs in one task.
Here ranks are computed without ever ordering all rows in one place:

1. collapse the sample to distinct values with counts (partial aggregation;
   a hot value costs one row per task);
2. deal the values out by a first digit, an arithmetic and rising function of
   the value (its logarithm on a scale of 16 bits), so that every branch of
   the plan, and every re-run of a lost task, agrees on a value's slice; a
   slice with too many values is dealt out again by its next digit, the place
   between its least and its greatest value on a scale of 16 bits;
3. a running sum of counts per slice and stratum (a window whose partitions
   are bounded by the slice size);
4. per-slice totals (slices x strata rows) give each slice's offset with a
   running sum over that small table, joined back by slice and stratum;
5. mid-rank = rows before + (count + 1) / 2, equal to pandas ``rank()``.

One path serves every size; slices grow in number with the values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

#: Rows of a slice that one task may sort; a larger slice of unequal values is dealt out by its next digit.
SLICE_ROWS = 1_000_000
#: The first digit: steps for each unit of the logarithm, up to more than that of any double.
STEPS, MOST = 46, 710.0
DIGIT = 1 << 16


def first_digit(value: Column) -> Column:
    """A rising function of a value, on a scale of 16 bits; NaN comes last."""
    v = value.cast("double")
    scaled = F.signum(v) * F.least(F.log1p(F.abs(v)), F.lit(MOST)) * F.lit(STEPS)
    return F.when(F.isnan(v), F.lit(DIGIT)).otherwise(F.floor(scaled)).cast("int")


def next_digit(value: Column, lo: Column, hi: Column) -> Column:
    """A value's place between the least and the greatest value of its slice: it rises, and parts these two."""
    place = F.floor((value.cast("double") - lo) / (hi - lo) * F.lit(DIGIT))
    return F.least(place, F.lit(DIGIT - 1)).cast("int")


def dealt_again(rows: DataFrame, value: str, keys: Sequence[str], large: DataFrame, digit: str, few: bool) -> DataFrame:
    """Rows with the next ``digit`` of their value if their slice is in ``large`` (keys, __lo, __hi), else 0."""
    slices = large.select(*[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__lo").alias("__from"), F.col("__hi").alias("__to"))
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    joined = rows.join(F.broadcast(slices) if few else slices, same, "left")
    at = F.when(F.col("__to").isNull(), F.lit(0)).otherwise(next_digit(F.col(value), F.col("__from"), F.col("__to")))
    return joined.withColumn(digit, at).drop(*[f"__of_{k}" for k in keys], "__from", "__to")


def midranks(counts: DataFrame, value: str, by: Sequence[str] = (), count_col: str = "cnt",
             slice_rows: int = SLICE_ROWS, with_total: bool = False) -> DataFrame:
    """Add ``before`` (rows with a smaller value in the stratum) and ``midrank`` to a value-count frame.

    ``counts`` has one row per (by..., value) with ``count_col``; any other
    columns (per-class counts, say) are carried along.  It is read at least
    twice, so pass a materialised frame.  ``with_total`` also adds
    ``group_n``, the stratum's total count.  Null stratum keys form a stratum
    of their own (SQL GROUP BY semantics).
    """
    by = list(by)
    digits = ["__s0"]
    sliced = counts.withColumn("__s0", first_digit(F.col(value)))
    v = F.col(value).cast("double")
    while True:
        keys = [*by, *digits]
        totals = materialise(sliced.groupBy(*keys).agg(F.sum(count_col).alias("__tot"), F.count(F.lit(1)).alias("__n"),
                                                       F.min(v).alias("__lo"), F.max(v).alias("__hi")))
        large = totals.where((F.col("__n") > slice_rows) & (F.col("__lo") < F.col("__hi")))
        if large.isEmpty():
            break
        digits.append(f"__s{len(digits)}")
        sliced = dealt_again(sliced, value, keys, large, digits[-1], few=False)
    w_local = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("__local", F.coalesce(F.sum(count_col).over(w_local), F.lit(0)))
    w_all = Window.partitionBy(*by)
    w_off = w_all.orderBy(*digits).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__off", F.coalesce(F.sum("__tot").over(w_off), F.lit(0)))
    if with_total:
        offsets = offsets.withColumn("group_n", F.sum("__tot").over(w_all))
    offsets = offsets.select(*[F.col(k).alias(f"__of_{k}") for k in keys], "__off", *(["group_n"] if with_total else []))
    out = local.join(offsets, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    out = out.withColumn("before", F.col("__off") + F.col("__local"))
    out = out.withColumn("midrank", F.col("before") + (F.col(count_col) + F.lit(1)) / F.lit(2.0))
    return out.drop(*digits, *[f"__of_{k}" for k in keys], "__local", "__off")


def rank_values(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Average rank of every row's value within its stratum (rows keep their identity)."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("cnt"))
    r = midranks(counts, value, by).select(*by, value, "midrank")
    return df.join(r, [*by, value], "left")
