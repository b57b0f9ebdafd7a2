"""Exact quantiles without holding a group in one task.

Spark's ``percentile`` is exact, but its final merge keeps a group's whole
value -> count map in a single task: a city holding a third of all rows with
a continuous column (revenue, velocity, occupancy) lands in one reducer.
Here values are selected digit by digit, as in a radix selection:

1. rows are counted per (group, column, first digit) with partial
   aggregation; the digit is a rising arithmetic function of the value
   (``ranks.first_digit``), so no cut points have to be found first.  A running
   sum over those counts tells which slice holds the positions floor(p(n-1))
   and ceil(p(n-1)) of each requested quantile;
2. a wanted slice with more than ``slice_rows`` rows is dealt out by the next
   digit, the place between its least and greatest value, and its rows alone
   are counted again; a slice of one value needs no more than that value;
3. only rows of the wanted slices are collapsed to distinct values with counts
   and numbered by a running sum per slice, which picks the two values;
4. interpolate linearly, exactly as Spark ``percentile`` / pandas
   ``quantile`` / SQL ``PERCENTILE_CONT`` do.

Several columns and probabilities share the passes.  One path serves every
size; the input is read twice and never shuffled as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import col as _c
from ..session import materialise
from .ranks import SLICE_ROWS, dealt_again, first_digit

QuantileSpec = Mapping[str, tuple]  # out name -> (column name or Column, probability)

#: Slices to search (groups x quantiles x 2) that may be broadcast: counted first, and joined by shuffle beyond.
BROADCAST_TARGETS = 100_000


def exact_quantiles(df: DataFrame, specs: QuantileSpec, by: Sequence[str] = (),
                    slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per group (groups with at least one non-null value) with a column per spec.

    ``specs`` maps an output name to ``(value, p)``; ``value`` is a column
    name or any Column expression (``F.when(cond, price)`` gives a
    conditional quantile).  Null values are skipped; null group keys form a
    group (SQL semantics) — filter them first for pandas semantics.
    Building the plan runs the counting job, one more for each further digit.
    """
    by = list(by)
    exprs: list[Column] = []
    index: dict[str, int] = {}
    plan: list[tuple[str, int, float]] = []
    for out, (c, p) in specs.items():
        e = _c(c)
        key = str(e)
        if key not in index:
            index[key] = len(exprs)
            exprs.append(e)
        plan.append((out, index[key], float(p)))

    if len(exprs) == 1:
        long = df.select(*by, F.lit(0).alias("__j"), exprs[0].cast("double").alias("__v"))
    else:
        pairs = F.array(*[F.struct(F.lit(j).alias("__j"), e.cast("double").alias("__v"))
                          for j, e in enumerate(exprs)])
        long = df.select(*by, F.explode(pairs).alias("__s")).select(*by, "__s.__j", "__s.__v")
    long = long.where(F.col("__v").isNotNull())
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(p).alias("p"))
                                 for i, (_, j, p) in enumerate(plan)]))
    pos = (F.col("__n") - F.lit(1)).cast("double") * F.col("__w.p")
    ends = F.explode(F.array(F.struct(F.lit(False).alias("hi"), F.floor(pos).alias("at")),
                             F.struct(F.lit(True).alias("hi"), F.ceil(pos).alias("at"))))
    group = Window.partitionBy(*by, "__j")
    digits = ["__s0"]
    sliced = long.withColumn("__s0", first_digit(F.col("__v")))
    while True:
        keys = [*by, "__j", *digits]
        earlier = group.orderBy(*digits).rowsBetween(Window.unboundedPreceding, -1)
        totals = (sliced.groupBy(*keys).agg(F.count(F.lit(1)).alias("__t"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
                  .withColumn("__before", F.coalesce(F.sum("__t").over(earlier), F.lit(0)))
                  .withColumn("__n", F.sum("__t").over(group)))
        targets = materialise(
            totals.withColumn("__w", wanted).where(F.col("__w.j") == F.col("__j"))
            .withColumn("__pos", pos).withColumn("__e", ends)
            .where((F.col("__before") <= F.col("__e.at")) & (F.col("__e.at") < F.col("__before") + F.col("__t")))
            .select(*keys, "__t", "__lo", "__hi", F.col("__w.i").alias("__i"), F.col("__e.hi").alias("__end"), "__pos",
                    (F.col("__e.at") - F.col("__before")).alias("__k")))
        unequal = F.col("__lo") < F.col("__hi")
        size = targets.agg(F.count(F.lit(1)).alias("n"), F.count_if(unequal & (F.col("__t") > slice_rows)).alias("large")).first()
        few = size.n <= BROADCAST_TARGETS
        if not size.large:
            break
        large = targets.where(unequal & (F.col("__t") > slice_rows)).select(*keys, "__lo", "__hi").distinct()
        digits.append(f"__s{len(digits)}")
        sliced = dealt_again(sliced, "__v", keys, large, digits[-1], few)

    of = {k: f"__of_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(of[k])) for k in keys]

    def sized(t: DataFrame) -> DataFrame:
        t = t.withColumnsRenamed(of)
        return F.broadcast(t) if few else t

    sought = targets.where(unequal)
    inside = (sliced.join(sized(sought.select(*keys).distinct()), same, "leftsemi")
              .groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__cnt")))
    run = Window.partitionBy(*keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = inside.withColumn("__prior", F.coalesce(F.sum("__cnt").over(run), F.lit(0)))
    found = ranked.join(sized(sought.select(*keys, "__i", "__end", "__pos", "__k")), [
        *same, F.col("__prior") <= F.col("__k"), F.col("__k") < F.col("__prior") + F.col("__cnt")])
    picks = [*by, "__i", "__end", "__pos", "__v"]
    found = found.select(*picks).unionByName(targets.where(~unequal).withColumn("__v", F.col("__lo")).select(*picks))
    picked = found.groupBy(*by).agg(*[
        F.max(F.when((F.col("__i") == i) & (F.col("__end") == F.lit(hi)), F.struct("__pos", "__v"))).alias(f"__{name}{i}")
        for i in range(len(plan)) for name, hi in (("lo", False), ("hi", True))])
    outs = []
    for i, (out, _, _) in enumerate(plan):
        pos, xl, xh = F.col(f"__lo{i}.__pos"), F.col(f"__lo{i}.__v"), F.col(f"__hi{i}.__v")
        lo, hi = F.floor(pos), F.ceil(pos)
        outs.append(F.when((hi == lo) | (xh == xl), xl).otherwise((hi - pos) * xl + (pos - lo) * xh).alias(out))
    return picked.select(*by, *outs)


def merge_group_rows(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Put two one-row-per-group frames side by side without a join.

    Both frames are stacked (missing columns null) and folded per group with
    ``first(ignorenulls)``: null group keys match each other, the global case
    (no keys) needs no constant-key join, and the shuffle carries one row per
    group and side.  Groups present on the right only are dropped (left
    semantics).
    """
    by = list(by)
    lcols = [c for c in left.columns if c not in by]
    rcols = [c for c in right.columns if c not in by and c not in lcols]
    stacked = (left.select(*by, *lcols, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in rcols],
                           F.lit(True).alias("__left"))
               .unionByName(right.select(*by, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols],
                                         *rcols, F.lit(None).cast("boolean").alias("__left"))))
    folded = stacked.groupBy(*by).agg(*[F.first(c, ignorenulls=True).alias(c) for c in [*lcols, *rcols, "__left"]])
    return folded.where(F.col("__left")).select(*by, *lcols, *rcols)
