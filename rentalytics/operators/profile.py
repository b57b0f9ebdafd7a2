"""Profiling operators.

Each profile is a single aggregate over all requested columns (one scan),
unpivoted into one row per column; only the small profile reaches the
driver when a caller asks for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import round_aggregate

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def describe(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = (), digits: int = 2,
             method: str = "distributed") -> DataFrame:
    """Count, mean, std (ddof 1), min, q25, q50, q75, max per column — exact quantiles, rounded half-even.

    Output: group keys, ``column``, the eight statistics.  The quantiles of
    all columns come from one rank-based plan (``method="distributed"``) or
    from Spark ``percentile`` (``"exact"``).
    """
    from .aggregates import agg_with_quantiles
    cols = list(cols) if cols is not None else numeric_columns(df)
    aggs, specs = [], {}
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        specs.update({f"q{i}_0": (v, 0.25), f"q{i}_1": (v, 0.5), f"q{i}_2": (v, 0.75)})
    wide = agg_with_quantiles(df, by, aggs, specs, method)
    r = lambda x: round_aggregate(x, digits)
    rows = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), r(F.col(f"m{i}")).alias("mean"),
        r(F.col(f"s{i}")).alias("std"), r(F.col(f"lo{i}")).alias("min"), r(F.col(f"q{i}_0")).alias("q25"),
        r(F.col(f"q{i}_1")).alias("q50"), r(F.col(f"q{i}_2")).alias("q75"), r(F.col(f"hi{i}")).alias("max"))
        for i, c in enumerate(cols)])).alias("d")
    return wide.select(*by, rows).select(*by, "d.*")


def _null_counts(df: DataFrame) -> DataFrame:
    """(column, null_count, null_pct, total_rows) for every column, from one aggregate."""
    total = F.count(F.lit(1))
    wide = df.agg(total.alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"__{i}") for i, c in enumerate(df.columns)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__{i}").alias("null_count"))
                               for i, c in enumerate(df.columns)])).alias("p")
    return wide.select("__n", rows).select(
        "p.column", "p.null_count", round_aggregate(F.col("p.null_count") / F.col("__n") * 100, 2).alias("null_pct"),
        F.col("__n").alias("total_rows"))


def null_profile(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Null count and % per column (one pass); by default only columns with nulls."""
    out = _null_counts(df).drop("total_rows")
    return out.where(F.col("null_count") > 0) if only_positive else out


def first_values(df: DataFrame, cols: Sequence[str], order_col: str, k: int = 3) -> DataFrame:
    """The first k non-null values of each column in ``order_col`` order (as text).

    One scan: every non-null cell becomes a (column, position, value) row and
    a row_number window per column keeps the first k.  Spark evaluates that
    limit partially before the shuffle (``WindowGroupLimit``), so at most k
    rows per column and task move; nothing unbounded is gathered.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                for c in cols])).alias("__c")
    long = (df.select(F.col(order_col).alias("position"), cells)
              .select("__c.column", "position", "__c.value").where(F.col("value").isNotNull()))
    w = Window.partitionBy("column").orderBy(F.col("position").asc_nulls_last())
    return long.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r")


def column_profile(df: DataFrame, order_col: str, k: int = 3, samples_as_text: bool = False) -> DataFrame:
    """Per column dtype, nulls, null %, total rows and the first k sample values.

    ``samples_as_text`` renders the samples as one ``[a, b, c]`` string
    (``sample_values``), the form the profile report (S11) stores.
    """
    cols = [c for c in df.columns if c != order_col]
    nulls = _null_counts(df.select(*cols))
    samples = first_values(df, cols, order_col, k).groupBy("column").agg(
        F.sort_array(F.collect_list(F.struct("position", "value"))).alias("s"))  # k values per column
    types = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes if c != order_col], "column string, dtype string")
    out = types.join(nulls, "column", "left").join(samples, "column", "left")
    out = out.withColumn("samples", F.transform("s", lambda x: x["value"])).drop("s")
    if samples_as_text:
        out = out.withColumn("samples", F.concat(F.lit("["), F.array_join("samples", ", "), F.lit("]"))) \
                 .withColumnRenamed("samples", "sample_values")
    return out


def row_fingerprint(df: DataFrame, cols: Sequence[str]):
    """256-bit fingerprint of the listed columns: SHA-256 of the row's JSON encoding.

    ``to_json`` of a struct is injective for a fixed schema (a null field is
    omitted, so null equals null); signed zeros are normalised first so the
    fingerprint groups values exactly as ``GROUP BY`` does.
    """
    parts = []
    for c in cols:
        t = df.schema[c].dataType
        v = F.col(c)
        if isinstance(t, (T.FloatType, T.DoubleType)):
            v = v + F.lit(0.0).cast(t)  # -0.0 + 0.0 = 0.0
        parts.append(v.alias(c))
    return F.unhex(F.sha2(F.to_json(F.struct(*parts)), 256))


def duplicate_counts(df: DataFrame, key: Sequence[str] | None = None, fingerprint: bool = True) -> DataFrame:
    """A10: exact-duplicate rows and duplicate keys (null equals null), as one row.

    Grouping (not ``count(distinct)``) keeps null-bearing rows and lets
    Spark pre-aggregate before the shuffle, so a hot value costs one
    partial row per task.  Rows are grouped by key and rest, then by key, so
    each value is read and hashed once.  With ``fingerprint`` the grouping
    keys are 32-byte SHA-256 values instead of the columns themselves, so
    long texts never travel through the shuffle.
    """
    key = list(key or [])
    rest = [c for c in df.columns if c not in key]

    def grouping(cols: list[str], name: str) -> list[Column]:
        return [row_fingerprint(df, cols).alias(name)] if fingerprint and cols else [F.col(c) for c in cols]

    keys = grouping(key, "__key")
    rows = df.groupBy(*keys, *grouping(rest, "__rest")).agg(F.count(F.lit(1)).alias("__n"))
    per_key = rows.groupBy(*([F.col("__key")] if fingerprint and key else [F.col(c) for c in key])).agg(
        F.sum("__n").alias("__rows"), F.sum(F.col("__n") - 1).alias("__again"))
    out = per_key.agg(F.sum("__rows").alias("total_rows"), F.sum("__again").alias("duplicate_rows"),
                      F.sum(F.col("__rows") - 1).alias("duplicate_keys"))
    return out if key else out.drop("duplicate_keys")
