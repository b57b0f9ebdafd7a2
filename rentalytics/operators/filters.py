"""Projections and filters.

Every filter here is a plain Catalyst predicate, so it reaches the Parquet
scan as a pushed filter and partition filters prune ``city`` folders.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import col as _c


def drop_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop the named columns that exist (missing ones are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns with no non-null value, found in one aggregate pass (one row to the driver)."""
    if not df.columns:
        return []
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] == 0]


def drop_all_null_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop 100 %-null columns (a data-dependent schema; costs one scan)."""
    keep = set(keep)
    return df.drop(*[c for c in all_null_columns(df) if c not in keep])


def select_present(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order (Parquet prunes the scan to them)."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """P04."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """P05."""
    return df.withColumn(name, F.lit(value))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """P06."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def in_list(df: DataFrame, col, values: Iterable) -> DataFrame:
    """P07."""
    return df.where(_c(col).isin(list(values)))


def between(df: DataFrame, col, low, high) -> DataFrame:
    """P08 (inclusive)."""
    return df.where(_c(col).between(low, high))


def where_all(df: DataFrame, *conds: Column) -> DataFrame:
    """Conjunction of predicates."""
    cond = F.lit(True)
    for c in conds:
        cond = cond & c
    return df.where(cond)


def listing_filter(df: DataFrame, *, cities: Iterable[str] | None = None,
                   room_types: Iterable[str] | None = None,
                   price_range: tuple[float, float] | None = None,
                   max_min_nights: float | None = None,
                   city_col: str = "city", room_col: str = "room_type",
                   price_col: str = "price", nights_col: str = "minimum_nights") -> DataFrame:
    """P10: the dashboard's composed filter; parameters become predicates, never SQL text."""
    df = not_null(df, price_col)
    if cities is not None:
        df = in_list(df, city_col, cities)
    if room_types is not None:
        df = in_list(df, room_col, room_types)
    if price_range is not None:
        df = between(df, price_col, *price_range)
    if max_min_nights is not None:
        df = where_all(df, F.col(nights_col) <= max_min_nights)
    return df  # Catalyst merges the chained filters into one pushed-down predicate


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or any of ``subset``) column."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def cap_by_group(df: DataFrame, value_col: str, caps: Mapping[str, float], group_col: str = "city",
                 default: float | None = None) -> DataFrame:
    """Keep ``value <= cap`` of the row's group (caps table is tiny; a CASE expression)."""
    cap = None
    for k, v in caps.items():
        cap = F.when(F.col(group_col) == k, F.lit(v)) if cap is None else cap.when(F.col(group_col) == k, F.lit(v))
    cap = cap.otherwise(F.lit(default)) if default is not None else cap
    return df.where(F.col(value_col) <= cap)


def quantile_trim(df: DataFrame, value_col: str, q: float, by: Sequence[str] = ("city",)) -> DataFrame:
    """Keep rows with ``value <= quantile_q`` of their group (exact, interpolated)."""
    from .quantiles import exact_quantiles
    by = list(by)
    qs = exact_quantiles(df, {"__q": (value_col, q)}, by)
    return df.join(qs, by, "inner").where(F.col(value_col) <= F.col("__q")).drop("__q")


def is_true(df: DataFrame, col) -> DataFrame:
    """Boolean match; nulls fall out on both sides."""
    return df.where(_c(col) == F.lit(True))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42, by: Sequence[str] = ()) -> DataFrame:
    """Reproducible sample of at most ``n`` rows, of all or of each group (top-n by a seeded hash; n is the
    feature).

    Integer keys use ``mix32`` (portable: the same sample in any engine);
    other keys ``xxhash64``.  Top-n keeps n rows per task before the merge.
    """
    from pyspark.sql import types as T
    from ..functions.numeric import mix32
    integral = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    h = mix32(key, seed) if integral else F.xxhash64(F.col(key), F.lit(seed))
    if by:  # a rank filter: Spark keeps n rows of a group in each task before the shuffle
        w = Window.partitionBy(*by).orderBy(h, F.col(key))
        return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")
    return df.orderBy(h, F.col(key)).limit(n)


def is_empty(df: DataFrame) -> bool:
    """P16."""
    return df.isEmpty()
