"""Joins (J01-J10).

Equi-joins are left to Catalyst + AQE (sort-merge or shuffled hash, skew
splitting, runtime conversion to broadcast when a side is measured small):
no side is broadcast by a hint here.  Callers that attach a row per city, or
areas they counted, hint it: AQE keeps a sort-merge join whose keys fill few
partitions, and a detail table would then go to as many tasks as keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-key aggregate (or dimension) back onto detail rows."""
    return df.join(stats, list(keys), how)


def inner_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on a composite key."""
    return left.join(right, list(keys), "inner")


def lookup(df: DataFrame, col: str, mapping: Mapping[str, str], out: str, default: str | None = "Other") -> DataFrame:
    """Dictionary lookup with a default; the dictionary is a literal map (bounded size)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    value = m[F.col(col)]
    return df.withColumn(out, F.coalesce(value, F.lit(default)) if default is not None else value)


def merge_into_features(features: DataFrame, stats: DataFrame, keys: Sequence[str],
                        defaults: Mapping[str, object] | None = None,
                        name_field: str = "neighbourhood") -> DataFrame:
    """Merge per-area statistics into each feature's ``properties``.

    ``features`` has ``city``, ``feature`` (struct with ``properties``) and
    the join key(s); unmatched features receive ``defaults`` (0 for counts
    by default, null otherwise).
    """
    defaults = dict(defaults or {})
    stat_cols = [c for c in stats.columns if c not in keys]
    j = features.join(stats, list(keys), "left")
    props = F.col("feature.properties")
    for c in stat_cols:
        v = F.col(c)
        if c in defaults:
            v = F.coalesce(v, F.lit(defaults[c]))
        props = props.withField(c, v)
    return j.withColumn("feature", F.col("feature").withField("properties", props)).drop(*stat_cols)


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep rows whose key is in a key set."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def complete_axis(df: DataFrame, axis_col: str, values: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """Re-index on a complete axis (e.g. months 1-12); missing points are null rows.

    The axis is a literal sequence; the group keys come from the data.
    """
    axis = F.explode(F.sequence(F.lit(min(values)), F.lit(max(values)))).alias(axis_col) \
        if list(values) == list(range(min(values), max(values) + 1)) else \
        F.explode(F.array(*[F.lit(v) for v in values])).alias(axis_col)
    if by:
        grid = df.select(*by).distinct().select(*by, axis)
    else:
        grid = df.sparkSession.range(1).select(axis)
    dtype = df.schema[axis_col].dataType
    grid = grid.withColumn(axis_col, F.col(axis_col).cast(dtype if not isinstance(dtype, T.NullType) else "int"))
    return grid.join(df, list(by) + [axis_col], "left")
