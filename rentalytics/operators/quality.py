"""Data-quality operators (Q01-Q06)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.config import OTHER_GROUP


def listing_rule_counts(listings: DataFrame, extreme_price: float = 100_000) -> DataFrame:
    """Q01/Q02: rule violations per city in long form (city, rule, violations).

    ``listings`` is cleaned (has the per-city bounds from the config join).
    A null coordinate counts as outside; cities without configured bounds
    get a null count for the coordinate rule.  The negative-price rule can
    never fire because the currency parser drops the minus sign (kept).
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    inside = lat.between(F.col("lat_min"), F.col("lat_max")) & lon.between(F.col("lon_min"), F.col("lon_max"))
    has_bounds = F.col("lat_min").isNotNull()
    rules = {
        "negative_price": F.col("price") < 0,
        "zero_price": F.col("price") == 0,
        "extreme_price": F.col("price") > extreme_price,
        "outside_coordinates": has_bounds & ~F.coalesce(inside, F.lit(False)),
        "accommodates_below_1": F.col("accommodates") < 1,
        "minimum_nights_over_365": F.col("minimum_nights") > 365,
    }
    wide = listings.groupBy("city").agg(
        *[F.count_if(cond).alias(name) for name, cond in rules.items()],
        F.max(has_bounds.cast("int")).alias("__bounds"))
    wide = wide.withColumn("outside_coordinates", F.when(F.col("__bounds") == 1, F.col("outside_coordinates")))
    return wide.unpivot("city", list(rules), "rule", "violations")


def unmapped_categories(listings: DataFrame, raw_col: str = "property_type",
                        group_col: str = "property_type_grouped") -> DataFrame:
    """Q03: raw values that fell into the default group, with counts."""
    return (listings.where(F.col(group_col) == OTHER_GROUP).groupBy("city", raw_col)
            .agg(F.count(F.lit(1)).alias("count")))


def audit(stages: Mapping[str, DataFrame], cols: Sequence[str] = ()) -> DataFrame:
    """Q04: before / after audit: rows and null counts of each named stage, one aggregate per stage."""
    from .sets import concat_labelled
    return concat_labelled({name: df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols]) for name, df in stages.items()}, "stage")


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Q05: keys that occur more than once (declared primary keys must return no rows)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def unknown_tenants(requested: DataFrame, config: DataFrame, col: str = "city") -> DataFrame:
    """Q06: requested tenants without configuration."""
    return requested.select(col).distinct().join(config.select(col), col, "left_anti")


def reject_unknown_tenants(spark, cities: Sequence[str], config: DataFrame) -> None:
    """Q06: fail fast when a requested city has no configuration (list is small, user input)."""
    req = spark.createDataFrame([(c,) for c in cities], "city string")
    bad = [r.city for r in unknown_tenants(req, config).collect()]
    if bad:
        raise ValueError(f"unknown cities: {sorted(bad)}")
