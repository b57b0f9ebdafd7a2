"""Enrichment builder (B05): listings + occupancy -> benchmarks, tiers, velocity, revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import age_years, pct_deviation, price_tier, round_aggregate, round_even, row_mean, safe_ratio
from ..operators.aggregates import agg_with_quantiles
from ..operators.joins import attach
from ..operators.quantiles import BROADCAST_TARGETS, exact_quantiles, merge_group_rows

REVIEW_SCORE_COLUMNS = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value",
]


def join_occupancy(listings: DataFrame, occupancy: DataFrame) -> DataFrame:
    """Listings (key ``id``) left-joined with the per-listing occupancy summary."""
    occ = occupancy.select(F.col("city").alias("__c"), F.col("listing_id").alias("__id"),
                           "total_days", "available_days", "booked_days", "occupancy_rate")
    return (listings.join(occ, (F.col("id") == F.col("__id")) & (F.col("city") == F.col("__c")), "left")
                    .drop("__c", "__id"))


def price_quantile_levels(listings: DataFrame, key: str = "neighbourhood_cleansed") -> tuple[DataFrame, DataFrame]:
    """Area medians and city quartiles of non-null prices from one distinct-value table.

    Each priced listing counts at two levels, its (city, area) and its city
    (grouping sets as a two-element explode), so one quantile pass answers
    both; the per-group result (one row per area and city) is checkpointed
    because the enrichment reads it twice.
    """
    from ..session import materialise
    priced = listings.where(F.col("price").isNotNull())
    levels = F.explode(F.array(
        F.struct(F.col(key).alias("__area"), F.lit(0).alias("__level")),
        F.struct(F.lit(None).cast(listings.schema[key].dataType).alias("__area"), F.lit(1).alias("__level"))))
    x = priced.select("city", levels.alias("__l"), "price").select("city", "__l.__area", "__l.__level", "price")
    q = materialise(exact_quantiles(x, {"median": ("price", 0.5), "p25": ("price", 0.25), "p75": ("price", 0.75)},
                                    ["city", "__area", "__level"]))
    area = q.where((F.col("__level") == 0) & F.col("__area").isNotNull()).select(
        "city", F.col("__area").alias(key), F.col("median").alias("neighbourhood_median_price"))
    city = q.where(F.col("__level") == 1).select("city", F.col("p25").alias("price_p25"), F.col("p75").alias("price_p75"))
    return area, city


def neighbourhood_benchmarks(listings: DataFrame, key: str = "neighbourhood_cleansed",
                             medians: DataFrame | None = None) -> DataFrame:
    """Per (city, area) statistics over priced listings, rounded half-even to 2 dp (null areas dropped).

    ``medians`` (city, area, neighbourhood_median_price) may come precomputed
    from ``price_quantile_levels``.
    """
    priced = listings.where(F.col("price").isNotNull() & F.col(key).isNotNull())
    aggs = [F.avg("price").alias("neighbourhood_mean_price"),
            F.count("id").alias("neighbourhood_listing_count"),
            F.avg("review_scores_rating").alias("neighbourhood_avg_rating"),
            F.avg("occupancy_rate").alias("neighbourhood_avg_occupancy")]
    if medians is None:
        stats = agg_with_quantiles(priced, ["city", key], aggs, {"neighbourhood_median_price": ("price", 0.5)})
    else:
        stats = merge_group_rows(priced.groupBy("city", key).agg(*aggs), medians, ["city", key])
    return stats.withColumns({c: round_aggregate(c, 2) for c in
                              ["neighbourhood_median_price", "neighbourhood_mean_price",
                               "neighbourhood_avg_rating", "neighbourhood_avg_occupancy"]})


def enrich_listings(listings: DataFrame, occupancy: DataFrame,
                    review_cols: Sequence[str] = REVIEW_SCORE_COLUMNS, checkpoint: bool = True) -> DataFrame:
    """J01 -> A03+J02 -> F19 -> F25 -> F14/F18 -> F21 -> F20.

    ``listings`` is the output of ``clean_listings`` (has ``scrape_date``).
    With ``checkpoint`` the listings joined with their occupancy are written
    once as Parquet to the shared checkpoint folder: the area medians, the
    city tier quantiles and the final projection all read them (pruned to
    their columns), so the calendar aggregate behind the occupancy runs once
    instead of once per branch.
    """
    df = join_occupancy(listings, occupancy)
    if checkpoint:
        from ..session import materialise_table
        df = materialise_table(df, "listings_occupancy")
    area_medians, city_quartiles = price_quantile_levels(df)
    areas = neighbourhood_benchmarks(df, medians=area_medians)
    # one row per area, as many as medians: counted, and broadcast unless there are very many, as a join by area
    # would send each area's listings to one task
    if area_medians.count() <= BROADCAST_TARGETS:
        areas = F.broadcast(areas)
    df = attach(df, areas, ["city", "neighbourhood_cleansed"])
    df = df.withColumn("price_vs_neighbourhood",
                       round_even(pct_deviation("price", "neighbourhood_median_price"), 2))
    # one row per city: bounded, broadcast
    df = attach(df, F.broadcast(city_quartiles), ["city"])
    df = df.withColumn("price_tier", price_tier("price", "price_p25", "price_p75")).drop("price_p25", "price_p75")
    if "first_review" in df.columns:
        df = df.withColumn("listing_age_years", age_years(F.col("scrape_date"), F.col("first_review")))
        df = df.withColumn("review_velocity",
                           round_even(safe_ratio(F.col("number_of_reviews"), F.col("listing_age_years")), 2))
    present = [c for c in review_cols if c in df.columns]
    if present:
        df = df.withColumn("review_score_composite", round_even(row_mean(present), 3))
    return df.withColumn("estimated_annual_revenue", round_even(F.col("price") * F.col("booked_days"), 2))
