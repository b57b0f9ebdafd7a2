"""Star-schema builders.

Dimensions are aggregates (small); facts are projections conformed to the
published schemas.  Keep-first de-duplication uses ``min(struct(order,
...))`` — an aggregate with map-side combine — rather than a window, so a
host owning a third of all listings never lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_parts, greater_than_flag, month_name, round_aggregate, title_case
from ..operators.aggregates import agg_with_quantiles
from ..operators.windows import surrogate_key
from ..schema import (DIM_DATE, DIM_HOST, DIM_NEIGHBOURHOOD, DIM_PROPERTY_TYPE, DIM_ROOM_TYPE,
                      FACT_CALENDAR, FACT_LISTINGS, FACT_REVIEWS, conform)

HOST_COLUMNS = [c.name for c in DIM_HOST.fields if c.name not in ("host_id", "city")]


def keep_first(df: DataFrame, keys: list[str], order_col: str, cols: list[str]) -> DataFrame:
    """First row per key by ``order_col`` (deterministic), as an aggregate."""
    first = F.min(F.struct(F.col(order_col).alias("__o"), *[F.col(c) for c in cols])).alias("__f")
    out = df.groupBy(*keys).agg(first)
    return out.select(*keys, *[F.col(f"__f.{c}").alias(c) for c in cols])


def dim_host(listings: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per (host_id, city); attributes of the host's lowest listing id.

    ``columns`` restricts the attributes (and the keep-first struct) to those
    a caller joins: Catalyst cannot prune fields inside ``min(struct(...))``,
    so a narrow request reads only its columns.
    """
    df = listings
    if "is_commercial_host" not in df.columns and "calculated_host_listings_count" in df.columns:
        df = df.withColumn("is_commercial_host", greater_than_flag("calculated_host_listings_count", 1))
    cols = [c for c in (columns or HOST_COLUMNS) if c in df.columns]
    out = keep_first(df.where(F.col("host_id").isNotNull()), ["host_id", "city"], "id", cols)
    return out if columns else conform(out, DIM_HOST)


def dim_neighbourhood(listings: DataFrame, neighbourhoods: DataFrame, normalise_listing_names: bool = True) -> DataFrame:
    """Reference areas left-joined with per-area stats (areas without listings keep nulls).

    The listing-side name is title-cased like the reference side unless
    ``normalise_listing_names=False`` (reproduces case-mismatch misses).
    """
    name = title_case("neighbourhood_cleansed") if normalise_listing_names else F.col("neighbourhood_cleansed")
    named = listings.where(F.col("neighbourhood_cleansed").isNotNull()).select(
        "city", name.alias("neighbourhood"), "id", "price", "review_scores_rating", "occupancy_rate")
    stats = agg_with_quantiles(named, ["city", "neighbourhood"],
                               [F.count("id").alias("listing_count"), F.avg("review_scores_rating").alias("avg_rating"),
                                F.avg("occupancy_rate").alias("avg_occupancy")],
                               {"median_price": ("price", 0.5)},
                               order=["listing_count", "median_price", "avg_rating", "avg_occupancy"])
    stats = stats.withColumns({c: round_aggregate(c, 2) for c in ["median_price", "avg_rating", "avg_occupancy"]})
    out = neighbourhoods.join(stats, ["city", "neighbourhood"], "left")
    return conform(out, DIM_NEIGHBOURHOOD)


def dim_room_type(listings: DataFrame) -> DataFrame:
    """Per (city, room type) count / mean price / mean occupancy (2 dp) + surrogate key."""
    s = (listings.where(F.col("room_type").isNotNull()).groupBy("city", "room_type")
         .agg(F.count("id").alias("listing_count"), F.avg("price").alias("avg_price"),
              F.avg("occupancy_rate").alias("avg_occupancy")))
    s = s.withColumns({"avg_price": round_aggregate("avg_price", 2), "avg_occupancy": round_aggregate("avg_occupancy", 2)})
    return conform(surrogate_key(s, ["room_type"], "room_type_id"), DIM_ROOM_TYPE)


def dim_property_type(listings: DataFrame) -> DataFrame:
    """B09."""
    s = (listings.where(F.col("property_type").isNotNull()).groupBy("city", "property_type")
         .agg(F.count("id").alias("listing_count"), F.avg("price").alias("avg_price")))
    s = s.withColumn("avg_price", round_aggregate("avg_price", 2))
    return conform(surrogate_key(s, ["property_type"], "property_type_id"), DIM_PROPERTY_TYPE)


def dim_date(reviews: DataFrame, calendar: DataFrame) -> DataFrame:
    """Distinct review and calendar dates per city, with calendar parts and a key per city."""
    r = reviews.select("city", F.col("date").cast("date").alias("date"))
    c = calendar.select("city", F.col("date").cast("date").alias("date"))
    dates = r.unionByName(c).where(F.col("date").isNotNull()).distinct()
    d = calendar_parts(dates, "date").withColumn("month_name", month_name("date")) \
                                     .withColumn("quarter", F.quarter("date"))
    return conform(surrogate_key(d, ["date"], "date_id"), DIM_DATE)


def fact_listings(enriched: DataFrame) -> DataFrame:
    """B11."""
    return conform(enriched.withColumnRenamed("id", "listing_id"), FACT_LISTINGS)


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """B12."""
    return conform(reviews.withColumnRenamed("id", "review_id"), FACT_REVIEWS)


def fact_calendar(calendar: DataFrame) -> DataFrame:
    """B13."""
    return conform(calendar, FACT_CALENDAR)
