"""Published table schemas (S14) and conform-to-schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_L, _I, _D, _B, _S, _DT = (T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
                           T.StringType(), T.DateType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_HOST = _struct(
    ("host_id", _L), ("city", _S), ("host_name", _S), ("host_since", _DT), ("host_location", _S),
    ("host_response_time", _S), ("host_response_rate", _D), ("host_acceptance_rate", _D),
    ("host_is_superhost", _B), ("host_has_profile_pic", _B), ("host_identity_verified", _B),
    ("host_listings_count", _D), ("host_total_listings_count", _D), ("host_tenure_years", _D),
    ("is_commercial_host", _B))

DIM_NEIGHBOURHOOD = _struct(
    ("neighbourhood_id", _I), ("city", _S), ("neighbourhood", _S), ("neighbourhood_group", _S),
    ("geometry_type", _S), ("listing_count", _L), ("median_price", _D), ("avg_rating", _D),
    ("avg_occupancy", _D))

DIM_ROOM_TYPE = _struct(("room_type_id", _I), ("city", _S), ("room_type", _S), ("listing_count", _L),
                        ("avg_price", _D), ("avg_occupancy", _D))

DIM_PROPERTY_TYPE = _struct(("property_type_id", _I), ("city", _S), ("property_type", _S),
                            ("listing_count", _L), ("avg_price", _D))

DIM_DATE = _struct(("date_id", _I), ("city", _S), ("date", _DT), ("year", _I), ("month", _I),
                   ("month_name", _S), ("quarter", _I), ("day_of_week", _S), ("is_weekend", _B))

FACT_LISTINGS = _struct(
    ("listing_id", _L), ("city", _S), ("host_id", _L), ("neighbourhood_cleansed", _S), ("room_type", _S),
    ("property_type", _S), ("property_type_grouped", _S), ("price", _D), ("price_per_bedroom", _D),
    ("price_vs_neighbourhood", _D), ("price_tier", _S), ("minimum_nights", _D), ("maximum_nights", _I),
    ("availability_30", _I), ("availability_60", _I), ("availability_90", _I), ("availability_365", _I),
    ("number_of_reviews", _I), ("number_of_reviews_ltm", _I), ("number_of_reviews_l30d", _I),
    ("reviews_per_month", _D), ("review_scores_rating", _D), ("review_scores_accuracy", _D),
    ("review_scores_cleanliness", _D), ("review_scores_checkin", _D), ("review_scores_communication", _D),
    ("review_scores_location", _D), ("review_scores_value", _D), ("review_score_composite", _D),
    ("review_velocity", _D), ("occupancy_rate", _D), ("booked_days", _L), ("available_days", _L),
    ("total_days", _L), ("estimated_annual_revenue", _D), ("host_tenure_years", _D),
    ("instant_bookable", _B), ("has_availability", _B), ("calculated_host_listings_count", _I),
    ("last_scraped", _DT))

FACT_REVIEWS = _struct(("review_id", _L), ("city", _S), ("listing_id", _L), ("reviewer_id", _L),
                       ("reviewer_name", _S), ("date", _DT), ("comment_length", _I), ("review_year", _I),
                       ("review_month", _I), ("review_year_month", _S))

FACT_CALENDAR = _struct(("listing_id", _L), ("city", _S), ("date", _DT), ("available", _B),
                        ("minimum_nights", _I), ("maximum_nights", _I), ("day_of_week", _S),
                        ("month", _I), ("year", _I), ("year_month", _S), ("is_weekend", _B))

OCCUPANCY_SUMMARY = _struct(("listing_id", _L), ("city", _S), ("total_days", _L), ("available_days", _L),
                            ("booked_days", _L), ("occupancy_rate", _D))

TABLES = {
    "dim_host": DIM_HOST, "dim_neighbourhood": DIM_NEIGHBOURHOOD, "dim_room_type": DIM_ROOM_TYPE,
    "dim_property_type": DIM_PROPERTY_TYPE, "dim_date": DIM_DATE, "fact_listings": FACT_LISTINGS,
    "fact_reviews": FACT_REVIEWS, "fact_calendar": FACT_CALENDAR,
}


def conform(df: DataFrame, schema: T.StructType, *, keep_extra: bool = False) -> DataFrame:
    """Project onto a schema — cast present columns, add missing ones as typed nulls.

    Casting uses ``try_cast`` so a malformed value becomes null instead of
    failing the job under ANSI mode.
    """
    cols = []
    present = set(df.columns)
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*cols)
