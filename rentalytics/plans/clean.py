"""Cleaning builders (B01-B04): raw frames -> typed, derived frames.

Every builder is one lazy plan: projections and expressions fuse into a
single whole-stage-codegen span; the only shuffles are the aggregates the
semantics require (per-city source check, occupancy per listing).
Builders look only at *schemas* to choose a parse, never at data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (age_years, calendar_parts, fill_text, greater_than_flag, lenient_date_of,
                         parse_bool, parse_currency, parse_percent, round_even, safe_ratio,
                         text_length, title_case, year_month)
from ..operators.aggregates import flag_counts
from ..operators.filters import drop_all_null_columns, drop_present
from ..operators.joins import lookup
from ..sources.config import OTHER_GROUP, PROPERTY_TYPE_GROUPS, with_city_config

# Columns dropped from raw listings, date and boolean columns.
LISTING_DROP_COLUMNS = [
    "license", "calendar_updated", "neighbourhood_group_cleansed", "listing_url", "scrape_id",
    "picture_url", "host_url", "host_thumbnail_url", "host_picture_url",
]
LISTING_DATE_COLUMNS = ["last_scraped", "host_since", "first_review", "last_review", "calendar_last_scraped"]
LISTING_BOOL_COLUMNS = ["host_is_superhost", "host_has_profile_pic", "host_identity_verified",
                        "has_availability", "instant_bookable"]
PERCENT_COLUMNS = ["host_response_rate", "host_acceptance_rate"]
NUMERIC_COLUMNS = {
    "id": "long", "host_id": "long", "accommodates": "double", "bedrooms": "double", "beds": "double",
    "bathrooms": "double", "minimum_nights": "double", "maximum_nights": "int",
    "availability_30": "int", "availability_60": "int", "availability_90": "int", "availability_365": "int",
    "number_of_reviews": "int", "number_of_reviews_ltm": "int", "number_of_reviews_l30d": "int",
    "reviews_per_month": "double", "calculated_host_listings_count": "int",
    "host_listings_count": "double", "host_total_listings_count": "double",
    "hosts_time_as_host_years": "double", "latitude": "double", "longitude": "double",
    "review_scores_rating": "double", "review_scores_accuracy": "double",
    "review_scores_cleanliness": "double", "review_scores_checkin": "double",
    "review_scores_communication": "double", "review_scores_location": "double",
    "review_scores_value": "double",
}


def _is_string(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.StringType)


def type_columns(df: DataFrame) -> DataFrame:
    """Numeric columns to their types (``try_cast``: junk text -> null)."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in NUMERIC_COLUMNS.items() if c in df.columns})


def clean_listings(raw: DataFrame, config: DataFrame, *, property_groups: Mapping[str, str] = PROPERTY_TYPE_GROUPS,
                   drop_columns: Sequence[str] = LISTING_DROP_COLUMNS, allow_negative: bool = False) -> DataFrame:
    """P01 -> F01 -> F02 -> F08 -> F28 -> F27 -> J06 -> F29, F18, F26.

    ``raw`` must carry ``city``; ``allow_negative`` keeps the sign of prices (``parse_currency``).  Validation counters are a separate
    operator (``operators.quality.listing_rule_counts``).
    """
    df = drop_present(raw, drop_columns)
    df = type_columns(df)
    updates = {"price": parse_currency("price", allow_negative)}
    for c in PERCENT_COLUMNS:
        if c in df.columns:
            updates[c] = parse_percent(c) if _is_string(df, c) else F.col(c).cast("double")
    for c in LISTING_DATE_COLUMNS:
        if c in df.columns:
            updates[c] = lenient_date_of(df, c)
    for c in LISTING_BOOL_COLUMNS:
        if c in df.columns:
            updates[c] = parse_bool(c) if not isinstance(df.schema[c].dataType, T.BooleanType) else F.col(c)
    df = df.withColumns(updates)

    # F27 imputation (beds rounded half-even over the whole column, as numpy does)
    imp = {}
    if "bedrooms" in df.columns:
        imp["bedrooms"] = F.coalesce(F.col("bedrooms"), F.lit(1.0))
    if "bathrooms" in df.columns:
        imp["bathrooms"] = F.coalesce(F.col("bathrooms"), F.lit(1.0))
    if "beds" in df.columns and "accommodates" in df.columns:
        imp["beds"] = F.rint(F.coalesce(F.col("beds"), F.col("accommodates") / F.lit(2.0)))
    df = df.withColumns(imp)

    # J06 property groups
    if "property_type" in df.columns:
        df = lookup(df, "property_type", property_groups, "property_type_grouped", OTHER_GROUP)

    df = with_city_config(df, config)
    df = with_host_tenure(df)
    derived = {}
    if "bedrooms" in df.columns:
        derived["price_per_bedroom"] = round_even(safe_ratio(F.col("price"), F.col("bedrooms")), 2)
    if "calculated_host_listings_count" in df.columns:
        derived["is_commercial_host"] = greater_than_flag("calculated_host_listings_count", 1)
    return df.withColumns(derived)


def with_host_tenure(df: DataFrame) -> DataFrame:
    """tenure from ``host_since`` when the city has any, else the pre-computed years, else null.

    The per-city availability check is an aggregate with one row per city,
    broadcast: dealt out by city the listings would go to as many tasks as
    there are cities (AQE keeps that sort-merge join, as most of its
    partitions are empty).
    """
    has_since = "host_since" in df.columns
    has_years = "hosts_time_as_host_years" in df.columns
    if not has_since and not has_years:
        return df.withColumn("host_tenure_years", F.lit(None).cast("double"))
    checks = []
    if has_since:
        checks.append((F.count("host_since") > 0).alias("__has_since"))
    if has_years:
        checks.append((F.count("hosts_time_as_host_years") > 0).alias("__has_years"))
    flags = df.groupBy("city").agg(*checks)
    j = df.join(F.broadcast(flags), "city", "left")
    expr = None
    if has_since:
        expr = F.when(F.col("__has_since"), age_years(F.col("scrape_date"), F.col("host_since")))
    if has_years:
        y = round_even("hosts_time_as_host_years", 2)
        expr = F.when(F.col("__has_years"), y) if expr is None else expr.when(F.col("__has_years"), y)
    return j.withColumn("host_tenure_years", expr).drop("__has_since", "__has_years")


def clean_reviews(raw: DataFrame) -> DataFrame:
    """F08 -> P11(comments) -> F05 -> F09/F10 -> F04."""
    df = raw.withColumn("date", lenient_date_of(raw, "date"))
    df = df.where(F.col("comments").isNotNull())
    df = df.withColumn("reviewer_name", fill_text("reviewer_name", "Anonymous"))
    for c, t in {"id": "long", "listing_id": "long", "reviewer_id": "long"}.items():
        df = df.withColumn(c, F.col(c).try_cast(t))
    return df.withColumns({
        "review_year": F.year("date"),
        "review_month": F.month("date"),
        "review_year_month": year_month("date"),
        "comment_length": text_length("comments"),
    })


def clean_calendar(raw: DataFrame, drop_empty: bool = False) -> DataFrame:
    """B03 (detail part): F28 -> F08 -> F09-F12.

    ``drop_empty=True`` also drops 100 %-null columns (P02); it costs a full
    extra scan of the largest table, and the fact builder re-adds required
    columns as typed nulls anyway, so it is off by default.
    """
    df = raw
    if drop_empty:
        df = drop_all_null_columns(df, keep=["listing_id", "date", "available", "city"])
    upd = {"available": parse_bool("available") if _is_string(df, "available") else F.col("available"),
           "date": lenient_date_of(df, "date"),
           "listing_id": F.col("listing_id").try_cast("long")}
    for c in ("minimum_nights", "maximum_nights"):
        if c in df.columns:
            upd[c] = F.col(c).try_cast("int")
    df = df.withColumns(upd)
    return calendar_parts(df, "date")


def occupancy_summary(calendar: DataFrame) -> DataFrame:
    """B03 (summary part) / A05: per listing total / available / booked days and occupancy %.

    The one heavy shuffle of the pipeline; partial aggregation reduces each
    listing's ~365 rows to one partial row per task before it.
    """
    return flag_counts(calendar, ["city", "listing_id"], "available")


def clean_neighbourhoods(features: DataFrame, position_col: str | None = None) -> DataFrame:
    """F31/F32 -> F03 -> W02.

    ``features`` has ``city`` and a ``feature`` struct (properties, VARIANT
    geometry) — as produced by ``read_geojson_features`` plus a city column.
    The surrogate key is the 1-based document position when ``position_col``
    is given, else the rank of the name within the city.
    """
    props = F.col("feature.properties")
    df = features.select(
        "city",
        *([position_col] if position_col else []),
        title_case(F.coalesce(props["neighbourhood"], F.lit(""))).alias("neighbourhood"),
        props["neighbourhood_group"].alias("neighbourhood_group"),
        F.variant_get(F.col("feature.geometry"), "$.type", "string").alias("geometry_type"),
    )
    if position_col:
        return df.withColumnRenamed(position_col, "neighbourhood_id").withColumn(
            "neighbourhood_id", F.col("neighbourhood_id").cast("int"))
    from ..operators.windows import surrogate_key
    return surrogate_key(df, ["neighbourhood"], "neighbourhood_id")


def cleaned_features(features: DataFrame) -> DataFrame:
    """S10 input (F33): features with the standardised name overwritten and the city inserted into properties."""
    props = F.col("feature.properties")
    new_props = props.withField("neighbourhood", title_case(F.coalesce(props["neighbourhood"], F.lit("")))) \
                     .withField("city", F.col("city"))
    return features.withColumn("feature", F.col("feature").withField("properties", new_props))
