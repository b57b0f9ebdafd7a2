"""Driver tables -> rental-shaped raw frames.

The driver ships TPC-H-like tables.  These adapters re-express them as the
raw inputs the library cleans (listings, calendar, reviews, neighbourhood
features), so every operator runs over data whose size grows with the
driver's scale factor.  Every value is derived from table columns:

* listings   <- ``part`` (+ one per-part aggregate of ``lineitem``, + ``supplier`` as host)
* calendar   <- ``lineitem`` (one row per line: part x ship date, available = return flag N)
* reviews    <- ``orders`` (+ ``customer`` as reviewer)
* features   <- distinct (city, brand) of ``part``
* city       <- brand number 1-12 -> bangkok, 13-25 -> lisbon (a neighbourhood lies in one city);
               for reviews the reviewer's nation 0-12 -> bangkok, else lisbon.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise_table
from .config import CITY_SETTINGS
from .files import read_table

# Fixed values of the adapter (not of the reference): p_type -> property group.
# STANDARD is left unmapped on purpose so the "Other" default is exercised.
SYNTHETIC_PROPERTY_GROUPS = {
    "ECONOMY": "Private Room",
    "SMALL": "Shared Room",
    "MEDIUM": "Entire Apartment",
    "LARGE": "Entire House",
    "PROMO": "Hotel Room",
}


def city_of_brand(brand) -> Column:
    n = F.regexp_extract(F.col(brand) if isinstance(brand, str) else brand, r"(\d+)$", 1).try_cast("int")
    return F.when(n <= 12, F.lit("bangkok")).otherwise(F.lit("lisbon"))


def city_of_nation(nationkey) -> Column:
    return F.when(F.col(nationkey) <= 12, F.lit("bangkok")).otherwise(F.lit("lisbon"))


def _centre(city: Column, idx: int) -> Column:
    expr = None
    for name, s in CITY_SETTINGS.items():
        v = F.lit(s["centre"][idx])
        expr = F.when(city == name, v) if expr is None else expr.when(city == name, v)
    return expr


def part_line_stats(lineitem: DataFrame) -> DataFrame:
    """Per-part figures from lineitem: host (supplier of the first line), review dates and scores."""
    n = F.count(F.lit(1))
    return lineitem.groupBy(F.col("l_partkey").alias("pk")).agg(
        F.min(F.struct("l_orderkey", "l_linenumber", "l_suppkey"))["l_suppkey"].alias("host_id"),
        F.min("l_shipdate").cast("date").alias("first_review"),
        F.max("l_shipdate").cast("date").alias("last_review"),
        F.count_if(F.col("l_linestatus") == "F").cast("int").alias("number_of_reviews"),
        (F.lit(5.0) * F.count_if(F.col("l_returnflag") != "R") / n).alias("review_scores_accuracy"),
        (F.lit(5.0) * F.count_if(F.col("l_linestatus") == "O") / n).alias("review_scores_cleanliness"),
        (F.lit(5.0) * F.count_if(F.col("l_discount") < 0.05) / n).alias("review_scores_value"),
    )


def raw_listings(part: DataFrame, lineitem: DataFrame, supplier: DataFrame) -> DataFrame:
    stats = part_line_stats(lineitem)
    sup = supplier.select(F.col("s_suppkey").alias("sk"), "s_name", "s_nationkey", "s_acctbal")
    city = city_of_brand("p_brand")
    base = (part.join(stats, part.p_partkey == stats.pk, "left")
                .join(sup, F.col("host_id") == F.col("sk"), "left"))
    # the host counts and the cleaning's per-city flags read the written rows, so lineitem is aggregated once
    base = materialise_table(base, "raw_listings")
    host_n = base.groupBy(F.col("host_id").alias("hk")).agg(F.count(F.lit(1)).cast("int").alias("host_n"))
    base = base.join(host_n, F.col("host_id") == F.col("hk"), "left")
    acc = F.ceil(F.col("p_size") / F.lit(7.0)).cast("int")
    return base.select(
        F.col("p_partkey").alias("id"),
        city.alias("city"),
        "host_id",
        F.col("s_name").alias("host_name"),
        F.lit(None).cast("string").alias("host_since"),
        F.col("s_nationkey").cast("double").alias("hosts_time_as_host_years"),
        F.concat((F.col("s_nationkey") * 4).cast("string"), F.lit("%")).alias("host_response_rate"),
        F.lit(None).cast("string").alias("host_acceptance_rate"),
        F.when(F.col("s_acctbal") > 5000, "t").when(F.col("s_acctbal").isNotNull(), "f").alias("host_is_superhost"),
        F.lit("t").alias("host_has_profile_pic"),
        F.when(F.col("s_acctbal") >= 0, "t").when(F.col("s_acctbal").isNotNull(), "f").alias("host_identity_verified"),
        F.col("p_brand").alias("neighbourhood_cleansed"),
        F.col("p_type").alias("room_type"),
        F.col("p_type").alias("property_type"),
        F.concat(F.lit("$"), F.format_number("p_retailprice", 2)).alias("price"),
        acc.alias("accommodates"),
        F.when(F.col("p_size") <= 45, F.ceil(F.col("p_size") / F.lit(15.0))).cast("double").alias("bedrooms"),
        F.when(F.col("p_size") > 10, acc).cast("double").alias("beds"),
        F.lit(None).cast("double").alias("bathrooms"),
        F.col("p_size").cast("double").alias("minimum_nights"),
        F.lit(365).alias("maximum_nights"),
        (F.col("p_size") * 7).alias("availability_365"),
        "number_of_reviews",
        F.date_format("first_review", "yyyy-MM-dd").alias("first_review"),
        F.date_format("last_review", "yyyy-MM-dd").alias("last_review"),
        F.date_format("last_review", "yyyy-MM-dd").alias("last_scraped"),
        (F.col("p_size") / F.lit(10.0)).alias("review_scores_rating"),
        "review_scores_accuracy", "review_scores_cleanliness", "review_scores_value",
        (_centre(city, 0) + (F.col("p_size") - 25) * F.lit(0.004)).alias("latitude"),
        (_centre(city, 1) + (F.col("p_retailprice") - 950.0) * F.lit(0.002)).alias("longitude"),
        F.col("host_n").alias("calculated_host_listings_count"),
        F.when(F.col("p_type") == "PROMO", "t").otherwise("f").alias("instant_bookable"),
        F.lit("t").alias("has_availability"),
        F.lit("https://example.invalid/listing").alias("listing_url"),
    )


def raw_calendar(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One calendar row per lineitem; the city comes from the listing's brand."""
    p = part.select(F.col("p_partkey"), city_of_brand("p_brand").alias("city"))
    li = lineitem.select("l_partkey", "l_shipdate", "l_returnflag", "l_linenumber", "l_quantity")
    return li.join(p, li.l_partkey == p.p_partkey, "inner").select(
        F.col("l_partkey").alias("listing_id"),
        "city",
        F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_returnflag") == "N", "t").otherwise("f").alias("available"),
        F.col("l_linenumber").alias("minimum_nights"),
        F.col("l_quantity").cast("int").alias("maximum_nights"),
    )


def raw_reviews(orders: DataFrame, customer: DataFrame) -> DataFrame:
    c = customer.select("c_custkey", "c_name", "c_nationkey")
    return orders.join(c, orders.o_custkey == c.c_custkey, "left").select(
        F.col("o_orderkey").alias("id"),
        city_of_nation("c_nationkey").alias("city"),
        F.col("o_custkey").alias("listing_id"),
        F.col("o_custkey").alias("reviewer_id"),
        F.col("c_name").alias("reviewer_name"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("comments"),
    )


def raw_neighbourhood_features(part: DataFrame) -> DataFrame:
    """Feature rows shaped like an exploded GeoJSON document, names in lower case."""
    names = part.select(city_of_brand("p_brand").alias("city"), F.lower("p_brand").alias("name")).distinct()
    return names.select(
        "city",
        F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.col("name").alias("neighbourhood"),
                     F.lit(None).cast("string").alias("neighbourhood_group")).alias("properties"),
            F.parse_json(F.lit('{"type":"Polygon","coordinates":[]}')).alias("geometry"),
        ).alias("feature"),
    )


class SyntheticSource:
    """Lazily built raw frames over one driver scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    def listings(self) -> DataFrame:
        return raw_listings(self.table("part"), self.table("lineitem"), self.table("supplier"))

    def calendar(self) -> DataFrame:
        return raw_calendar(self.table("lineitem"), self.table("part"))

    def reviews(self) -> DataFrame:
        return raw_reviews(self.table("orders"), self.table("customer"))

    def neighbourhood_features(self) -> DataFrame:
        return raw_neighbourhood_features(self.table("part"))
