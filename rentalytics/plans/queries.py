"""Named market queries.

Each query takes published frames (``fact_listings``, ``dim_host``,
``fact_calendar``, ``fact_reviews`` ...) and returns a DataFrame; all
cities are answered at once (grouped by ``city``).  Rounding follows the
origin of each query: SQL-origin queries round half-up on the decimal
value (``round_half_up``), notebook/dashboard ones half-even (``round_aggregate``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bool_label, bucket_right, haversine_km, round_aggregate, round_half_up
from ..operators import aggregates as A
from ..operators.filters import cap_by_group, listing_filter
from ..operators.joins import complete_axis, inner_join, semi_join
from ..operators.windows import rank_by_metric, top_k_per_group
from ..sources.config import CITY_SETTINGS, PRICE_CAPS


# ----------------------------------------------------------------- SQL-origin (load step + dashboard)
def top_neighbourhoods_by_avg_price(fact: DataFrame, k: int = 5) -> DataFrame:
    """Top-k areas by mean price per city."""
    s = (fact.where(F.col("price").isNotNull()).groupBy("city", "neighbourhood_cleansed")
         .agg(round_half_up(F.avg("price"), 0).alias("avg_price"), F.count(F.lit(1)).alias("listing_count")))
    return top_k_per_group(s, k, ["avg_price"], tie_break=["neighbourhood_cleansed"])


def superhost_comparison(fact: DataFrame, dim_host: DataFrame) -> DataFrame:
    """Superhost vs not (J04 inner join on (host_id, city), P06, A02)."""
    j = inner_join(fact, dim_host.select("host_id", "city", "host_is_superhost"), ["host_id", "city"])
    return (j.where(F.col("host_is_superhost").isNotNull()).groupBy("city", "host_is_superhost").agg(
        F.count(F.lit(1)).alias("listing_count"),
        round_half_up(F.avg("price"), 0).alias("avg_price"),
        round_half_up(F.avg("review_scores_rating"), 3).alias("avg_rating"),
        round_half_up(F.avg("occupancy_rate"), 1).alias("avg_occupancy")))


def room_type_breakdown(fact: DataFrame) -> DataFrame:
    """M03."""
    return fact.groupBy("city", "room_type").agg(
        F.count(F.lit(1)).alias("listing_count"),
        round_half_up(F.avg("price"), 0).alias("avg_price"),
        round_half_up(F.avg("occupancy_rate"), 1).alias("avg_occupancy"))


def reviews_by_year(reviews: DataFrame) -> DataFrame:
    """M04."""
    return reviews.groupBy("city", "review_year").agg(F.count(F.lit(1)).alias("review_count"))


def price_tier_distribution(fact: DataFrame) -> DataFrame:
    """M05."""
    return (fact.where(F.col("price_tier").isNotNull()).groupBy("city", "price_tier").agg(
        F.count(F.lit(1)).alias("listing_count"),
        round_half_up(F.avg("occupancy_rate"), 1).alias("avg_occupancy"),
        round_half_up(F.avg("price"), 0).alias("avg_price")))


SERVING_COLUMNS = [
    "listing_id", "city", "host_id", "neighbourhood_cleansed", "room_type", "property_type",
    "property_type_grouped", "price", "price_tier", "price_per_bedroom", "price_vs_neighbourhood",
    "minimum_nights", "maximum_nights", "availability_365", "number_of_reviews", "review_scores_rating",
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_location", "review_scores_communication", "review_scores_value",
    "review_score_composite", "review_velocity", "occupancy_rate", "booked_days", "available_days",
    "estimated_annual_revenue", "host_tenure_years", "instant_bookable", "calculated_host_listings_count",
]
HOST_SERVING_COLUMNS = ["host_is_superhost", "is_commercial_host", "host_response_rate", "host_acceptance_rate"]


def filtered_listings(fact: DataFrame, dim_host: DataFrame, *, cities: Sequence[str], room_types: Sequence[str],
                      price_range: tuple[float, float], max_min_nights: float) -> DataFrame:
    """The dashboard's listing frame (P10 + J05 left join with host attributes)."""
    f = listing_filter(fact, cities=cities, room_types=room_types, price_range=price_range,
                       max_min_nights=max_min_nights)
    h = dim_host.select("host_id", "city", *HOST_SERVING_COLUMNS)
    return f.select(*SERVING_COLUMNS).join(h, ["host_id", "city"], "left") \
            .select(*SERVING_COLUMNS, *HOST_SERVING_COLUMNS)


def review_counts_monthly(reviews: DataFrame, min_year: int = 2015) -> DataFrame:
    """M07."""
    return (reviews.where(F.col("review_year") >= min_year)
            .groupBy("city", "review_year", "review_month", "review_year_month")
            .agg(F.count(F.lit(1)).alias("review_count")))


def availability_by_month_weekend(calendar: DataFrame) -> DataFrame:
    """SQL-style rate (null availability counts as not available)."""
    return calendar.groupBy("city", "month", "is_weekend").agg(
        A.rate_pct("available", "sql").alias("availability_rate"),
        F.count(F.lit(1)).alias("total_days"))


def neighbourhood_stats(fact: DataFrame) -> DataFrame:
    """Per-area count, mean, median, rating, occupancy, revenue (SQL rounding)."""
    s = A.agg_with_quantiles(fact.where(F.col("price").isNotNull()), ["city", "neighbourhood_cleansed"], [
        F.count(F.lit(1)).alias("listing_count"),
        round_half_up(F.avg("price"), 0).alias("avg_price"),
        round_half_up(F.avg("review_scores_rating"), 3).alias("avg_rating"),
        round_half_up(F.avg("occupancy_rate"), 1).alias("avg_occupancy"),
        round_half_up(F.avg("estimated_annual_revenue"), 0).alias("avg_revenue")],
        {"median_price": ("price", 0.5)},
        order=["listing_count", "avg_price", "median_price", "avg_rating", "avg_occupancy", "avg_revenue"])
    return s.withColumn("median_price", round_half_up("median_price", 0))


def kpi_cards(listing_frame: DataFrame) -> DataFrame:
    """Per-city and total KPIs."""
    k = A.kpi_block(listing_frame)
    return k.select(F.coalesce("city", F.lit("ALL")).alias("city"), "listing_count",
                    round_aggregate("median_price", 2).alias("median_price"),
                    round_aggregate("mean_occupancy", 4).alias("mean_occupancy"),
                    round_aggregate("mean_rating", 4).alias("mean_rating"))


# ----------------------------------------------------------------- notebook / dashboard views
def _r(c, d=6):
    return round_aggregate(c, d)


def price_distribution(listing_frame: DataFrame, bins: int = 50, caps=PRICE_CAPS["distribution"]) -> DataFrame:
    """Histogram of capped prices per city (P12 + A24)."""
    capped = cap_by_group(listing_frame.where(F.col("price").isNotNull()), "price", caps)
    h = A.histogram(capped, "price", bins)
    return h.select("city", "bin", _r("bin_lo").alias("bin_lo"), _r("bin_hi").alias("bin_hi"), "count")


def price_summary(listing_frame: DataFrame, caps=PRICE_CAPS["distribution"]) -> DataFrame:
    """Median / mean of all prices and the cap used, per city."""
    cap = None
    for k, v in caps.items():
        cap = F.when(F.col("city") == k, F.lit(v)) if cap is None else cap.when(F.col("city") == k, F.lit(v))
    s = A.agg_with_quantiles(listing_frame.where(F.col("price").isNotNull()), ["city"],
                             [_r(F.avg("price")).alias("mean_price")], {"median_price": ("price", 0.5)},
                             order=["median_price", "mean_price"])
    return s.withColumn("median_price", _r("median_price")).withColumn("price_cap", cap)


def price_by_room_type_box(listing_frame: DataFrame, caps=PRICE_CAPS["distribution"], min_n: int = 10) -> DataFrame:
    """Box statistics of capped price per room type (A25), classes with n > 10."""
    capped = cap_by_group(listing_frame.where(F.col("price").isNotNull()), "price", caps)
    b = A.box_stats(capped, "price", ["city", "room_type"], min_n=min_n)
    return b.select("city", "room_type", "n", *[_r(c).alias(c) for c in
                                                 ["mean", "q1", "median", "q3", "whisker_low", "whisker_high"]])


def rating_inflation(listing_frame: DataFrame, high: float = 4.5, top: float = 5.0) -> DataFrame:
    """Share of rated listings at or above 4.5 and exactly 5.0."""
    r = F.col("review_scores_rating")
    return listing_frame.where(r.isNotNull()).groupBy("city").agg(
        F.count(r).alias("rated"),
        _r(F.count_if(r >= high) / F.count(r) * 100).alias("pct_at_least_high"),
        _r(F.count_if(r == top) / F.count(r) * 100).alias("pct_perfect"))


SUB_DIMENSIONS = ["review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
                  "review_scores_checkin", "review_scores_communication", "review_scores_location",
                  "review_scores_value"]


def review_dimension_gap(listing_frame: DataFrame, class_col: str = "host_is_superhost") -> DataFrame:
    """Mean of each review sub-dimension for the class vs the rest, and the gap."""
    present = [c for c in SUB_DIMENSIONS if c in listing_frame.columns]
    g = A.class_means(listing_frame.where(F.col(class_col).isNotNull()), present, class_col)
    return g.select("city", "dimension", *[_r(c).alias(c) for c in ["mean_pos", "mean_neg", "gap"]])


# Host portfolio buckets (labels as displayed; edges start at 0
# so a single-listing host is counted in "1").
PORTFOLIO_EDGES = [0, 1, 2, 3, 5, 10, 20, 50, 100, float("inf")]
PORTFOLIO_EDGES_CLOSED = [*PORTFOLIO_EDGES[:-1], 9999]  # the source's last edge: larger hosts fall out of "100+"
PORTFOLIO_LABELS = ["1", "2", "3", "4-5", "6-10", "11-20", "21-50", "51-100", "100+"]


def host_portfolio(fact: DataFrame, edges=PORTFOLIO_EDGES, labels=PORTFOLIO_LABELS) -> DataFrame:
    """M15 (A16)."""
    return A.portfolio_distribution(fact.where(F.col("host_id").isNotNull()), "host_id", "listing_id", edges, labels)


def market_concentration(fact: DataFrame) -> DataFrame:
    """M16 (A17)."""
    c = A.concentration(fact.where(F.col("host_id").isNotNull()), "host_id")
    return c.select("city", "total_hosts", "total_items", "multi_hosts",
                    *[_r(x).alias(x) for x in ["multi_host_pct", "multi_item_pct", "top_share_pct"]])


def availability_distribution(listing_frame: DataFrame, bins: int = 50) -> DataFrame:
    """M17 (a): histogram of ``availability_365`` per city."""
    h = A.histogram(listing_frame, "availability_365", bins)
    return h.select("city", "bin", _r("bin_lo").alias("bin_lo"), _r("bin_hi").alias("bin_hi"), "count")


def zero_availability_share(listing_frame: DataFrame) -> DataFrame:
    """M17 (b): share of listings with zero days available (over all rows, A22)."""
    return listing_frame.groupBy("city").agg(
        _r(F.count_if(F.col("availability_365") == 0) / F.count(F.lit(1)) * 100).alias("pct_zero_availability"))


def monthly_availability(calendar: DataFrame) -> DataFrame:
    """True mean availability per month (null flags skipped) on a complete 1-12 axis."""
    m = calendar.groupBy("city", "month").agg(_r(A.rate_pct("available", "pandas")).alias("availability_rate"))
    return complete_axis(m, "month", list(range(1, 13)), by=["city"])


def availability_dashboard_views(calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The dashboard's monthly and weekend lines = unweighted means of (month, weekend) rates."""
    rates = availability_by_month_weekend(calendar)
    monthly = A.mean_of_rates(rates, ["city", "month"], "availability_rate")
    weekend = A.mean_of_rates(rates, ["city", "is_weekend"], "availability_rate")
    return monthly.withColumn("availability_rate", _r("availability_rate")), \
        weekend.withColumns({"availability_rate": _r("availability_rate"),
                             "day_type": bool_label("is_weekend", "Weekend", "Weekday")})


def occupancy_distribution(listing_frame: DataFrame, bins: int = 50) -> DataFrame:
    """Occupancy histogram per city with the city median on every row (A24 + A03)."""
    h = A.histogram(listing_frame, "occupancy_rate", bins)
    med = A.group_quantiles(listing_frame, {"median_occupancy": ("occupancy_rate", 0.5)}, ["city"]) \
           .withColumn("median_occupancy", _r("median_occupancy"))
    return h.select("city", "bin", _r("bin_lo").alias("bin_lo"), _r("bin_hi").alias("bin_hi"), "count") \
            .join(med, "city")


def top_neighbourhoods_by_median_price(listing_frame: DataFrame, k: int = 10) -> DataFrame:
    """M21 (A03 + W03)."""
    s = A.median_by(listing_frame.where(F.col("price").isNotNull()), ["city", "neighbourhood_cleansed"], "price",
                    out="median_price")
    return top_k_per_group(s, k, ["median_price"], tie_break=["neighbourhood_cleansed"])


def neighbourhood_metrics(listing_frame: DataFrame) -> DataFrame:
    """Per-area metrics used by the ranking and the map (pandas rounding)."""
    s = A.agg_with_quantiles(listing_frame.where(F.col("neighbourhood_cleansed").isNotNull()),
                             ["city", "neighbourhood_cleansed"],
                             [F.count(F.lit(1)).alias("listing_count"), _r(F.avg("occupancy_rate")).alias("avg_occupancy"),
                              _r(F.avg("review_scores_rating")).alias("avg_rating")],
                             {"median_price": ("price", 0.5)},
                             order=["median_price", "listing_count", "avg_occupancy", "avg_rating"])
    return s.withColumn("median_price", _r("median_price"))


def neighbourhood_ranking(listing_frame: DataFrame, metric: str = "avg_occupancy", k: int = 10) -> DataFrame:
    """M22 (T04)."""
    return rank_by_metric(neighbourhood_metrics(listing_frame), metric, k)


def price_vs_occupancy(fact: DataFrame, min_listings: int = 5) -> DataFrame:
    """Per-area stats (M09) for areas with at least 5 listings."""
    return neighbourhood_stats(fact).where(F.col("listing_count") >= min_listings)


def choropleth_features(fact: DataFrame, neighbourhoods: DataFrame) -> DataFrame:
    """Per-area stats merged into the area features (J07: unmatched -> count 0, stats null)
    with the city's colour range (p5 / p95 of area median price, A26)."""
    stats = neighbourhood_stats(fact).select(
        "city", F.col("neighbourhood_cleansed").alias("neighbourhood"), "listing_count", "median_price",
        "avg_occupancy")
    feats = neighbourhoods.select("city", "neighbourhood", F.struct(
        F.struct(F.col("neighbourhood").alias("neighbourhood")).alias("properties")).alias("feature"))
    from ..operators.joins import merge_into_features
    merged = merge_into_features(feats, stats, ["city", "neighbourhood"], defaults={"listing_count": 0})
    rng = A.quantiles(stats, "median_price", [0.05, 0.95], by=["city"], prefix="colour_p")
    p = F.col("feature.properties")
    return merged.select("city", "neighbourhood", p["listing_count"].alias("listing_count"),
                         p["median_price"].alias("median_price"), p["avg_occupancy"].alias("avg_occupancy")) \
                 .join(rng, "city", "left") \
                 .withColumns({"colour_p05": _r("colour_p05"), "colour_p95": _r("colour_p95")})


# Distance bands from the city centre (km).
DISTANCE_EDGES = [0, 2, 4, 6, 8, 10, 15, 20, float("inf")]
DISTANCE_EDGES_CLOSED = [*DISTANCE_EDGES[:-1], 50]  # the source's last edge: listings farther off fall out of "20+"
DISTANCE_LABELS = ["0-2", "2-4", "4-6", "6-8", "8-10", "10-15", "15-20", "20+"]


def price_gradient(listings: DataFrame, edges=DISTANCE_EDGES, labels=DISTANCE_LABELS) -> DataFrame:
    """Median price, count and occupancy by distance band from the city centre (F23 + F24 + A03)."""
    cols = ["id", "latitude", "longitude", "price", "occupancy_rate", "room_type"]
    if "centre_lat" in listings.columns:  # centre from the tenant configuration (S17)
        clat, clon = F.col("centre_lat"), F.col("centre_lon")
    else:
        clat = clon = None
        for name, s in CITY_SETTINGS.items():
            clat = F.when(F.col("city") == name, F.lit(s["centre"][0])) if clat is None else clat.when(F.col("city") == name, F.lit(s["centre"][0]))
            clon = F.when(F.col("city") == name, F.lit(s["centre"][1])) if clon is None else clon.when(F.col("city") == name, F.lit(s["centre"][1]))
    df = listings.select("city", *cols, clat.alias("__clat"), clon.alias("__clon")).na.drop("any", subset=cols)
    clat, clon = F.col("__clat"), F.col("__clon")
    df = df.withColumn("distance_km", haversine_km("latitude", "longitude", clat, clon))
    df = df.withColumn("distance_bin", bucket_right("distance_km", edges, labels)) \
           .withColumn("bin_order", bucket_right("distance_km", edges))
    s = A.agg_with_quantiles(df.where(F.col("distance_bin").isNotNull()), ["city", "distance_bin", "bin_order"],
                             [F.count("id").alias("listing_count"), _r(F.avg("occupancy_rate")).alias("avg_occupancy")],
                             {"median_price": ("price", 0.5)}, order=["median_price", "listing_count", "avg_occupancy"])
    return s.withColumn("median_price", _r("median_price"))


def room_mix_top_neighbourhoods(listing_frame: DataFrame, k: int = 15) -> DataFrame:
    """Room-type shares inside the k largest areas per city (J08 + A20 + W06)."""
    counts = A.count_by(listing_frame.where(F.col("neighbourhood_cleansed").isNotNull()),
                        ["city", "neighbourhood_cleansed"], "n")
    top = top_k_per_group(counts, k, ["n"], tie_break=["neighbourhood_cleansed"])
    sub = semi_join(listing_frame, top, ["city", "neighbourhood_cleansed"])
    x = A.crosstab_pct(sub, "neighbourhood_cleansed", "room_type", by=["city"])
    from ..operators.windows import cumulative_before
    x = cumulative_before(x, "row_pct", ["room_type"], ["city", "neighbourhood_cleansed"], "cum_before")
    return x.select("city", "neighbourhood_cleansed", "room_type", "count", _r("row_pct").alias("row_pct"),
                    _r("cum_before").alias("cum_before"))


def yearly_review_trend(reviews: DataFrame, first_year: int = 2015, last_year: int = 2026) -> DataFrame:
    """Reviews per city and year inside a year window (A01 + A18)."""
    monthly = review_counts_monthly(reviews, first_year)
    yearly = A.reaggregate(monthly, ["city", "review_year"], "review_count")
    return yearly.where(F.col("review_year") <= last_year)


def weekend_vs_weekday(calendar: DataFrame) -> DataFrame:
    """Availability % by weekend flag (mean over non-null flags)."""
    return calendar.groupBy("city", "is_weekend").agg(_r(A.rate_pct("available", "pandas")).alias("availability_rate"))


MIN_NIGHT_EDGES = [0, 1, 2, 3, 7, 14, 30, 90, 365]
MIN_NIGHT_LABELS = ["1", "2", "3", "4-7", "8-14", "15-30", "31-90", "90+"]


def minimum_night_policy(listing_frame: DataFrame) -> DataFrame:
    """Share of listings per minimum-night band (nights <= 365), % of the bucketed rows."""
    df = listing_frame.where(F.col("minimum_nights") <= 365).withColumn(
        "band", bucket_right("minimum_nights", MIN_NIGHT_EDGES, MIN_NIGHT_LABELS))
    s = A.share_of_total(df.where(F.col("band").isNotNull()), ["band"])
    return s.select("city", "band", "count", _r("share_pct").alias("share_pct"))


TENURE_EDGES = [0, 1, 2, 3, 4, 5, 7, 10, 16]
TENURE_LABELS = ["<1", "1-2", "2-3", "3-4", "4-5", "5-7", "7-10", "10+"]


def tenure_vs_price(listing_frame: DataFrame, max_years: float = 16) -> DataFrame:
    """Median price per host-tenure band (tenure <= 16 years)."""
    df = listing_frame.where(F.col("host_tenure_years").isNotNull() & F.col("price").isNotNull()
                             & (F.col("host_tenure_years") <= max_years))
    df = df.withColumn("tenure_bin", bucket_right("host_tenure_years", TENURE_EDGES, TENURE_LABELS))
    return A.median_by(df, ["city", "tenure_bin"], "price", out="median_price") \
            .withColumn("median_price", _r("median_price"))


def superhost_profile(listing_frame: DataFrame) -> DataFrame:
    """Superhost share, medians, means and rating advantage per city."""
    sh = F.col("host_is_superhost")
    yes, no = sh == F.lit(True), sh == F.lit(False)
    g = A.agg_with_quantiles(listing_frame, ["city"], [
        (F.count_if(yes) / F.count(sh) * 100).alias("superhost_pct"),
        F.avg(F.when(yes, F.col("occupancy_rate"))).alias("sh_avg_occupancy"),
        F.avg(F.when(no, F.col("occupancy_rate"))).alias("nsh_avg_occupancy"),
        F.avg(F.when(yes, F.col("review_scores_rating"))).alias("sh_avg_rating"),
        F.avg(F.when(no, F.col("review_scores_rating"))).alias("nsh_avg_rating")],
        {"sh_median_price": (F.when(yes, F.col("price")), 0.5), "nsh_median_price": (F.when(no, F.col("price")), 0.5)},
        order=["superhost_pct", "sh_median_price", "nsh_median_price", "sh_avg_occupancy", "nsh_avg_occupancy",
               "sh_avg_rating", "nsh_avg_rating"])
    g = g.withColumn("rating_advantage", F.col("sh_avg_rating") - F.col("nsh_avg_rating"))
    return g.select("city", *[_r(c).alias(c) for c in g.columns if c != "city"])


def commercial_profile(listing_frame: DataFrame) -> DataFrame:
    """Commercial (count > 1) vs casual hosts: count, share, median price, means."""
    df = listing_frame.where(F.col("is_commercial_host").isNotNull())
    s = A.share_of_total(df, ["is_commercial_host"])
    m = A.agg_with_quantiles(df, ["city", "is_commercial_host"],
                             [_r(F.avg("occupancy_rate")).alias("avg_occupancy"), _r(F.avg("review_scores_rating")).alias("avg_rating")],
                             {"median_price": ("price", 0.5)}, order=["median_price", "avg_occupancy", "avg_rating"]) \
          .withColumn("median_price", _r("median_price"))
    return s.withColumn("share_pct", _r("share_pct")).join(m, ["city", "is_commercial_host"])


def commercial_price_histograms(listing_frame: DataFrame, bins: int = 40, caps=PRICE_CAPS["commercial"]) -> DataFrame:
    """Capped price histogram per city and host class."""
    df = cap_by_group(listing_frame.where(F.col("price").isNotNull() & F.col("is_commercial_host").isNotNull()),
                      "price", caps)
    h = A.histogram(df, "price", bins, by=["city", "is_commercial_host"])
    return h.select("city", "is_commercial_host", "bin", _r("bin_lo").alias("bin_lo"), _r("bin_hi").alias("bin_hi"), "count")


def scatter_sample(listing_frame: DataFrame, n: int = 2000, seed: int = 42, caps=PRICE_CAPS["reviews"]) -> DataFrame:
    """M33 (a): reviews-vs-price points: at most n reviewed and priced listings of each city (P15), then the city's
    price cap (P12)."""
    from ..operators.filters import seeded_sample
    df = listing_frame.where(F.col("price").isNotNull() & (F.col("number_of_reviews") > 0)).select(
        "listing_id", "city", "number_of_reviews", "price", "review_scores_rating")
    return cap_by_group(seeded_sample(df, n, "listing_id", seed, by=["city"]), "price", caps)


def rating_price_sample(listing_frame: DataFrame, n: int = 3000, seed: int = 42, caps=PRICE_CAPS["scatter"]) -> DataFrame:
    """M33 (b): price-vs-rating points: at most n capped listings with price, rating and occupancy, of all cities."""
    from ..operators.filters import drop_nulls, seeded_sample
    df = drop_nulls(listing_frame, ["price", "review_scores_rating", "occupancy_rate"])
    return seeded_sample(cap_by_group(df, "price", caps).select("listing_id", "city", "review_scores_rating", "price", "occupancy_rate"),
                         n, "listing_id", seed)


def review_velocity_summary(listing_frame: DataFrame, fast: float = 20) -> DataFrame:
    """M34 (a): median / mean velocity, share above 20/yr, and the p95 trim point of the histogram."""
    v = F.col("review_velocity")
    s = A.agg_with_quantiles(listing_frame.where(v.isNotNull()), ["city"],
                             [_r(F.avg(v)).alias("mean_velocity"), _r(F.count_if(v > fast) / F.count(v) * 100).alias("pct_fast")],
                             {"median_velocity": (v, 0.5), "p95_velocity": (v, 0.95)},
                             order=["median_velocity", "mean_velocity", "pct_fast", "p95_velocity"])
    return s.withColumns({"median_velocity": _r("median_velocity"), "p95_velocity": _r("p95_velocity")})


def review_velocity_histogram(listing_frame: DataFrame, bins: int = 60, trim_q: float = 0.95) -> DataFrame:
    """M34 (b): histogram of velocities up to each city's trim quantile (P13 + A24), with the trimmed median."""
    from ..operators.filters import quantile_trim
    kept = quantile_trim(listing_frame.where(F.col("review_velocity").isNotNull()), "review_velocity", trim_q)
    med = A.group_quantiles(kept, {"trimmed_median": ("review_velocity", 0.5)}, ["city"])
    h = A.histogram(kept, "review_velocity", bins)
    return h.join(med, "city").select("city", "bin", *[_r(c).alias(c) for c in ["bin_lo", "bin_hi"]], "count",
                                      _r("trimmed_median").alias("trimmed_median"))


def high_review_low_score(listing_frame: DataFrame, min_reviews: int = 50, max_score: float = 4.5) -> DataFrame:
    """M35 (a): flagged listings (many reviews, low score) per city, with their median price and occupancy."""
    f = listing_frame.where((F.col("number_of_reviews") > min_reviews) & (F.col("review_scores_rating") < max_score))
    s = A.agg_with_quantiles(f, ["city"], [F.count(F.lit(1)).alias("flagged")],
                             {"median_price": ("price", 0.5), "median_occupancy": ("occupancy_rate", 0.5)},
                             order=["flagged", "median_price", "median_occupancy"])
    return s.withColumns({c: _r(c) for c in ["median_price", "median_occupancy"]})


def review_rating_points(listing_frame: DataFrame, min_reviews: int = 10, caps=PRICE_CAPS["reviews"]) -> DataFrame:
    """M35 (b): the base of the reviews-vs-rating scatter: every rated and capped listing with enough reviews."""
    from ..operators.filters import not_null
    df = not_null(listing_frame, "review_scores_rating", "price").where(F.col("number_of_reviews") >= min_reviews)
    return cap_by_group(df, "price", caps).select("listing_id", "city", "number_of_reviews", "review_scores_rating", "price")


TIER_ORDER = ["Budget", "Mid-range", "Premium"]


def price_tier_performance(listing_frame: DataFrame) -> DataFrame:
    """Per tier count, share, mean occupancy, median revenue, in tier order."""
    from ..functions import ordinal
    df = listing_frame.where(F.col("price_tier").isNotNull())
    s = A.share_of_total(df, ["price_tier"])
    m = A.agg_with_quantiles(df, ["city", "price_tier"], [_r(F.avg("occupancy_rate")).alias("avg_occupancy")],
                             {"median_revenue": ("estimated_annual_revenue", 0.5)},
                             order=["avg_occupancy", "median_revenue"]).withColumn("median_revenue", _r("median_revenue"))
    return s.withColumn("share_pct", _r("share_pct")).join(m, ["city", "price_tier"]) \
            .withColumn("tier_order", ordinal("price_tier", TIER_ORDER))


def category_counts(listing_frame: DataFrame) -> DataFrame:
    """Room-type and property-group counts per city, in one long frame."""
    from ..operators.sets import concat_labelled
    parts = {d: A.value_counts(listing_frame, d, by=["city"]).select("city", F.col(d).alias("value"), "count")
             for d in ["room_type", "property_type_grouped"]}
    return concat_labelled(parts, "dimension").select("city", "dimension", "value", "count")


def neighbourhood_top5_summary(enriched: DataFrame, k: int = 5) -> DataFrame:
    """M38 (a): the k areas with the highest benchmark median price per city (T02 on the benchmark table)."""
    from ..plans.enrich import neighbourhood_benchmarks
    b = neighbourhood_benchmarks(enriched)
    t = top_k_per_group(b, k, ["neighbourhood_median_price"], tie_break=["neighbourhood_cleansed"])
    return t.select("city", "neighbourhood_cleansed", "neighbourhood_median_price", "neighbourhood_listing_count", "rank")


def neighbourhood_top5_by_count(listing_frame: DataFrame, k: int = 5) -> DataFrame:
    """M38 (b): the k areas with the most listings per city, with median price and mean occupancy."""
    t = top_k_per_group(neighbourhood_metrics(listing_frame), k, ["listing_count"], tie_break=["neighbourhood_cleansed"])
    return t.select("city", "neighbourhood_cleansed", "listing_count", "median_price", "avg_occupancy", "rank")


def calendar_cleaning_summary(calendar: DataFrame) -> DataFrame:
    """A29 + A27: weekend / weekday availability % (mean over non-null flags) and the date range, per city."""
    avail, wk = F.col("available").cast("double"), F.col("is_weekend")
    return calendar.groupBy("city").agg(
        _r(A.filtered_mean(avail, wk) * 100).alias("weekend_availability_pct"),
        _r(A.filtered_mean(avail, ~wk) * 100).alias("weekday_availability_pct"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def review_cleaning_summary(reviews: DataFrame) -> DataFrame:
    """Review date and year range and comment-length min / max / median, per city."""
    r = A.range_summary(reviews, "comment_length", by=["city"])
    d = reviews.groupBy("city").agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                                    F.min("review_year").alias("first_year"), F.max("review_year").alias("last_year"))
    return d.join(r.select("city", F.col("min").alias("min_comment_length"), F.col("max").alias("max_comment_length"),
                           F.col("median").alias("median_comment_length")), "city", "left")


def listing_count_per_city(fact: DataFrame) -> DataFrame:
    """M39."""
    return A.count_by(fact, ["city"], "listing_count")


# The columns summarised per city.
DESCRIBE_COLUMNS = ["price", "minimum_nights", "number_of_reviews", "review_scores_rating", "occupancy_rate",
                    "estimated_annual_revenue", "host_tenure_years", "review_score_composite", "availability_365"]


def city_describe(listing_frame: DataFrame, cols: Sequence[str] = DESCRIBE_COLUMNS) -> DataFrame:
    """describe() of the key columns per city (A07; exact quantiles, 2 dp)."""
    from ..operators.profile import describe
    return describe(listing_frame, [c for c in cols if c in listing_frame.columns], by=["city"])


def city_comparison(listing_frame: DataFrame) -> DataFrame:
    """Side-by-side key metrics per city in long form (A15: one aggregate + unpivot)."""
    metrics = {
        "total_listings": F.count(F.lit(1)),
        "median_price": ("price", 0.5),
        "mean_occupancy_rate": F.avg("occupancy_rate"),
        "median_annual_revenue": ("estimated_annual_revenue", 0.5),
        "avg_review_score": F.avg("review_scores_rating"),
        "median_min_nights": ("minimum_nights", 0.5),
        "avg_reviews_per_listing": F.avg("number_of_reviews"),
        "median_host_tenure_years": ("host_tenure_years", 0.5),
    }
    return A.city_comparison(listing_frame, metrics).withColumn("value", _r("value"))
