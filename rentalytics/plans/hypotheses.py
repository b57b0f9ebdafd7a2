"""Hypothesis reports (X12-X17): compositions of the rank tests, effect sizes and regression.

Every report answers all cities at once (``city`` is the stratum).  Class
labels and thresholds are parameters; defaults are the source's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import log1p, round_aggregate, threshold_label
from ..operators import aggregates as A
from ..operators import stats as S
from ..operators.joins import semi_join
from ..operators.windows import top_k_per_group


def _labels(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    return (df.withColumn("effect", threshold_label("rank_biserial", [0.3, 0.5], ["Small", "Medium", "Large"]))
              .withColumn("reject_h0", F.col("p_value") < alpha))


def h1_room_type_price(listings: DataFrame, first: str = "Entire home/apt", second: str = "Private room") -> DataFrame:
    """First room type priced higher than the second (one-sided MWU, rank-biserial, medians)."""
    rt = F.col("room_type")
    t = S.mann_whitney(listings, "price", rt == first, rt == second, alternative="greater")
    med = A.group_quantiles(listings.where(F.col("price").isNotNull()),
                            {"median_first": (F.when(rt == first, F.col("price")), 0.5),
                             "median_second": (F.when(rt == second, F.col("price")), 0.5)}, ["city"])
    return _labels(t).join(med, "city")


def h2_superhost_rating(listings: DataFrame) -> DataFrame:
    """Superhost ratings higher (one-sided MWU, r, Cohen's d)."""
    sh = F.col("host_is_superhost")
    rated = listings.where(F.col("review_scores_rating").isNotNull())
    t = S.mann_whitney(rated, "review_scores_rating", sh == F.lit(True), sh == F.lit(False), alternative="greater")
    d = S.cohens_d(rated, "review_scores_rating", sh == F.lit(True), sh == F.lit(False))
    d = d.withColumn("practical", threshold_label("cohens_d", [0.5, 0.8], ["Small", "Medium", "Large"]))
    return _labels(t).join(d, "city")


def h2_rating_density(listings: DataFrame, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """X13 (chart data): KDE of ratings per city and superhost class on a 200-point grid."""
    df = listings.where(F.col("host_is_superhost").isNotNull())
    return S.gaussian_kde(df, "review_scores_rating", 200, by=["city", "host_is_superhost"], lo=lo, hi=hi)


def h3_reviews_price(listings: DataFrame, threshold: int = 10) -> DataFrame:
    """Price of listings with > threshold reviews vs the rest (two-sided MWU), with both medians and means."""
    n = F.col("number_of_reviews")
    t = S.mann_whitney(listings, "price", n > threshold, n <= threshold, alternative="two-sided")
    price = {"many": F.when(n > threshold, F.col("price")), "few": F.when(n <= threshold, F.col("price"))}
    means = A.agg_with_quantiles(listings.where(F.col("price").isNotNull()), ["city"],
                                 [F.avg(v).alias(f"mean_{k}") for k, v in price.items()],
                                 {f"median_{k}": (v, 0.5) for k, v in price.items()},
                                 order=["median_many", "mean_many", "median_few", "mean_few"])
    return _labels(t).join(means.withColumn("median_diff", F.col("median_many") - F.col("median_few")), "city")


def h3_price_boxes(listings: DataFrame, threshold: int = 10, trim_q: float = 0.95) -> DataFrame:
    """X14 (chart data): box statistics of price per review group, each trimmed at its own quantile (P13 + A25)."""
    from ..operators.filters import quantile_trim
    n = F.col("number_of_reviews")
    grouped = listings.where(F.col("price").isNotNull() & n.isNotNull()).select(
        "city", "price", F.when(n > threshold, F.lit("many")).otherwise(F.lit("few")).alias("review_group"))
    return A.box_stats(quantile_trim(grouped, "price", trim_q, ["city", "review_group"]), "price", ["city", "review_group"])


def h4_neighbourhood_prices(listings: DataFrame, top: int = 15) -> DataFrame:
    """Kruskal-Wallis over the ``top`` largest areas per city, eta-squared, city median."""
    counts = A.count_by(listings.where(F.col("neighbourhood_cleansed").isNotNull()), ["city", "neighbourhood_cleansed"], "n")
    keys = top_k_per_group(counts, top, ["n"], tie_break=["neighbourhood_cleansed"])
    sub = semi_join(listings.where(F.col("price").isNotNull()), keys, ["city", "neighbourhood_cleansed"])
    kw = S.kruskal_wallis(sub, "price", "neighbourhood_cleansed")
    kw = kw.withColumn("effect", F.when(F.col("eta_squared") > 0.14, "Large")
                       .when(F.col("eta_squared") > 0.06, "Medium").otherwise("Small"))
    return A.with_group_total(kw, listings.where(F.col("price").isNotNull()), "price", out="city_median_price")


def h5_weekend_availability(calendar: DataFrame) -> DataFrame:
    """Weekend vs weekday availability (0/1 values, two-sided MWU) with both rates."""
    c = calendar.where(F.col("available").isNotNull() & F.col("is_weekend").isNotNull()) \
                .withColumn("avail01", F.col("available").cast("int"))
    w = F.col("is_weekend")
    t = S.mann_whitney(c, "avail01", w == F.lit(True), w == F.lit(False), alternative="two-sided")
    rates = c.groupBy("city").agg(
        (F.avg(F.when(w, F.col("avail01"))) * 100).alias("weekend_rate"),
        (F.avg(F.when(~w, F.col("avail01"))) * 100).alias("weekday_rate"))
    t = t.withColumn("effect", threshold_label("rank_biserial", [0.1, 0.3], ["Negligible", "Small", "Medium"]))
    return t.withColumn("reject_h0", F.col("p_value") < 0.05).join(rates, "city")


def h5_month_weekend_table(calendar: DataFrame) -> DataFrame:
    """X16 (table): availability % by month, weekend vs weekday."""
    return A.pivot_rate(calendar.withColumn("available", F.col("available")), ["city", "month"], "available", "is_weekend")


# Candidate correlation and regression columns (only existing
# ones are used; the rest are reported as skipped).
CORR_COLUMNS = ["price", "accommodates", "bedrooms", "bathrooms", "beds", "minimum_nights", "number_of_reviews",
                "review_scores_rating", "occupancy_rate", "host_tenure_years", "availability_365",
                "calculated_host_listings_count"]
REG_FEATURES = ["accommodates", "bedrooms", "bathrooms", "minimum_nights", "number_of_reviews",
                "review_scores_rating", "host_tenure_years", "availability_365", "calculated_host_listings_count"]


def correlation_report(listings: DataFrame, cols: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """X17 (correlation part): pairwise Pearson matrix per city, lower triangle."""
    return S.correlation_pairs(listings, cols, by=["city"])


def regression_report(listings: DataFrame, features: Sequence[str] = REG_FEATURES, trim_q: float = 0.99) -> DataFrame:
    """X17 (regression part): OLS of log1p(price) on the existing features after dropping nulls and
    trimming price above the city's 99th percentile; coefficients, p-values, VIF, fit statistics."""
    from ..operators.filters import quantile_trim
    feats = [c for c in features if c in listings.columns]
    df = listings.select("city", "price", *feats).na.drop("any")
    df = quantile_trim(df, "price", trim_q).withColumn("log_price", log1p("price"))
    return S.ols(df, "log_price", feats, by=["city"])


def round_report(df: DataFrame, digits: int = 6) -> DataFrame:
    dbl = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: round_aggregate(c, digits) for c in dbl})
