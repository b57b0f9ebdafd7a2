"""Registered queries: each pairs a Spark builder with its DuckDB oracle SQL.

Builders read the driver tables under ``sf_dir`` through the synthetic
adapter, so every query's work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from oracle_queries import CITY_OF_BRAND, hu, q, re
from rentalytics.functions.text import NULL_TOKENS
from rentalytics.plans import queries as M
from rentalytics.plans.market import Market

_MARKETS: dict[tuple[str, int, str], Market] = {}


def market_for(spark: SparkSession, sf_dir: str) -> Market:
    """One lazy Market per (application, session, folder): plans are shared, nothing is cached in memory.

    The application id keeps a Market (and its checkpointed intermediates)
    from outliving its SparkContext when a session is stopped and a new one
    is created.
    """
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _MARKETS:
        _MARKETS[key] = Market.from_driver_tables(spark, sf_dir)
    return _MARKETS[key]


@dataclass
class Spec:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Spec] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = Spec(fn, sql)
        return fn
    return deco


# ------------------------------------------------------------------ M01-M10
@register("m01_top_neighbourhoods_avg_price", q(f"""
SELECT city, neighbourhood_cleansed, avg_price, listing_count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY avg_price DESC, neighbourhood_cleansed) AS INTEGER) AS rank
  FROM (SELECT city, neighbourhood_cleansed, {hu('avg(price)', 0)} AS avg_price, count(*) AS listing_count
        FROM fact_listings WHERE price IS NOT NULL GROUP BY city, neighbourhood_cleansed))
WHERE rank <= 5
"""))
def _m01(spark, d):
    return M.top_neighbourhoods_by_avg_price(market_for(spark, d).fact_listings)


@register("m02_superhost_comparison", q(f"""
SELECT f.city, h.host_is_superhost, count(*) AS listing_count, {hu('avg(f.price)', 0)} AS avg_price,
       {hu('avg(f.review_scores_rating)', 3)} AS avg_rating, {hu('avg(f.occupancy_rate)', 1)} AS avg_occupancy
FROM fact_listings f JOIN dim_host_flat h ON f.host_id = h.host_id AND f.city = h.city
WHERE h.host_is_superhost IS NOT NULL GROUP BY f.city, h.host_is_superhost
"""))
def _m02(spark, d):
    m = market_for(spark, d)
    return M.superhost_comparison(m.fact_listings, m.dim_host)


@register("m03_room_type_breakdown", q(f"""
SELECT city, room_type, count(*) AS listing_count, {hu('avg(price)', 0)} AS avg_price,
       {hu('avg(occupancy_rate)', 1)} AS avg_occupancy
FROM fact_listings GROUP BY city, room_type
"""))
def _m03(spark, d):
    return M.room_type_breakdown(market_for(spark, d).fact_listings)


@register("m04_reviews_by_year", q("""
SELECT city, review_year, count(*) AS review_count FROM reviews GROUP BY city, review_year
"""))
def _m04(spark, d):
    return M.reviews_by_year(market_for(spark, d).fact_reviews)


@register("m05_price_tier_distribution", q(f"""
SELECT city, price_tier, count(*) AS listing_count, {hu('avg(occupancy_rate)', 1)} AS avg_occupancy,
       {hu('avg(price)', 0)} AS avg_price
FROM fact_listings WHERE price_tier IS NOT NULL GROUP BY city, price_tier
"""))
def _m05(spark, d):
    return M.price_tier_distribution(market_for(spark, d).fact_listings)


M06_ARGS = dict(cities=["bangkok", "lisbon"], room_types=["ECONOMY", "LARGE", "PROMO", "STANDARD"],
                price_range=(910.0, 990.0), max_min_nights=40)


@register("m06_filtered_listings", q("""
SELECT listing_id, city, host_id, neighbourhood_cleansed, room_type, property_type, property_type_grouped,
       price, price_tier, price_per_bedroom, price_vs_neighbourhood, minimum_nights, maximum_nights,
       availability_365, number_of_reviews, review_scores_rating, review_scores_accuracy,
       review_scores_cleanliness, CAST(NULL AS DOUBLE) AS review_scores_checkin,
       CAST(NULL AS DOUBLE) AS review_scores_location, CAST(NULL AS DOUBLE) AS review_scores_communication,
       review_scores_value, review_score_composite, review_velocity, occupancy_rate, booked_days,
       available_days, estimated_annual_revenue, host_tenure_years, instant_bookable,
       calculated_host_listings_count, host_is_superhost, is_commercial_host, host_response_rate,
       host_acceptance_rate
FROM serving
WHERE city IN ('bangkok', 'lisbon') AND room_type IN ('ECONOMY', 'LARGE', 'PROMO', 'STANDARD')
  AND price BETWEEN 910.0 AND 990.0 AND minimum_nights <= 40 AND price IS NOT NULL
"""))
def _m06(spark, d):
    m = market_for(spark, d)
    return M.filtered_listings(m.fact_listings, m.dim_host, **M06_ARGS)


@register("m07_review_counts_monthly", q("""
SELECT city, review_year, review_month, review_year_month, count(*) AS review_count
FROM reviews WHERE review_year >= 1997 GROUP BY city, review_year, review_month, review_year_month
"""))
def _m07(spark, d):
    return M.review_counts_monthly(market_for(spark, d).fact_reviews, min_year=1997)


@register("m08_availability_month_weekend", q(f"""
SELECT city, month, is_weekend, {re('avg(CASE WHEN available THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE', 6)} AS availability_rate,
       count(*) AS total_days
FROM calendar GROUP BY city, month, is_weekend
"""))
def _m08(spark, d):
    from rentalytics.functions import round_aggregate
    df = M.availability_by_month_weekend(market_for(spark, d).fact_calendar)
    return df.withColumn("availability_rate", round_aggregate("availability_rate", 6))


@register("m09_neighbourhood_stats", q(f"""
SELECT city, neighbourhood_cleansed, count(*) AS listing_count, {hu('avg(price)', 0)} AS avg_price,
       {hu('quantile_cont(price, 0.5)', 0)} AS median_price, {hu('avg(review_scores_rating)', 3)} AS avg_rating,
       {hu('avg(occupancy_rate)', 1)} AS avg_occupancy, {hu('avg(estimated_annual_revenue)', 0)} AS avg_revenue
FROM fact_listings WHERE price IS NOT NULL GROUP BY city, neighbourhood_cleansed
"""))
def _m09(spark, d):
    return M.neighbourhood_stats(market_for(spark, d).fact_listings)


@register("m10_kpi_cards", q(f"""
SELECT coalesce(city, 'ALL') AS city, count(*) AS listing_count,
       {re('quantile_cont(price, 0.5)', 2)} AS median_price,
       {re('avg(occupancy_rate)', 4)} AS mean_occupancy, {re('avg(review_scores_rating)', 4)} AS mean_rating
FROM fact_listings GROUP BY ROLLUP (city)
"""))
def _m10(spark, d):
    return M.kpi_cards(market_for(spark, d).fact_listings)


# ------------------------------------------------------------------ SQL helpers for the oracle
def cap_sql(caps: dict) -> str:
    return "CASE city " + " ".join(f"WHEN '{k}' THEN {float(v)!r}" for k, v in caps.items()) + " END"


def hist_ctes(source: str, value: str, n: int, by: str = "city") -> str:
    """Leading-comma CTEs of an equal-width histogram per group (last bin closed)."""
    return f"""
, hbase AS (SELECT {by}, {value} AS v FROM {source} WHERE {value} IS NOT NULL),
hrng AS (SELECT {by}, CASE WHEN max(v) > min(v) THEN min(v) ELSE min(v) - 0.5 END AS lo,
                      CASE WHEN max(v) > min(v) THEN max(v) ELSE max(v) + 0.5 END AS hi
         FROM hbase GROUP BY {by}),
hb AS (SELECT {', '.join('b.' + x.strip() for x in by.split(','))}, lo, hi,
              CAST(least(floor((v - lo) / (hi - lo) * {n}) + 1, {n}) AS INTEGER) AS bin
       FROM hbase b JOIN hrng r USING ({by}))
"""


def hist_select(n: int, by: str = "city") -> str:
    return f"""SELECT {by}, bin, {re(f'lo + (bin - 1) * ((hi - lo) / {n})', 6)} AS bin_lo,
       {re(f'lo + bin * ((hi - lo) / {n})', 6)} AS bin_hi, count(*) AS count
FROM hb GROUP BY {by}, bin, lo, hi"""


def hist_sql(source: str, value: str, n: int, by: str = "city") -> str:
    return hist_ctes(source, value, n, by) + hist_select(n, by)


from rentalytics.sources.config import PRICE_CAPS  # noqa: E402
from rentalytics.plans.queries import (DISTANCE_EDGES, DISTANCE_LABELS, MIN_NIGHT_EDGES, MIN_NIGHT_LABELS,  # noqa: E402
                                       PORTFOLIO_EDGES, PORTFOLIO_LABELS, TENURE_EDGES, TENURE_LABELS)


def bucket_sql(v: str, edges, labels=None) -> str:
    parts = []
    for i in range(len(edges) - 1):
        out = f"'{labels[i]}'" if labels else str(i)
        upper = "" if edges[i + 1] == float("inf") else f" AND {v} <= {edges[i + 1]}"
        parts.append(f"WHEN {v} > {edges[i]}{upper} THEN {out}")
    return "CASE " + " ".join(parts) + " END"


DIST_CAP = cap_sql(PRICE_CAPS["distribution"])
COMM_CAP = cap_sql(PRICE_CAPS["commercial"])
SCAT_CAP = cap_sql(PRICE_CAPS["scatter"])


# ------------------------------------------------------------------ M12-M39
@register("m12_price_histogram", q(f"""
, capped AS (SELECT * FROM serving WHERE price IS NOT NULL AND price <= {DIST_CAP})
{hist_sql('capped', 'price', 50)}"""))
def _m12a(spark, d):
    return M.price_distribution(market_for(spark, d).serving())


@register("m12_price_summary", q(f"""
SELECT city, {re('quantile_cont(price, 0.5)', 6)} AS median_price, {re('avg(price)', 6)} AS mean_price,
       CAST({DIST_CAP} AS DOUBLE) AS price_cap
FROM serving WHERE price IS NOT NULL GROUP BY city
"""))
def _m12b(spark, d):
    return M.price_summary(market_for(spark, d).serving())


@register("m12_price_by_room_type_box", q(f"""
, base AS (SELECT city, room_type, price AS v FROM serving WHERE price IS NOT NULL AND price <= {DIST_CAP}),
qs AS (SELECT city, room_type, count(v) AS n, avg(v) AS mean, quantile_cont(v, 0.25) AS q1,
              quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
       FROM base GROUP BY city, room_type HAVING count(v) > 10),
w AS (SELECT b.city, b.room_type, min(CASE WHEN v >= q1 - 1.5 * (q3 - q1) THEN v END) AS whisker_low,
             max(CASE WHEN v <= q3 + 1.5 * (q3 - q1) THEN v END) AS whisker_high
      FROM base b JOIN qs USING (city, room_type) GROUP BY b.city, b.room_type)
SELECT city, room_type, n, {re('mean', 6)} AS mean, {re('q1', 6)} AS q1, {re('median', 6)} AS median,
       {re('q3', 6)} AS q3, {re('whisker_low', 6)} AS whisker_low, {re('whisker_high', 6)} AS whisker_high
FROM qs JOIN w USING (city, room_type)
"""))
def _m12c(spark, d):
    return M.price_by_room_type_box(market_for(spark, d).serving())


@register("m13_rating_inflation", q(f"""
SELECT city, count(review_scores_rating) AS rated,
       {re('CAST(count_if(review_scores_rating >= 4.5) AS DOUBLE) / CAST(count(review_scores_rating) AS DOUBLE) * 100', 6)} AS pct_at_least_high,
       {re('CAST(count_if(review_scores_rating = 5.0) AS DOUBLE) / CAST(count(review_scores_rating) AS DOUBLE) * 100', 6)} AS pct_perfect
FROM serving WHERE review_scores_rating IS NOT NULL GROUP BY city
"""))
def _m13(spark, d):
    return M.rating_inflation(market_for(spark, d).serving())


_DIMS = ["review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
         "review_scores_communication", "review_scores_location", "review_scores_value"]
_PRESENT = {"review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness", "review_scores_value"}


def _dim_sql(c):
    x = c if c in _PRESENT else "CAST(NULL AS DOUBLE)"
    return (f"SELECT city, '{c}' AS dimension, {re(f'avg(CASE WHEN host_is_superhost THEN {x} END)', 6)} AS mean_pos, "
            f"{re(f'avg(CASE WHEN NOT host_is_superhost THEN {x} END)', 6)} AS mean_neg, "
            f"{re(f'avg(CASE WHEN host_is_superhost THEN {x} END) - avg(CASE WHEN NOT host_is_superhost THEN {x} END)', 6)} AS gap "
            f"FROM serving WHERE host_is_superhost IS NOT NULL GROUP BY city")


@register("m14_review_dimension_gap", q("\n" + "\nUNION ALL\n".join(_dim_sql(c) for c in _DIMS)))
def _m14(spark, d):
    return M.review_dimension_gap(market_for(spark, d).serving())


@register("m15_host_portfolio", q(f"""
, per AS (SELECT city, host_id, count(listing_id) AS n FROM fact_listings WHERE host_id IS NOT NULL GROUP BY city, host_id)
SELECT city, {bucket_sql('n', PORTFOLIO_EDGES, PORTFOLIO_LABELS)} AS bucket,
       {bucket_sql('n', PORTFOLIO_EDGES)} AS bucket_order, count(*) AS entity_count
FROM per WHERE {bucket_sql('n', PORTFOLIO_EDGES)} IS NOT NULL GROUP BY ALL
"""))
def _m15(spark, d):
    return M.host_portfolio(market_for(spark, d).fact_listings)


@register("m16_market_concentration", q(f"""
, per AS (SELECT city, host_id, count(*) AS n FROM fact_listings WHERE host_id IS NOT NULL GROUP BY city, host_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC, host_id) AS r,
              count(*) OVER (PARTITION BY city) AS th FROM per)
SELECT city, count(*) AS total_hosts, CAST(sum(n) AS BIGINT) AS total_items, count_if(n > 1) AS multi_hosts,
       {re('CAST(count_if(n > 1) AS DOUBLE) / count(*) * 100', 6)} AS multi_host_pct,
       {re('CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100', 6)} AS multi_item_pct,
       {re('CAST(sum(CASE WHEN r <= floor(th * 0.1) THEN n ELSE 0 END) AS DOUBLE) / CAST(sum(n) AS DOUBLE) * 100', 6)} AS top_share_pct
FROM rk GROUP BY city
"""))
def _m16(spark, d):
    return M.market_concentration(market_for(spark, d).fact_listings)


@register("m17_availability_histogram", q(hist_sql("serving", "availability_365", 50)))
def _m17a(spark, d):
    return M.availability_distribution(market_for(spark, d).serving())


@register("m17_zero_availability_share", q(f"""
SELECT city, {re('CAST(count_if(availability_365 = 0) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100', 6)} AS pct_zero_availability
FROM serving GROUP BY city
"""))
def _m17b(spark, d):
    return M.zero_availability_share(market_for(spark, d).serving())


@register("m18_monthly_availability", q(f"""
, m AS (SELECT city, month, {re('avg(CAST(available AS DOUBLE)) * 100', 6)} AS availability_rate
        FROM calendar GROUP BY city, month),
axis AS (SELECT c.city, CAST(g.month AS INTEGER) AS month FROM (SELECT DISTINCT city FROM m) c,
         (SELECT unnest(range(1, 13)) AS month) g)
SELECT a.city, a.month, m.availability_rate FROM axis a LEFT JOIN m ON a.city = m.city AND a.month = m.month
"""))
def _m18(spark, d):
    return M.monthly_availability(market_for(spark, d).fact_calendar)


_RATES = """
, rates AS (SELECT city, month, is_weekend, avg(CASE WHEN available THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100.0::DOUBLE AS availability_rate
            FROM calendar GROUP BY city, month, is_weekend)
"""


@register("m19_monthly_mean_of_rates", q(_RATES + f"""
SELECT city, month, {re('avg(availability_rate)', 6)} AS availability_rate FROM rates GROUP BY city, month
"""))
def _m19a(spark, d):
    return M.availability_dashboard_views(market_for(spark, d).fact_calendar)[0]


@register("m19_weekend_mean_of_rates", q(_RATES + f"""
SELECT city, is_weekend, {re('avg(availability_rate)', 6)} AS availability_rate,
       CASE WHEN is_weekend THEN 'Weekend' WHEN NOT is_weekend THEN 'Weekday' END AS day_type
FROM rates GROUP BY city, is_weekend
"""))
def _m19b(spark, d):
    return M.availability_dashboard_views(market_for(spark, d).fact_calendar)[1]


@register("m20_occupancy_histogram", q(hist_ctes("serving", "occupancy_rate", 50) + f"""
, med AS (SELECT city, {re('quantile_cont(occupancy_rate, 0.5)', 6)} AS median_occupancy FROM serving GROUP BY city)
SELECT h.*, med.median_occupancy FROM ({hist_select(50)}) h JOIN med USING (city)
"""))
def _m20(spark, d):
    return M.occupancy_distribution(market_for(spark, d).serving())


@register("m21_top_neighbourhoods_median_price", q(f"""
SELECT * FROM (
  SELECT city, neighbourhood_cleansed, median_price,
         CAST(row_number() OVER (PARTITION BY city ORDER BY median_price DESC, neighbourhood_cleansed) AS INTEGER) AS rank
  FROM (SELECT city, neighbourhood_cleansed, quantile_cont(price, 0.5) AS median_price FROM serving
        WHERE price IS NOT NULL AND neighbourhood_cleansed IS NOT NULL GROUP BY city, neighbourhood_cleansed))
WHERE rank <= 10
"""))
def _m21(spark, d):
    return M.top_neighbourhoods_by_median_price(market_for(spark, d).serving())


_NB_METRICS = f"""
, nm AS (SELECT city, neighbourhood_cleansed, {re('quantile_cont(price, 0.5)', 6)} AS median_price,
                count(*) AS listing_count, {re('avg(occupancy_rate)', 6)} AS avg_occupancy,
                {re('avg(review_scores_rating)', 6)} AS avg_rating
         FROM serving WHERE neighbourhood_cleansed IS NOT NULL GROUP BY city, neighbourhood_cleansed)
"""


@register("m22_neighbourhood_ranking", q(_NB_METRICS + """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY avg_occupancy DESC NULLS LAST,
                      neighbourhood_cleansed) AS INTEGER) AS rank FROM nm) WHERE rank <= 10
"""))
def _m22(spark, d):
    return M.neighbourhood_ranking(market_for(spark, d).serving(), "avg_occupancy", 10)


@register("m23_price_vs_occupancy", q(f"""
SELECT * FROM (
SELECT city, neighbourhood_cleansed, count(*) AS listing_count, {hu('avg(price)', 0)} AS avg_price,
       {hu('quantile_cont(price, 0.5)', 0)} AS median_price, {hu('avg(review_scores_rating)', 3)} AS avg_rating,
       {hu('avg(occupancy_rate)', 1)} AS avg_occupancy, {hu('avg(estimated_annual_revenue)', 0)} AS avg_revenue
FROM fact_listings WHERE price IS NOT NULL GROUP BY city, neighbourhood_cleansed) WHERE listing_count >= 5
"""))
def _m23(spark, d):
    return M.price_vs_occupancy(market_for(spark, d).fact_listings)


@register("m24_choropleth_features", q(f"""
, feats AS (SELECT DISTINCT {CITY_OF_BRAND} AS city, p_brand AS neighbourhood FROM part),
st AS (SELECT city, neighbourhood_cleansed AS neighbourhood, count(*) AS listing_count,
              {hu('quantile_cont(price, 0.5)', 0)} AS median_price, {hu('avg(occupancy_rate)', 1)} AS avg_occupancy
       FROM fact_listings WHERE price IS NOT NULL GROUP BY city, neighbourhood_cleansed),
rng AS (SELECT city, {re('quantile_cont(median_price, 0.05)', 6)} AS colour_p05,
               {re('quantile_cont(median_price, 0.95)', 6)} AS colour_p95 FROM st GROUP BY city)
SELECT f.city, f.neighbourhood, coalesce(st.listing_count, 0) AS listing_count, st.median_price, st.avg_occupancy,
       rng.colour_p05, rng.colour_p95
FROM feats f LEFT JOIN st ON f.city = st.city AND f.neighbourhood = st.neighbourhood LEFT JOIN rng ON f.city = rng.city
"""))
def _m24(spark, d):
    m = market_for(spark, d)
    return M.choropleth_features(m.fact_listings, m.neighbourhoods)


_HAV = ("6371.0 * 2 * asin(sqrt(pow(sin((radians(clat) - radians(latitude)) / 2), 2) + "
        "cos(radians(latitude)) * cos(radians(clat)) * pow(sin((radians(clon) - radians(longitude)) / 2), 2)))")


@register("m25_price_gradient", q(f"""
, g AS (SELECT city, id, price, occupancy_rate,
               {_HAV.replace('clat', "(CASE city WHEN 'bangkok' THEN 13.7563 WHEN 'lisbon' THEN 38.7169 END)").replace('clon', "(CASE city WHEN 'bangkok' THEN 100.5018 WHEN 'lisbon' THEN -9.1399 END)")} AS dist
        FROM enriched WHERE id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND price IS NOT NULL
          AND occupancy_rate IS NOT NULL AND room_type IS NOT NULL)
SELECT city, {bucket_sql('dist', DISTANCE_EDGES, DISTANCE_LABELS)} AS distance_bin, {bucket_sql('dist', DISTANCE_EDGES)} AS bin_order,
       {re('quantile_cont(price, 0.5)', 6)} AS median_price, count(id) AS listing_count, {re('avg(occupancy_rate)', 6)} AS avg_occupancy
FROM g WHERE {bucket_sql('dist', DISTANCE_EDGES)} IS NOT NULL GROUP BY ALL
"""))
def _m25(spark, d):
    return M.price_gradient(market_for(spark, d).enriched)


@register("m26_room_mix_top_neighbourhoods", q(f"""
, cnt AS (SELECT city, neighbourhood_cleansed, count(*) AS n FROM serving WHERE neighbourhood_cleansed IS NOT NULL
          GROUP BY city, neighbourhood_cleansed),
top AS (SELECT city, neighbourhood_cleansed FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC,
        neighbourhood_cleansed) AS r FROM cnt) WHERE r <= 15),
sub AS (SELECT s.* FROM serving s SEMI JOIN top t ON s.city = t.city AND s.neighbourhood_cleansed = t.neighbourhood_cleansed),
grid AS (SELECT r.city, r.neighbourhood_cleansed, c.room_type FROM (SELECT DISTINCT city, neighbourhood_cleansed FROM sub) r,
         (SELECT DISTINCT room_type FROM sub) c),
x AS (SELECT g.city, g.neighbourhood_cleansed, g.room_type, count(s.listing_id) AS count
      FROM grid g LEFT JOIN sub s ON g.city = s.city AND g.neighbourhood_cleansed = s.neighbourhood_cleansed AND g.room_type = s.room_type
      GROUP BY ALL),
p AS (SELECT *, CAST(count AS DOUBLE) / sum(count) OVER (PARTITION BY city, neighbourhood_cleansed) * 100 AS row_pct FROM x)
SELECT city, neighbourhood_cleansed, room_type, count, {re('row_pct', 6)} AS row_pct,
       {re('coalesce(sum(row_pct) OVER (PARTITION BY city, neighbourhood_cleansed ORDER BY room_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)', 6)} AS cum_before
FROM p
"""))
def _m26(spark, d):
    return M.room_mix_top_neighbourhoods(market_for(spark, d).serving())


@register("m27_yearly_review_trend", q("""
SELECT city, review_year, count(*) AS review_count FROM reviews WHERE review_year BETWEEN 1996 AND 2000
GROUP BY city, review_year
"""))
def _m27(spark, d):
    return M.yearly_review_trend(market_for(spark, d).fact_reviews, 1996, 2000)


@register("m28_weekend_vs_weekday", q(f"""
SELECT city, is_weekend, {re('avg(CAST(available AS DOUBLE)) * 100', 6)} AS availability_rate FROM calendar GROUP BY city, is_weekend
"""))
def _m28(spark, d):
    return M.weekend_vs_weekday(market_for(spark, d).fact_calendar)


@register("m29_minimum_night_policy", q(f"""
, b AS (SELECT city, {bucket_sql('minimum_nights', MIN_NIGHT_EDGES, MIN_NIGHT_LABELS)} AS band FROM serving WHERE minimum_nights <= 365),
c AS (SELECT city, band, count(*) AS count FROM b WHERE band IS NOT NULL GROUP BY city, band)
SELECT city, band, count, {re('CAST(count AS DOUBLE) / sum(count) OVER (PARTITION BY city) * 100', 6)} AS share_pct FROM c
"""))
def _m29(spark, d):
    return M.minimum_night_policy(market_for(spark, d).serving())


@register("m30_tenure_vs_price", q(f"""
, t AS (SELECT city, price, {bucket_sql('host_tenure_years', TENURE_EDGES, TENURE_LABELS)} AS tenure_bin FROM serving
        WHERE host_tenure_years IS NOT NULL AND price IS NOT NULL AND host_tenure_years <= 16)
SELECT city, tenure_bin, {re('quantile_cont(price, 0.5)', 6)} AS median_price FROM t WHERE tenure_bin IS NOT NULL
GROUP BY city, tenure_bin
"""))
def _m30(spark, d):
    return M.tenure_vs_price(market_for(spark, d).serving())


@register("m31_superhost_profile", q(f"""
SELECT city,
  {re('CAST(count_if(host_is_superhost) AS DOUBLE) / CAST(count(host_is_superhost) AS DOUBLE) * 100', 6)} AS superhost_pct,
  {re('quantile_cont(price, 0.5) FILTER (WHERE host_is_superhost)', 6)} AS sh_median_price,
  {re('quantile_cont(price, 0.5) FILTER (WHERE NOT host_is_superhost)', 6)} AS nsh_median_price,
  {re('avg(occupancy_rate) FILTER (WHERE host_is_superhost)', 6)} AS sh_avg_occupancy,
  {re('avg(occupancy_rate) FILTER (WHERE NOT host_is_superhost)', 6)} AS nsh_avg_occupancy,
  {re('avg(review_scores_rating) FILTER (WHERE host_is_superhost)', 6)} AS sh_avg_rating,
  {re('avg(review_scores_rating) FILTER (WHERE NOT host_is_superhost)', 6)} AS nsh_avg_rating,
  {re('avg(review_scores_rating) FILTER (WHERE host_is_superhost) - avg(review_scores_rating) FILTER (WHERE NOT host_is_superhost)', 6)} AS rating_advantage
FROM serving GROUP BY city
"""))
def _m31(spark, d):
    return M.superhost_profile(market_for(spark, d).serving())


@register("m32_commercial_profile", q(f"""
SELECT city, is_commercial_host, count(*) AS count,
       {re('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY city) * 100', 6)} AS share_pct,
       {re('quantile_cont(price, 0.5)', 6)} AS median_price, {re('avg(occupancy_rate)', 6)} AS avg_occupancy,
       {re('avg(review_scores_rating)', 6)} AS avg_rating
FROM serving WHERE is_commercial_host IS NOT NULL GROUP BY city, is_commercial_host
"""))
def _m32(spark, d):
    return M.commercial_profile(market_for(spark, d).serving())


@register("m32_commercial_price_histograms", q(f"""
, capped AS (SELECT * FROM serving WHERE price IS NOT NULL AND is_commercial_host IS NOT NULL AND price <= {COMM_CAP})
{hist_sql('capped', 'price', 40, 'city, is_commercial_host')}"""))
def _m32b(spark, d):
    return M.commercial_price_histograms(market_for(spark, d).serving())


def mix32_sql(x: str, seed: int) -> str:
    """The oracle's statement of ``functions.mix32`` (same integer steps)."""
    from rentalytics.functions.numeric import MIX_MULTIPLIER
    v = f"((({x}) + {seed}) % 4294967296 + 4294967296) % 4294967296"
    for _ in range(2):
        v = f"((xor(({v}) >> 16, {v}) * {MIX_MULTIPLIER}) % 4294967296)"
    return f"xor(({v}) >> 16, {v})"


@register("m33_scatter_sample", q(f"""
SELECT listing_id, city, number_of_reviews, price, review_scores_rating FROM (
  SELECT *, row_number() OVER (PARTITION BY city ORDER BY {mix32_sql('listing_id', 42)}, listing_id) AS r
  FROM serving WHERE price IS NOT NULL AND number_of_reviews > 0)
WHERE r <= 2000 AND price <= {cap_sql(PRICE_CAPS["reviews"])}
"""))
def _m33(spark, d):
    return M.scatter_sample(market_for(spark, d).serving())


@register("m33_rating_price_sample", q(f"""
SELECT listing_id, city, review_scores_rating, price, occupancy_rate FROM serving
WHERE price IS NOT NULL AND review_scores_rating IS NOT NULL AND occupancy_rate IS NOT NULL
  AND price <= {cap_sql(PRICE_CAPS["scatter"])}
ORDER BY {mix32_sql('listing_id', 42)}, listing_id LIMIT 3000
"""))
def _m33b(spark, d):
    return M.rating_price_sample(market_for(spark, d).serving())


@register("m34_review_velocity_histogram", q(f"""
, cut AS (SELECT city, quantile_cont(review_velocity, 0.95) AS top FROM serving WHERE review_velocity IS NOT NULL GROUP BY city),
trimmed AS (SELECT s.* FROM serving s JOIN cut USING (city) WHERE review_velocity <= top),
med AS (SELECT city, quantile_cont(review_velocity, 0.5) AS m FROM trimmed GROUP BY city)
{hist_ctes('trimmed', 'review_velocity', 60)}
SELECT city, bin, {re('lo + (bin - 1) * ((hi - lo) / 60)', 6)} AS bin_lo, {re('lo + bin * ((hi - lo) / 60)', 6)} AS bin_hi,
       count(*) AS count, {re('m', 6)} AS trimmed_median
FROM hb JOIN med USING (city) GROUP BY city, bin, lo, hi, m
"""))
def _m34b(spark, d):
    return M.review_velocity_histogram(market_for(spark, d).serving())


@register("m34_review_velocity_summary", q(f"""
SELECT city, {re('quantile_cont(review_velocity, 0.5)', 6)} AS median_velocity, {re('avg(review_velocity)', 6)} AS mean_velocity,
       {re('CAST(count_if(review_velocity > 20) AS DOUBLE) / CAST(count(review_velocity) AS DOUBLE) * 100', 6)} AS pct_fast,
       {re('quantile_cont(review_velocity, 0.95)', 6)} AS p95_velocity
FROM serving WHERE review_velocity IS NOT NULL GROUP BY city
"""))
def _m34(spark, d):
    return M.review_velocity_summary(market_for(spark, d).serving())


@register("m35_high_review_low_score", q(f"""
SELECT city, count(*) AS flagged, {re('quantile_cont(price, 0.5)', 6)} AS median_price,
       {re('quantile_cont(occupancy_rate, 0.5)', 6)} AS median_occupancy FROM serving
WHERE number_of_reviews > 18 AND review_scores_rating < 4.5 GROUP BY city
"""))
def _m35(spark, d):
    return M.high_review_low_score(market_for(spark, d).serving(), min_reviews=18)


@register("m35_review_rating_points", q(f"""
SELECT listing_id, city, number_of_reviews, review_scores_rating, price FROM serving
WHERE number_of_reviews >= 10 AND review_scores_rating IS NOT NULL AND price IS NOT NULL AND price <= {cap_sql(PRICE_CAPS["reviews"])}
"""))
def _m35b(spark, d):
    return M.review_rating_points(market_for(spark, d).serving())


@register("m36_price_tier_performance", q(f"""
SELECT city, price_tier, count(*) AS count,
       {re('CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY city) * 100', 6)} AS share_pct,
       {re('avg(occupancy_rate)', 6)} AS avg_occupancy, {re('quantile_cont(estimated_annual_revenue, 0.5)', 6)} AS median_revenue,
       CASE price_tier WHEN 'Budget' THEN 0 WHEN 'Mid-range' THEN 1 WHEN 'Premium' THEN 2 END AS tier_order
FROM serving WHERE price_tier IS NOT NULL GROUP BY city, price_tier
"""))
def _m36(spark, d):
    return M.price_tier_performance(market_for(spark, d).serving())


@register("m37_category_counts", q("""
SELECT city, 'room_type' AS dimension, room_type AS value, count(*) AS count FROM serving GROUP BY city, room_type
UNION ALL
SELECT city, 'property_type_grouped', property_type_grouped, count(*) FROM serving GROUP BY city, property_type_grouped
"""))
def _m37(spark, d):
    return M.category_counts(market_for(spark, d).serving())


@register("m38_neighbourhood_top5_summary", q("""
SELECT city, neighbourhood_cleansed, neighbourhood_median_price, neighbourhood_listing_count, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY neighbourhood_median_price DESC, neighbourhood_cleansed) AS INTEGER) AS rank
  FROM nb) WHERE rank <= 5
"""))
def _m38(spark, d):
    return M.neighbourhood_top5_summary(market_for(spark, d).enriched)


@register("m38_neighbourhood_top5_by_count", q(f"""
, st AS (SELECT city, neighbourhood_cleansed, count(*) AS listing_count, {re('quantile_cont(price, 0.5)', 6)} AS median_price,
                {re('avg(occupancy_rate)', 6)} AS avg_occupancy
         FROM serving WHERE neighbourhood_cleansed IS NOT NULL GROUP BY city, neighbourhood_cleansed)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY city ORDER BY listing_count DESC, neighbourhood_cleansed) AS INTEGER) AS rank
               FROM st) WHERE rank <= 5
"""))
def _m38b(spark, d):
    return M.neighbourhood_top5_by_count(market_for(spark, d).serving())


@register("m39_listing_count_per_city", q("""
SELECT city, count(*) AS listing_count FROM fact_listings GROUP BY city
"""))
def _m39(spark, d):
    return M.listing_count_per_city(market_for(spark, d).fact_listings)


@register("a29_calendar_cleaning_summary", q(f"""
SELECT city,
       {re('avg(CASE WHEN is_weekend THEN CAST(available AS DOUBLE) END) * 100', 6)} AS weekend_availability_pct,
       {re('avg(CASE WHEN NOT is_weekend THEN CAST(available AS DOUBLE) END) * 100', 6)} AS weekday_availability_pct,
       min(date) AS first_date, max(date) AS last_date
FROM calendar GROUP BY city
"""))
def _a29(spark, d):
    return M.calendar_cleaning_summary(market_for(spark, d).fact_calendar)


@register("a27_review_cleaning_summary", q("""
SELECT city, min(date) AS first_date, max(date) AS last_date, min(review_year) AS first_year,
       max(review_year) AS last_year, min(comment_length) AS min_comment_length,
       max(comment_length) AS max_comment_length,
       quantile_cont(comment_length, 0.5) AS median_comment_length
FROM reviews GROUP BY city
"""))
def _a27(spark, d):
    return M.review_cleaning_summary(market_for(spark, d).fact_reviews)


@register("b04_neighbourhoods_clean", q(f"""
, feats AS (SELECT DISTINCT {CITY_OF_BRAND} AS city, p_brand AS neighbourhood FROM part)
SELECT city, CAST(row_number() OVER (PARTITION BY city ORDER BY neighbourhood) AS INTEGER) AS neighbourhood_id,
       neighbourhood, CAST(NULL AS VARCHAR) AS neighbourhood_group, 'Polygon' AS geometry_type
FROM feats
"""))
def _b04(spark, d):
    return market_for(spark, d).neighbourhoods


@register("s10_cleaned_feature_properties", q(f"""
, feats AS (SELECT DISTINCT {CITY_OF_BRAND} AS city, p_brand AS neighbourhood FROM part)
SELECT city, neighbourhood, json_object('neighbourhood', neighbourhood, 'city', city)::VARCHAR AS properties_json
FROM feats
"""))
def _s10(spark, d):
    from pyspark.sql import functions as F
    from rentalytics.plans.clean import cleaned_features
    f = cleaned_features(market_for(spark, d).raw_features)
    return f.select("city", F.col("feature.properties.neighbourhood").alias("neighbourhood"),
                    F.to_json("feature.properties").alias("properties_json"))


# ------------------------------------------------------------------ sources and sinks over text built from the tables
def _scratch(spark, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    import uuid
    from rentalytics.session import scratch_path
    return scratch_path(spark, f"text/{name}-{uuid.uuid4().hex}")


@register("s03_orders_through_csv", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders
""")
def _s03(spark, d):
    """S09 CSV stage output, S01 / S03 read with dates parsed at load, S04 / P03 wanted columns, P04 rename."""
    from pyspark.sql import functions as F
    from rentalytics.functions import lenient_date
    from rentalytics.operators.filters import rename, select_present
    from rentalytics.sources.files import read_csv_raw
    from rentalytics.sources.sinks import write_stage
    path = _scratch(spark, "orders")
    out = read_table(spark, d, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    write_stage(rename(out, {"o_totalprice": "price", "absent": "x"}), path, "csv")
    raw = select_present(read_csv_raw(spark, path), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "price", "absent"])
    typed = raw.withColumns({"o_orderkey": F.col("o_orderkey").cast("bigint"), "o_custkey": F.col("o_custkey").cast("bigint"),
                             "o_orderdate": lenient_date("o_orderdate"), "price": F.col("price").cast("double")})
    return rename(typed, {"price": "o_totalprice"})


_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


@register("s02_documents_through_csv", f"""
SELECT doc_id, CASE WHEN text NOT IN ({_TOKENS}) THEN text END AS text, CASE WHEN lang NOT IN ({_TOKENS}) THEN lang END AS lang FROM documents
""")
def _s02(spark, d):
    """Whole multi-line texts with quotes through CSV and back, missing-value tokens as null."""
    from pyspark.sql import functions as F
    from rentalytics.sources.files import read_csv_raw
    from rentalytics.sources.sinks import write_stage
    path = _scratch(spark, "documents")
    write_stage(read_table(spark, d, "documents").select("doc_id", "text", "lang"), path, "csv")
    return read_csv_raw(spark, path, ["doc_id", "text", "lang"]).withColumn("doc_id", F.col("doc_id").cast("bigint"))


AREAS_A_DOCUMENT = 500


@register("s05_broken_records", """
WITH lines AS (SELECT doc_id, CASE doc_id % 7 WHEN 3 THEN 1 WHEN 5 THEN 3 ELSE 2 END AS fields FROM documents)
SELECT CAST(doc_id % 2 AS INTEGER) AS side, count(*) AS rows, count(*) FILTER (fields <> 2) AS broken, count(*) FILTER (fields = 2) AS fine,
       count(*) FILTER (fields > 1) AS with_text, 0 AS absent_sources
FROM lines GROUP BY doc_id % 2
UNION ALL SELECT 2, 0, 0, 0, 0, 2
""")
def _s05(spark, d):
    """Documents as CSV in which some records lack their text or have a field too many: broken records are told and
    counted with the others (Q04); of two optional sources one is missing and one cannot be read."""
    from pyspark.sql import functions as F
    from rentalytics.sources.files import read_csv_raw, read_optional
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    kind = F.col("doc_id") % 7
    line = F.when(kind == 3, F.col("doc_id").cast("string")).when(kind == 5, F.concat_ws(",", "doc_id", quoted, F.lit("more"))).otherwise(F.concat_ws(",", "doc_id", quoted))
    path, bad = _scratch(spark, "broken"), _scratch(spark, "unreadable")
    # each file of the text sink starts with the header, as files of a CSV sink do
    docs = read_table(spark, d, "documents")
    head = F.first(F.lit("doc_id,text"))
    docs.withColumn("part", F.spark_partition_id()).groupBy("part").agg(head.alias("value")).select("part", "value", F.lit(0).alias("o")) \
        .unionByName(docs.select(F.spark_partition_id().alias("part"), line.alias("value"), F.lit(1).alias("o"))) \
        .repartition("part").sortWithinPartitions("part", "o").drop("o").write.partitionBy("part").text(path)
    read = read_csv_raw(spark, path, ["doc_id", "text"], null_tokens=False, corrupt="broken")
    docs.limit(1).select("doc_id").write.orc(bad)
    absent = [read_optional(lambda: read_csv_raw(spark, f"{path}-none"), "none"), read_optional(lambda: spark.read.schema("doc_id long").parquet(bad), "bad")]
    counts = read.groupBy((F.col("doc_id").cast("bigint") % 2).cast("int").alias("side")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("broken").alias("broken"), F.count_if(F.col("broken").isNull()).alias("fine"),
        F.count("text").alias("with_text"), F.lit(0).alias("absent_sources"))
    zero = spark.range(1).select(F.lit(2).alias("side"), *[F.lit(0).cast("long").alias(c) for c in ("rows", "broken", "fine", "with_text")],
                                 F.lit(sum(a is None for a in absent)).alias("absent_sources"))
    return counts.unionByName(zero)


@register("s06_areas_through_geojson", f"""
SELECT p_partkey // {AREAS_A_DOCUMENT} AS doc, CAST(row_number() OVER (PARTITION BY p_partkey // {AREAS_A_DOCUMENT} ORDER BY p_partkey) AS BIGINT) AS feature_pos,
       p_name AS neighbourhood, p_brand AS neighbourhood_group, CASE WHEN p_size % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS geometry_type,
       CAST(p_size AS BIGINT) AS size, p_name || '!' AS name_out, 'here' AS city_out, CAST(p_size AS BIGINT) AS size_out
FROM part
""")
def _s06(spark, d):
    """GeoJSON documents of some hundred areas each, made from ``part``, cut into features by many tasks (S06 / F31 / F32), and
    written again with a property overwritten and one inserted (S10 / F33); other properties stay."""
    from pyspark.sql import functions as F
    from rentalytics.sources.files import read_geojson_features
    from rentalytics.sources.sinks import feature_json
    part = read_table(spark, d, "part")
    ring = F.array(*[F.array(F.col("p_size") + x, F.col("p_partkey") % 90 + y) for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))])
    shape = F.when(F.col("p_size") % 3 == 0, F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring)).alias("coordinates")))).otherwise(
        F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))))
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"),
                                 F.struct(F.col("p_name").alias("neighbourhood"), F.col("p_brand").alias("neighbourhood_group"), F.col("p_size").alias("size")).alias("properties"),
                                 F.parse_json(shape).alias("geometry")))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", feature.alias("f")))), lambda x: x["f"])
    docs = part.groupBy(F.expr(f"p_partkey div {AREAS_A_DOCUMENT}").alias("doc")).agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(listed, ","), F.lit("]}")).alias("value"))
    path = _scratch(spark, "areas")
    docs.repartition("doc").write.partitionBy("doc").text(path)  # a file for each document
    read = read_geojson_features(spark, path)
    p = F.col("feature.properties")
    changed = read.withColumn("feature", F.col("feature").withField("properties", p.withField("neighbourhood", F.concat(p["neighbourhood"], F.lit("!")))
                                                                    .withField("city", F.lit("here"))))
    # each feature as read, beside the text that is written from its changed form
    out = F.parse_json("value")
    back = feature_json(changed, keep=["file", "feature_pos"]).select(
        "file", "feature_pos", F.variant_get(out, "$.properties.neighbourhood", "string").alias("name_out"),
        F.variant_get(out, "$.properties.city", "string").alias("city_out"), F.variant_get(out, "$.properties.size", "bigint").alias("size_out"))
    flat = read.select("file", "feature_pos", p["neighbourhood"].alias("neighbourhood"), p["neighbourhood_group"].alias("neighbourhood_group"),
                       F.variant_get("feature.geometry", "$.type", "string").alias("geometry_type"), F.variant_get(p["source"], "$.size", "bigint").alias("size"))
    return flat.join(back, ["file", "feature_pos"]).withColumn("doc", F.regexp_extract("file", "doc=([0-9]+)", 1).cast("bigint")).drop("file")


@register("s11_profile_report_stage", """
SELECT 'customers' AS stage, count(*) AS rows, count(*) - count(c_name) AS nulls_c_name, count(*) - count(c_acctbal) AS nulls_c_acctbal FROM customer
UNION ALL
SELECT 'positive', count(*), count(*) - count(c_name), count(*) - count(c_acctbal) FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT 'loaded', count(*), count(*) - count(c_name), 0 FROM customer WHERE c_acctbal > 0 OR c_nationkey = 3
""")
def _s11(spark, d):
    """Q04 audit of a cleaning and of an appended table (S12, P05, P09), written and read as a stage report."""
    from pyspark.sql import functions as F
    from rentalytics.operators.filters import where_all, with_literal
    from rentalytics.operators.quality import audit
    from rentalytics.sources.sinks import append_load, write_stage
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_nationkey")
    positive, path = where_all(c, F.col("c_acctbal") > 0), _scratch(spark, "customers")
    append_load(positive, path, "one")
    append_load(with_literal(where_all(c, F.col("c_acctbal") <= 0, F.col("c_nationkey") == 3), "city", "two"), path)
    report = _scratch(spark, "report")
    write_stage(audit({"customers": c, "positive": positive, "loaded": spark.read.parquet(path)}, ["c_name", "c_acctbal"]), report)
    return spark.read.parquet(report)


@register("p02_customer_columns", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL
""")
def _p02(spark, d):
    """Columns without any value go; P16: nothing is done on an empty result."""
    from pyspark.sql import functions as F
    from rentalytics.operators.filters import drop_all_null_columns, drop_nulls, is_empty
    c = drop_nulls(read_table(spark, d, "customer").select("c_custkey", "c_acctbal", F.lit(None).cast("string").alias("unused"),
                                                           F.lit(None).cast("double").alias("kept")), ["c_acctbal"])
    return c if is_empty(c) else drop_all_null_columns(c, keep=["kept"]).drop("kept")


@register("f06_money_labels", """
SELECT o_orderkey, CASE WHEN o_totalprice >= 1000000 THEN '€' || CAST(round(CAST(o_totalprice / 1000000 AS DECIMAL(38, 10)), 1) AS DECIMAL(38, 1)) || 'M'
                        WHEN o_totalprice >= 1000 THEN '€' || CAST(round(CAST(o_totalprice / 1000 AS DECIMAL(38, 10)), 1) AS DECIMAL(38, 1)) || 'K'
                        ELSE format('€{:,.0f}', o_totalprice) END AS label,
       ln(1 + o_totalprice) AS log_price
FROM orders
""")
def _f06(spark, d):
    """F06 and F22 on every order."""
    from rentalytics.functions import human_money, log1p
    o = read_table(spark, d, "orders")
    return o.select("o_orderkey", human_money("o_totalprice", "€").alias("label"), log1p("o_totalprice").alias("log_price"))


@register("t01_first_orders", """
SELECT o_orderkey, o_custkey, o_orderdate, place FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY o_orderdate DESC, o_custkey, o_orderkey) AS BIGINT) AS place FROM orders) WHERE place <= 1000
""")
def _t01(spark, d):
    """The first thousand of an order by three keys, with their places."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from rentalytics.operators.windows import top_k
    keys, falling = ["o_orderdate", "o_custkey", "o_orderkey"], [True, False, False]
    top = top_k(read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), 1000, keys, falling)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc(keys[0]), *keys[1:])).cast("long"))  # 1000 rows


@register("t03_orders_sorted", """
SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, CAST(row_number() OVER (ORDER BY o_orderdate DESC, o_custkey, o_orderkey) AS BIGINT) AS place FROM orders
""")
def _t03(spark, d):
    """Every order with its place by three keys, in that order."""
    from rentalytics.operators.windows import places, sort
    keys, falling = ["o_orderdate", "o_custkey", "o_orderkey"], [True, False, False]
    orders = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return sort(places(orders, keys, falling), ["place"])


@register("u01_shipping_dates", """
SELECT l_shipdate AS date FROM lineitem WHERE l_shipdate IS NOT NULL UNION SELECT o_orderdate FROM orders WHERE o_orderdate IS NOT NULL
""")
def _u01(spark, d):
    """Two date columns of different tables, distinct and sorted."""
    from pyspark.sql import functions as F
    from rentalytics.operators.sets import distinct_union
    from rentalytics.operators.windows import sort
    ships, orders = read_table(spark, d, "lineitem").select(F.col("l_shipdate").alias("date")), read_table(spark, d, "orders").select(F.col("o_orderdate").alias("date"))
    return sort(distinct_union([ships, orders], "date"), ["date"])


@register("q06_unknown_tenants", """
SELECT DISTINCT city FROM (SELECT CASE WHEN n.n_nationkey = 3 THEN 'lisbon' ELSE lower(n.n_name) END AS city
                           FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
WHERE city NOT IN ('bangkok', 'lisbon')
""")
def _q06(spark, d):
    from pyspark.sql import functions as F
    from rentalytics.sources.config import config_frame
    c, n = read_table(spark, d, "customer"), read_table(spark, d, "nation")
    city = F.when(F.col("n_nationkey") == 3, F.lit("lisbon")).otherwise(F.lower("n_name"))  # one that is configured
    requested = c.join(n, c.c_nationkey == n.n_nationkey).select(city.alias("city"))
    return QU.unknown_tenants(requested, config_frame(spark))


@register("b14_publish_twice", q("""
, kept AS (SELECT * FROM fact_listings WHERE city = 'bangkok' AND listing_id % 2 = 0),
days AS (SELECT c.* FROM calendar c WHERE c.city = 'bangkok' AND c.listing_id % 2 = 0)
SELECT 'fact_listings' AS table_name, 'bangkok' AS city, count(*) AS rows, sum(listing_id)::BIGINT AS key_sum FROM kept
UNION ALL SELECT 'fact_calendar', 'bangkok', count(*), sum(listing_id)::BIGINT FROM days
UNION ALL SELECT 'dim_host', 'bangkok', count(DISTINCT host_id), sum(DISTINCT host_id)::BIGINT FROM kept WHERE host_id IS NOT NULL
UNION ALL SELECT 'dim_room_type', 'bangkok', count(DISTINCT room_type), (count(DISTINCT room_type) * (count(DISTINCT room_type) + 1) // 2)::BIGINT FROM kept WHERE room_type IS NOT NULL
UNION ALL SELECT 'runs', city, 2, sum(n)::BIGINT FROM (
  SELECT 'bangkok' AS city, 1 AS n UNION ALL SELECT 'lisbon', 0) GROUP BY city
"""))
def _b14(spark, d):
    """Both cities are published, then again with half of one city's listings and none of the other's, and read
    back by the run log; ``runs`` has each city's runs in the log and whether the last one left it any rows."""
    from functools import reduce
    from pyspark.sql import functions as F
    from rentalytics.plans import build
    from rentalytics.plans.market import Market, Published
    from rentalytics.sources.sinks import RUN_LOG
    from rentalytics.sources.synthetic import SYNTHETIC_PROPERTY_GROUPS, SyntheticSource
    src, base, cities = SyntheticSource(spark, d), _scratch(spark, "star"), ["bangkok", "lisbon"]
    listings, calendar = src.listings(), src.calendar()
    half = (F.col("city") == "bangkok") & (F.col("id").cast("bigint") % 2 == 0)
    build.publish(Market(spark, listings=listings, calendar=calendar, property_groups=SYNTHETIC_PROPERTY_GROUPS), base, cities)
    build.publish(Market(spark, listings=listings.where(half), property_groups=SYNTHETIC_PROPERTY_GROUPS,
                         calendar=calendar.where((F.col("city") == "bangkok") & (F.col("listing_id").cast("bigint") % 2 == 0))), base, cities)
    now = Published(spark, base)
    keys = {"fact_listings": "listing_id", "fact_calendar": "listing_id", "dim_host": "host_id", "dim_room_type": "room_type_id"}
    parts = [getattr(now, t).groupBy("city").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(k).cast("bigint")).alias("key_sum"))
             .select(F.lit(t).alias("table_name"), "city", "rows", "key_sum") for t, k in keys.items()]
    log = spark.read.parquet(f"{base}/{RUN_LOG}").groupBy("city").agg(
        F.count(F.lit(1)).alias("rows"), F.max_by((F.col("total_rows") > 0).cast("bigint"), "run_timestamp").alias("key_sum"))
    return reduce(lambda x, y: x.unionByName(y), [*parts, log.select(F.lit("runs").alias("table_name"), "city", "rows", "key_sum")])


# ------------------------------------------------------------------ builders
from rentalytics.schema import FACT_LISTINGS  # noqa: E402


@register("b03_occupancy_summary", q("SELECT city, listing_id, total_days, available_days, booked_days, occupancy_rate FROM occ"))
def _b03(spark, d):
    return market_for(spark, d).occupancy


@register("b06_dim_host", q("""
SELECT host_id, city, f.name AS host_name, CAST(NULL AS DATE) AS host_since, CAST(NULL AS VARCHAR) AS host_location,
       CAST(NULL AS VARCHAR) AS host_response_time, f.rr AS host_response_rate, f.ar AS host_acceptance_rate,
       f.sh AS host_is_superhost, TRUE AS host_has_profile_pic, f.iv AS host_identity_verified,
       CAST(NULL AS DOUBLE) AS host_listings_count, CAST(NULL AS DOUBLE) AS host_total_listings_count,
       f.ten AS host_tenure_years, f.com AS is_commercial_host
FROM dim_host
"""))
def _b06(spark, d):
    return market_for(spark, d).dim_host


@register("b07_dim_neighbourhood", q(f"""
, feats AS (SELECT DISTINCT {CITY_OF_BRAND} AS city, p_brand AS neighbourhood FROM part),
st AS (SELECT city, neighbourhood_cleansed AS neighbourhood, count(id) AS listing_count,
              {re('quantile_cont(price, 0.5)', 2)} AS median_price, {re('avg(review_scores_rating)', 2)} AS avg_rating,
              {re('avg(occupancy_rate)', 2)} AS avg_occupancy
       FROM enriched WHERE neighbourhood_cleansed IS NOT NULL GROUP BY city, neighbourhood_cleansed)
SELECT CAST(row_number() OVER (PARTITION BY f.city ORDER BY f.neighbourhood) AS INTEGER) AS neighbourhood_id,
       f.city, f.neighbourhood, CAST(NULL AS VARCHAR) AS neighbourhood_group, 'Polygon' AS geometry_type,
       st.listing_count, st.median_price, st.avg_rating, st.avg_occupancy
FROM feats f LEFT JOIN st ON f.city = st.city AND f.neighbourhood = st.neighbourhood
"""))
def _b07(spark, d):
    return market_for(spark, d).dim_neighbourhood


@register("b08_dim_room_type", q(f"""
SELECT CAST(row_number() OVER (PARTITION BY city ORDER BY room_type) AS INTEGER) AS room_type_id, city, room_type,
       count(id) AS listing_count, {re('avg(price)', 2)} AS avg_price, {re('avg(occupancy_rate)', 2)} AS avg_occupancy
FROM enriched WHERE room_type IS NOT NULL GROUP BY city, room_type
"""))
def _b08(spark, d):
    return market_for(spark, d).dim_room_type


@register("b09_dim_property_type", q(f"""
SELECT CAST(row_number() OVER (PARTITION BY city ORDER BY property_type) AS INTEGER) AS property_type_id, city,
       property_type, count(id) AS listing_count, {re('avg(price)', 2)} AS avg_price
FROM enriched WHERE property_type IS NOT NULL GROUP BY city, property_type
"""))
def _b09(spark, d):
    return market_for(spark, d).dim_property_type


@register("b10_dim_date", q("""
, dates AS (SELECT DISTINCT city, date FROM (SELECT city, date FROM reviews UNION ALL SELECT city, date FROM calendar)
            WHERE date IS NOT NULL)
SELECT CAST(row_number() OVER (PARTITION BY city ORDER BY date) AS INTEGER) AS date_id, city, date,
       CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
       CAST(quarter(date) AS INTEGER) AS quarter, dayname(date) AS day_of_week, dayofweek(date) IN (0, 6) AS is_weekend
FROM dates
"""))
def _b10(spark, d):
    return market_for(spark, d).dim_date


@register("b11_fact_listings", q("SELECT * FROM fact_full"))
def _b11(spark, d):
    return market_for(spark, d).fact_listings


@register("b12_fact_reviews", q("""
SELECT review_id, city, listing_id, reviewer_id, reviewer_name, date, comment_length, review_year, review_month,
       review_year_month FROM reviews
"""))
def _b12(spark, d):
    return market_for(spark, d).fact_reviews


@register("b13_fact_calendar", q("""
SELECT listing_id, city, date, available, minimum_nights, maximum_nights, day_of_week, month, year, year_month,
       is_weekend FROM calendar
"""))
def _b13(spark, d):
    return market_for(spark, d).fact_calendar


# ------------------------------------------------------------------ profile and quality
from rentalytics.operators import profile as PR, quality as QU  # noqa: E402
from rentalytics.sources.files import read_table  # noqa: E402


@register("a07_describe_events", f"""
SELECT event_type, 'value' AS column, count(value) AS count, {re('avg(value)', 2)} AS mean,
       {re('stddev_samp(value)', 2)} AS std, {re('min(value)', 2)} AS min, {re('quantile_cont(value, 0.25)', 2)} AS q25,
       {re('quantile_cont(value, 0.5)', 2)} AS q50, {re('quantile_cont(value, 0.75)', 2)} AS q75, {re('max(value)', 2)} AS max
FROM events GROUP BY event_type
""")
def _a07(spark, d):
    return PR.describe(read_table(spark, d, "events"), ["value"], by=["event_type"])


def _null_profile_sql() -> str:
    parts = [f"SELECT '{f.name}' AS \"column\", count_if({f.name} IS NULL) AS null_count, count(*) AS n FROM fact_full"
             for f in FACT_LISTINGS.fields]
    return q(f"""
, np AS ({' UNION ALL '.join(parts)})
SELECT "column", CAST(null_count AS BIGINT) AS null_count, {re('CAST(null_count AS DOUBLE) / CAST(n AS DOUBLE) * 100', 2)} AS null_pct
FROM np WHERE null_count > 0
""")


@register("a08_null_profile_fact_listings", _null_profile_sql())
def _a08(spark, d):
    return PR.null_profile(market_for(spark, d).fact_listings)


@register("a10_duplicate_documents", """
SELECT r.total_rows, r.duplicate_rows, k.duplicate_keys FROM
 (SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
  FROM (SELECT count(*) AS n FROM documents GROUP BY doc_id, text, lang, source, n_chars)) r,
 (SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_keys FROM (SELECT count(*) AS n FROM documents GROUP BY text)) k
""")
def _a10(spark, d):
    return PR.duplicate_counts(read_table(spark, d, "documents"), key=["text"])


@register("q01_listing_rule_counts", q("""
, r AS (SELECT city,
          count_if(price < 0) AS negative_price, count_if(price = 0) AS zero_price, count_if(price > 100000) AS extreme_price,
          count_if(NOT coalesce(latitude BETWEEN (CASE city WHEN 'bangkok' THEN 13.4 ELSE 38.4 END) AND (CASE city WHEN 'bangkok' THEN 14.1 ELSE 39.4 END)
                   AND longitude BETWEEN (CASE city WHEN 'bangkok' THEN 100.2 ELSE -9.6 END) AND (CASE city WHEN 'bangkok' THEN 101.0 ELSE -8.8 END), FALSE)) AS outside_coordinates,
          count_if(accommodates < 1) AS accommodates_below_1, count_if(minimum_nights > 365) AS minimum_nights_over_365
        FROM listings GROUP BY city)
SELECT city, rule, CAST(violations AS BIGINT) AS violations FROM r
UNPIVOT (violations FOR rule IN (negative_price, zero_price, extreme_price, outside_coordinates,
                                 accommodates_below_1, minimum_nights_over_365))
"""))
def _q01(spark, d):
    return QU.listing_rule_counts(market_for(spark, d).listings)


@register("q03_unmapped_property_types", q("""
SELECT city, property_type, count(*) AS count FROM listings WHERE property_type_grouped = 'Other' GROUP BY city, property_type
"""))
def _q03(spark, d):
    return QU.unmapped_categories(market_for(spark, d).listings)


@register("q05_calendar_key_violations", q("""
SELECT listing_id, date, count(*) AS count FROM calendar GROUP BY listing_id, date HAVING count(*) > 1
"""))
def _q05(spark, d):
    return QU.key_violations(market_for(spark, d).fact_calendar, ["listing_id", "date"])


@register("f04_document_text_lengths", """
SELECT lang, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS total_chars, max(length(text)) AS max_chars,
       count_if(length(text) <> n_chars) AS length_mismatches
FROM documents GROUP BY lang
""")
def _f04(spark, d):
    from pyspark.sql import functions as F
    from rentalytics.functions import text_length
    docs = read_table(spark, d, "documents").withColumn("len", text_length("text"))
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.sum("len").alias("total_chars"),
                                    F.max("len").alias("max_chars"),
                                    F.count_if(F.col("len") != F.col("n_chars")).alias("length_mismatches"))


# ------------------------------------------------------------------ statistics
from rentalytics.operators import stats as ST  # noqa: E402
from rentalytics.plans import hypotheses as H  # noqa: E402


def _rounded(df, digits=6):
    return H.round_report(df, digits)


@register("x01_mann_whitney_u", q(f"""
, s AS (SELECT city, price AS v, room_type = 'LARGE' AS g1 FROM serving
        WHERE price IS NOT NULL AND room_type IN ('LARGE', 'ECONOMY')),
r AS (SELECT city, g1, CAST(rank() OVER (PARTITION BY city ORDER BY v) AS DOUBLE)
                      + (CAST(count(*) OVER (PARTITION BY city, v) AS DOUBLE) - 1) / 2.0 AS mr FROM s),
t AS (SELECT city, sum(CAST(c AS DOUBLE) * c * c - c) AS tie FROM (SELECT city, v, count(*) AS c FROM s GROUP BY city, v) GROUP BY city),
a AS (SELECT city, CAST(count_if(g1) AS DOUBLE) AS n1, CAST(count_if(NOT g1) AS DOUBLE) AS n2,
             sum(CASE WHEN g1 THEN mr ELSE 0 END) AS r1 FROM r GROUP BY city),
u AS (SELECT a.city, n1, n2, r1 - n1 * (n1 + 1) / 2 AS u1, tie FROM a JOIN t USING (city))
SELECT city, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {re('u1', 6)} AS u,
       {re('(u1 - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1))))', 6)} AS z,
       {re('1.0 - 2 * u1 / (n1 * n2)', 6)} AS rank_biserial
FROM u
"""))
def _x01(spark, d):
    from pyspark.sql import functions as F
    rt = F.col("room_type")
    t = ST.mann_whitney(market_for(spark, d).serving(), "price", rt == "LARGE", rt == "ECONOMY",
                        alternative="greater", with_p=False)
    return _rounded(t)


@register("x03_cohens_d", q(f"""
SELECT city, {re('avg(review_scores_rating) FILTER (WHERE host_is_superhost)', 6)} AS mean1,
       {re('avg(review_scores_rating) FILTER (WHERE NOT host_is_superhost)', 6)} AS mean2,
       {re('stddev_samp(review_scores_rating) FILTER (WHERE host_is_superhost)', 6)} AS sd1,
       {re('stddev_samp(review_scores_rating) FILTER (WHERE NOT host_is_superhost)', 6)} AS sd2,
       {re('''(avg(review_scores_rating) FILTER (WHERE host_is_superhost) - avg(review_scores_rating) FILTER (WHERE NOT host_is_superhost))
            / sqrt((power(stddev_samp(review_scores_rating) FILTER (WHERE host_is_superhost), 2)
                  + power(stddev_samp(review_scores_rating) FILTER (WHERE NOT host_is_superhost), 2)) / 2)''', 6)} AS cohens_d
FROM serving WHERE review_scores_rating IS NOT NULL GROUP BY city
"""))
def _x03(spark, d):
    from pyspark.sql import functions as F
    sh = F.col("host_is_superhost")
    df = market_for(spark, d).serving().where(F.col("review_scores_rating").isNotNull())
    return _rounded(ST.cohens_d(df, "review_scores_rating", sh == F.lit(True), sh == F.lit(False)))


@register("x04_kruskal_wallis", q(f"""
, cnt AS (SELECT city, neighbourhood_cleansed, count(*) AS n FROM serving WHERE neighbourhood_cleansed IS NOT NULL
          GROUP BY city, neighbourhood_cleansed),
top AS (SELECT city, neighbourhood_cleansed FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC,
        neighbourhood_cleansed) AS r FROM cnt) WHERE r <= 15),
s AS (SELECT s.city, s.neighbourhood_cleansed AS grp, s.price AS v FROM serving s
      SEMI JOIN top t ON s.city = t.city AND s.neighbourhood_cleansed = t.neighbourhood_cleansed WHERE s.price IS NOT NULL),
r AS (SELECT city, grp, CAST(rank() OVER (PARTITION BY city ORDER BY v) AS DOUBLE)
                        + (CAST(count(*) OVER (PARTITION BY city, v) AS DOUBLE) - 1) / 2.0 AS mr FROM s),
t AS (SELECT city, sum(CAST(c AS DOUBLE) * c * c - c) AS tie FROM (SELECT city, v, count(*) AS c FROM s GROUP BY city, v) GROUP BY city),
g AS (SELECT city, grp, count(*) AS ng, sum(mr) AS rg FROM r GROUP BY city, grp),
a AS (SELECT city, count(*) AS k, CAST(sum(ng) AS DOUBLE) AS n, sum(rg * rg / ng) AS ss FROM g GROUP BY city),
hh AS (SELECT a.city, k, n, (12.0 / (n * (n + 1)) * ss - 3 * (n + 1)) / (1.0 - tie / (n * n * n - n)) AS h
       FROM a JOIN t USING (city))
SELECT city, k, CAST(n AS BIGINT) AS n, {re('h', 6)} AS h, {re('(h - k + 1) / (n - k)', 6)} AS eta_squared FROM hh
"""))
def _x04(spark, d):
    from pyspark.sql import functions as F
    from rentalytics.operators.aggregates import count_by
    from rentalytics.operators.joins import semi_join
    from rentalytics.operators.windows import top_k_per_group
    lf = market_for(spark, d).serving()
    counts = count_by(lf.where(F.col("neighbourhood_cleansed").isNotNull()), ["city", "neighbourhood_cleansed"], "n")
    keys = top_k_per_group(counts, 15, ["n"], tie_break=["neighbourhood_cleansed"])
    sub = semi_join(lf.where(F.col("price").isNotNull()), keys, ["city", "neighbourhood_cleansed"])
    return _rounded(ST.kruskal_stats(sub, "price", "neighbourhood_cleansed"))


@register("x06_moments_events", f"""
WITH m AS (SELECT event_type, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd FROM events
           WHERE value IS NOT NULL GROUP BY event_type),
c AS (SELECT e.event_type, avg(power(value - mean, 2)) AS m2, avg(power(value - mean, 3)) AS m3,
             avg(power(value - mean, 4)) AS m4 FROM events e JOIN m USING (event_type) WHERE value IS NOT NULL
      GROUP BY e.event_type),
g AS (SELECT m.event_type, CAST(n AS DOUBLE) AS n, mean, sd, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) - 3 AS g2
      FROM m JOIN c USING (event_type))
SELECT event_type, CAST(n AS BIGINT) AS n, {re('mean', 6)} AS mean, {re('sd', 6)} AS sd,
       {re('g1 * sqrt(n * (n - 1)) / (n - 2)', 6)} AS skewness,
       {re('(n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)', 6)} AS kurtosis,
       {re('n / 6 * (g1 * g1 + g2 * g2 / 4)', 6)} AS jarque_bera, {re('exp(-(n / 6 * (g1 * g1 + g2 * g2 / 4)) / 2)', 6)} AS jb_p_value
FROM g
""")
def _x06(spark, d):
    return _rounded(ST.moments(read_table(spark, d, "events"), "value", by=["event_type"]))


_CORR = [c for c in H.CORR_COLUMNS if c in {f.name for f in FACT_LISTINGS.fields}]
_PAIRS = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[:i]]


@register("x08_correlation_pairs", q("\n" + "\nUNION ALL\n".join(
    f"SELECT city, '{a}' AS col_a, '{b}' AS col_b, {re(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 6)} AS corr, "
    f"count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM fact_listings GROUP BY city"
    for a, b in _PAIRS)))
def _x08(spark, d):
    return _rounded(H.correlation_report(market_for(spark, d).fact_listings))


@register("x11_rating_kde", q(f"""
, base AS (SELECT city, host_is_superhost, review_scores_rating AS v FROM serving
           WHERE host_is_superhost IS NOT NULL AND review_scores_rating IS NOT NULL),
st AS (SELECT city, host_is_superhost, count(v) AS n, stddev_samp(v) * pow(count(v), -0.2) AS h,
              min(v) AS lo, max(v) AS hi FROM base GROUP BY city, host_is_superhost),
cnt AS (SELECT city, host_is_superhost, v, count(*) AS c FROM base GROUP BY city, host_is_superhost, v),
gr AS (SELECT CAST(unnest(range(0, 200)) AS INTEGER) AS grid),
k AS (SELECT st.city, st.host_is_superhost, grid, lo, hi, n, h,
             ((lo + grid * (hi - lo) / 199) - v) / h AS z, c
      FROM cnt JOIN st USING (city, host_is_superhost), gr)
SELECT city, host_is_superhost, grid, {re('lo + grid * (hi - lo) / 199', 6)} AS x,
       {re('sum(c * exp(-0.5 * z * z) / (h * sqrt(2 * pi()))) / n', 6)} AS density
FROM k GROUP BY city, host_is_superhost, grid, lo, hi, n, h
"""))
def _x11(spark, d):
    return _rounded(H.h2_rating_density(market_for(spark, d).serving()))


# ------------------------------------------------------------------ X12-X16 reports with p-values
# The oracle takes the tails by another way than the code: Simpson's rule over the density, relative to its value at
# the statistic, so that small tails keep their digits.
def simpson_sql(f: str, upper: str, n: int = 4000) -> str:
    """Integral over t from 0 to ``upper``; ``f`` is SQL in ``t``."""
    step = f"(({upper}) / {n}.0)"
    weight = f"(CASE WHEN i = 0 OR i = {n} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END)"
    return f"({step} / 3.0 * list_sum(list_transform(range(0, {n + 1}), lambda i: {weight} * {f.replace('{t}', f'(i * {step})')})))"


def log_normal_sf_sql(z: str) -> str:
    a = f"abs({z})"
    tail = f"(-{a} * {a} / 2 - 0.5 * ln(2 * pi()) + ln({simpson_sql(f'exp(-{a} * {{t}} - {{t}} * {{t}} / 2)', f'least(12.0, 50.0 / greatest({a}, 1.0))')}))"
    return f"(CASE WHEN {z} >= 0 THEN {tail} ELSE ln(1 - exp({tail})) END)"


def log_chi2_sf_sql(x: str, k: str) -> str:
    h = f"(({k}) / 2.0)"
    density = f"(({h} - 1) * ln({x}) - ({x}) / 2 - {h} * ln(2.0) - lgamma({h}))"
    area = simpson_sql(f"exp(({h} - 1) * ln(1 + {{t}} / ({x})) - {{t}} / 2)", f"(100.0 + 8 * ({k}))")
    return f"(CASE WHEN ({x}) <= 0 THEN 0.0 ELSE least(0.0, {density} + ln({area})) END)"


def t_two_sided_sql(t: str, dof: str) -> str:
    density = (f"exp(lgamma((({dof}) + 1) / 2.0) - lgamma(({dof}) / 2.0) - 0.5 * ln(({dof}) * pi())"
               f" - (({dof}) + 1) / 2.0 * ln(1 + {{t}} * {{t}} / ({dof})))")
    return f"greatest(0.0, 1 - 2 * {simpson_sql(density, f'least(abs({t}), 60.0)')})"


def mwu_sql(two_sided: bool) -> str:
    """CTEs over ``s(city, v, g1)`` ending in ``mw(city, n1, n2, u1, z, r, lp, p)``."""
    u_test = "greatest(u1, n1 * n2 - u1)" if two_sided else "u1"
    p = f"least(0.0, ln(2.0) + {log_normal_sf_sql('z')})" if two_sided else log_normal_sf_sql("z")
    return f""",
r AS (SELECT city, g1, CAST(rank() OVER (PARTITION BY city ORDER BY v) AS DOUBLE)
                      + (CAST(count(*) OVER (PARTITION BY city, v) AS DOUBLE) - 1) / 2.0 AS mr FROM s),
t AS (SELECT city, sum(CAST(c AS DOUBLE) * c * c - c) AS tie FROM (SELECT city, v, count(*) AS c FROM s GROUP BY city, v) GROUP BY city),
a AS (SELECT city, CAST(count_if(g1) AS DOUBLE) AS n1, CAST(count_if(NOT g1) AS DOUBLE) AS n2,
             sum(CASE WHEN g1 THEN mr ELSE 0 END) AS r1 FROM r GROUP BY city),
u AS (SELECT a.city, n1, n2, r1 - n1 * (n1 + 1) / 2 AS u1, tie FROM a JOIN t USING (city)),
uz AS (SELECT *, ({u_test} - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - tie / ((n1 + n2) * (n1 + n2 - 1)))) AS z FROM u),
mwl AS (SELECT city, n1, n2, u1, z, 1.0 - 2 * u1 / (n1 * n2) AS r, {p} AS lp FROM uz),
mw AS (SELECT *, exp(lp) AS p FROM mwl)"""


def label_sql(v: str, cuts, labels) -> str:
    return "CASE " + " ".join(f"WHEN abs({v}) < {c} THEN '{lab}'" for c, lab in zip(cuts, labels)) + f" ELSE '{labels[-1]}' END"


def mw_columns(effect_cuts=(0.3, 0.5), effect_labels=("Small", "Medium", "Large")) -> str:
    return (f"mw.city, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, {re('u1', 6)} AS u, {re('z', 6)} AS z, "
            f"{re('r', 6)} AS rank_biserial, {re('p', 6)} AS p_value, {re('lp / ln(10.0)', 6)} AS log10_p, {label_sql('r', effect_cuts, effect_labels)} AS effect, "
            f"p < 0.05 AS reject_h0")


@register("x12_h1_room_type_price", q(f"""
, s AS (SELECT city, price AS v, room_type = 'LARGE' AS g1 FROM serving
        WHERE price IS NOT NULL AND room_type IN ('LARGE', 'ECONOMY')){mwu_sql(False)},
med AS (SELECT city, quantile_cont(price, 0.5) FILTER (WHERE room_type = 'LARGE') AS m1,
               quantile_cont(price, 0.5) FILTER (WHERE room_type = 'ECONOMY') AS m2
        FROM serving WHERE price IS NOT NULL GROUP BY city)
SELECT {mw_columns()}, {re('m1', 6)} AS median_first, {re('m2', 6)} AS median_second
FROM mw JOIN med USING (city)
"""))
def _x12(spark, d):
    return _rounded(H.h1_room_type_price(market_for(spark, d).serving(), "LARGE", "ECONOMY"))


@register("x13_h2_superhost_rating", q(f"""
, s AS (SELECT city, review_scores_rating AS v, host_is_superhost AS g1 FROM serving
        WHERE review_scores_rating IS NOT NULL AND host_is_superhost IS NOT NULL){mwu_sql(False)},
d AS (SELECT city, avg(review_scores_rating) FILTER (WHERE host_is_superhost) AS mean1,
             avg(review_scores_rating) FILTER (WHERE NOT host_is_superhost) AS mean2,
             stddev_samp(review_scores_rating) FILTER (WHERE host_is_superhost) AS sd1,
             stddev_samp(review_scores_rating) FILTER (WHERE NOT host_is_superhost) AS sd2
      FROM serving WHERE review_scores_rating IS NOT NULL GROUP BY city),
dd AS (SELECT *, (mean1 - mean2) / sqrt((sd1 * sd1 + sd2 * sd2) / 2) AS cd FROM d)
SELECT {mw_columns()}, {re('mean1', 6)} AS mean1, {re('mean2', 6)} AS mean2, {re('sd1', 6)} AS sd1,
       {re('sd2', 6)} AS sd2, {re('cd', 6)} AS cohens_d, {label_sql('cd', (0.5, 0.8), ('Small', 'Medium', 'Large'))} AS practical
FROM mw JOIN dd USING (city)
"""))
def _x13(spark, d):
    return _rounded(H.h2_superhost_rating(market_for(spark, d).serving()))


@register("x14_h3_reviews_price", q(f"""
, s AS (SELECT city, price AS v, number_of_reviews > 15 AS g1 FROM serving
        WHERE price IS NOT NULL AND number_of_reviews IS NOT NULL){mwu_sql(True)},
mm AS (SELECT city, quantile_cont(v, 0.5) FILTER (WHERE g1) AS m1, quantile_cont(v, 0.5) FILTER (WHERE NOT g1) AS m2,
              avg(v) FILTER (WHERE g1) AS a1, avg(v) FILTER (WHERE NOT g1) AS a2 FROM s GROUP BY city)
SELECT {mw_columns()}, {re('m1', 6)} AS median_many, {re('a1', 6)} AS mean_many, {re('m2', 6)} AS median_few, {re('a2', 6)} AS mean_few,
       {re('m1 - m2', 6)} AS median_diff
FROM mw JOIN mm USING (city)
"""))
def _x14(spark, d):
    return _rounded(H.h3_reviews_price(market_for(spark, d).serving(), threshold=15))


@register("x14_h3_price_boxes", q(f"""
, g AS (SELECT city, CASE WHEN number_of_reviews > 15 THEN 'many' ELSE 'few' END AS review_group, price FROM serving
        WHERE price IS NOT NULL AND number_of_reviews IS NOT NULL),
cut AS (SELECT city, review_group, quantile_cont(price, 0.95) AS top FROM g GROUP BY ALL),
t AS (SELECT g.* FROM g JOIN cut USING (city, review_group) WHERE price <= top),
b AS (SELECT city, review_group, count(*) AS n, avg(price) AS mean, quantile_cont(price, 0.25) AS q1,
             quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM t GROUP BY ALL),
w AS (SELECT city, review_group, min(price) FILTER (WHERE price >= q1 - 1.5 * (q3 - q1)) AS lo,
             max(price) FILTER (WHERE price <= q3 + 1.5 * (q3 - q1)) AS hi FROM t JOIN b USING (city, review_group) GROUP BY ALL)
SELECT city, review_group, n, {re('mean', 6)} AS mean, {re('q1', 6)} AS q1, {re('median', 6)} AS median, {re('q3', 6)} AS q3,
       {re('lo', 6)} AS whisker_low, {re('hi', 6)} AS whisker_high
FROM b JOIN w USING (city, review_group)
"""))
def _x14b(spark, d):
    return _rounded(H.h3_price_boxes(market_for(spark, d).serving(), threshold=15))


@register("x15_h4_neighbourhood_prices", q(f"""
, cnt AS (SELECT city, neighbourhood_cleansed, count(*) AS n FROM serving WHERE neighbourhood_cleansed IS NOT NULL
          GROUP BY city, neighbourhood_cleansed),
top AS (SELECT city, neighbourhood_cleansed FROM (SELECT *, row_number() OVER (PARTITION BY city ORDER BY n DESC,
        neighbourhood_cleansed) AS r FROM cnt) WHERE r <= 15),
s AS (SELECT s.city, s.neighbourhood_cleansed AS grp, s.price AS v FROM serving s
      SEMI JOIN top t ON s.city = t.city AND s.neighbourhood_cleansed = t.neighbourhood_cleansed WHERE s.price IS NOT NULL),
r AS (SELECT city, grp, CAST(rank() OVER (PARTITION BY city ORDER BY v) AS DOUBLE)
                        + (CAST(count(*) OVER (PARTITION BY city, v) AS DOUBLE) - 1) / 2.0 AS mr FROM s),
t AS (SELECT city, sum(CAST(c AS DOUBLE) * c * c - c) AS tie FROM (SELECT city, v, count(*) AS c FROM s GROUP BY city, v) GROUP BY city),
g AS (SELECT city, grp, count(*) AS ng, sum(mr) AS rg FROM r GROUP BY city, grp),
a AS (SELECT city, count(*) AS k, CAST(sum(ng) AS DOUBLE) AS n, sum(rg * rg / ng) AS ss FROM g GROUP BY city),
hh AS (SELECT a.city, k, n, (12.0 / (n * (n + 1)) * ss - 3 * (n + 1)) / (1.0 - tie / (n * n * n - n)) AS h
       FROM a JOIN t USING (city)),
he AS (SELECT *, (h - k + 1) / (n - k) AS eta, {log_chi2_sf_sql('h', 'k - 1')} AS lp FROM hh),
med AS (SELECT city, quantile_cont(price, 0.5) AS m FROM serving WHERE price IS NOT NULL GROUP BY city)
SELECT city, k, CAST(n AS BIGINT) AS n, {re('h', 6)} AS h, {re('eta', 6)} AS eta_squared, {re('exp(lp)', 6)} AS p_value,
       {re('lp / ln(10.0)', 6)} AS log10_p,
       CASE WHEN eta > 0.14 THEN 'Large' WHEN eta > 0.06 THEN 'Medium' ELSE 'Small' END AS effect,
       {re('m', 6)} AS city_median_price
FROM he LEFT JOIN med USING (city)
"""))
def _x15(spark, d):
    return _rounded(H.h4_neighbourhood_prices(market_for(spark, d).serving()))


@register("x16_h5_weekend_availability", q(f"""
, s AS (SELECT city, CAST(available AS INTEGER) AS v, is_weekend AS g1 FROM calendar
        WHERE available IS NOT NULL AND is_weekend IS NOT NULL){mwu_sql(True)},
rates AS (SELECT city, avg(v) FILTER (WHERE g1) * 100 AS wr, avg(v) FILTER (WHERE NOT g1) * 100 AS dr FROM s GROUP BY city)
SELECT {mw_columns((0.1, 0.3), ('Negligible', 'Small', 'Medium'))}, {re('wr', 6)} AS weekend_rate, {re('dr', 6)} AS weekday_rate
FROM mw JOIN rates USING (city)
"""))
def _x16(spark, d):
    return _rounded(H.h5_weekend_availability(market_for(spark, d).fact_calendar))


@register("x16_month_weekend_table", q(f"""
SELECT city, month, {re('avg(CASE WHEN is_weekend THEN CAST(available AS DOUBLE) END) * 100', 6)} AS available_rate_when_is_weekend,
       {re('avg(CASE WHEN NOT is_weekend THEN CAST(available AS DOUBLE) END) * 100', 6)} AS available_rate_when_not_is_weekend
FROM calendar GROUP BY city, month
"""))
def _x16b(spark, d):
    return _rounded(H.h5_month_weekend_table(market_for(spark, d).fact_calendar))


# Two regressors of the adapter that are not multiples of one another; the oracle solves the 2 x 2 system.
REGRESSORS = ["bedrooms", "number_of_reviews"]
_FIT = ", ".join(f"{re(c, 6)} AS {c}" for c in ("r2", "adj_r2", "f_stat", "f_p_value"))


def _term_sql(term: str, coef: str, se: str, vif: str) -> str:
    t = f"({coef} / {se})"
    return (f"SELECT city, '{term}' AS term, {re(coef, 6)} AS coef, {re(se, 6)} AS std_err, {re(t, 6)} AS t, "
            f"{re(t_two_sided_sql(t, 'dof'), 6)} AS p_value, {vif} AS vif, {_FIT}, n FROM f")


@register("x17_regression_report", q(f"""
, raw AS (SELECT city, price, CAST(bedrooms AS DOUBLE) AS x1, CAST(number_of_reviews AS DOUBLE) AS x2 FROM enriched
          WHERE price IS NOT NULL AND bedrooms IS NOT NULL AND number_of_reviews IS NOT NULL),
cut AS (SELECT city, quantile_cont(price, 0.99) AS top FROM raw GROUP BY city),
obs AS (SELECT city, ln(1 + price) AS y, x1, x2 FROM raw JOIN cut USING (city) WHERE price <= top),
mom AS (SELECT city, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v11, var_pop(x2) AS v22,
               covar_pop(x1, x2) AS v12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, var_pop(y) AS vy FROM obs GROUP BY city),
slopes AS (SELECT *, n - 3 AS dof, v11 * v22 - v12 * v12 AS det, (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12) AS b1,
                  (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) AS b2 FROM mom),
errors AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, n * (vy - b1 * c1 - b2 * c2) / dof AS s2, 1 - (vy - b1 * c1 - b2 * c2) / vy AS r2 FROM slopes),
f AS (SELECT *, 1 - (1 - r2) * (n - 1) / dof AS adj_r2, (r2 / 2) / ((1 - r2) / dof) AS f_stat,
             pow(1 + r2 / (1 - r2), -dof / 2.0) AS f_p_value, sqrt(s2 * v22 / (n * det)) AS se1, sqrt(s2 * v11 / (n * det)) AS se2,
             sqrt(s2 / n + s2 / (n * det) * (m1 * m1 * v22 - 2 * m1 * m2 * v12 + m2 * m2 * v11)) AS se0,
             1 / (1 - v12 * v12 / (v11 * v22)) AS infl FROM errors)
{_term_sql('const', 'b0', 'se0', 'CAST(NULL AS DOUBLE)')}
UNION ALL
{_term_sql('bedrooms', 'b1', 'se1', re('infl', 6))}
UNION ALL
{_term_sql('number_of_reviews', 'b2', 'se2', re('infl', 6))}
"""))
def _x17(spark, d):
    return _rounded(H.regression_report(market_for(spark, d).enriched, REGRESSORS))


# ------------------------------------------------------------------ M11
def _describe_sql(col: str) -> str:
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT city, '{col}' AS \"column\", count({x}) AS count, {re(f'avg({x})', 2)} AS mean, "
            f"{re(f'stddev_samp({x})', 2)} AS std, {re(f'min({x})', 2)} AS min, {re(f'quantile_cont({x}, 0.25)', 2)} AS q25, "
            f"{re(f'quantile_cont({x}, 0.5)', 2)} AS q50, {re(f'quantile_cont({x}, 0.75)', 2)} AS q75, "
            f"{re(f'max({x})', 2)} AS max FROM serving GROUP BY city")


@register("m11_city_describe", q("\n" + "\nUNION ALL\n".join(_describe_sql(c) for c in M.DESCRIBE_COLUMNS)))
def _m11a(spark, d):
    return M.city_describe(market_for(spark, d).serving())


_CMP = {
    "total_listings": "CAST(count(*) AS DOUBLE)",
    "median_price": "quantile_cont(price, 0.5)",
    "mean_occupancy_rate": "avg(occupancy_rate)",
    "median_annual_revenue": "quantile_cont(estimated_annual_revenue, 0.5)",
    "avg_review_score": "avg(review_scores_rating)",
    "median_min_nights": "quantile_cont(minimum_nights, 0.5)",
    "avg_reviews_per_listing": "avg(number_of_reviews)",
    "median_host_tenure_years": "quantile_cont(host_tenure_years, 0.5)",
}


@register("m11_city_comparison", q("\n" + "\nUNION ALL\n".join(
    f"SELECT city, '{k}' AS metric, {re(v, 6)} AS value FROM serving GROUP BY city" for k, v in _CMP.items())))
def _m11b(spark, d):
    return M.city_comparison(market_for(spark, d).serving())


# DuckDB type name -> Spark's ``df.dtypes`` name for the driver's parquet types
_SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
               "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean"}
_EVENT_COLUMNS = ["ts", "user_id", "event_type", "value", "props"]


def _profile_sql(table: str, cols, order_col: str, k: int = 3) -> str:
    def dtype(c):
        return "CASE typeof(any_value(" + c + ")) " + " ".join(
            f"WHEN '{a}' THEN '{b}'" for a, b in _SPARK_TYPE.items()) + " END"
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", {dtype(c)} AS dtype, CAST(count(*) - count({c}) AS BIGINT) AS null_count,
       {re(f'CAST(count(*) - count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100', 2)} AS null_pct,
       CAST(count(*) AS BIGINT) AS total_rows,
       (SELECT '[' || string_agg(v, ', ' ORDER BY p) || ']' FROM (SELECT CAST({c} AS VARCHAR) AS v, {order_col} AS p
          FROM {table} WHERE {c} IS NOT NULL ORDER BY {order_col} LIMIT {k})) AS sample_values
FROM {table}""")
    return "\nUNION ALL\n".join(parts)


@register("a09_column_profile_events", _profile_sql("events", _EVENT_COLUMNS, "event_id"))
def _a09(spark, d):
    return PR.column_profile(read_table(spark, d, "events"), "event_id", samples_as_text=True)
