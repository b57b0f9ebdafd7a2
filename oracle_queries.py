"""Oracle SQL (DuckDB) for the registered queries.

An independent formulation of the same computation: the synthetic adapter,
cleaning, enrichment and star schema are written once here as CTEs over the
driver's views, and each query appends its own SELECT.  Rounding recipes:
half-even on the binary double = ``round_even(x * 10^d, 0) / 10^d``;
half-up on the decimal value = round of a DECIMAL cast.
"""

from __future__ import annotations


def re(x: str, d: int) -> str:
    """Half-even rounding on the double, as numpy does, after cutting noise below 1e-10 (a sum's order is free).

    The cut changes no double that is nearest to a number of ten decimals.  It is applied below 1e5 only: above, a
    double's spacing is already near 1e-10, and DuckDB's DECIMAL(38,10) -> DOUBLE cast stops being correctly rounded
    once the scaled integer passes 2^53.
    """
    s = f"{float(10 ** d)!r}::DOUBLE"
    settled = f"(CASE WHEN abs({x}) < 1e5 THEN CAST(CAST(({x}) AS DECIMAL(38,10)) AS DOUBLE) ELSE CAST(({x}) AS DOUBLE) END)"
    return f"(round_even({settled} * {s}, 0) / {s})"


def rx(x: str, d: int) -> str:
    """Half-even rounding of one row's value, which is settled by nothing."""
    s = f"{float(10 ** d)!r}::DOUBLE"
    return f"(round_even(CAST(({x}) AS DOUBLE) * {s}, 0) / {s})"


def hu(x: str, d: int) -> str:
    """Half-up rounding on the decimal value (PostgreSQL numeric / Spark round)."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(38,10)), {d}) AS DOUBLE)"


CITY_OF_BRAND = "CASE WHEN CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) <= 12 THEN 'bangkok' ELSE 'lisbon' END"

PRELUDE = f"""
WITH
li_stats AS (
  SELECT l_partkey AS pk,
         min({{'o': l_orderkey, 'n': l_linenumber, 's': l_suppkey}}).s AS host_id,
         CAST(min(l_shipdate) AS DATE) AS first_review,
         CAST(max(l_shipdate) AS DATE) AS last_review,
         CAST(count_if(l_linestatus = 'F') AS INTEGER) AS number_of_reviews,
         5.0::DOUBLE * CAST(count_if(l_returnflag <> 'R') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS review_scores_accuracy,
         5.0::DOUBLE * CAST(count_if(l_linestatus = 'O') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS review_scores_cleanliness,
         5.0::DOUBLE * CAST(count_if(l_discount < 0.05) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS review_scores_value
  FROM lineitem GROUP BY l_partkey
),
lst0 AS (
  SELECT p.p_partkey AS id, {CITY_OF_BRAND} AS city, s.host_id, su.s_name AS host_name,
         su.s_nationkey, su.s_acctbal, p.p_brand, p.p_type, p.p_size, p.p_retailprice,
         s.first_review, s.last_review, s.number_of_reviews,
         s.review_scores_accuracy, s.review_scores_cleanliness, s.review_scores_value
  FROM part p LEFT JOIN li_stats s ON p.p_partkey = s.pk
              LEFT JOIN supplier su ON su.s_suppkey = s.host_id
),
host_n AS (SELECT host_id AS hk, count(*) AS host_n FROM lst0 GROUP BY host_id),
lst1 AS (
  SELECT l.*, CAST(h.host_n AS INTEGER) AS calculated_host_listings_count,
         CASE city WHEN 'bangkok' THEN DATE '2025-09-27' WHEN 'lisbon' THEN DATE '2026-03-26' ELSE DATE '2025-01-01' END AS scrape_date,
         count(s_nationkey) OVER (PARTITION BY city) > 0 AS has_years
  FROM lst0 l LEFT JOIN host_n h ON l.host_id = h.hk
),
listings AS (
  SELECT id, city, host_id, host_name,
         CASE WHEN s_acctbal > 5000 THEN TRUE WHEN s_acctbal IS NOT NULL THEN FALSE END AS host_is_superhost,
         CASE WHEN s_acctbal >= 0 THEN TRUE WHEN s_acctbal IS NOT NULL THEN FALSE END AS host_identity_verified,
         CAST(s_nationkey * 4 AS DOUBLE) AS host_response_rate,
         CAST(NULL AS DOUBLE) AS host_acceptance_rate,
         p_brand AS neighbourhood_cleansed, p_type AS room_type, p_type AS property_type,
         CASE p_type WHEN 'ECONOMY' THEN 'Private Room' WHEN 'SMALL' THEN 'Shared Room'
                     WHEN 'MEDIUM' THEN 'Entire Apartment' WHEN 'LARGE' THEN 'Entire House'
                     WHEN 'PROMO' THEN 'Hotel Room' ELSE 'Other' END AS property_type_grouped,
         p_retailprice AS price,
         CAST(ceil(p_size / 7.0) AS DOUBLE) AS accommodates,
         coalesce(CAST(CASE WHEN p_size <= 45 THEN ceil(p_size / 15.0) END AS DOUBLE), 1.0::DOUBLE) AS bedrooms,
         CAST(p_size AS DOUBLE) AS minimum_nights, 365 AS maximum_nights, p_size * 7 AS availability_365,
         number_of_reviews, first_review, last_review, last_review AS last_scraped,
         p_size / 10.0::DOUBLE AS review_scores_rating,
         review_scores_accuracy, review_scores_cleanliness, review_scores_value,
         calculated_host_listings_count, coalesce(calculated_host_listings_count > 1, FALSE) AS is_commercial_host,
         p_type = 'PROMO' AS instant_bookable, TRUE AS has_availability,
         scrape_date,
         CASE WHEN has_years THEN {rx('CAST(s_nationkey AS DOUBLE)', 2)} END AS host_tenure_years,
         CASE city WHEN 'bangkok' THEN 13.7563 WHEN 'lisbon' THEN 38.7169 END + (p_size - 25) * 0.004::DOUBLE AS latitude,
         CASE city WHEN 'bangkok' THEN 100.5018 WHEN 'lisbon' THEN -9.1399 END + (p_retailprice - 950.0) * 0.002::DOUBLE AS longitude
  FROM lst1
),
calendar AS (
  SELECT l.l_partkey AS listing_id, {CITY_OF_BRAND} AS city, CAST(l.l_shipdate AS DATE) AS date,
         l.l_returnflag = 'N' AS available,
         l.l_linenumber AS minimum_nights, CAST(l.l_quantity AS INTEGER) AS maximum_nights,
         dayname(CAST(l.l_shipdate AS DATE)) AS day_of_week,
         CAST(month(l.l_shipdate) AS INTEGER) AS month, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         strftime(l.l_shipdate, '%Y-%m') AS year_month,
         dayofweek(l.l_shipdate) IN (0, 6) AS is_weekend
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
occ AS (
  SELECT city, listing_id, count(available) AS total_days,
         CAST(count_if(available) AS BIGINT) AS available_days,
         CAST(count_if(NOT available) AS BIGINT) AS booked_days,
         {rx('(CAST(count_if(NOT available) AS DOUBLE) / CAST(count(available) AS DOUBLE)) * 100.0::DOUBLE', 2)} AS occupancy_rate
  FROM calendar GROUP BY city, listing_id
),
lo AS (
  SELECT l.*, o.total_days, o.available_days, o.booked_days, o.occupancy_rate
  FROM listings l LEFT JOIN occ o ON l.id = o.listing_id AND l.city = o.city
),
nb AS (
  SELECT city, neighbourhood_cleansed,
         {re('quantile_cont(price, 0.5)', 2)} AS neighbourhood_median_price,
         {re('avg(price)', 2)} AS neighbourhood_mean_price,
         count(id) AS neighbourhood_listing_count,
         {re('avg(review_scores_rating)', 2)} AS neighbourhood_avg_rating,
         {re('avg(occupancy_rate)', 2)} AS neighbourhood_avg_occupancy
  FROM lo WHERE price IS NOT NULL AND neighbourhood_cleansed IS NOT NULL
  GROUP BY city, neighbourhood_cleansed
),
tiers AS (
  SELECT city, quantile_cont(price, 0.25) AS p25, quantile_cont(price, 0.75) AS p75
  FROM lo WHERE price IS NOT NULL GROUP BY city
),
enriched AS (
  SELECT lo.*, nb.neighbourhood_median_price, nb.neighbourhood_mean_price, nb.neighbourhood_listing_count,
         nb.neighbourhood_avg_rating, nb.neighbourhood_avg_occupancy,
         CASE WHEN nb.neighbourhood_median_price <> 0 THEN
              {rx('((lo.price - nb.neighbourhood_median_price) / nb.neighbourhood_median_price) * 100.0::DOUBLE', 2)} END
           AS price_vs_neighbourhood,
         CASE WHEN lo.price IS NULL THEN NULL WHEN lo.price <= t.p25 THEN 'Budget'
              WHEN lo.price <= t.p75 THEN 'Mid-range' ELSE 'Premium' END AS price_tier,
         {rx('CAST(date_diff(' + "'day'" + ', lo.first_review, lo.scrape_date) AS DOUBLE) / 365.25::DOUBLE', 2)} AS listing_age_years,
         CASE WHEN lo.bedrooms > 0 THEN {rx('lo.price / lo.bedrooms', 2)} END AS price_per_bedroom,
         {rx('lo.price * lo.booked_days', 2)} AS estimated_annual_revenue,
         CASE WHEN (CASE WHEN lo.review_scores_rating IS NULL THEN 0 ELSE 1 END
                  + CASE WHEN lo.review_scores_accuracy IS NULL THEN 0 ELSE 1 END
                  + CASE WHEN lo.review_scores_cleanliness IS NULL THEN 0 ELSE 1 END
                  + CASE WHEN lo.review_scores_value IS NULL THEN 0 ELSE 1 END) > 0 THEN
           {rx('''(coalesce(lo.review_scores_rating, 0.0::DOUBLE) + coalesce(lo.review_scores_accuracy, 0.0::DOUBLE)
               + coalesce(lo.review_scores_cleanliness, 0.0::DOUBLE) + coalesce(lo.review_scores_value, 0.0::DOUBLE))
             / CAST((CASE WHEN lo.review_scores_rating IS NULL THEN 0 ELSE 1 END
                  + CASE WHEN lo.review_scores_accuracy IS NULL THEN 0 ELSE 1 END
                  + CASE WHEN lo.review_scores_cleanliness IS NULL THEN 0 ELSE 1 END
                  + CASE WHEN lo.review_scores_value IS NULL THEN 0 ELSE 1 END) AS DOUBLE)''', 3)} END
           AS review_score_composite
  FROM lo LEFT JOIN nb ON lo.city = nb.city AND lo.neighbourhood_cleansed = nb.neighbourhood_cleansed
          LEFT JOIN tiers t ON lo.city = t.city
),
fact_listings AS (
  SELECT id AS listing_id, city, host_id, neighbourhood_cleansed, room_type, property_type, property_type_grouped,
         price, price_per_bedroom, price_vs_neighbourhood, price_tier, minimum_nights, maximum_nights,
         availability_365, number_of_reviews, review_scores_rating, review_scores_accuracy,
         review_scores_cleanliness, review_scores_value, review_score_composite,
         CASE WHEN listing_age_years > 0 THEN {rx('number_of_reviews / listing_age_years', 2)} END AS review_velocity,
         occupancy_rate, booked_days, available_days, total_days, estimated_annual_revenue, host_tenure_years,
         instant_bookable, has_availability, calculated_host_listings_count, last_scraped, latitude, longitude
  FROM enriched
),
dim_host AS (
  SELECT host_id, city,
         min({{'o': id, 'name': host_name, 'sh': host_is_superhost, 'iv': host_identity_verified,
              'rr': host_response_rate, 'ar': host_acceptance_rate, 'ten': host_tenure_years,
              'com': is_commercial_host}}) AS f
  FROM listings WHERE host_id IS NOT NULL GROUP BY host_id, city
),
dim_host_flat AS (
  SELECT host_id, city, f.name AS host_name, f.sh AS host_is_superhost, f.iv AS host_identity_verified,
         f.rr AS host_response_rate, f.ar AS host_acceptance_rate, f.ten AS host_tenure_years,
         f.com AS is_commercial_host
  FROM dim_host
),
reviews AS (
  SELECT o.o_orderkey AS review_id,
         CASE WHEN c.c_nationkey <= 12 THEN 'bangkok' ELSE 'lisbon' END AS city,
         o.o_custkey AS listing_id, o.o_custkey AS reviewer_id, coalesce(c.c_name, 'Anonymous') AS reviewer_name,
         CAST(o.o_orderdate AS DATE) AS date, CAST(length(o.o_orderpriority) AS INTEGER) AS comment_length,
         CAST(year(o.o_orderdate) AS INTEGER) AS review_year, CAST(month(o.o_orderdate) AS INTEGER) AS review_month,
         strftime(o.o_orderdate, '%Y-%m') AS review_year_month
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderpriority IS NOT NULL
),
serving AS (
  SELECT f.*, h.host_is_superhost, h.is_commercial_host, h.host_response_rate, h.host_acceptance_rate
  FROM fact_listings f LEFT JOIN dim_host_flat h ON f.host_id = h.host_id AND f.city = h.city
),
fact_full AS (
  SELECT listing_id, city, host_id, neighbourhood_cleansed, room_type, property_type, property_type_grouped,
         price, price_per_bedroom, price_vs_neighbourhood, price_tier, minimum_nights, maximum_nights,
         CAST(NULL AS INTEGER) AS availability_30, CAST(NULL AS INTEGER) AS availability_60,
         CAST(NULL AS INTEGER) AS availability_90, availability_365, number_of_reviews,
         CAST(NULL AS INTEGER) AS number_of_reviews_ltm, CAST(NULL AS INTEGER) AS number_of_reviews_l30d,
         CAST(NULL AS DOUBLE) AS reviews_per_month, review_scores_rating, review_scores_accuracy,
         review_scores_cleanliness, CAST(NULL AS DOUBLE) AS review_scores_checkin,
         CAST(NULL AS DOUBLE) AS review_scores_communication, CAST(NULL AS DOUBLE) AS review_scores_location,
         review_scores_value, review_score_composite, review_velocity, occupancy_rate, booked_days,
         available_days, total_days, estimated_annual_revenue, host_tenure_years, instant_bookable,
         has_availability, calculated_host_listings_count, last_scraped
  FROM fact_listings
)
"""


def q(body: str) -> str:
    return PRELUDE + body
