"""Properties of the built tables on the driver's sf0.01 data."""

import pytest
from pyspark.sql import functions as F

from rentalytics.operators import stats as S
from rentalytics.plans import queries as M
from rentalytics.plans.market import Market

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def market(spark):
    return Market.from_driver_tables(spark, SF)


def test_occupancy_bounds_and_day_accounting(market):
    bad = market.occupancy.where(
        (F.col("occupancy_rate") < 0) | (F.col("occupancy_rate") > 100)
        | (F.col("available_days") + F.col("booked_days") != F.col("total_days"))).count()
    assert bad == 0


def test_tiers_cover_priced_listings(market):
    per_tier = M.price_tier_distribution(market.fact_listings).groupBy("city").agg(F.sum("listing_count").alias("t"))
    priced = market.fact_listings.where(F.col("price").isNotNull()).groupBy("city").count()
    got = {r.city: r.t for r in per_tier.collect()}
    assert got == {r.city: r["count"] for r in priced.collect()}


def test_histogram_counts_sum_to_rows(market):
    h = M.availability_distribution(market.fact_listings).groupBy("city").agg(F.sum("count").alias("s"))
    n = market.fact_listings.where(F.col("availability_365").isNotNull()).groupBy("city").count()
    assert {r.city: r.s for r in h.collect()} == {r.city: r["count"] for r in n.collect()}


def test_portfolio_buckets_count_every_host(market):
    p = M.host_portfolio(market.fact_listings).groupBy("city").agg(F.sum("entity_count").alias("hosts"))
    hosts = market.fact_listings.where(F.col("host_id").isNotNull()).groupBy("city") \
        .agg(F.countDistinct("host_id").alias("hosts"))
    assert {r.city: r.hosts for r in p.collect()} == {r.city: r.hosts for r in hosts.collect()}


def test_concentration_bounds(market):
    for r in M.market_concentration(market.fact_listings).collect():
        assert 0 <= r.multi_hosts <= r.total_hosts and 0 <= r.top_share_pct <= 100
        assert r.multi_item_pct >= r.multi_host_pct  # multi-listing hosts hold at least their share of listings


def test_u1_plus_u2_on_driver_data(market):
    v = market.fact_listings.where(F.col("price").isNotNull())
    first, second = F.col("room_type") == "LARGE", F.col("room_type") == "ECONOMY"
    a = {r.city: r for r in S.mann_whitney(v, "price", first, second, alternative="greater", with_p=False).collect()}
    b = {r.city: r for r in S.mann_whitney(v, "price", second, first, alternative="greater", with_p=False).collect()}
    for c in a:
        assert a[c].u + b[c].u == pytest.approx(a[c].n1 * a[c].n2)
