"""Sources, cleaning, enrichment, star schema and publishing on the hand-written fixture cities."""

import os
import re

import pytest
from pyspark.sql import functions as F

from rentalytics.plans import build
from rentalytics.plans import queries as M
from rentalytics.sources.config import config_frame
from rentalytics.plans.market import Published
from rentalytics.sources.files import read_csv_raw, read_geojson_features, read_optional

CITIES = ["aldmere", "brisk"]
# aldmere is configured like a city with bounds; brisk uses the defaults
SETTINGS = {"aldmere": {"scrape_date": __import__("datetime").date(2025, 9, 27), "currency": "€",
                        "lat": (38.4, 39.4), "lon": (-9.6, -8.8), "centre": (38.7169, -9.1399)}}


@pytest.fixture(scope="module")
def market(spark):
    base = os.path.join(os.path.dirname(__file__), "fixtures")
    return build.market_from_files(spark, base, CITIES, config_frame(spark, SETTINGS))


def test_csv_multiline_and_null_tokens(spark, fixtures):
    df = read_csv_raw(spark, os.path.join(fixtures, "aldmere", "reviews.csv"))
    rows = {r.id: r for r in df.collect()}
    assert rows["101"].comments == 'Great host!\nWould stay again — "truly" 😀'
    assert rows["101"].reviewer_name is None and rows["102"].reviewer_name is None
    assert rows["102"].comments is None


def test_optional_source_missing(spark, fixtures):
    assert read_optional(lambda: read_csv_raw(spark, os.path.join(fixtures, "brisk", "reviews.csv"))) is None


def test_geojson_keeps_mixed_geometry(spark, fixtures):
    f = read_geojson_features(spark, os.path.join(fixtures, "aldmere", "neighbourhoods.geojson"))
    types = [r[0] for r in f.orderBy("feature_pos").select(F.variant_get("feature.geometry", "$.type", "string")).collect()]
    assert types == ["Polygon", "MultiPolygon", "Polygon", "Polygon", "Polygon"]


def test_clean_listings(market):
    rows = {r.id: r for r in market.listings.collect()}
    assert rows[1].price == 1234.5 and rows[3].price == 80.0 and rows[4].price is None and rows[6].price == 5.0
    assert rows[1].host_response_rate == 95.0 and rows[2].host_response_rate == 100.0
    assert rows[1].beds == 0.0 and rows[2].beds == 2.0 and rows[3].beds == 2.0   # accommodates/2 half-even
    assert rows[1].bedrooms == 1.0 and rows[2].bedrooms == 0.0 and rows[2].price_per_bedroom is None
    assert rows[2].property_type_grouped == "Unique Stay" and rows[3].property_type_grouped == "Other"
    assert rows[4].property_type_grouped == "Other"
    assert rows[4].host_is_superhost is None and rows[1].host_is_superhost is True
    assert str(rows[4].first_review) == "None"                                  # 2022-02-30 -> null
    assert rows[1].host_tenure_years == round((__import__("datetime").date(2025, 9, 27)
                                               - __import__("datetime").date(2015, 3, 1)).days / 365.25, 2)
    assert rows[20].host_tenure_years == 3.46                                   # fallback column
    assert rows[1].is_commercial_host is True and rows[4].is_commercial_host is False


def test_occupancy(market):
    occ = {(r.city, r.listing_id): r for r in market.occupancy.collect()}
    r = occ[("aldmere", 1)]
    assert (r.total_days, r.available_days, r.booked_days, r.occupancy_rate) == (4, 1, 3, 75.0)
    assert occ[("aldmere", 3)].total_days == 0 and occ[("aldmere", 3)].occupancy_rate is None
    assert 0 <= occ[("brisk", 20)].occupancy_rate <= 100


def test_enrichment_tiers_and_benchmarks(market):
    e = market.enriched
    tiers = e.where(F.col("price").isNotNull()).groupBy("city").agg(F.count("price_tier").alias("t"), F.count("*").alias("n"))
    assert all(r.t == r.n for r in tiers.collect())                            # tiers cover non-null prices
    r = {x.id: x for x in e.collect()}
    assert r[4].price_tier is None
    assert r[20].neighbourhood_median_price == 1050.0 and r[20].price_vs_neighbourhood == pytest.approx(90.48)


def test_dim_neighbourhood_title_case_join(market):
    d = {r.neighbourhood: r for r in market.dim_neighbourhood.collect()}
    assert set(d) == {"São Domingos De Benfica", "Sant'Ana D'Água", "A-B District", "3Rd Ward", "Empty Quarter"}
    assert d["São Domingos De Benfica"].listing_count == 2 and d["Empty Quarter"].listing_count is None
    assert d["Sant'Ana D'Água"].geometry_type == "MultiPolygon" and d["São Domingos De Benfica"].neighbourhood_id == 1


def test_dim_host_first_listing(market):
    h = {(r.city, r.host_id): r for r in market.dim_host.collect()}
    assert h[("aldmere", 10)].host_name == "Ana" and len(h) == 5


def test_reviews(market):
    r = {x.review_id: x for x in market.fact_reviews.collect()}
    assert 102 not in r                                                         # null comment dropped
    assert r[101].reviewer_name == "Anonymous" and r[101].comment_length == len('Great host!\nWould stay again — "truly" 😀')


def test_dim_date_parts(market):
    d = market.dim_date.where(F.col("city") == "aldmere").orderBy("date_id").collect()
    assert d[0].date_id == 1 and str(d[0].date) == "2022-12-31" and d[0].day_of_week == "Saturday"


def test_queries_run_on_fixtures(market):
    assert M.top_neighbourhoods_by_avg_price(market.fact_listings).count() > 0
    assert M.monthly_availability(market.fact_calendar).count() == 24
    assert M.price_gradient(market.enriched).where("city = 'aldmere'").count() >= 1


def test_publish_replaces_only_given_city(spark, tmp_path, fixtures):
    out = str(tmp_path / "star")
    cfg = config_frame(spark, SETTINGS)
    build.publish(build.market_from_files(spark, fixtures, CITIES, cfg), out, CITIES, run_log=out + "/pipeline_metadata")
    before = Published(spark, out).fact_listings.groupBy("city").count().collect()
    build.publish(build.market_from_files(spark, fixtures, ["brisk"], cfg), out, ["brisk"], run_log=out + "/pipeline_metadata")
    after = Published(spark, out).fact_listings.groupBy("city").count().collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after)) == [("aldmere", 6), ("brisk", 3)]
    log = spark.read.parquet(out + "/pipeline_metadata")
    assert log.count() == 3 and log.where("city = 'brisk'").agg(F.min("total_rows")).first()[0] > 0


def test_rerun_clears_what_a_city_no_longer_has(spark, tmp_path, fixtures):
    """A requested city that now yields no rows, or whose optional source is gone, loses its old rows."""
    out = str(tmp_path / "star")
    cfg = config_frame(spark, SETTINGS)
    build.publish(build.market_from_files(spark, fixtures, CITIES, cfg), out, CITIES)
    assert Published(spark, out).fact_reviews.where("city = 'aldmere'").count() > 0
    m = build.market_from_files(spark, fixtures, CITIES, cfg)
    m.raw_reviews = None
    m.raw_calendar = m.raw_calendar.where("city <> 'brisk'")
    build.publish(m, out, CITIES, run_log=out + "/pipeline_metadata")
    assert Published(spark, out).fact_calendar.where("city = 'brisk'").isEmpty()
    assert Published(spark, out).fact_calendar.where("city = 'aldmere'").count() > 0
    assert Published(spark, out).fact_reviews.isEmpty()
    log = {r.city: r for r in spark.read.parquet(out + "/pipeline_metadata").orderBy("run_timestamp").collect()}
    assert set(log) == set(CITIES) and "fact_reviews" not in log["brisk"].tables_loaded


def test_failed_run_leaves_the_old_tables(spark, tmp_path, fixtures, monkeypatch):
    """A run that breaks between two tables, or before its commit, changes no table; the next one changes all."""
    out, cfg = str(tmp_path / "star"), config_frame(spark, SETTINGS)

    def counts():
        p = Published(spark, out)
        return {t: sorted(map(tuple, getattr(p, t).groupBy("city").count().collect())) for t in build.TABLES}

    def half():
        m = build.market_from_files(spark, fixtures, CITIES, cfg)
        return m.use(raw_listings=m.raw_listings.where("id % 2 = 0"))
    build.publish(build.market_from_files(spark, fixtures, CITIES, cfg), out, CITIES)
    before = counts()
    staged = build.stage_table
    for broken in ("dim_room_type", "commit"):
        def fail(df, base, name, run_id, broken=broken):
            if name == broken:
                raise RuntimeError("executor lost")
            staged(df, base, name, run_id)
        with monkeypatch.context() as mp, pytest.raises(RuntimeError):
            mp.setattr(build, "stage_table", fail)
            if broken == "commit":
                mp.setattr(build, "commit_run", lambda *a, **k: fail(None, None, "commit", None))
            build.publish(half(), out, CITIES)
        assert counts() == before
    build.publish(half(), out, ["aldmere"])
    after = counts()
    assert after["fact_listings"] != before["fact_listings"]
    assert all([r for r in after[t] if r[0] == "brisk"] == [r for r in before[t] if r[0] == "brisk"] for t in after)


def test_sinks(spark, tmp_path):
    from rentalytics.sources import files, sinks
    df = spark.createDataFrame([("a b", 1), ("c", 2)], "city string, n int")
    path = str(tmp_path / "t")
    sinks.replace_tenants({"x": df, "y": df}, path, ["a b", "c"])
    sinks.replace_tenants({"x": df.where("n = 3"), "y": df.withColumn("n", F.lit(7))}, path, ["a b"])
    assert [(r.city, r.n) for r in sinks.read_committed(spark, path, "x").collect()] == [("c", 2)]
    assert sorted((r.city, r.n) for r in sinks.read_committed(spark, path, "y").collect()) == [("a b", 7), ("c", 2)]
    sinks.append_load(df.drop("city").where("n = 1"), path + "-plain", "d")
    sinks.append_load(df.where("n = 2"), path + "-plain")
    assert sorted(r.city for r in spark.read.parquet(path + "-plain").collect()) == ["c", "d"]
    text = spark.createDataFrame([("x", 'line "one"\nline, two'), ("y", "plain"), ("z", None)], "k string, t string")
    sinks.write_stage(text, str(tmp_path / "csv"), "csv")
    assert sorted(map(tuple, files.read_csv_raw(spark, str(tmp_path / "csv")).collect())) == sorted(map(tuple, text.collect()))


def test_publish_scans_raw_calendar_once(spark, tmp_path, fixtures):
    out = str(tmp_path / "star")
    m = build.market_from_files(spark, fixtures, CITIES, config_frame(spark, SETTINGS))
    build.publish(m, out, CITIES)
    occ_plan = m.occupancy._jdf.queryExecution().executedPlan().toString()
    # the published Parquet, pruned to these cities' partitions and to two columns
    assert "FileScan parquet" in occ_plan and "FileScan csv" not in occ_plan
    assert "PartitionFilters: [city" in occ_plan and "ReadSchema: struct<listing_id:bigint,available:boolean>" in occ_plan
    # the dimensions read the materialised enriched listings (pruned Parquet), not the raw files
    dim_plan = m.dim_room_type._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in dim_plan and "/tables/enri" in dim_plan
    assert "ReadSchema: struct<city:string,id:bigint,room_type:string,price:double,occupancy_rate:double>" in dim_plan


def test_queries_on_published_tables_equal_lazy_plans(spark, tmp_path, fixtures):
    """Production path: publish once, answer queries from the city-partitioned Parquet star schema."""
    out = str(tmp_path / "star")
    cfg = config_frame(spark, SETTINGS)
    build.publish(build.market_from_files(spark, fixtures, CITIES, cfg), out, CITIES)
    lazy = build.market_from_files(spark, fixtures, CITIES, cfg)
    pub = Published(spark, out, cities=["aldmere"])

    def rows(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())

    aldmere = F.col("city") == "aldmere"
    for q in (M.neighbourhood_stats, M.room_type_breakdown, M.price_tier_distribution, M.host_portfolio):
        assert rows(q(pub.fact_listings)) == rows(q(lazy.fact_listings).where(aldmere)), q.__name__
    assert rows(M.monthly_availability(pub.fact_calendar)) == rows(M.monthly_availability(lazy.fact_calendar).where(aldmere))
    assert rows(M.superhost_comparison(pub.fact_listings, pub.dim_host)) == \
        rows(M.superhost_comparison(lazy.fact_listings, lazy.dim_host).where(aldmere))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = pub.fact_listings._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[[^\n]*city#\d+ = aldmere", plan)   # only aldmere's folder is read


def test_published_read_tolerates_added_column(spark, tmp_path):
    """A city partition written before a column existed reads back with that column null."""
    from rentalytics.schema import DIM_ROOM_TYPE
    out = str(tmp_path / "star")
    new = spark.createDataFrame([(1, "a", "Entire home", 3, 10.0, 50.0)], DIM_ROOM_TYPE)
    new.write.partitionBy("city").parquet(out + "/dim_room_type")
    old = new.drop("avg_occupancy").withColumn("city", F.lit("b"))   # the older layout
    old.write.mode("append").partitionBy("city").parquet(out + "/dim_room_type")
    got = {r.city: r for r in Published(spark, out).dim_room_type.collect()}
    assert got["a"].avg_occupancy == 50.0 and got["b"].avg_occupancy is None and got["b"].avg_price == 10.0
    assert Published(spark, out).dim_room_type.columns == DIM_ROOM_TYPE.names


def test_listing_rules(market):
    from rentalytics.operators.quality import listing_rule_counts
    got = {(r.city, r.rule): r.violations for r in listing_rule_counts(market.listings).collect()}
    assert got[("aldmere", "outside_coordinates")] == 2                         # 39.9 lat and null coords
    assert got[("brisk", "outside_coordinates")] is None                        # no bounds configured
    assert got[("aldmere", "minimum_nights_over_365")] == 1 and got[("aldmere", "negative_price")] == 0


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_no_listing_is_dealt_out_by_city_or_area(spark):
    """A city's or an area's listings would all go to one task."""
    from rentalytics.plans import clean, enrich
    from rentalytics.sources.config import with_city_config
    cities = spark.range(400).selectExpr("id", "if(id % 2 = 0, 'bangkok', 'lisbon') as city", "'x' as host_since", "1.5D as hosts_time_as_host_years")
    by_city = r"hashpartitioning\((city|__cfg_city)#"
    config = with_city_config(cities, config_frame(spark))
    assert "SortMergeJoin" not in executed_plan(config) and not re.search(by_city, executed_plan(config))
    tenure = executed_plan(clean.with_host_tenure(config.withColumn("host_since", F.lit(None).cast("date"))))
    assert "SortMergeJoin" not in tenure
    listings = spark.range(400).selectExpr(
        "id", "if(id % 2 = 0, 'bangkok', 'lisbon') as city", "concat('a', id % 5) as neighbourhood_cleansed", "100D + id as price",
        "4D as review_scores_rating", "date'2025-01-01' as scrape_date")
    occupancy = spark.range(400).selectExpr("id as listing_id", "if(id % 2 = 0, 'bangkok', 'lisbon') as city", "10L as total_days",
                                            "4L as available_days", "6L as booked_days", "60D as occupancy_rate")
    enriched = enrich.enrich_listings(listings, occupancy)
    plan = executed_plan(enriched)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    rows = {r.id: r for r in enriched.collect()}
    assert len(rows) == 400 and rows[0].neighbourhood_median_price == 295.0 and rows[0].price_tier == "Budget"
