"""One Spark job builds and publishes the star schema for any number of cities.

The reference ran seven scripts per city in a loop; here a city is a
column: raw files of all requested cities are read into one frame per
source, cleaned and modelled together, and the published tables are
written partitioned by run and ``city``; one run-log write makes all of
them visible, so a re-run replaces exactly the cities it contains, in all
tables at once (``sources.sinks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import reject_unknown_tenants
from ..sources.config import config_frame
from ..sources.files import read_city_csv, read_geojson_features
from ..sources.sinks import commit_run, new_run, run_folder, stage_table, staged_rows, write_geojson_lines
from .clean import cleaned_features
from .market import Market


def read_city_features(spark: SparkSession, base: str, cities: Sequence[str]) -> DataFrame | None:
    """GeoJSON of each city (``base/<city>/neighbourhoods.geojson``) with the city and document position."""
    from ..sources.files import read_optional
    frames = []
    for c in cities:
        f = read_optional(lambda p=f"{base.rstrip('/')}/{c}/neighbourhoods.geojson": read_geojson_features(spark, p), "raw-neighbourhoods")
        if f is not None:
            frames.append(f.withColumn("city", F.lit(c)))
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def market_from_files(spark: SparkSession, raw_base: str, cities: Sequence[str],
                      config: DataFrame | None = None, strict: bool = False) -> Market:
    """Market over raw per-city files; reviews and neighbourhoods are optional sources.

    A file is cut into records by many tasks; each source is landed once as Parquet in the shared checkpoint folder.
    """
    from ..session import materialise_table
    config = config if config is not None else config_frame(spark)
    if strict:
        reject_unknown_tenants(spark, cities, config)
    listings = read_city_csv(spark, raw_base, cities, "listings")
    calendar = read_city_csv(spark, raw_base, cities, "calendar")
    reviews = read_city_csv(spark, raw_base, cities, "reviews", optional=True)
    features = read_city_features(spark, raw_base, cities)
    listings, calendar = materialise_table(listings, "raw-listings"), materialise_table(calendar, "raw-calendar")
    return Market(spark, listings=listings, calendar=calendar, reviews=reviews, features=features,
                  config=config, feature_position="feature_pos" if features is not None else None)


#: The tables of the star schema: a re-run clears its cities in all of them.
TABLES = ("fact_calendar", "fact_listings", "dim_host", "dim_room_type", "dim_property_type", "fact_reviews", "dim_date",
          "dim_neighbourhood")


def publish(market: Market, out_base: str, cities: Sequence[str], run_log: str | None = None) -> dict[str, int]:
    """Write every star-schema table (replacing only these cities) and commit them by one run-log row per city.

    The raw calendar — the largest input — is cleaned and scanned once: its
    fact is written first, and the per-listing occupancy is then computed
    from the published Parquet (three columns, these cities' partitions
    only).  The enriched listings, which the listing fact and four
    dimensions share, are written once in the shared checkpoint folder,
    so no table re-runs the cleaning, the occupancy aggregate or the
    benchmarks.  Rows per table and city are counted by one grouped job over
    the staged files.  A table without a source in this run loses
    these cities' old rows.  Readers (``market.Published``) see the run once its
    run-log rows are written, all tables at once; a run that fails before leaves
    what they see as it was.  Intermediates below the checkpoint folder and
    replaced runs' folders are not removed here, but by the storage's retention.
    """
    from ..schema import FACT_CALENDAR
    from ..session import materialise_table

    spark, base, run_id = market.spark, out_base.rstrip("/"), new_run()
    written: list[str] = []

    def write(name: str, df: DataFrame) -> None:
        stage_table(df.where(F.col("city").isin(list(cities))), base, name, run_id)
        written.append(name)

    write("fact_calendar", market.fact_calendar)
    published = spark.read.schema(FACT_CALENDAR).parquet(run_folder(base, "fact_calendar", run_id)).where(F.col("city").isin(list(cities)))
    market.use(calendar=published)
    enriched = materialise_table(market.enriched, "enriched")
    market.use(enriched=enriched)

    write("fact_listings", market.fact_listings)
    write("dim_host", market.dim_host)
    write("dim_room_type", market.dim_room_type)
    write("dim_property_type", market.dim_property_type)
    if market.raw_reviews is not None:
        write("fact_reviews", market.fact_reviews)
        write("dim_date", market.dim_date)
    if market.raw_features is not None:
        write("dim_neighbourhood", market.dim_neighbourhood)
        write_geojson_lines(cleaned_features(market.raw_features), run_folder(base, "neighbourhoods_geojson", run_id))
    rows = staged_rows(spark, base, written, run_id)
    commit_run(spark, base, run_id, cities, written, rows, TABLES, run_log)
    return {t: sum(n for (name, _), n in rows.items() if name == t) for t in written}


def run(spark: SparkSession, raw_base: str, cities: Sequence[str], out_base: str,
        config: DataFrame | None = None, strict: bool = True) -> dict[str, int]:
    """Full batch read -> clean -> enrich -> model -> publish (fails fast on unknown cities when strict)."""
    m = market_from_files(spark, raw_base, cities, config, strict)
    return publish(m, out_base, cities)
