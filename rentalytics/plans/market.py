"""Build the cleaned frames and the star schema from raw inputs, lazily.

``Market`` is a lazy handle on the whole batch flow for any number of
cities at once (``city`` is a column, never a loop).  Nothing runs until an
action; ``publish`` writes the star schema partitioned by city.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..sources.config import PROPERTY_TYPE_GROUPS, config_frame
from . import clean, enrich, model


class Market:
    def __init__(self, spark: SparkSession, *, listings: DataFrame | Callable[[], DataFrame], calendar: DataFrame,
                 reviews: DataFrame | None = None, features: DataFrame | None = None,
                 config: DataFrame | None = None, property_groups=PROPERTY_TYPE_GROUPS,
                 feature_position: str | None = None):
        self.spark = spark
        self._listings = listings  # a frame, or a function that builds it when first used
        self.raw_calendar = calendar
        self.raw_reviews = reviews
        self.raw_features = features
        self.config = config if config is not None else config_frame(spark)
        self.property_groups = property_groups
        self.feature_position = feature_position

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str) -> "Market":
        from ..sources.synthetic import SYNTHETIC_PROPERTY_GROUPS, SyntheticSource
        src = SyntheticSource(spark, sf_dir)
        return cls(spark, listings=src.listings, calendar=src.calendar(), reviews=src.reviews(),
                   features=src.neighbourhood_features(), property_groups=SYNTHETIC_PROPERTY_GROUPS)

    # ------------------------------------------------------------------ cleaned
    @cached_property
    def raw_listings(self) -> DataFrame:
        return self._listings() if callable(self._listings) else self._listings

    @cached_property
    def calendar(self) -> DataFrame:
        return clean.clean_calendar(self.raw_calendar)

    @cached_property
    def occupancy(self) -> DataFrame:
        return clean.occupancy_summary(self.calendar)

    @cached_property
    def listings(self) -> DataFrame:
        return clean.clean_listings(self.raw_listings, self.config, property_groups=self.property_groups)

    @cached_property
    def reviews(self) -> DataFrame:
        if self.raw_reviews is None:
            raise ValueError("no reviews source")
        return clean.clean_reviews(self.raw_reviews)

    @cached_property
    def neighbourhoods(self) -> DataFrame:
        if self.raw_features is None:
            raise ValueError("no neighbourhood source")
        return clean.clean_neighbourhoods(self.raw_features, self.feature_position)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich_listings(self.listings, self.occupancy)

    # ------------------------------------------------------------------ star schema
    @cached_property
    def fact_listings(self) -> DataFrame:
        return model.fact_listings(self.enriched)

    @cached_property
    def dim_host(self) -> DataFrame:
        # the enriched rows are the cleaned listings (one per listing, every listing column)
        # read from their checkpoint, so the raw listings are not cleaned a second time
        return model.dim_host(self.enriched)

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return model.fact_reviews(self.reviews)

    @cached_property
    def fact_calendar(self) -> DataFrame:
        return model.fact_calendar(self.calendar)

    @cached_property
    def dim_room_type(self) -> DataFrame:
        return model.dim_room_type(self.enriched)

    @cached_property
    def dim_property_type(self) -> DataFrame:
        return model.dim_property_type(self.enriched)

    @cached_property
    def dim_neighbourhood(self) -> DataFrame:
        return model.dim_neighbourhood(self.enriched, self.neighbourhoods)

    @cached_property
    def dim_date(self) -> DataFrame:
        return model.dim_date(self.reviews, self.calendar)

    def use(self, **stages: DataFrame) -> "Market":
        """Replace stages (``calendar``, ``enriched``, ...) by written or checkpointed copies.

        Later stages are then built from those copies instead of re-running
        the plan behind them; call it before the later stages are first used.
        """
        for name, df in stages.items():
            self.__dict__[name] = df
        return self

    def serving(self) -> DataFrame:
        """Facts left-joined with host attributes (the dashboard/notebook frame)."""
        h = model.dim_host(self.enriched, ["host_is_superhost", "is_commercial_host",
                                           "host_response_rate", "host_acceptance_rate"])
        return self.fact_listings.join(h, ["host_id", "city"], "left")

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_host": self.dim_host, "dim_neighbourhood": self.dim_neighbourhood,
            "dim_room_type": self.dim_room_type, "dim_property_type": self.dim_property_type,
            "dim_date": self.dim_date, "fact_listings": self.fact_listings,
            "fact_reviews": self.fact_reviews, "fact_calendar": self.fact_calendar,
        }


class Published:
    """Read side: the star schema as written by ``build.publish`` (partition-pruned by city)."""

    def __init__(self, spark: SparkSession, base: str, cities: list[str] | None = None):
        self.spark, self.base, self.cities = spark, base.rstrip("/"), cities

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        from ..schema import TABLES
        from ..sources.sinks import read_committed
        # S15 on the read side: the declared schema is read as is, so a column added after
        # older city partitions were written comes back null for them — no footer merging
        # over every file (which mergeSchema would need)
        return read_committed(self.spark, self.base, name, TABLES.get(name), cities=self.cities)
