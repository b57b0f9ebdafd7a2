"""Tenant (city) configuration and lookup tables.

Configuration is a small DataFrame joined on ``city`` (bounded by the number
of configured cities, so broadcasting it is safe); unknown cities fall back
to the defaults.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Per-city settings and defaults that results depend on.
# ---------------------------------------------------------------------------
DEFAULT_SCRAPE_DATE = dt.date(2025, 1, 1)
DEFAULT_CURRENCY = "$"

CITY_SETTINGS = {
    "bangkok": {
        "scrape_date": dt.date(2025, 9, 27), "currency": "฿",
        "lat": (13.4, 14.1), "lon": (100.2, 101.0),
        "centre": (13.7563, 100.5018),
    },
    "lisbon": {
        "scrape_date": dt.date(2026, 3, 26), "currency": "€",
        "lat": (38.4, 39.4), "lon": (-9.6, -8.8),
        "centre": (38.7169, -9.1399),
    },
}

# Price caps used by the distribution views (upper, lower
# variant per city).  Keys: view name -> city -> cap.
PRICE_CAPS = {
    "distribution": {"bangkok": 10000.0, "lisbon": 1000.0},
    "scatter": {"bangkok": 8000.0, "lisbon": 800.0},
    "reviews": {"bangkok": 10000.0, "lisbon": 800.0},
    "commercial": {"bangkok": 8000.0, "lisbon": 600.0},
}

# Raw property type -> property group, in the source's order.
# Anything not listed maps to "Other".
PROPERTY_TYPE_GROUPS = {
    "Entire rental unit": "Entire Apartment",
    "Entire condo": "Entire Apartment",
    "Entire serviced apartment": "Entire Apartment",
    "Entire loft": "Entire Apartment",
    "Entire guest suite": "Entire Apartment",
    "Private room in rental unit": "Private Room",
    "Private room in condo": "Private Room",
    "Private room in home": "Private Room",
    "Private room in loft": "Private Room",
    "Private room in guest suite": "Private Room",
    "Private room in villa": "Private Room",
    "Private room in serviced apartment": "Private Room",
    "Private room in guesthouse": "Private Room",
    "Private room in bed and breakfast": "Private Room",
    "Private room in hostel": "Private Room",
    "Private room in casa particular": "Private Room",
    "Private room in townhouse": "Private Room",
    "Private room in farm stay": "Private Room",
    "Private room in castle": "Private Room",
    "Private room in nature lodge": "Private Room",
    "Private room in cabin": "Private Room",
    "Private room in chalet": "Private Room",
    "Private room in tent": "Private Room",
    "Private room in cottage": "Private Room",
    "Private room in boat": "Private Room",
    "Private room in dome": "Private Room",
    "Private room in earthen home": "Private Room",
    "Private room in windmill": "Private Room",
    "Private room in tiny home": "Private Room",
    "Private room in camper/rv": "Private Room",
    "Private room in vacation home": "Private Room",
    "Private room in bungalow": "Private Room",
    "Private room in minsu": "Private Room",
    "Private room": "Private Room",
    "Entire home": "Entire House",
    "Entire villa": "Entire House",
    "Entire townhouse": "Entire House",
    "Entire place": "Entire House",
    "Entire bungalow": "Entire House",
    "Entire cottage": "Entire House",
    "Entire vacation home": "Entire House",
    "Entire guesthouse": "Entire House",
    "Entire cabin": "Entire House",
    "Entire chalet": "Entire House",
    "Entire bed and breakfast": "Entire House",
    "Casa particular": "Entire House",
    "Farm stay": "Entire House",
    "Entire home/apt": "Entire House",
    "Room in hotel": "Hotel Room",
    "Room in boutique hotel": "Hotel Room",
    "Room in aparthotel": "Hotel Room",
    "Room in serviced apartment": "Hotel Room",
    "Room in bed and breakfast": "Hotel Room",
    "Room in hostel": "Hotel Room",
    "Room in nature lodge": "Hotel Room",
    "Shared room in rental unit": "Shared Room",
    "Shared room in home": "Shared Room",
    "Shared room in hostel": "Shared Room",
    "Shared room in guesthouse": "Shared Room",
    "Shared room in bed and breakfast": "Shared Room",
    "Shared room in hotel": "Shared Room",
    "Shared room in boutique hotel": "Shared Room",
    "Shared room in townhouse": "Shared Room",
    "Shared room in villa": "Shared Room",
    "Boat": "Unique Stay",
    "Houseboat": "Unique Stay",
    "Camper/RV": "Unique Stay",
    "Tiny home": "Unique Stay",
    "Windmill": "Unique Stay",
    "Dome": "Unique Stay",
    "Hut": "Unique Stay",
    "Tent": "Unique Stay",
    "Campsite": "Unique Stay",
    "Shipping container": "Unique Stay",
    "Earthen home": "Unique Stay",
    "Yurt": "Unique Stay",
    "Cave": "Unique Stay",
    "Castle": "Unique Stay",
    "Lighthouse": "Unique Stay",
    "Treehouse": "Unique Stay",
    "Tower": "Unique Stay",
    "Bus": "Unique Stay",
    "Barn": "Unique Stay",
    "Entire hostel": "Unique Stay",
    "Holiday park": "Unique Stay",
}
OTHER_GROUP = "Other"

CONFIG_SCHEMA = T.StructType([
    T.StructField("city", T.StringType(), False),
    T.StructField("scrape_date", T.DateType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("lat_min", T.DoubleType(), True),
    T.StructField("lat_max", T.DoubleType(), True),
    T.StructField("lon_min", T.DoubleType(), True),
    T.StructField("lon_max", T.DoubleType(), True),
    T.StructField("centre_lat", T.DoubleType(), True),
    T.StructField("centre_lon", T.DoubleType(), True),
])


def config_frame(spark: SparkSession, settings: dict | None = None) -> DataFrame:
    """City settings as a DataFrame (one row per configured city)."""
    settings = CITY_SETTINGS if settings is None else settings
    rows = []
    for city, s in settings.items():
        lat = s.get("lat") or (None, None)
        lon = s.get("lon") or (None, None)
        centre = s.get("centre") or (None, None)
        rows.append((city, s.get("scrape_date"), s.get("currency"), lat[0], lat[1], lon[0], lon[1],
                     centre[0], centre[1]))
    return spark.createDataFrame(rows, CONFIG_SCHEMA)


def with_city_config(df: DataFrame, config: DataFrame, city_col: str = "city") -> DataFrame:
    """Attach per-city settings with defaults (date 2025-01-01, ``$``, no bounds).

    The settings, a row per configured city, are broadcast: dealt out by city the rows would go to as many tasks as there are cities.
    """
    cfg = F.broadcast(config.withColumnRenamed("city", "__cfg_city"))
    out = df.join(cfg, F.col(city_col) == F.col("__cfg_city"), "left").drop("__cfg_city")
    return (out.withColumn("scrape_date", F.coalesce(F.col("scrape_date"), F.lit(DEFAULT_SCRAPE_DATE)))
               .withColumn("currency", F.coalesce(F.col("currency"), F.lit(DEFAULT_CURRENCY))))
