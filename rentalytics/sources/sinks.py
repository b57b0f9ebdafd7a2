"""Writers and table maintenance."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import read_optional


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = "city",
                mode: str = "overwrite") -> None:
    """Write one stage's output, partitioned by tenant when it has one."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("quoteAll", True).option("escape", '"') \
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by and partition_by in df.columns:
        w = w.partitionBy(partition_by)
    w.save(path)


def append_load(df: DataFrame, path: str, city: str | None = None) -> None:
    """Append rows, stamping the tenant when given; parallel partition writes."""
    if city is not None:
        df = df.withColumn("city", F.lit(city))
    df.hint("rebalance", "city").write.mode("append").partitionBy("city").parquet(path)


# ------------------------------------------------------------------ several tables, one commit
# <base>/<table>/run=<run id>/city=<city>/...   rows of a city as a run wrote them; never changed afterwards
# <base>/pipeline_metadata                      run log: a row per city and run, with the rows of each table
#
# A run writes all its tables first, each below its own run folder, and then the run log in one file.  That file is the
# commit: readers take of each (table, city) the folder of the last run in the log, so a run that fails anywhere before
# changes nothing for them, and one that commits changes all its tables at once.  A table without rows of a city has an
# entry of 0 and no folder, so the city's old rows are gone.  Folders that no reader follows any more are left to the
# storage's retention.
RUN_LOG = "pipeline_metadata"
RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("city", T.StringType(), True),
    T.StructField("run_timestamp", T.TimestampType(), True),
    T.StructField("tables_loaded", T.StringType(), True),
    T.StructField("total_rows", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("table_rows", T.MapType(T.StringType(), T.LongType()), True),
])


def new_run() -> str:
    return uuid.uuid4().hex


def run_folder(base: str, table: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/{table}/run={run_id}"


def stage_table(df: DataFrame, base: str, table: str, run_id: str) -> None:
    """Write a run's rows of a table; no reader sees them yet.  Rows are rebalanced on ``city``, so a city's files are as many
    as its size asks for, not one for each task."""
    df.hint("rebalance", "city").write.mode("overwrite").partitionBy("city").parquet(run_folder(base, table, run_id))


def staged_rows(spark: SparkSession, base: str, tables: Sequence[str], run_id: str) -> dict[tuple[str, str], int]:
    """Rows that a run staged, by table and city: one grouped job (tables x cities rows)."""
    parts = [spark.read.schema("city string").parquet(run_folder(base, t, run_id)).select(F.lit(t).alias("name"), "city") for t in tables]
    if not parts:
        return {}
    found = reduce(DataFrame.unionByName, parts).groupBy("name", "city").agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r["name"], r.city): r.n for r in found}


def commit_run(spark: SparkSession, base: str, run_id: str, cities: Sequence[str], tables: Sequence[str],
               rows: Mapping[tuple[str, str], int], all_tables: Sequence[str] | None = None, run_log: str | None = None,
               status: str = "success") -> DataFrame:
    """Append the run's rows to the run log, one per city, in one file; from then on readers follow this run.

    ``all_tables`` names the tables that the run replaces, also those that it has no rows for (``tables`` without them).
    """
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    replaced = list(all_tables or tables)
    log = spark.createDataFrame([
        (run_id, c, now, ",".join(tables), sum(rows.get((t, c), 0) for t in replaced), status, {t: int(rows.get((t, c), 0)) for t in replaced})
        for c in cities], RUN_LOG_SCHEMA)
    log.coalesce(1).write.mode("append").parquet(run_log or f"{base.rstrip('/')}/{RUN_LOG}")
    return log


def committed_runs(spark: SparkSession, base: str, table: str, run_log: str | None = None) -> dict[str, list[str]] | None:
    """The run that each city's rows of a table come from, as run -> cities (only cities with rows); None without a run log."""
    log = read_optional(lambda: spark.read.schema(RUN_LOG_SCHEMA).parquet(run_log or f"{base.rstrip('/')}/{RUN_LOG}"))
    if log is None:
        return None
    entries = log.where(F.col("status") == "success").select("run_id", "city", "run_timestamp", F.col("table_rows")[table].alias("n")).where("n is not null")
    last = entries.groupBy("city").agg(F.max_by(F.struct("run_id", "n"), F.struct("run_timestamp", "run_id")).alias("r"))
    out: dict[str, list[str]] = {}
    for r in last.where("r.n > 0").select("city", "r.run_id").collect():  # a row per city
        out.setdefault(r.run_id, []).append(r.city)
    return out


def read_committed(spark: SparkSession, base: str, table: str, schema: T.StructType | None = None, run_log: str | None = None,
                   cities: Sequence[str] | None = None) -> DataFrame:
    """A table (of these cities) as its last committed runs left it: the filter on run and city prunes all other folders.

    ``schema`` (with ``city``) is read as it is, so a column that was added after older runs is null in them.  A table
    written without a run log is read whole.
    """
    path, runs = f"{base.rstrip('/')}/{table}", committed_runs(spark, base, table, run_log)
    if runs is None:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
        df = df.where(F.col("city").isin(list(cities))) if cities else df
        return df.select(*schema.names) if schema else df
    if cities:
        runs = {r: kept for r, c in runs.items() if (kept := [x for x in c if x in cities])}
    if not runs and schema:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("run", T.StringType())])) if schema else spark.read
    df = reader.option("basePath", path).parquet(*[f"{path}/run={r}" for r in runs])
    follows = reduce(lambda a, b: a | b, ((F.col("run") == r) & F.col("city").isin(c) for r, c in runs.items()), F.lit(False))
    df = df.where(follows)
    return df.select(*schema.names) if schema else df.drop("run")


def replace_tenants(tables: Mapping[str, DataFrame], base: str, cities: Sequence[str], run_log: str | None = None) -> str:
    """Replace the rows of these cities in all ``tables`` at once; other cities stay.  Returns the run's id."""
    spark, run_id = next(iter(tables.values())).sparkSession, new_run()
    for name, df in tables.items():
        stage_table(df.where(F.col("city").isin(list(cities))), base, name, run_id)
    commit_run(spark, base, run_id, cities, list(tables), staged_rows(spark, base, list(tables), run_id), run_log=run_log)
    return run_id


def feature_json(features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One GeoJSON feature per row as text (``value``), beside the columns in ``keep``.  All properties that were read are
    kept; the struct's own fields overwrite or join them."""
    props = features.schema["feature"].dataType["properties"].dataType
    own = [f.name for f in props.fields if f.name != "source"]
    p = F.col("feature.properties")
    new = F.map_from_arrays(F.array(*map(F.lit, own)), F.array(*[p[n].cast("string").cast("variant") for n in own]))
    if "source" in props.names:
        read = F.from_json(F.to_json(p["source"]), "map<string,variant>")
        kept = F.map_filter(F.coalesce(read, F.create_map().cast("map<string,variant>")), lambda k, _: ~k.isin(own))
        new = F.map_concat(kept, new)
    return features.select(*keep, F.to_json(F.struct(
        F.coalesce(F.col("feature.type"), F.lit("Feature")).alias("type"), new.alias("properties"),
        F.col("feature.geometry").alias("geometry"))).alias("value"))


def write_geojson_lines(features: DataFrame, path: str) -> None:
    """One GeoJSON feature per line (``feature`` is a struct column)."""
    feature_json(features).write.mode("overwrite").text(path)

