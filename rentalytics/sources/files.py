"""Readers (S01-S08).

Raw CSV is read as text (types come from the cleaning operators, never from
inference) and pandas-style missing-value tokens are normalised to null.
Quoted multi-line CSV and GeoJSON are cut into records by many tasks
(``sources.records``), so one large file is not one task.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise_null_tokens
from ..session import materialise, materialise_table
from .records import csv_records, geojson_features


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_raw(spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None,
                 null_tokens: bool = True, corrupt: str | None = None, file: str | None = None) -> DataFrame:
    """Header CSV with quoted multi-line text, everything as string; a file is read by as many tasks as it has splits.

    The columns are those of the header, in each file by its own (absent ones are null); ``columns`` picks some of them.
    ``corrupt`` names a column that holds the text of a record with too few or too many fields, or with quotes left
    open at its file's end; other records have null there.  ``file`` names a column for each record's file.  Fields that hold a quote are quoted themselves; a lone
    quote inside a bare field is a character of it, but at a bare field's end it is taken for a closing one.
    """
    records = csv_records(spark, path)
    first = records.groupBy("file").agg(F.min(F.struct("block", "place")).alias("f")).select(
        F.col("file").alias("__file"), F.col("f.block").alias("__block"), F.col("f.place").alias("__place"))
    is_first = (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")) & (F.col("place") == F.col("__place"))
    heads = materialise(records.join(first, is_first).select("file", F.regexp_replace("record", "^\uFEFF", "").alias("head")))
    texts = sorted(r.head for r in heads.select("head").distinct().collect())  # files of one source share their header
    if not texts:
        return spark.createDataFrame([], string_schema([*(columns or []), *(c for c in (corrupt, file) if c)]))
    body = records.join(first, is_first, "leftanti")
    frames = []
    for text in texts:
        names = next(csv.reader(io.StringIO(text, newline="")))
        mine = body if len(texts) == 1 else body.join(heads.where(F.col("head") == text).select("file"), "file")
        frames.append(parsed_csv(mine, names, list(columns) if columns is not None else names, corrupt, file))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return normalise_null_tokens(out) if null_tokens else out


def parsed_csv(records: DataFrame, names: list[str], wanted: list[str], corrupt: str | None, file: str | None) -> DataFrame:
    """The ``wanted`` columns of CSV records with the fields ``names``."""
    fields = [*names, "__corrupt"]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in fields)
    row = F.from_csv("record", schema, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
    parsed = records.select(row.alias("r"), "closed", "record", "file")
    cols = [(F.col("r").getField(n) if n in names else F.lit(None).cast("string")).alias(n) for n in wanted]
    if corrupt:
        cols.append(F.when(~F.col("closed"), F.col("record")).otherwise(F.col("r").getField("__corrupt")).alias(corrupt))
    if file:
        cols.append(F.col("file").alias(file))
    return parsed.select(*cols)


def read_csv_by_file(spark: SparkSession, path: str, columns: Iterable[str] | None = None, null_tokens: bool = True) -> DataFrame:
    """The same by Spark's own multi-line reader, a task for each file: for many small files."""
    reader = (spark.read.option("header", True).option("multiLine", True)
              .option("escape", '"').option("mode", "PERMISSIVE"))
    if columns is not None:
        reader = reader.schema(string_schema(columns)).option("enforceSchema", False)
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    return normalise_null_tokens(df) if null_tokens else df


#: Error conditions of a source that is not there or cannot be read.
UNREADABLE = ("PATH_NOT_FOUND", "Path does not exist", "FAILED_READ_FILE", "MALFORMED_", "UNABLE_TO_INFER_SCHEMA")


def read_optional(loader: Callable[[], DataFrame], name: str | None = None) -> DataFrame | None:
    """A failed optional source yields ``None``; later steps skip it.

    With ``name`` the source is read here, whole, and landed as Parquet in the shared checkpoint folder, so that a file that
    is there but breaks while it is read is absent too.  Errors of other kinds are raised.
    """
    try:
        df = loader()
        df.schema  # resolve the plan now so a missing path surfaces here
        return materialise_table(df, name) if name else df
    except (PySparkException, Py4JJavaError) as exc:
        if any(c in str(exc) for c in UNREADABLE):
            return None
        raise


def read_geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature with its 1-based document position (``feature_pos``) and its document (``file``).

    ``feature.properties`` has the two named fields and all properties as they were read (``source``, VARIANT); the geometry
    is VARIANT, since an inferred schema over mixed Polygon and MultiPolygon coordinates corrupts it.
    """
    f = geojson_features(spark, path).select("file", "position", F.from_json("feature", "type string, properties variant, geometry variant").alias("f"))
    props = F.struct(*[F.try_variant_get("f.properties", f"$.{n}", "string").alias(n) for n in ("neighbourhood", "neighbourhood_group")],
                     F.col("f.properties").alias("source"))
    return f.select("file", F.col("position").alias("feature_pos"), F.struct("f.type", props.alias("properties"), "f.geometry").alias("feature"))


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table under ``base``."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_city_csv(spark: SparkSession, base: str, cities: Iterable[str], name: str,
                  optional: bool = False, corrupt: str | None = None) -> DataFrame | None:
    """Raw CSV of several cities (``base/<city>/<name>.csv``), city stamped, aligned by column name.

    Cities may ship different column sets; missing columns become null.  An optional file that is missing or cannot be
    read is skipped (S05).  ``corrupt`` names the column of broken records' texts (``read_csv_raw``).
    """
    paths = {city: f"{base.rstrip('/')}/{city}/{name}.csv" for city in cities}
    if optional:  # each city's by itself, as any of them may be absent
        frames = [df.withColumn("city", F.lit(city)) for city, path in paths.items()
                  if (df := read_optional(lambda p=path: read_csv_raw(spark, p, corrupt=corrupt), f"raw-{name}")) is not None]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None
    df = read_csv_raw(spark, list(paths.values()), corrupt=corrupt, file="__file")
    of = F.lit(None).cast("string")
    for city in paths:
        of = F.when(F.url_decode(F.replace(F.col("__file"), F.lit("+"), F.lit("%2B"))).endswith(f"/{city}/{name}.csv"), city).otherwise(of)
    return df.withColumn("city", of).drop("__file")
