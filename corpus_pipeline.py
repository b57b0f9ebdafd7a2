"""The corpus pipeline: documents through five stages, each written as Parquet and read again by the next.

Each stage works on all that the one before kept.  The classifier's rejects, all but one of each group of near
duplicates and contaminated documents go; personal data is masked; what stays is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentalytics.llm import decontam, ordermin, packing, pii, quality
from rentalytics.llm.common import keep, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the co-trained classifier takes for low quality or toxic."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, prefix="__").where("__keep").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return ordermin.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark."""
    judged = decontam.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = keep(judged.where("contaminated").select(F.col("doc_id").alias("__id"), F.col("h").alias("__h")).distinct(), "contaminated")
    return docs.join(bad, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__h")), "leftanti")


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data in the texts."""
    return pii.redact(docs, pii.fit(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents; a row for each piece, with its ids."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]

#: Trained classifiers, sketches and packing have no SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
