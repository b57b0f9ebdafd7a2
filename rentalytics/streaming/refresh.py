"""Scheduled refresh as a Structured Streaming job.

The source refreshes each city on a weekly schedule by re-running the
batch.  Here arrivals drive it: whenever a manifest row
``{"city": ..., "raw_base": ...}`` lands in a folder, the next
micro-batch rebuilds and republishes exactly the cities it names.  The
stream's checkpoint gives exactly-once bookkeeping of manifests, and the
publish step is idempotent (a run replaces its cities in all tables by one
commit), so a batch that is retried after an executor loss gives the same
tables.

Run with ``trigger(availableNow=True)`` from a scheduler (one refresh of
whatever arrived), or with a processing-time trigger to keep it running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..session import scratch_path
from ..plans import build

MANIFEST_SCHEMA = "city string, raw_base string"


def _refresh_batch(out_base: str, config: DataFrame | None, strict: bool):
    def run(batch: DataFrame, batch_id: int) -> None:
        # a manifest batch is a handful of rows (one per city drop): bounded
        arrivals = batch.dropDuplicates(["city", "raw_base"]).collect()
        by_base: dict[str, list[str]] = {}
        for r in arrivals:
            by_base.setdefault(r.raw_base, []).append(r.city)
        for raw_base, cities in by_base.items():
            build.run(batch.sparkSession, raw_base, sorted(set(cities)), out_base, config=config, strict=strict)
    return run


def start_refresh(spark: SparkSession, landing: str, out_base: str, *, checkpoint: str | None = None,
                  config: DataFrame | None = None, strict: bool = True, available_now: bool = True,
                  interval: str = "1 hour") -> StreamingQuery:
    """Start the refresh stream over manifest JSON files in ``landing``."""
    manifests = spark.readStream.schema(MANIFEST_SCHEMA).json(landing)
    w = (manifests.writeStream.foreachBatch(_refresh_batch(out_base, config, strict))
         .option("checkpointLocation", checkpoint or scratch_path(spark, "refresh-stream")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
