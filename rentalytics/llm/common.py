"""Helpers shared by the operators: table access, intermediates, word splitting, Arrow slices."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentalytics.session import apply_conf, materialise_table, scratch_path, ship_package

#: Text bytes that a Python task turns into words at a time: bounds its memory whatever the batch size.
SLICE_BYTES = 2 << 20
#: Bytes of text that a model is trained on at most, and of one text in it: they go to one task.
SAMPLE_BYTES, SAMPLE_TEXT_BYTES = 128 << 20, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand texts to Python in Arrow batches of few bytes, unless the session was launched with sizes of its own; and
    let the workers import this package."""
    ship_package(spark)
    apply_conf(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES)})
    return spark


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it back: the lineage ends there,
    so a lost executor repeats no more than the job that reads it."""
    return materialise_table(df, f"llm-{name}")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return scratch_path(spark, f"files/{name}-{uuid.uuid4().hex}")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The same at most ``rows`` rows on every run: those whose hashed key is least.

    A first filter on the hash, set by a count, leaves about twice that many, so that what the tasks hand to the last
    one does not grow with their number.
    """
    h = F.xxhash64(F.col(key).cast("string"))
    share = min(1.0, (2 * rows + 100) / max(df.count(), 1))
    if share < 1:
        df = df.where(h < int(-(1 << 63) + share * (1 << 64)))
    return df.orderBy(h, F.col(key)).limit(rows)


def bounded_bytes(sample: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Of a bounded sample the rows of least hashed key whose texts have ``SAMPLE_BYTES`` together; texts longer than
    ``SAMPLE_TEXT_BYTES`` are not trained on, neither whole nor in part."""
    size = F.coalesce(F.octet_length(text), F.lit(0))
    earlier = Window.orderBy(F.xxhash64(F.col(key).cast("string")), F.col(key), F.xxhash64(text)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (sample.where(size <= SAMPLE_TEXT_BYTES).withColumn("__upto", F.sum(size).over(earlier))
            .where(F.col("__upto") <= SAMPLE_BYTES).drop("__upto"))


def fitted(sample: DataFrame, order: str, fit: Callable[[pa.Table], object]) -> object:
    """What ``fit`` makes of a bounded sample in ``order``: it runs in one task, so that neither the rows nor the
    work on them are the driver's; only its result, a small model, comes back."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        model = fit(pa.Table.from_batches(rows).combine_chunks() if rows else None)
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    small_batches(sample.sparkSession)
    found = sample.repartition(1).sortWithinPartitions(order).mapInArrow(work, "model binary").collect()
    return pickle.loads(found[0].model) if found else fit(None)


def text_array(column: pa.Array) -> pa.Array:
    """A string column as Arrow hands it over, nulls as empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batches: Iterable[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``size`` bytes in each; one longer row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        length = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(length) - length) // size
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for lo, hi in zip(starts, np.r_[starts[1:], batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))
    pa.default_memory_pool().release_unused()  # the worker lives on, idle, beside the executor


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """White-space words of a batch: its distinct words, each word's index into them, and where each
    text's words begin (one entry more than texts)."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    if "" in words:  # of white space at either end of a text
        real = codes != words.index("")
        codes, offsets = codes[real], np.r_[0, np.cumsum(real)][offsets]
    return words, codes, offsets


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of arange(s, s + n) over all pairs."""
    total = int(lengths.sum())
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(total, dtype=np.int64)
