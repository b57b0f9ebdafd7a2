"""Records that span lines, cut out of large text files by many tasks.

A quoted CSV field may hold line ends and a GeoJSON document may be one line, so where a record ends depends on all text
before it.  That dependence is small, though: whether a line begins inside quotes is the parity of the quotes before it, and
whether a feature ends at a brace is the depth of brackets before it.  So

1. files are read as pieces (lines, or what lies between closing braces) in splits, and each split's pieces are summed up to
   what they do to that state (one row a split);
2. a running sum over a file's splits gives the state in which each of them begins;
3. tasks read the splits again, each from its own state, and join pieces to records; only what is cut off at the two ends of
   a split is shuffled, to be joined with its neighbours'.

A split is what the text source makes of a file (``spark.sql.files.maxPartitionBytes``); both reads see the same ones.
The table of splits has a row for each of them, as the driver's own list has when it plans a scan; it is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialise, materialise_table, ship_package

SPLIT = ["file", "block"]


def pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """value, file and block (where its split begins) of every piece between separators, in file order within a task."""
    return spark.read.option("lineSep", separator).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def start_states(steps: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """A row for each split: the running sum of each of ``totals`` over the file's splits before it."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = steps.groupBy(*SPLIT).agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    return sums.select(*SPLIT, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"start_{n}") for n in totals])


def with_state(steps: DataFrame, states: DataFrame) -> DataFrame:
    """Pieces, still in their order, with the state in which their split begins."""
    at = states.select(F.col("file").alias("__file"), F.col("block").alias("__block"), *[c for c in states.columns if c not in SPLIT])
    return steps.join(F.broadcast(at), (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block"))).drop("__file", "__block")


def cut(batches: Iterator[pa.RecordBatch], separator: str, ends: Callable[[pa.RecordBatch, tuple | None], tuple[np.ndarray, tuple]]) -> Iterator[pa.RecordBatch]:
    """Join the pieces of each split to records.

    ``ends(batch, state)`` tells after which pieces a record ends, and the state after the last (``None``: a split begins).
    ``place`` counts a split's records; the first (place 0) and what is left over at its end (``closed`` false) may be
    parts of records that other splits share.
    """
    key, state, place, rest = None, None, 0, []

    def row(records: pa.Array, first: int, closed: bool) -> pa.RecordBatch:
        n = len(records)
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]] * n, pa.string()), pa.array(np.full(n, key[1], dtype=np.int64)), pa.array(first + np.arange(n)),
            pa.array(np.full(n, closed)), records], names=[*SPLIT, "place", "closed", "record"])

    for batch in batches:
        if not batch.num_rows:
            continue
        block, file = batch.column("block").to_numpy(), batch.column("file").dictionary_encode()
        code = file.indices.to_numpy()
        turns = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (code[1:] != code[:-1])])
        for lo, hi in zip(turns, np.r_[turns[1:], batch.num_rows]):
            run, here = batch.slice(int(lo), int(hi - lo)), (file.dictionary[int(code[lo])].as_py(), int(block[lo]))
            if here != key:
                if rest:
                    yield row(pa.array([separator.join(rest)]), place, False)
                key, state, place, rest = here, None, 0, []
            last, state = ends(run, state)
            value, at = run.column("value"), np.flatnonzero(last)
            if not len(at):
                rest.append(separator.join(value.to_pylist()))
                continue
            head = separator.join([*rest, *value[:int(at[0]) + 1].to_pylist()])
            yield row(pa.array([head]), place, True)
            if len(at) > 1:
                lists = pa.ListArray.from_arrays(pa.array(at + 1, pa.int32()), value)
                yield row(pc.binary_join(lists, separator), place + 1, True)
            place += len(at)
            rest = [separator.join(value[int(at[-1]) + 1:].to_pylist())] if at[-1] + 1 < len(value) else []
    if rest:
        yield row(pa.array([separator.join(rest)]), place, False)


CUT_SCHEMA = "file string, block long, place long, closed boolean, record string"


def stitched(parts: DataFrame, separator: str) -> DataFrame:
    """Whole records: those inside a split as they are, and those that splits share joined together.  A joined record's place is
    0 in the split where it ends; what no split ends (at a file's end) has ``closed`` false."""
    shared = parts.where("place = 0 or not closed")
    before = Window.partitionBy("file").orderBy("block", "place").rowsBetween(Window.unboundedPreceding, -1)
    of = (shared.select(*SPLIT, "place", "closed")  # two rows a split at most, without their texts
          .withColumn("nth", F.coalesce(F.sum(F.col("closed").cast("long")).over(before), F.lit(0))).drop("closed"))
    one = (shared.join(of, [*SPLIT, "place"]).groupBy("file", "nth")
           .agg(F.array_sort(F.collect_list(F.struct("block", "place", "record"))).alias("p"), F.max("closed").alias("closed")))
    joined = one.select("file", F.element_at("p", -1)["block"].alias("block"),
                        F.when(F.col("closed"), F.lit(0)).otherwise(F.element_at("p", -1)["place"]).cast("long").alias("place"), "closed",
                        F.array_join(F.transform("p", lambda x: x["record"]), separator).alias("record"))
    return parts.where("place > 0 and closed").unionByName(joined)


# ------------------------------------------------------------------ CSV
def quote_steps(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """Lines with ``odd``: whether they turn quotes on or off.  Doubled quotes and quotes in the middle of a bare field do not."""
    d = "\\" + delimiter
    single = F.replace(F.col("value"), F.lit('""'), F.lit(""))
    turning = F.regexp_count(single, F.lit(f'(?<=^|{d})"|"(?=\\r?\\z|{d})'))
    return pieces(spark, path, "\n").withColumn("odd", F.when(F.col("value").contains('"'), turning % 2).otherwise(F.lit(0)).cast("int"))


def csv_records(spark: SparkSession, path: str | list[str], delimiter: str = ",") -> DataFrame:
    """file, block, place, closed and record (its text) of every CSV record below ``path``, headers too; no empty lines."""
    ship_package(spark)

    def ends(run: pa.RecordBatch, state: tuple | None) -> tuple[np.ndarray, tuple]:
        start = run.column("start_odd")[0].as_py() if state is None else state[0]
        inside = (start + np.cumsum(run.column("odd").to_numpy())) % 2
        return inside == 0, (int(inside[-1]),)

    steps = quote_steps(spark, path, delimiter)
    states = materialise(start_states(steps, {"odd": F.col("odd")}))
    parts = materialise_table(with_state(steps, states).mapInArrow(lambda b: cut(b, "\n", ends), CUT_SCHEMA), "csv-records")
    return stitched(parts, "\n").withColumn("record", F.regexp_replace("record", r"\r\z", "")).where("record <> ''")


# ------------------------------------------------------------------ GeoJSON
def bracket_steps(spark: SparkSession, path: str) -> DataFrame:
    """Texts up to each closing brace, with the parity of their quotes and what they do to the depth of braces and brackets,
    if they begin outside a string (curly0, square0) and if inside one (curly1, square1)."""
    def depth(text: Column, up: str, down: str) -> Column:
        return F.length(F.replace(text, F.lit(down), F.lit(""))) - F.length(F.replace(text, F.lit(up), F.lit("")))

    plain = F.regexp_replace("value", r"\\.", "")
    outside = F.regexp_replace(plain, '"[^"]*("|$)', "")
    after = F.regexp_replace(F.regexp_replace(plain, '^[^"]*("|$)', ""), '"[^"]*("|$)', "")
    return pieces(spark, path, "}").select(
        "*", ((F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2).alias("odd"),
        depth(outside, "{", "}").alias("curly0"), depth(outside, "[", "]").alias("square0"),
        depth(after, "{", "}").alias("curly1"), depth(after, "[", "]").alias("square1"))


def object_from(text: str, curly: int, square: int) -> str | None:
    """The object of a list of features that ends a text; the text may begin before the list."""
    start, string, skip = None, False, False
    for i, c in enumerate(text):
        if string:
            string, skip = skip or c != '"', not skip and c == "\\"
        elif c == '"':
            string = True
        elif c in "{}":
            if c == "{" and (curly, square) == (1, 1):
                start = i
            curly += 1 if c == "{" else -1
        elif c in "[]":
            square += 1 if c == "[" else -1
    return text[start:] if start is not None else None


def geojson_features(spark: SparkSession, path: str) -> DataFrame:
    """file, position (1..n in its document) and feature (its text) of every GeoJSON document below ``path``: the objects that lie in
    an array of the document itself."""
    ship_package(spark)

    def ends(run: pa.RecordBatch, state: tuple | None) -> tuple[np.ndarray, tuple]:
        first = tuple(run.column(f"start_{c}")[0].as_py() for c in ("odd", "curly", "square"))
        odd, curly, square = first if state is None else state
        inside = (odd + np.cumsum(run.column("odd").to_numpy())) % 2  # at the brace after a piece
        begins = np.r_[odd % 2, inside[:-1]] > 0
        c = curly + np.cumsum(np.where(begins, run.column("curly1").to_numpy(), run.column("curly0").to_numpy()) - (inside == 0))
        s = square + np.cumsum(np.where(begins, run.column("square1").to_numpy(), run.column("square0").to_numpy()))
        return (inside == 0) & (c == 1) & (s == 1), (int(inside[-1]), int(c[-1]), int(s[-1]))

    steps = bracket_steps(spark, path)
    parity = materialise(start_states(steps, {"odd": F.col("odd")}))
    begun = with_parity(steps, parity)
    states = materialise(start_states(begun, {"odd": F.col("odd"), "curly": F.col("curly"), "square": F.col("square")}))
    parts = materialise_table(with_state(steps, states).mapInArrow(lambda b: cut(b, "}", ends), CUT_SCHEMA), "geojson-features")

    whole = stitched(parts, "}").where("closed")
    counts = parts.where("closed").groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("file").alias("__file"), F.col("block").alias("__block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    placed = whole.join(F.broadcast(offsets), (F.col("file") == F.col("__file")) & (F.col("block") == F.col("__block")))
    position = F.col("__before") + F.col("place") + 1
    # between two features of a list there is a comma; a document's first feature follows its head
    bare = F.regexp_replace(F.col("record"), r"^[\s,]*", "")
    named = placed.select("file", position.alias("position"), "record", bare.alias("bare"))
    plain = named.where("position > 1 and startswith(bare, '{')").select("file", "position", F.concat("bare", F.lit("}")).alias("feature"))
    other = named.where("position = 1 or not startswith(bare, '{')").select("file", "position", feature_after("record", F.col("position") == 1).alias("f"))
    return plain.unionByName(other.where("f is not null").select("file", "position", F.concat("f", F.lit("}")).alias("feature")))


def with_parity(steps: DataFrame, parity: DataFrame) -> DataFrame:
    """Pieces with what they do to the depth, by the state of quotes in which each begins: a task counts quotes on from its split's
    start."""
    kinds = "file string, block long, odd int, curly long, square long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, odd = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            file, block, odds = batch.column("file").to_pylist(), batch.column("block").to_numpy(), batch.column("odd").to_numpy()
            turns = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | np.array([a != b for a, b in zip(file[1:], file)], dtype=bool)])
            out = []
            for lo, hi in zip(turns, np.r_[turns[1:], batch.num_rows]):
                if (file[lo], block[lo]) != key:
                    key, odd = (file[lo], block[lo]), batch.column("start_odd")[int(lo)].as_py()
                inside = (odd + np.cumsum(odds[lo:hi])) % 2
                begins = np.r_[odd % 2, inside[:-1]] > 0
                curly, square = (np.where(begins, batch.column(f"{n}1").to_numpy()[lo:hi], batch.column(f"{n}0").to_numpy()[lo:hi]) for n in ("curly", "square"))
                out.append((file[lo], block[lo], int(odds[lo:hi].sum()) % 2, int((curly - (inside == 0)).sum()), int(square.sum())))
                odd = int(inside[-1])
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                             names=["file", "block", "odd", "curly", "square"])

    return with_state(steps, parity).drop("value").mapInArrow(work, kinds)


@F.pandas_udf(StringType())
def feature_after(text: pd.Series, first: pd.Series) -> pd.Series:
    """The feature that ends a text: after a document's head, or after the end of another list."""
    return pd.Series([object_from(t, *((0, 0) if f else (1, 1))) for t, f in zip(text, first)], dtype=object)
