"""Operator 8: packing by minimum bin slack.

A document's ids are cut into whole windows of ``capacity`` and a remainder.  How many remainders have each length
is a table of at most ``capacity`` rows whatever the input, so the packing itself is planned once on the driver:
``plan_windows`` seeds a window with the longest remainder left, finds by a bitset subset-sum the multiset of
lengths that comes closest to capacity, backtracks how many of each length it takes, and repeats that window as
often as the counts allow.  A slack that no multiset fills is filled by cutting one more remainder.  What is left in
the end, less than a window, is cut into sequences whose lengths are powers of two: those need no padding.

A remainder's place in the plan is its rank among those of its length: its rank in its partition plus the prefix sum
of the counts of the partitions before it, so no length, however frequent, meets in one task.

Defined cases: null text is empty (the end id alone); a null doc_id and repeated doc_ids are packed like any other
row; an empty table has no pieces; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentalytics.llm.common import keep, slices, small_batches, text_array
from rentalytics.llm.tokens import END_ID, TOKENIZER, encoder

CAPACITY = 2048


def fill(space: int, counts: dict[int, int]) -> dict[int, int]:
    """How many of each length come closest to ``space`` from below: bounded subset sums as bits of an integer."""
    mask, sums, steps = (1 << space + 1) - 1, 1, []
    for length in sorted((n for n in counts if n <= space and counts[n] > 0), reverse=True):
        left, lot = min(counts[length], space // length), 1
        while left:  # lots of 1, 2, 4, ... give every count up to the one there is
            lot = min(lot, left)
            steps.append((length, lot, sums))
            sums |= sums << lot * length & mask
            left, lot = left - lot, lot * 2
        if sums >> space & 1:
            break
    total, taken = sums.bit_length() - 1, defaultdict(int)
    for length, lot, before in reversed(steps):
        if not before >> total & 1:  # not to be had without this lot
            taken[length] += lot
            total -= lot * length
    return dict(taken)


class Supply:
    """Remainders by the length that is left of them, as runs (source length, first rank, how many, ids used)."""

    def __init__(self, counts: dict[int, int]):
        self.runs = defaultdict(list, {n: [(n, 0, c, 0)] for n, c in counts.items() if n and c})
        self.counts = {n: c for n, c in counts.items() if n and c}

    def take(self, length: int, many: int) -> list[tuple[int, int, int, int]]:
        self.counts[length] -= many
        if not self.counts[length]:
            del self.counts[length]
        out = []
        while many:
            source, first, there, used = self.runs[length].pop()
            n = min(there, many)
            out.append((source, first, n, used))
            if there > n:
                self.runs[length].append((source, first + n, there - n, used))
            many -= n
        return out

    def give(self, length: int, runs: list[tuple[int, int, int, int]]) -> None:
        self.runs[length] += runs
        self.counts[length] = self.counts.get(length, 0) + sum(r[2] for r in runs)


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rows (source length, first rank, how many, start, length, first sequence, offset): the remainder of that
    length and rank first + i puts ids start.. of itself into sequence first sequence + i; and how many sequences."""
    supply, rows, sequences = Supply(counts), [], 0
    total = sum(n * c for n, c in supply.counts.items())

    def put(length: int, many: int, offset: int, whole: int | None = None) -> None:
        """One piece into each of the next ``many`` sequences; what is left of a cut remainder goes back."""
        at, taken = sequences, supply.take(whole or length, many)
        for source, first, n, used in taken:
            rows.append((source, first, n, used, length, at, offset))
            at += n
        if whole and whole > length:
            supply.give(whole - length, [(s, f, n, used + length) for s, f, n, used in taken])

    while total >= capacity:
        seed = max(supply.counts)
        window = fill(capacity - seed, supply.counts | {seed: supply.counts[seed] - 1})
        window[seed] = window.get(seed, 0) + 1
        many = min(supply.counts[n] // c for n, c in window.items())
        slack = capacity - sum(n * c for n, c in window.items())
        cut = None
        if slack:  # every remainder that is left is longer than the slack, else it would have been taken
            many = min(many, total // capacity)
            free = {n: supply.counts[n] - window.get(n, 0) for n in supply.counts if n > slack}
            cut = max((n for n in free if free[n] > 0), key=lambda n: (free[n], n))
            many = min(many, supply.counts[cut] // (window.get(cut, 0) + 1))
        offset = 0
        for length, c in sorted(window.items(), reverse=True):
            for _ in range(c):
                put(length, many, offset)
                offset += length
        if cut:
            put(slack, many, offset, cut)
        sequences, total = sequences + many, total - many * capacity
    space = offset = 0
    while total:
        if not space:
            space, offset = 1 << total.bit_length() - 1, 0
        whole = max((n for n in supply.counts if n <= space), default=max(supply.counts))
        length = min(whole, space)
        put(length, 1, offset, whole)
        offset, space, total = offset + length, space - length, total - length
        sequences += not space
    return np.array(rows, dtype=np.int64).reshape(-1, 7), sequences


class Places:
    """Looks pieces up in a plan by source length, rank and start."""

    def __init__(self, rows: np.ndarray):
        self.at = {}
        order = np.lexsort((rows[:, 1], rows[:, 3], rows[:, 0]))
        rows = rows[order]
        keys, first = np.unique(rows[:, [0, 3]], axis=0, return_index=True)
        for (source, start), lo, hi in zip(keys.tolist(), first, np.r_[first[1:], len(rows)]):
            self.at[source, start] = rows[lo:hi]

    def pieces(self, source: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of one remainder."""
        start = 0
        while start < source:
            runs = self.at[source, start]
            run = runs[np.searchsorted(runs[:, 1], rank, side="right") - 1]
            yield start, int(run[4]), int(run[5]) + rank - int(run[1]), int(run[6])
            start += int(run[4])


def tokenized(docs: DataFrame, capacity: int, tokenizer: str, end_id: int) -> DataFrame:
    """Each document's ids, with its remainder's rank among those of its length in its partition, and how many whole
    windows its partition has before it."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        seen, windows = np.zeros(capacity, dtype=np.int64), 0
        for batch in slices(batches, "text"):
            ids, counts = enc.encode(text_array(batch.column("text")), end_id)
            rest, whole = counts % capacity, counts // capacity
            rank = np.empty_like(rest)
            order = np.argsort(rest, kind="stable")
            ordered = rest[order]
            new = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            size = np.diff(np.r_[new, len(ordered)])
            rank[order] = np.arange(len(ordered)) - np.repeat(new, size) + seen[ordered]
            seen[ordered[new]] += size
            before = windows + np.cumsum(whole) - whole
            windows += int(whole.sum())
            flat, ends = ids.astype(enc.id_type), np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.full(len(counts), part)), pa.array(counts), pa.array(rest),
                pa.array(rank), pa.array(whole), pa.array(before),
                pa.array([flat[e - c:e].tobytes() for c, e in zip(counts, ends)], pa.binary()),
                pa.array([enc.id_type.str] * len(counts))],
                names=["doc_id", "part", "n", "rest", "rank", "whole", "window", "ids", "id_type"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, part long, n long, rest long, rank long, whole long, window long, ids binary, id_type string")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, start (its document's ids before it), length, doc_tokens, sequence_id, offset
    (ids before it in the sequence) and ids (little-endian unsigned 32-bit)."""
    small_batches(docs.sparkSession)
    encoded = keep(tokenized(docs, capacity, tokenizer, end_id), "packing-ids")
    lots = keep(encoded.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum("whole").alias("whole")), "packing-lots")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = lots.groupBy("part").agg(F.sum("whole").alias("whole")).select(  # one row a partition
        "part", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("windows_before"))
    bases = lots.select("part", "rest", F.coalesce(F.sum("n").over(earlier.partitionBy("rest")), F.lit(0)).alias("rank_before")).join(parts, "part")
    totals = {r.rest: r.n for r in lots.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    rows, sequences = plan_windows(totals, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(rows)
        for batch in slices(batches, "ids"):
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], dtype=r["id_type"]).astype("<u4")
                first = sequences + r["windows_before"] + r["window"]
                found = [(i * capacity, capacity, first + i, 0) for i in range(r["whole"])]
                base = r["whole"] * capacity
                found += [(base + s, n, q, o) for s, n, q, o in places.pieces(r["rest"], r["rank_before"] + r["rank"])]
                for start, length, sequence, offset in found:
                    for k, v in zip(out, (r["doc_id"], start, length, r["n"], sequence, offset, ids[start:start + length].tobytes())):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()})

    return encoded.join(bases, ["part", "rest"]).mapInArrow(
        place, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
