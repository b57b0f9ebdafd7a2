"""Operator 12: vector codes of four bytes, by active-entry Lloyd.

A vector's components become the integers floor(``SCALE`` * x); it is cut into ``PARTS`` consecutive parts, and each part
position has a codebook of up to ``ENTRIES`` entries, at first those parts of the smallest vec_ids.  A round assigns every
part to the nearest entry (squared Euclidean distance, ties to the lower index) and moves each entry to the floor of its
parts' mean; entries without parts stay.

Beside its code each part keeps its exact distance.  In the next round a part whose entry stayed where it was compares
only the entries that moved against that distance: no other can have come nearer.  A part whose entry moved is compared
with the whole codebook.  Both give the code of a whole scan, ties included (``scanned`` counts the compared entries).

A round is one pass: tasks read the written table of the round before, and write the new codes and, at their end, one row
for each entry that has parts (their number and componentwise sum).  Only codebooks (PARTS x ENTRIES entries, whatever
the input) are at the driver.

Defined cases: rows whose vector is null, holds null or non-finite components, or is of another length than that of the
smallest kept vec_id are dropped; a length that is no multiple of four gives parts that differ by one; with fewer than
256 kept rows the codebooks have that many entries; null vec_ids come after all others, equal vec_ids are ordered by
their vectors; repeated rows are kept and count as often as they come; integers are held within +-2^24, so that distances are
exact in 64 bits; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import keep, small_batches

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Integers are held within this bound.
FAR = 1 << 24
#: Vectors compared with a codebook at a time.
LOT = 4096
#: Labels up to which their sums are sent to every task; beyond, they are joined by a shuffle, each under ``SALTS`` keys.
BROADCAST_LABELS, SALTS = 50_000, 16
STATE = "vec_id long, label {label}, vector array<int>, codes array<int>, distances array<long>, position int, entry int, n long, scanned long, sums array<long>"
INTS, LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())


@dataclass
class Codebooks:
    """One (entries, width) array of integers for each part position, and which entries the last update moved."""
    entries: list[np.ndarray]
    moved: list[np.ndarray]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for e in self.entries for x in e.ravel().tolist()).encode()).hexdigest()


def cuts(width: int) -> list[int]:
    return [width * p // PARTS for p in range(PARTS + 1)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows to all entries: by floating-point products where every number in them is an
    integer that a double holds, else in 64-bit integers."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if x.shape[1] * 4 * most * most < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    out = np.zeros((len(x), len(entries)), dtype=np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[:, j]) ** 2
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry, the lowest of equally near ones, and its distance."""
    code, far = np.zeros(len(x), dtype=np.int32), np.zeros(len(x), dtype=np.int64)
    for lo in range(0, len(x), LOT):
        d = distances(x[lo:lo + LOT], entries)
        best = d.argmin(axis=1)
        code[lo:lo + LOT], far[lo:lo + LOT] = best, d[np.arange(len(d)), best]
    return code, far


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``nearest`` from the last round's codes and distances; also how many distances it took."""
    code, far = code.copy(), far.copy()
    lost = moved[code]
    code[lost], far[lost] = nearest(x[lost], entries)
    held, active = np.flatnonzero(~lost), np.flatnonzero(moved)
    if len(active) and len(held):
        at, d = nearest(x[held], entries[active])
        at = active[at].astype(np.int32)
        nearer = (d < far[held]) | ((d == far[held]) & (at < code[held]))
        code[held[nearer]], far[held[nearer]] = at[nearer], d[nearer]
    return code, far, int(lost.sum()) * len(entries) + len(held) * len(active)


def kept_rows(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, vector (integers) of the rows that are kept; of any length yet."""
    x = F.col(vector)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.floor(c.cast("double") * SCALE))).cast("int"))
    return vectors.where(x.isNotNull() & whole).select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), scaled.alias("vector"))


def first_codebooks(kept: DataFrame) -> Codebooks | None:
    """The parts of the smallest vec_ids; None without rows."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    width = kept.orderBy(*order).limit(1).select(F.size("vector").alias("w")).collect()
    if not width:
        return None
    rows = kept.where(F.size("vector") == width[0].w).orderBy(*order).limit(ENTRIES).select("vector").collect()
    all_ = np.array([r.vector for r in rows], dtype=np.int64).reshape(len(rows), width[0].w)
    entries = [all_[:, a:b] for a, b in zip(cuts(width[0].w), cuts(width[0].w)[1:])]
    return Codebooks(entries, [np.ones(len(rows), dtype=bool)] * PARTS)


def flat(column: pa.Array, kind: type, rows: int) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(rows, -1)


def table_rows(n: int, columns: dict[str, pa.Array], label: pa.DataType) -> pa.RecordBatch:
    """Rows of a round's table; the columns that are not given are null."""
    kinds = {"vec_id": pa.int64(), "label": label, "vector": INTS, "codes": INTS, "distances": LONGS,
             "position": pa.int32(), "entry": pa.int32(), "n": pa.int64(), "scanned": pa.int64(), "sums": LONGS}
    return pa.RecordBatch.from_arrays([columns[c].cast(k) if c in columns else pa.nulls(n, k) for c, k in kinds.items()], names=list(kinds))


def assigned(rows: DataFrame, books: Codebooks, first: bool, last: bool) -> DataFrame:
    """A round's table: rows with codes and distances (with vectors but in the last round), and, after each task's rows,
    its sums for each entry (``position`` and ``entry`` are null in the former)."""
    bounds = cuts(sum(e.shape[1] for e in books.entries))
    width = bounds[-1]
    schema = STATE.format(label=rows.schema["label"].dataType.simpleString())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(e), dtype=np.int64) for e in books.entries]
        sums = [np.zeros_like(e) for e in books.entries]
        scanned, like = 0, None
        for batch in batches:
            like = batch.schema if like is None else like
            n = batch.num_rows
            if not n:
                continue
            x = flat(batch.column("vector"), np.int64, n) if width else np.zeros((n, 0), dtype=np.int64)
            codes, far = np.empty((n, PARTS), dtype=np.int32), np.empty((n, PARTS), dtype=np.int64)
            if not first:
                before, known = flat(batch.column("codes"), np.int32, n), flat(batch.column("distances"), np.int64, n)
            for p, entries in enumerate(books.entries):
                part = x[:, bounds[p]:bounds[p + 1]]
                if first:
                    codes[:, p], far[:, p] = nearest(part, entries)
                    scanned += n * len(entries)
                else:
                    codes[:, p], far[:, p], k = reassign(part, entries, books.moved[p], before[:, p], known[:, p])
                    scanned += k
                counts[p] += np.bincount(codes[:, p], minlength=len(entries))
                order = np.argsort(codes[:, p], kind="stable")
                used, begin = np.unique(codes[order, p], return_index=True)
                sums[p][used] += np.add.reduceat(part[order], begin, axis=0)
            ends = pa.array(np.arange(0, n * PARTS + 1, PARTS), pa.int32())
            yield table_rows(n, {"vec_id": batch.column("vec_id"), "label": batch.column("label"),
                                 "codes": pa.ListArray.from_arrays(ends, pa.array(codes.ravel())),
                                 "distances": pa.ListArray.from_arrays(ends, pa.array(far.ravel()))}
                             | ({} if last else {"vector": batch.column("vector")}), like.field("label").type)
        if like is None:
            return
        for p in range(PARTS):
            used = np.flatnonzero(counts[p])
            m = len(used)
            if m:
                compared = np.zeros(m, dtype=np.int64)
                compared[0], scanned = scanned, 0
                yield table_rows(m, {"position": pa.array(np.full(m, p)), "entry": pa.array(used), "n": pa.array(counts[p][used]),
                                     "scanned": pa.array(compared), "sums": pa.array(list(sums[p][used]), LONGS)}, like.field("label").type)

    return rows.mapInArrow(work, schema)


def updated(books: Codebooks, state: DataFrame) -> Codebooks:
    """Entries at the floor of their parts' mean; at most PARTS x ENTRIES x width numbers come to the driver."""
    sums = state.where("entry is not null")
    counts = sums.groupBy("position", "entry").agg(F.sum("n").alias("n")).collect()
    total = sums.select("position", "entry", F.posexplode("sums").alias("at", "x")).groupBy("position", "entry", "at").agg(F.sum("x").alias("x")).collect()
    n = [np.zeros(len(e), dtype=np.int64) for e in books.entries]
    new = [e.copy() for e in books.entries]
    for r in counts:
        n[r.position][r.entry] = r.n
    for r in total:
        new[r.position][r.entry, r.at] = r.x // int(n[r.position][r.entry])
    return Codebooks(new, [(a != b).any(axis=1) for a, b in zip(books.entries, new)])


def train(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS,
          trace: list[int] | None = None) -> tuple[DataFrame, Codebooks] | None:
    """The last round's rows (vec_id, label, codes, distances) and the final codebooks; None if no row is kept.

    ``trace`` gets the number of distances computed in each round.
    """
    small_batches(vectors.sparkSession)
    kept = kept_rows(vectors, key, vector, label)
    books = first_codebooks(kept)
    if books is None:
        return None
    rows = kept.where(F.size("vector") == sum(e.shape[1] for e in books.entries))
    for r in range(rounds + 1):
        state = keep(assigned(rows, books, r == 0, r == rounds), "codes")
        if trace is not None:
            trace.append(state.agg(F.sum("scanned")).first()[0])
        if r < rounds:
            books = updated(books, state)
        rows = state.where("entry is null").select("vec_id", "label", "vector", "codes", "distances")
    return rows.drop("vector"), books


def with_label_sums(rows: DataFrame, value: str, total: str) -> DataFrame:
    """``total``: the sum of ``value`` over the rows of the same label, nulls together.  A label may hold most rows: they are
    summed in the tasks first, and never gathered."""
    sums = keep(rows.groupBy("label").agg(F.sum(value).alias(total)), "codes-labels").withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    if sums.count() <= BROADCAST_LABELS:
        return rows.join(F.broadcast(sums), same).drop("__label")
    salted = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALTS)).cast("int"))
            .join(salted, same & (F.col("salt") == F.col("__salt"))).drop("__label", "salt", "__salt"))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, code (two hex digits a part), error, label_error (errors summed over the label), codebooks_sha256."""
    trained = train(vectors, key, vector, label)
    kind = vectors.schema[label].dataType.simpleString()
    if trained is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long, label_error long, codebooks_sha256 string")
    rows, books = trained
    code = F.concat(*[F.lower(F.lpad(F.hex(F.col("codes")[p]), 2, "0")) for p in range(PARTS)])
    coded = rows.select("vec_id", "label", "codes", code.alias("code"), sum((F.col("distances")[p] for p in range(1, PARTS)), F.col("distances")[0]).alias("error"))
    return with_label_sums(coded, "error", "label_error").drop("codes").withColumn("codebooks_sha256", F.lit(books.sha256()))
