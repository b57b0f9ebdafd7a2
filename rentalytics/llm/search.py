"""Operator 11: ranked lexical search for many items at once, with their common sub-expressions evaluated once.

An item's score of a document is a sum over its terms.  Terms (with the times the item repeats them) that lie in the same
items are one sum; of what is left, the pair of sums that lies in most items becomes a sum of its own, again and again, until
no pair is left in two items.  That gives a graph: term weights at the bottom, sums shared by several items above them, and
an item for each root.  Every node's partial scores of a block of documents are materialised once and read by all nodes
above, and the roots' are the items' scores.

Jobs: the documents are cut into terms once, and each document's terms that any item of the block has, with their number,
are written (``postings``); document frequencies and lengths are counted from that table for all documents; then tasks
evaluate the graph over blocks of postings, and hand on the ``top`` best documents of every item that they saw.  Items come in
blocks of about ``BLOCK_TERMS`` terms, so that a graph has that size at most, or that of one item.

Defined cases: null text has no terms; a document or an item without terms gives no row; equal rows of the benchmark are one
item whose rows come as often as it does, and rows that share an item_id only are items of their own; repeated documents
are ranked each; equal scores go by doc_id, nulls last, and a document scored 0 is not returned; empty tables give an
empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentalytics.llm.common import fitted, keep, slices, small_batches, text_array

TOP = 10
#: Terms of the items that are searched together.
BLOCK_TERMS = 20_000
#: Sums of an item among which shared pairs are looked for at a time: bounds the pairs of very long items.
SEGMENT = 64
#: Partial scores that a task holds at a time.
CELLS = 1 << 22
#: Digits, letters and all that is not ASCII stay, A-Z become a-z, the rest parts terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts in a row, and which text each is of."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = b"" if data is None else memoryview(data)[bounds[0]:bounds[-1]].tobytes().translate(_TERMS)
    clean = pa.StringArray.from_buffers(len(texts), pa.py_buffer((bounds - bounds[0]).tobytes()), pa.py_buffer(data))
    lists = pc.ascii_split_whitespace(clean)
    found, text = lists.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = pc.not_equal(found, "")
    return found.filter(real), text[real.to_numpy(zero_copy_only=False)]


@dataclass
class Graph:
    """Nodes in the order of their levels.  Leaf i < len(terms) is the weight of a term; the others are sums of ``factor`` times
    earlier nodes (``below``, from ``begin`` on).  ``root``: each item's node."""
    terms: list[str]
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    size: int
    items: list[tuple[int, int]]
    root: np.ndarray

    def evaluate(self, acc: np.ndarray) -> None:
        """Fill the rows of ``acc`` (nodes x documents) above the leaves."""
        for node, begin, below, factor in self.levels:
            values = acc[below]
            if (factor != 1).any():
                values *= factor[:, None]
            acc[node] = np.add.reduceat(values, begin, axis=0)


def shared_pairs(items: list[list[int]], fresh: int) -> dict[int, tuple[int, int]]:
    """Replace pairs of sums that lie in two lists or more by a new sum, most shared ones first; the new sums' parts."""
    made: dict[int, tuple[int, int]] = {}
    holds: dict[int, set[int]] = defaultdict(set)
    pairs: Counter = Counter()
    sets = [set(x) for x in items]
    for i, s in enumerate(sets):
        order = sorted(s)
        for x in order:
            holds[x].add(i)
        pairs.update((x, y) for k, x in enumerate(order) for y in order[k + 1:])
    heap = [(-n, p) for p, n in pairs.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (x, y) = heapq.heappop(heap)
        both = holds[x] & holds[y]
        if len(both) < 2:
            continue
        if len(both) != -n:  # counted before others took part of it
            heapq.heappush(heap, (-len(both), (x, y)))
            continue
        made[fresh] = (x, y)
        new: Counter = Counter()
        for i in both:
            sets[i] -= {x, y}
            new.update(sets[i])
            sets[i].add(fresh)
            holds[x].discard(i)
            holds[y].discard(i)
            holds[fresh].add(i)
        for z, n in new.items():
            if n > 1:
                heapq.heappush(heap, (-n, (z, fresh)))
        fresh += 1
    for x, s in zip(items, sets):
        x[:] = sorted(s)
    return made


def graph(items: list[tuple[int, int, list[str], list[int]]]) -> Graph:
    """The graph of items (number, rows, terms, times)."""
    names = sorted({t for _, _, ts, _ in items for t in ts})
    leaf = {t: i for i, t in enumerate(names)}
    where: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, (_, _, ts, times) in enumerate(items):
        for t, k in zip(ts, times):
            where[leaf[t], k].append(i)
    alike: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
    for element, holders in where.items():
        alike[tuple(holders)].append(element)
    below: dict[int, list[tuple[int, int]]] = {}
    parts: list[list[int]] = [[] for _ in items]
    often: dict[int, int] = {}
    for holders, elements in alike.items():
        if len(elements) == 1 and elements[0][1] == 1:
            node = elements[0][0]
        else:
            node = len(names) + len(below)
            below[node] = elements
        often[node] = len(holders)
        for i in holders:
            parts[i].append(node)
    # shared sums only can make shared pairs; those in most items come together
    segments, of = [], []
    for i, p in enumerate(parts):
        common = sorted((x for x in p if often[x] > 1), key=lambda x: (-often[x], x))
        parts[i] = [x for x in p if often[x] == 1]
        for lo in range(0, len(common), SEGMENT):
            segments.append(common[lo:lo + SEGMENT])
            of.append(i)
    for node, pair in shared_pairs(segments, len(names) + len(below)).items():
        below[node] = [(x, 1) for x in pair]
    for i, s in zip(of, segments):
        parts[i] += s
    root = []
    for p in parts:
        if len(p) == 1:
            root.append(p[0])
        else:
            root.append(len(names) + len(below))
            below[root[-1]] = [(x, 1) for x in p]
    depth = dict.fromkeys(range(len(names)), 0)
    at: dict[int, list[int]] = defaultdict(list)
    for node in sorted(below):  # parts come before what is made of them
        depth[node] = 1 + max(depth[x] for x, _ in below[node])
        at[depth[node]].append(node)
    levels = []
    for d in sorted(at):
        n = [len(below[x]) for x in at[d]]
        levels.append((np.array(at[d]), np.cumsum(n) - n, np.array([x for y in at[d] for x, _ in below[y]]), np.array([k for y in at[d] for _, k in below[y]])))
    return Graph(names, levels, len(names) + len(below), [(i[0], i[1]) for i in items], np.array(root, dtype=np.int64))


def item_terms(benchmark: DataFrame) -> DataFrame:
    """One row for each distinct row (item_id, text) with terms: item (a number), item_id, rows, terms and times."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, text = terms(text_array(batch.column("text")))
            names, times = [], []
            for i in range(batch.num_rows):
                lo, hi = np.searchsorted(text, (i, i + 1))
                count = Counter(found[lo:hi].to_pylist())
                names.append(list(count))
                times.append(list(count.values()))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("rows"), pa.array(names, pa.list_(pa.string())), pa.array(times, pa.list_(pa.int64()))],
                                             names=["item_id", "rows", "terms", "times"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = benchmark.groupBy("item_id", "text").agg(F.count("*").alias("rows")).select("item_id", "rows", "text")
    cut = rows.mapInArrow(work, f"item_id {kind}, rows long, terms array<string>, times array<long>").where("size(terms) > 0")
    return keep(cut.select(F.monotonically_increasing_id().alias("item"), "*"), "search-items")


def postings(docs: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, n (terms of the whole text, with repeats), and codes (places in ``names``) and tfs of the terms among ``names``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(names, pa.string())
        for batch in slices(batches, "text"):
            found, text = terms(text_array(batch.column("text")))
            n = np.bincount(text, minlength=batch.num_rows)
            code = pc.index_in(found, value_set=wanted)
            known = pc.is_valid(code).to_numpy(zero_copy_only=False)
            pair = text[known] * len(names) + code.drop_null().to_numpy()
            pair, tf = np.unique(pair, return_counts=True)
            ends = pa.array(np.searchsorted(pair, np.arange(batch.num_rows + 1) * len(names)), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(ends, pa.array((pair % len(names)).astype(np.int32))),
                                              pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))], names=["doc_id", "n", "codes", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return keep(rows.mapInArrow(work, "doc_id long, n long, codes array<int>, tfs array<long>").where("n > 0"), "search-postings")


def weights(found: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the weight of each of the block's terms."""
    total = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    df = np.zeros(n_terms, dtype=np.int64)
    for r in found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("df")).collect():
        df[r.code] = r.df
    return total.docs, total.terms or 0, np.floor(1000 * np.log((2 * total.docs + 2) / (2 * df + 1))).astype(np.int64)


class Best:
    """The best documents of each item so far, as (item, score, doc_id, whether that is null)."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.zeros(items, dtype=np.int64)
        self.rows = np.empty((4, 0), dtype=np.int64)

    def add(self, scores: np.ndarray, doc_id: np.ndarray, no_id: np.ndarray) -> None:
        item, doc = np.nonzero((scores >= self.least[:, None]) & (scores > 0))
        if not len(item):
            return
        rows = np.c_[self.rows, np.stack([item, scores[item, doc], doc_id[doc], no_id[doc]])]
        rows = rows[:, np.lexsort((rows[2], rows[3], -rows[1], rows[0]))]
        begin = np.searchsorted(rows[0], np.arange(len(self.least) + 1))
        place = np.arange(rows.shape[1]) - begin[rows[0]]
        self.rows = rows[:, place < self.top]
        last = begin[:-1] + self.top - 1
        full = last < begin[1:]
        self.least[full] = rows[1, last[full]]


def best_documents(found: DataFrame, g: Graph, docs: int, length: int, weight: np.ndarray, top: int) -> DataFrame:
    """item, score and doc_id: each task's best documents for every item."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, lot = Best(len(g.items), top), max(1, CELLS // g.size)
        for batch in batches:
            for lo in range(0, batch.num_rows, lot):
                part = batch.slice(lo, lot)
                codes, tfs = part.column("codes"), part.column("tfs")
                code, tf = codes.flatten().to_numpy(), tfs.flatten().to_numpy()
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(codes).to_numpy(zero_copy_only=False))
                m = 25 + 75 * part.column("n").to_numpy() * docs // length
                acc = np.zeros((g.size, part.num_rows), dtype=np.int64)
                acc[code, doc] = weight[code] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                g.evaluate(acc)
                ids = part.column("doc_id")
                best.add(acc[g.root], ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        item = np.array([i for i, _ in g.items], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(item[best.rows[0]]), pa.array(best.rows[1]), pa.array(best.rows[2], mask=best.rows[3] > 0)],
                                         names=["item", "score", "doc_id"])

    return found.mapInArrow(work, "item long, score long, doc_id long")


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of each item's ``top`` best documents."""
    spark = small_batches(docs.sparkSession)
    items = item_terms(benchmark)
    size = items.agg(F.sum(F.size("terms")).alias("n")).first().n or 0
    blocks = -(-size // BLOCK_TERMS)
    found = None
    for b in range(blocks):
        def build(rows: pa.Table | None) -> Graph:
            cols = rows.to_pydict() if rows is not None else {c: [] for c in ("item", "rows", "terms", "times")}
            return graph(list(zip(cols["item"], cols["rows"], cols["terms"], cols["times"])))

        here = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        g = fitted(here.select("item", "rows", "terms", "times"), "item", build)
        if not g.items:
            continue
        posted = postings(docs, g.terms)
        n, length, weight = weights(posted, len(g.terms))
        best = keep(best_documents(posted, g, n, length, weight, top), "search-best")
        found = best if found is None else found.unionByName(best)
    if found is None:
        kind = benchmark.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    # at most ``top`` rows of every task are left for an item
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    named = ranked.join(items.select("item", "item_id", "rows"), "item")
    return named.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select("item_id", "rank", "doc_id", "score")
