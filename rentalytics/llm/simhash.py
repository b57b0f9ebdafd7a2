"""Operator 13: SimHash near duplicates, found with a hierarchical index over fingerprints in Gray order.

A fingerprint has a bit where over half the hashes (XXH64) of a text's three-word shingles have it.  Distinct fingerprints
are sorted by their rank in the Gray code, in which neighbours share most bits, and dealt out by ranges of that rank.
In each range, runs of ``RUN`` neighbours are the groups of an index: a group keeps the bits that all its members share
(a mask and the bits under it), ``FAN`` groups in a row have a node above that takes over what they all share, and so on
up to one root, so each node holds only the bits that its parent does not.  A search carries a group of fingerprints down:
the differences under the shared bits add up on the way, and a node over ``DISTANCE`` is left out with all below it.

Of two fingerprints that differ in at most three bits, one half differs in at most one.  So there are two indexes, one
over the fingerprints and one with the halves swapped, and in each the differences of the upper half, by which it is
sorted, may add up to one only: a group then meets few others, and what is read grows almost in proportion to the input.

The roots of all ranges (a mask and bits for each task, so their number is the session's partitions) are an index of
their own, in which each group finds the ranges it has to visit; it is sent there with its members.  A visit returns
links enough to connect what it found (a forest, at most one link for each fingerprint in it), not all pairs.  Classes are
the connected components of those links, over distinct fingerprints.

Defined cases: null text is empty; a text without words has fingerprint zero and links like any other; of fewer than
three words all are one shingle; repeated rows and doc_ids are kept and get their fingerprint's component; a null doc_id
counts for no minimum, and a component without any other has a null id; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rentalytics.llm.common import keep, partitions, ranges, slices, small_batches, text_array
from rentalytics.llm.components import components

SHINGLE, SEED, DISTANCE = 3, 42, 3
#: Fingerprints in a group, and nodes below a node.
RUN, FAN = 16, 8
#: Bytes of a text whose words are at hand at a time.
PIECE = 1 << 20
#: Queries that go down together, and pairs that a search holds at a time.
LOT, PAIRS = 1 << 14, 1 << 20
#: Links that are taken into a forest at a time.
MEETINGS = 1 << 15
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SPACE = re.compile(rb"[ \t\n\v\f\r]")
_UPPER_HALF = np.uint64(0xFFFFFFFF00000000)


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists that overlap by the words a shingle reaches over."""
    at, tail = 0, []
    while at < len(text):
        gap = _SPACE.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        words = tail + text[at:end].split()
        at, tail = end, words[-(SHINGLE - 1):]
        yield words


def fingerprint(text: bytes) -> int:
    """The fingerprint of a text in UTF-8."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    short: list[bytes] = []
    for words in pieces(text.translate(_LOWER)):
        if len(words) < SHINGLE:
            short = words
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, ends[:-1] + 1][:len(words) - SHINGLE + 1].tolist()
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1:].tolist())], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n and short:
        return xxh64_intdigest(b" ".join(short), SEED)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (64 bits as a long) of each document."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in text_array(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, "doc_id long, fp long")


def gray_rank(fp: Column) -> Column:
    """The place of a fingerprint in the Gray code, as a long in the order of the unsigned rank."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def swapped(fp: Column) -> Column:
    """A fingerprint with its halves exchanged."""
    return F.shiftleft(fp, 32).bitwiseOR(F.shiftrightunsigned(fp, 32))


def shared_bits(ands: np.ndarray, ors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask of the bits in which all members agree, and those bits."""
    return ~(ands ^ ors), ands


def runs(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each group of a sorted range begins, its mask and its bits."""
    begin = np.arange(0, len(fps), RUN)
    mask, bits = shared_bits(np.bitwise_and.reduceat(fps, begin), np.bitwise_or.reduceat(fps, begin))
    return begin, mask, bits


class Index:
    """Levels of nodes over groups in Gray order, from the root down to the groups.  A level has each node's mask and bits
    without what its parent has (``own``), so that differences add up from level to level."""

    def __init__(self, mask: np.ndarray, bits: np.ndarray):
        levels = [(mask, bits)]
        while len(levels[-1][0]) > 1:
            m, b = levels[-1]
            begin = np.arange(0, len(m), FAN)
            # bits that all children share: fixed in each of them, and alike
            common, ands, ors = np.bitwise_and.reduceat(m, begin), np.bitwise_and.reduceat(b, begin), np.bitwise_or.reduceat(b, begin)
            levels.append((common & ~(ands ^ ors), ands))
        levels.reverse()
        self.levels = []
        for k, (m, b) in enumerate(levels):
            above = levels[k - 1][0][np.arange(len(m)) // FAN] if k else np.zeros_like(m)
            self.levels.append((m & ~above, b))

    def search(self, mask: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, group) that the sums of differences don't rule out, in lots."""
        if len(self.levels[0][0]):
            for lo in range(0, len(mask), LOT):
                q = np.arange(lo, min(lo + LOT, len(mask)))
                nothing = np.zeros(len(q), dtype=np.uint8)
                yield from self.descend(0, q, np.zeros(len(q), dtype=np.int64), nothing, nothing, mask, bits)

    def descend(self, level: int, q: np.ndarray, node: np.ndarray, upper: np.ndarray, total: np.ndarray, mask: np.ndarray, bits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        own, held = self.levels[level]
        differ = (bits[q] ^ held[node]) & mask[q] & own[node]
        upper, total = upper + np.bitwise_count(differ & _UPPER_HALF), total + np.bitwise_count(differ)
        near = (upper <= DISTANCE // 2) & (total <= DISTANCE)
        q, node, upper, total = q[near], node[near], upper[near], total[near]
        if level + 1 == len(self.levels):
            if len(q):
                yield q, node
            return
        below = len(self.levels[level + 1][0])
        for lo in range(0, len(q), PAIRS // FAN):
            part = slice(lo, lo + PAIRS // FAN)
            n = np.minimum(FAN, below - node[part] * FAN)
            yield from self.descend(level + 1, np.repeat(q[part], n), ranges(node[part] * FAN, n), np.repeat(upper[part], n), np.repeat(total[part], n), mask, bits)


def links(fps: np.ndarray, begin: np.ndarray, index: Index, mask: np.ndarray, bits: np.ndarray, members: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of an indexed fingerprint and a member of a visiting group, unequal ones, in lots."""
    most = max(1, PAIRS // (RUN * RUN))
    for q, g in index.search(mask, bits):
        for lo in range(0, len(q), most):
            a, b = q[lo:lo + most], g[lo:lo + most]
            width = np.minimum(RUN, len(fps) - begin[b])
            # every member of the visiting group with every member of the group it met
            left = ranges(first[a], size[a])
            pair = np.repeat(np.arange(len(a)), size[a])
            n = width[pair]
            x, y = np.repeat(members[left], n), fps[ranges(begin[b][pair], n)]
            differ = np.bitwise_count(x ^ y)
            near = (differ > 0) & (differ <= DISTANCE)
            if near.any():
                yield x[near], y[near]


class Forest:
    """Which of some fingerprints are connected so far; keeps the links that connected them."""

    def __init__(self, fps: np.ndarray):
        self.fps = np.unique(fps)
        self.root = np.arange(len(self.fps))
        self.links: list[tuple[int, int]] = []

    def top(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Take in links; those within what is connected are passed over at once."""
        x, y = np.searchsorted(self.fps, a), np.searchsorted(self.fps, b)
        for lo in range(0, len(x), MEETINGS):
            i, j = x[lo:lo + MEETINGS], y[lo:lo + MEETINGS]
            p, q = self.root[i], self.root[j]
            apart = p != q
            new, at = np.unique((np.minimum(p, q) * len(self.fps) + np.maximum(p, q))[apart], return_index=True)
            for i, j in zip(i[apart][at].tolist(), j[apart][at].tolist()):
                s, t = self.top(i), self.top(j)
                if s != t:
                    self.root[t] = s
                    self.links.append((i, j))
            while len(new):  # every node points at its root again
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up

    def edges(self) -> np.ndarray:
        return self.fps[np.array(self.links, dtype=np.int64).reshape(-1, 2)]


def groups(fps: DataFrame) -> DataFrame:
    """The groups of an index over ``fp``: part (the task's range), grp (its number there), mask, bits and members (little-endian)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, grp, rest = TaskContext.get().partitionId(), 0, np.empty(0, dtype=np.uint64)

        def rows(x: np.ndarray) -> pa.RecordBatch:
            begin, mask, bits = runs(x)
            cut = [x[b:b + RUN].tobytes() for b in begin.tolist()]
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(begin), part, dtype=np.int32)), pa.array(grp + np.arange(len(begin), dtype=np.int64)),
                pa.array(mask.view(np.int64)), pa.array(bits.view(np.int64)), pa.array(cut, pa.binary())], names=["part", "grp", "mask", "bits", "members"])

        for batch in batches:
            x = np.r_[rest, batch.column("fp").to_numpy().view(np.uint64)]
            whole = len(x) - len(x) % RUN
            rest = x[whole:]
            if whole:
                yield rows(x[:whole])
                grp += whole // RUN
        if len(rest):
            yield rows(rest)

    n = partitions(fps.sparkSession)
    ranked = fps.select("fp", gray_rank(F.col("fp")).alias("rank"))
    return (ranked.repartitionByRange(n, "rank").sortWithinPartitions("rank").select("fp")
            .mapInArrow(work, "part int, grp long, mask long, bits long, members binary"))


def roots(index: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """part, mask and bits of each range: one row for each task that wrote the index."""
    found = index.groupBy("part").agg(F.bit_and("mask").alias("m"), F.bit_and("bits").alias("ands"), F.bit_or("bits").alias("ors")).orderBy("part").collect()
    part, m, ands, ors = (np.array([r[i] for r in found], dtype=np.int64) for i in range(4))
    m, ands, ors = m.view(np.uint64), ands.view(np.uint64), ors.view(np.uint64)
    return part, m & ~(ands ^ ors), ands


def visits(index: DataFrame) -> DataFrame:
    """Each group once for every range that it has to search: to, mask, bits, members."""
    part, mask, bits = roots(index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = Index(mask, bits)
        for batch in batches:
            own = batch.column("part").to_numpy()
            m, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("mask", "bits"))
            for q, r in top.search(m, b):
                here, to = own[q], part[r]
                goes = (here == to) | (((here + to) % 2 == 0) == (here < to))  # of two ranges one visits the other
                rows = batch.take(pa.array(q[goes]))
                yield pa.RecordBatch.from_arrays([pa.array(to[goes].astype(np.int32)), *(rows.column(c) for c in ("mask", "bits", "members"))],
                                                 names=["to", "mask", "bits", "members"])

    return index.mapInArrow(work, "to int, mask long, bits long, members binary")


def indexed_links(fps: DataFrame) -> DataFrame:
    """Links (a, b) that connect what an index over ``fp`` finds."""
    index = keep(groups(fps), "simhash-index")

    def visit(here: pd.DataFrame, come: pd.DataFrame) -> pd.DataFrame:
        here = here.sort_values("grp")
        members = np.frombuffer(b"".join(here["members"]), "<u8")
        begin, mask, bits = runs(members)
        size = np.fromiter(map(len, come["members"]), np.int64, len(come)) // 8
        visitors = np.frombuffer(b"".join(come["members"]), "<u8")
        forest = Forest(np.r_[members, visitors])
        for x, y in links(members, begin, Index(mask, bits), *(come[c].to_numpy().view(np.uint64) for c in ("mask", "bits")),
                          visitors, np.cumsum(size) - size, size):
            forest.add(x, y)
        return pd.DataFrame(forest.edges().view(np.int64), columns=["a", "b"])

    return index.select("part", "grp", "members").groupBy("part").cogroup(visits(index).groupBy("to")).applyInPandas(visit, "a long, b long")


def near_links(fps: DataFrame) -> DataFrame:
    """Links among distinct fingerprints ``fp`` that connect all which differ in at most DISTANCE bits in a chain."""
    plain = indexed_links(fps)
    turned = indexed_links(fps.select(swapped(F.col("fp")).alias("fp")))
    return keep(plain.unionByName(turned.select(swapped(F.col("a")).alias("a"), swapped(F.col("b")).alias("b"))), "simhash-links")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id (least doc_id reachable) of each document."""
    small_batches(docs.sparkSession)
    made = keep(fingerprints(docs), "simhash-docs")
    nodes = keep(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    labels = components(near_links(nodes.select("fp")))
    classed = nodes.join(labels, nodes.fp == labels.node, "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    classed = keep(classed, "simhash-classes")
    least = classed.groupBy("label").agg(F.min("least").alias("component_id"))
    named = classed.join(least, "label").select("fp", "component_id")
    return made.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
