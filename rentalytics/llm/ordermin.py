"""Operator 5: near duplicates by order MinHash.

A text is the sequence of its five-word shingles, each labelled with which occurrence of that shingle it is.  Under
each of ``BANDS`` random orders the ``PICKED`` least shingles are taken and kept in text order; their hash is a bucket
key, so texts meet that share words in the same order.  Candidates are verified without the labels, by an alignment of
the two shingle sequences inside the band of diagonals that a similarity of ``SIMILARITY`` allows: matched / (n + m - matched).

Equal texts are one node.  In each bucket all members are aligned with one pivot, the member that meets most others;
buckets whose members are then still in different components are compared in blocks of ``BLOCK`` texts, or fewer of
``BLOCK_BYTES`` together, and of those only pairs of different components.  So every pair of a bucket is either compared or already linked, and no pairs
are written but verified ones.  Classes are the connected components.

Defined cases: null text is empty; texts without words are near duplicates of equal texts alone; a text of fewer than
five words is one shingle; repeated rows and doc_ids fall into their text's class; the class id is the least doc_id
of the class, null where it has none; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import keep, slices, small_batches, split_words, text_array
from rentalytics.llm.components import components

SHINGLE, SIMILARITY = 5, 0.8
#: Least shingles in a key and how many keys: a pair of similarity 0.8 shares a key with probability 0.9999.
PICKED, BANDS = 6, 32
#: Texts that are compared in one go, and how many bytes they have: of long texts a group holds fewer, one at least.
BLOCK, BLOCK_BYTES = 64, 8 << 20
#: Places of a shingle, on average, from which on two texts are aligned by bits.
MANY_PLACES = 16
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_RANDOM = np.random.default_rng(20240501)
MULTIPLIERS = _RANDOM.integers(0, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
WORD_PLACES = _RANDOM.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PICK_PLACES = _RANDOM.integers(0, 1 << 63, PICKED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shingles of all texts in order, as hashes, which text each is of, and where each text's begin."""
    words, codes, offsets = split_words(pc.utf8_lower(texts))
    hashes = pd.util.hash_array(np.array([*words, ""], dtype=object))[codes]
    n = np.diff(offsets)
    size = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    for j, m in enumerate(WORD_PLACES[:len(hashes)]):
        rolled[:len(hashes) - j] += hashes[j:] * m
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        rolled[offsets[i]] = (hashes[offsets[i]:offsets[i + 1]] * WORD_PLACES[:n[i]]).sum(dtype=np.uint64)
    doc = np.repeat(np.arange(len(n)), size)
    start = np.cumsum(size) - size
    return mix(rolled[np.arange(len(doc)) - start[doc] + offsets[:-1][doc]]), doc, start


def with_labels(rolled: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Hashes that also tell the first, second, ... occurrence of a shingle in its text apart."""
    order = np.lexsort((rolled, doc))  # stable: equal shingles of a text stay in text order
    same = np.r_[False, (rolled[order][1:] == rolled[order][:-1]) & (doc[order][1:] == doc[order][:-1])]
    if not same.any():
        return rolled
    place = np.arange(len(order))
    occurrence = np.empty_like(place)
    occurrence[order] = place - np.maximum.accumulate(np.where(same, 0, place))
    return np.where(occurrence > 0, mix(rolled + occurrence.astype(np.uint64)), rolled)


def plain_and_labelled(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each text's shingles in order, without and with the label of the occurrence."""
    rolled, doc, start = shingle_hashes(texts)
    if not len(start):
        return [], []
    return np.split(rolled, start[1:]), np.split(with_labels(rolled, doc), start[1:])


def labelled_shingles(texts: pa.Array) -> list[np.ndarray]:
    return plain_and_labelled(texts)[1]


def picked_of(n: int) -> int:
    """How many least shingles make a key of a text with n shingles: fewer in short texts."""
    return min(PICKED, max(1, n // 2))


def bucket_keys(shingles: np.ndarray) -> np.ndarray:
    """The keys of a text; of two lengths where a similar text may be short enough to take fewer shingles."""
    n = len(shingles)
    if not n:
        return np.empty(0, dtype=np.int64)
    orders, out = shingles * MULTIPLIERS[:, None], []
    for picked in sorted({picked_of(m) for m in range(int(np.ceil(SIMILARITY * n)), n + 1)} if n < 4 * PICKED else {PICKED}):
        at = np.argpartition(orders, picked - 1, axis=1)[:, :picked] if n > picked else np.tile(np.arange(n), (BANDS, 1))
        at.sort(axis=1)  # the order of the text
        keys = (shingles[at] * PICK_PLACES[:picked]).sum(axis=1, dtype=np.uint64)
        out.append(mix(keys + MULTIPLIERS + np.uint64(picked)).view(np.int64))
    return np.unique(np.concatenate(out))


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the longest common subsequence reaches the similarity.

    At this similarity at most ``band`` shingles are unmatched, and no match lies farther off the diagonal.  Each
    shingle is matched with all its places inside the band: by Hunt and Szymanski's rising runs, its places in
    falling order so that a run takes one of them, or by bits where the places are many.
    """
    n, m = len(a), len(b)
    need = similarity / (1 + similarity) * (n + m) - 1e-9
    band = int(n + m - 2 * need) + 1
    _, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    width = n + m + 1
    places = np.sort(code[n:] * width + np.arange(m))  # by shingle, then place
    i, base = np.arange(n), code[:n] * width
    lo = np.searchsorted(places, base + np.clip(i - band, 0, m))
    count = np.searchsorted(places, base + np.clip(i + band + 1, 0, m)) - lo
    if (count > 0).sum() < need:
        return False
    if count.sum() > MANY_PLACES * (n + m):
        return common_by_bits(code[:n], code[n:]) >= need
    last = np.cumsum(count)
    falling = np.repeat(lo, count) + np.repeat(last, count) - 1 - np.arange(last[-1] if n else 0)
    tails: list[int] = []
    for j in (places[falling] % width).tolist():
        at = bisect_left(tails, j)
        if at == len(tails):
            tails.append(j)
        else:
            tails[at] = j
    return len(tails) >= need


def common_by_bits(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence: a row of its table is a number of len(b) bits, 0 where it rises."""
    order = np.argsort(b, kind="stable")
    ends = np.searchsorted(b[order], np.stack([a, a + 1]))
    full = (1 << len(b)) - 1
    row, often = full, {}
    for x, lo, hi in zip(a.tolist(), *ends.tolist()):
        if lo == hi:
            continue
        if (mask := often.get(x)) is None:
            mask = 0
            if hi - lo > MANY_PLACES:  # few shingles come so often: their masks are kept
                bits = np.zeros(len(b), dtype=bool)
                bits[order[lo:hi]] = True
                mask = often[x] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            else:
                for j in order[lo:hi].tolist():
                    mask |= 1 << j
        hit = row & mask
        row = ((row + hit) | (row - hit)) & full
    return len(b) - row.bit_count()


def overlaps(shingles: list[np.ndarray]) -> np.ndarray:
    """How many labelled shingles each two texts share, by products of 0/1 matrices: no common subsequence is longer."""
    size = np.array([len(s) for s in shingles])
    doc = np.repeat(np.arange(len(size)), size)
    _, code, count = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    doc, code = doc[shared[code]], column[code[shared[code]]]
    order = np.argsort(code, kind="stable")
    doc, code = doc[order], code[order]
    out, width = np.zeros((len(size), len(size)), dtype=np.float32), 1 << 14
    for lo in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(code, (lo, lo + width))
        part = np.zeros((len(size), width), dtype=np.float32)
        part[doc[i:j], code[i:j] - lo] = 1
        out += part @ part.T
    return out


def link(group: pd.DataFrame, similarity: float = SIMILARITY) -> list[tuple[bytes, bytes]]:
    """Verified links that connect the texts of a group (side, node, comp, text): between its two sides, or among
    all if there is one side; never inside a component, and no more than connect it."""
    group = group.drop_duplicates(["side", "node"])
    plain, shingles = plain_and_labelled(pa.array(group["text"].fillna("")))
    size, side, nodes = np.array([len(s) for s in shingles]), group["side"].to_numpy(), group["node"].tolist()
    if len(group) < 2 or not size.sum():
        return []
    root: dict = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    comp = group["comp"].tolist()
    shared = overlaps(shingles)
    total = size[:, None] + size[None, :]
    can = np.triu((shared >= similarity * (total - shared) - 1e-3) & (shared > 0), 1)
    if len(set(side)) > 1:
        can &= side[:, None] != side[None, :]
    pairs, out = np.argwhere(can), []
    for i, j in pairs[np.argsort(-shared[pairs[:, 0], pairs[:, 1]], kind="stable")]:
        x, y = top(comp[i]), top(comp[j])
        if x != y and aligned(plain[i], plain[j], similarity):
            root[x] = y
            out.append((nodes[i], nodes[j]))
    return out


def linked(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified edges (a, b) of groups (gid, side, node, comp); texts (node, text)."""
    def verify(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(link(group), columns=["a", "b"])

    return groups.join(texts, "node").groupBy("gid").applyInPandas(verify, "a binary, b binary")


def node_of(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, node (which text), its size in bytes and its bucket keys."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = [bucket_keys(s) for s in labelled_shingles(text_array(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), batch.column("bytes"), pa.array(keys, pa.list_(pa.int64()))],
                                             names=["doc_id", "node", "bytes", "keys"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of(F.col("text")).alias("node"),
                        F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), "text")
            .mapInArrow(sketch, "doc_id long, node binary, bytes int, keys array<long>"))


def group_count(texts: str, size: str) -> Column:
    """Into how many groups so many texts of so many bytes are dealt."""
    return F.greatest(F.ceil(F.col(texts) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")


def star_groups(members: DataFrame, pivots: DataFrame) -> DataFrame:
    """Every member with its bucket's pivot, in groups of about BLOCK members or BLOCK_BYTES."""
    pairs = members.join(pivots, "key").where("node <> pivot").select("pivot", "node", "bytes").distinct()
    parts = (pairs.groupBy("pivot").agg(F.count("*").alias("own"), F.sum("bytes").alias("size"))
             .select("pivot", group_count("own", "size").alias("parts")))
    gid = F.xxhash64("pivot", "part")
    dealt = pairs.join(parts, "pivot").select("pivot", "node", F.pmod(F.hash("node"), "parts").alias("part"))
    return (dealt.select(gid.alias("gid"), F.lit(1).alias("side"), "node")
            .unionByName(dealt.select("pivot", "part").distinct().select(gid.alias("gid"), F.lit(0).alias("side"), F.col("pivot").alias("node")))
            .withColumn("comp", F.col("node")))


def block_groups(members: DataFrame, pivots: DataFrame, labels: DataFrame) -> DataFrame:
    """Members other than the pivot of the buckets that span several components, in pairs of blocks.

    A component's members in a bucket fill blocks of their own if they are many, so that pairs of blocks within one
    component are left out.  Buckets of equal members are compared once.
    """
    rest = (members.join(pivots, "key").where("node <> pivot").join(labels, "node", "left")
            .select("key", "node", "bytes", F.coalesce("label", "node").alias("comp")))
    open_ = (rest.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"),
                                     F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("node")).alias("xor"))
             .where("lo <> hi").groupBy("n", "sum", "xor").agg(F.min("key").alias("key")).select("key"))
    rest = keep(rest.join(open_, "key"), "neardup-open")
    sizes = rest.groupBy("key", "comp").agg(F.count("*").alias("own"), F.sum("bytes").alias("size"))
    full = (F.col("own") >= BLOCK) | (F.col("size") >= BLOCK_BYTES)
    many = sizes.where(full).select("key", "comp", F.col("comp").alias("pure"), group_count("own", "size").alias("parts"))
    few = (sizes.where(~full).groupBy("key").agg(F.sum("own").alias("own"), F.sum("size").alias("size"))
           .select("key", group_count("own", "size").alias("loose")))
    placed = (rest.join(many, ["key", "comp"], "left").join(few, "key", "left")
              .withColumn("parts", F.coalesce("parts", "loose"))
              .select("key", "node", "comp", "pure", F.pmod(F.hash("node"), "parts").alias("part")))
    placed = keep(placed.withColumn("block", F.xxhash64("pure", "part")), "neardup-placed")
    blocks = placed.select("key", "block", "pure").distinct()
    x, y = blocks.alias("x"), blocks.alias("y")
    pairs = x.join(y, F.expr("x.key = y.key and x.block <= y.block and (x.pure is null or y.pure is null or x.pure <> y.pure)")).select(
        F.col("x.key").alias("key"), F.col("x.block").alias("left"), F.col("y.block").alias("right"), F.xxhash64("x.key", "x.block", "y.block").alias("gid"))
    sides = pairs.select("key", F.col("left").alias("block"), F.lit(0).alias("side"), "gid").unionByName(
        pairs.where("left <> right").select("key", F.col("right").alias("block"), F.lit(1).alias("side"), "gid"))
    return placed.join(sides, ["key", "block"]).select("gid", "side", "node", "comp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, node (hash of the text), class_id (least doc_id of the class) and class_node for each document."""
    small_batches(docs.sparkSession)
    sketched = keep(sketches(docs), "neardup-sketches")
    groups = sketched.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("bytes").alias("bytes"), F.first("keys").alias("keys"))
    keys = groups.select("node", "least", "bytes", F.explode("keys").alias("key"))
    sizes = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = keep(keys.join(sizes, "key"), "neardup-members")
    centre = members.groupBy("node").agg(F.sum("size").alias("met"))
    pivots = keep(members.join(centre, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("p"))
                  .select("key", F.col("p.node").alias("pivot")), "neardup-pivots")
    # one row of each text that is in a bucket: the one with its least doc_id
    wanted = members.select("node", F.col("least").alias("of")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), node_of(F.col("text")).alias("md5"), "text").join(
        wanted, F.expr("md5 = node and doc_id <=> of"))
    texts = keep(rows.select("node", "text"), "neardup-texts")
    stars = keep(linked(star_groups(members, pivots), texts), "neardup-stars")
    labels = components(stars)
    more = keep(linked(block_groups(members, pivots, labels), texts), "neardup-blocks")
    if not more.isEmpty():
        labels = components(stars.unionByName(more))
    least = groups.select("node", "least").join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("class_node"))
    classes = keep(least, "neardup-classes")
    # written before it is joined: a large class is then split over tasks, not joined in the one that summed it up
    ids = keep(classes.groupBy("class_node").agg(F.min("least").alias("class_id")), "neardup-ids")
    named = classes.join(ids, "class_node").select("node", "class_node", "class_id")
    return sketched.select("doc_id", "node").join(named, "node").select("doc_id", "node", "class_id", "class_node")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay: of each class the row with the least doc_id (nulls last); of equal rows one."""
    found = keep(near_duplicates(docs), "neardup-found")
    # a class's keeper is its least doc_id; where rows share that doc_id, the one of the least text hash
    best = found.groupBy("class_node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("k")).select("class_node", "k.doc_id", "k.node")
    twice = found.groupBy("node", "doc_id").agg(F.count("*").alias("n"))
    stay = best.alias("b").join(twice.alias("t"), F.expr("b.node = t.node and b.doc_id <=> t.doc_id")).select(
        F.col("b.node").alias("__keep_node"), F.col("b.doc_id").alias("__keep_id"), F.col("n").alias("__n"))
    joined = docs.withColumn("__node", node_of(F.col("text"))).join(
        stay, (F.col("__node") == F.col("__keep_node")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__keep_id")))
    alone = joined.where("__n = 1").select(docs.columns)
    equal = joined.where("__n > 1").dropDuplicates(["doc_id", "__node"]).select(docs.columns)
    return alone.unionByName(equal)
