"""SimHash classes against plain fingerprints and all pairs, the index against all pairs, and odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from rentalytics.llm import simhash
from rentalytics.llm.common import table


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, min(len(words), 1)))]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(pairs):
    """doc_id, fingerprint -> the least doc_id reachable, by all pairs of distinct fingerprints."""
    fps = sorted({f for _, f in pairs})
    a = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in (np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1:]) <= 3) + i + 1).tolist():
            root[top(j)] = top(i)
    least = {}
    for d, f in pairs:
        c = top(fps.index(f))
        least[c] = min([x for x in (least.get(c), d) if x is not None], default=None)
    return {f: least[top(i)] for i, f in enumerate(fps)}


def held(spark, df):
    rows = [(r.doc_id, r.text) for r in df.select(F.col("doc_id").cast("long"), "text").collect()]
    pairs = [(d, plain_fingerprint(t)) for d, t in rows]
    classes = plain_classes(pairs)
    want = sorted(((d, f"{f:016x}", classes[f]) for d, f in pairs), key=str)
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == want
    return got


def test_given_table(spark):
    got = held(spark, table(spark, "/root/testdata/sf0.01", "documents"))
    assert len({c for _, _, c in got}) < len(got)


def test_planted_copies(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(1, 300))]
        for c in range(rng.randrange(1, 4)):
            near = list(words)
            if c:
                near[rng.randrange(len(near))] = "Changed"
            rows.append((len(rows), " \n".join(near)))
    held(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(7))


def test_odd_rows(spark, odd_docs, no_docs):
    held(spark, odd_docs)
    assert simhash.near_duplicates(no_docs).count() == 0


def test_only_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, None), (None, "")], "doc_id long, text string")
    held(spark, df)


def test_spark_hash_is_the_same(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("Grün und blau")).alias("h")).first()
    assert np.int64(r.h).view(np.uint64) == xxh64_intdigest("Grün und blau".encode(), 42)


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice(["ab", "C", "é", " ", "\n", "\t ", "xyz"]) for _ in range(4000))
    want = plain_fingerprint(text)
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(simhash, "PIECE", size)
        assert simhash.fingerprint(text.encode()) == want
        assert [simhash.fingerprint(t.encode()) for t in ("", " \n", "one", " one two ", "one two three")] == [
            plain_fingerprint(t) for t in ("", " \n", "one", " one two ", "one two three")]


def test_gray_rank(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, int(np.uint64(n ^ n >> 1).astype(np.int64)), int(np.uint64(n).astype(np.int64)))
                                for i, n in enumerate([0, 1, (1 << 64) - 1] + [rng.getrandbits(64) for _ in range(300)])], "i int, g long, n long")
    assert df.where(simhash.gray_rank(F.col("g")) != F.col("n").bitwiseXOR(F.lit(-(1 << 63)))).count() == 0
    assert df.where(simhash.swapped(simhash.swapped(F.col("g"))) != F.col("g")).count() == 0


def ball(rng, centre, n, bits):
    out = set()
    while len(out) < n:
        x = centre
        for b in rng.sample(range(64), rng.randrange(bits + 1)):
            x ^= 1 << b
        out.add(x)
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_index_against_all_pairs(spark, seed):
    """Random fingerprints, chains of three steps, and a dense ball of them, which fills many ranges."""
    rng = random.Random(seed)
    fps = {rng.getrandbits(64) for _ in range(3000)} | {0, (1 << 64) - 1} | ball(rng, rng.getrandbits(64), 1500, 4)
    for x in rng.sample(sorted(fps), 300):
        for b in rng.sample(range(64), rng.randrange(1, 5)):
            x ^= 1 << b
        fps.add(x)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long").repartition(5)
    found = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in simhash.near_links(df).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found) and len(found) < 40 * len(fps)
    want = plain_classes([(f, f) for f in fps])
    root = {f: f for f in fps}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in found:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    assert {f: top(f) for f in fps} == want


def test_search_prunes():
    rng = np.random.default_rng(0)
    n = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2)
    fps = np.sort(np.unique(n))
    fps = fps ^ (fps >> np.uint64(1))
    _, mask, bits = simhash.runs(fps)
    pairs = sum(len(q) for q, _ in simhash.Index(mask, bits).search(mask, bits))
    assert len(mask) <= pairs < len(mask) ** 2 / 20
