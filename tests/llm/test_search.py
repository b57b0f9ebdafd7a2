"""Ranked search against a plain evaluation of every item over every document; the graph against plain sums; odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rentalytics.llm import search
from rentalytics.llm.common import table

PATTERN = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
BENCH = "item_id long, text string"


def cut(text):
    return PATTERN.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, top=10):
    held = [(d, Counter(cut(t))) for d, t in docs if cut(t)]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        asked, scores = Counter(cut(text)), []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // length
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                    for t, k in asked.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return sorted(out, key=str)


def held(docs, benchmark, **kw):
    got = sorted((tuple(r) for r in search.search(docs, benchmark, **kw).collect()), key=str)
    want = plain([tuple(r) for r in docs.select(F.col("doc_id").cast("long"), "text").collect()],
                 [tuple(r) for r in benchmark.select("item_id", "text").collect()], **kw)
    assert got == want
    return got


def test_given_tables(spark):
    docs, items = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "benchmark"))
    assert len(held(docs.repartition(6), items)) == 400


def test_several_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 60)
    monkeypatch.setattr(search, "CELLS", 2000)
    monkeypatch.setattr(search, "SEGMENT", 4)
    rng = random.Random(3)
    text = lambda n: " ".join(f"{rng.choice('abcAB')}{rng.randrange(6)}" for _ in range(n))
    docs = spark.createDataFrame([(i, text(rng.randrange(0, 30))) for i in range(200)], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([(i, text(rng.randrange(0, 40))) for i in range(25)], BENCH)
    held(docs, items)
    held(docs, items, top=3)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "One two. one"), (1, "One two. one"), (1, "alpha"), (None, "日本語 テキスト"), (2, None), (3, ""), (4, "no such terms"), (5, " ,. ")], BENCH)
    extra = items.withColumns({c: F.lit(0) for c in ["item", "rows", "rank", "score", "doc_id", "copy", "terms", "times"]})
    held(odd_docs, extra)
    assert search.search(no_docs, items).count() == 0
    assert search.search(odd_docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert search.search(odd_docs, items.where("item_id = 3")).count() == 0


def test_ties_go_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(50, 0, -1)] + [(None, "same words here"), (7, "same words here"), (99, "other")], "doc_id long, text string")
    got = held(docs.repartition(4), spark.createDataFrame([(1, "same words")], BENCH))
    assert sorted(r[2] for r in got) == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9]


@pytest.mark.parametrize("seed", range(5))
def test_graph_equals_plain_sums(seed):
    rng = random.Random(seed)
    items = []
    for i in range(40):
        count = Counter(f"t{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(1, 50)))
        items.append((i, 1, list(count), list(count.values())))
    items += [(40 + k, 1, *items[k][2:]) for k in range(3)]  # equal items
    g = search.graph(items)
    acc = np.zeros((g.size, 7), dtype=np.int64)
    leaves = np.random.default_rng(seed).integers(0, 1000, (len(g.terms), 7))
    acc[:len(leaves)] = leaves
    g.evaluate(acc)
    at = {t: j for j, t in enumerate(g.terms)}
    want = np.array([sum(k * leaves[at[t]] for t, k in zip(ts, ks)) for _, _, ts, ks in items])
    assert (acc[g.root] == want).all()
    adds = sum(len(below) - len(node) for node, _, below, _ in g.levels)
    assert adds < sum(len(ts) - 1 for _, _, ts, _ in items) * 0.8  # sums are shared


def test_terms_of_sliced_arrays():
    texts = pa.array(["xx", "Aa-bB9_é,ÀZ", "", "  q  ", "[`{~\x7f", "日本 語a"])
    for lo in range(len(texts)):
        found, text = search.terms(texts.slice(lo))
        want = [(w, i) for i, t in enumerate(texts.slice(lo).to_pylist()) for w in cut(t)]
        assert list(zip(found.to_pylist(), text.tolist())) == want
