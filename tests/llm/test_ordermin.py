"""Operator 5 against all pairs, and its parts."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from rentalytics.llm import ordermin
from rentalytics.llm.components import components


def labelled(text):
    w, seen, out = (text or "").lower().split(), Counter(), []
    for i in range(max(len(w) - 4, 1) if w else 0):
        s = tuple(w[i:i + 5])
        seen[s] += 1
        out.append((s, seen[s]))
    return out


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain_classes(rows):
    shingles, parent = [labelled(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = shingles[i], shingles[j]
            if (rows[i][1] or "") == (rows[j][1] or "") or a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and \
                    5 * (k := common(a, b)) >= 4 * (len(a) + len(b) - k):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [least.get(top(i)) for i in range(len(rows))]


def family(rng, base, many, most):
    out = []
    for _ in range(many):
        w = base.split()
        for _ in range(rng.randrange(most + 1)):
            i = rng.randrange(len(w))
            kind = rng.randrange(3)
            w[i:i + 1] = [f"n{rng.randrange(9999)}"] if kind == 0 else [] if kind == 1 else [w[i], "extra"]
        out.append(" ".join(w))
    return out


def classes(df):
    return sorted(((r.doc_id, r.class_id) for r in ordermin.near_duplicates(df).collect()), key=str)


def test_equals_all_pairs(spark):
    rng = random.Random(11)
    base = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    texts = [t for n in (1, 3, 4, 5, 6, 7, 9, 12, 20, 40, 80, 120) for t in family(rng, base(n), 8, max(n // 20, 1))]
    texts += family(rng, base(100), 90, 3)  # a group larger than a block
    shared = base(60)
    texts += [shared + " " + base(80) for _ in range(60)]  # a passage that many share makes no duplicates
    texts += ["", None, "  ", "Same Case here one two", "same case HERE one two", "r s t u v " * 40, "r s t u v " * 41]
    rows = list(enumerate(texts)) + [(500, texts[3]), (500, texts[3]), (None, texts[4]), (None, "alone and without id yes")]
    got = classes(spark.createDataFrame(rows, "doc_id long, text string"))
    want = sorted(((d, c) for (d, _), c in zip(rows, plain_classes(rows))), key=str)
    assert got == want


def test_groups_of_few_bytes_change_nothing(spark, monkeypatch):
    """Long texts make small groups and blocks; the classes stay."""
    monkeypatch.setattr(ordermin, "BLOCK_BYTES", 2000)
    rng = random.Random(12)
    base = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    texts = [t for n in (6, 40, 120, 700) for t in family(rng, base(n), 8, max(n // 20, 1))]
    shared = base(60)
    texts += [shared + " " + base(80) for _ in range(12)] + family(rng, shared + " " + base(20), 6, 2)
    rows = list(enumerate(texts))
    want = sorted(((d, c) for (d, _), c in zip(rows, plain_classes(rows))), key=str)
    assert classes(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_chain_is_one_class(spark):
    """Each text is near the next alone: linked by components, whatever the pivot."""
    words = [f"c{i}" for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words[15 * i:15 * i + 15] = [f"d{i}x{k}" for k in range(15)]
    assert {c for _, c in classes(spark.createDataFrame(rows, "doc_id long, text string"))} == {0}


def test_aligned_is_the_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(300):
        a = family(rng, " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(5, 60))), 1, 0)[0]
        b = family(rng, a, 1, 3)[0]
        if rng.random() < 0.3:
            b = " ".join(b.split()[7:] + b.split()[:7])  # moved: the same shingles in another order
        x, y = ordermin.labelled_shingles(pa.array([a, b]))
        if len(x) and len(y):
            k = common(labelled(a), labelled(b))
            assert ordermin.aligned(x, y) == (5 * k >= 4 * (len(x) + len(y) - k))


def repeated_lines(rng):
    """A text of repeated lines, and the same with a few words changed."""
    lines = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(1, 22))) for _ in range(rng.randrange(1, 4))]
    a = " ".join(rng.choice(lines) for _ in range(rng.randrange(2, 16)))
    return a, family(rng, a, 1, 3)[0]


@pytest.mark.parametrize("many", [0, 2, 16])
def test_aligned_with_repeated_shingles(monkeypatch, many):
    monkeypatch.setattr(ordermin, "MANY_PLACES", many)  # 0: all by bits
    rng = random.Random(16)
    near = 0
    for _ in range(250):
        a, b = repeated_lines(rng)
        (x, y), _ = ordermin.plain_and_labelled(pa.array([a, b]))
        k = common(x.tolist(), y.tolist())
        assert ordermin.aligned(x, y) == (5 * k >= 4 * (len(x) + len(y) - k))
        assert not len(x) or not len(y) or ordermin.common_by_bits(*np.split(np.unique(np.r_[x, y], return_inverse=True)[1], [len(x)])) == k
        near += 5 * k >= 4 * (len(x) + len(y) - k)
    assert 50 < near < 250


def test_repeated_line_with_one_word_changed(spark):
    """Labels shift behind the changed copy, the texts stay near."""
    line = " ".join(f"w{i}" for i in range(20))
    texts = [" ".join([line] * 10), " ".join([line.replace("w9 ", "x "), *[line] * 9])]
    texts += [" ".join(f"v{i}" for i in range(200))]
    assert classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")) == [(0, 0), (1, 0), (2, 2)]


def test_overlaps():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(1, 40))) for _ in range(30)]
    got = ordermin.overlaps(ordermin.labelled_shingles(pa.array(texts)))
    sets = [set(labelled(t)) for t in texts]
    assert all(got[i, j] == len(sets[i] & sets[j]) for i in range(30) for j in range(30) if i != j)


@pytest.mark.parametrize("n", [4, 5, 6, 8, 12, 15, 30, 300])
def test_similar_texts_share_a_key(n):
    rng = np.random.default_rng(n)
    missed = 0
    for _ in range(200):
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.delete(a, rng.choice(n, n // 5, replace=False))
        missed += not set(ordermin.bucket_keys(a)) & set(ordermin.bucket_keys(b))
    assert missed <= 2


def test_link_compares_sides_and_components():
    t = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(0, b"1", b"1", t), (1, b"2", b"2", t + " end"), (1, b"3", b"2", t + " fin"), (1, b"4", b"4", "other words that are not near to it at all")]
    group = pd.DataFrame(rows, columns=["side", "node", "comp", "text"])
    assert len(ordermin.link(group)) == 1
    group["side"] = 1
    assert len(ordermin.link(group)) == 1
    group["comp"] = b"9"
    assert ordermin.link(group) == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (200, 200), (100, 102)] + [(300, 300 + i) for i in range(1, 50)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, **{300 + i: 300 for i in range(50)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    got = classes(odd_docs)
    assert got.count((4, 4)) == 2 and (5, 4) in got and (1, 1) in got and (2, 1) in got and len(got) == odd_docs.count()
    kept = ordermin.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 3, 4, 6, 7, 8, None], key=str)
    assert classes(no_docs) == [] and ordermin.one_of_each(no_docs).count() == 0
