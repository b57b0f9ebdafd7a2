"""Vector codes: active-entry Lloyd against whole scans in plain numpy, and odd rows."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rentalytics.llm import codes
from rentalytics.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=4, entries=256):
    """Whole scans in every round."""
    ok = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) for c in r[1]] for r in ok], dtype=np.int64)
    w = x.shape[1]
    cut = [w * p // 4 for p in range(5)]
    books = [x[:entries, a:b].copy() for a, b in zip(cut, cut[1:])]

    def assign():
        d = [((x[:, None, cut[p]:cut[p + 1]] - books[p][None]) ** 2).sum(2) for p in range(4)]
        return np.stack([e.argmin(1) for e in d], 1), np.stack([e.min(1) for e in d], 1)
    for _ in range(rounds):
        code, _ = assign()
        for p in range(4):
            for e in range(len(books[p])):
                mine = x[code[:, p] == e, cut[p]:cut[p + 1]]
                if len(mine):
                    books[p][e] = mine.sum(0) // len(mine)
    code, far = assign()
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    error = far.sum(1)
    by = {}
    for r, e in zip(ok, error):
        by[r[2]] = by.get(r[2], 0) + int(e)
    return sorted((r[0], "".join(f"{c:02x}" for c in cs), int(e), by[r[2]], sha) for r, cs, e in zip(ok, code.tolist(), error))


def got(df):
    return sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in codes.compress(df).collect())


def clustered(rng, n, width, spread=0.05):
    centres = rng.normal(size=(40, width)).astype(np.float32)
    return [(int(i), (centres[i % 40] + rng.normal(scale=spread, size=width)).astype(np.float32).tolist(), None if i % 7 == 0 else int(i % 5))
            for i in rng.permutation(n)]


@pytest.mark.parametrize("width", [16, 10, 3])
def test_equals_whole_scans(spark, width):
    rows = clustered(np.random.default_rng(width), 900, width)
    rows += [(5000 + i, rows[0][1], 1) for i in range(300)]  # one vector a quarter of all
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == plain(rows)


def test_given_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    assert got(df) == plain([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])


def test_coarse_values_tie(spark):
    """Few distinct integers: many equal distances, of which the lowest index wins."""
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2, 3, 8) / 1024).tolist(), None) for i in range(1500)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)


def test_active_entries_are_fewer(spark):
    trace = []
    codes.train(spark.createDataFrame(clustered(np.random.default_rng(1), 3000, 8, 0.001), SCHEMA), trace=trace)
    assert trace[0] == 3000 * 4 * 256 and trace[-1] < trace[0] / 2


def test_reassign_against_scan():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x, old = rng.integers(-3, 4, (60, 3)), rng.integers(-3, 4, (9, 3))
        code, far = codes.nearest(x, old)
        new = np.where(rng.random((9, 1)) < 0.4, rng.integers(-3, 4, (9, 3)), old)
        a, b, _ = codes.reassign(x, new, (new != old).any(axis=1), code, far)
        c, d = codes.nearest(x, new)
        assert (a == c).all() and (b == d).all()


def test_large_numbers_are_exact():
    x = np.array([[codes.FAR, -codes.FAR, 3], [1, 2, 3]], dtype=np.int64)
    e = np.array([[-codes.FAR, codes.FAR, 5], [codes.FAR, -codes.FAR, 3]], dtype=np.int64)
    assert codes.distances(x, e).tolist() == [[sum((int(p) - int(q)) ** 2 for p, q in zip(r, s)) for s in e] for r in x]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(None, [0.5, 0.25, 0.0, -0.1], 1), (3, [0.1, 0.2, 0.3, 0.4], None), (3, [0.1, 0.2, 0.3, 0.4], None), (2, [-0.0, 0.0, 1e30, -1e30], 2),
            (9, [1.0, 2.0, 3.0, 4.0], 2)]
    bad = [(1, None, 1), (4, [0.1, None, 0.3, 0.4], 1), (5, [nan, 0.0, 0.0, 0.0], 1), (6, [0.0, inf, 0.0, 0.0], 1), (7, [0.0, -inf, 0.0, 0.0], 1),
           (8, [0.5], 1), (10, [], 1)]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({c: F.lit(1) for c in ["code", "error", "codes", "n", "salt", "entry", "scanned"]})
    found = codes.compress(df).collect()
    assert sorted(r.vec_id or 0 for r in found) == [0, 2, 3, 3, 9] and all(r.error == 0 for r in found if r.vec_id != 2)
    assert codes.compress(df.where("vec_id = 1")).count() == 0
    assert codes.compress(df.limit(0)).columns == codes.compress(df).columns


def test_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", 2)
    rows = clustered(np.random.default_rng(8), 400, 8)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == plain(rows)
