"""Operator 7 against a plain search, and the rules' and decontamination's DuckDB text."""

import hashlib
import random
import re

import duckdb
import pytest

from rentalytics.llm import decontam
from rentalytics.llm import queries as Q

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(decontam.UPPER, decontam.LOWER)))


def plain(docs, items, width=13):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add(str(item_id) if item_id is not None else "")
    out = []
    for doc_id, text in docs:
        w, hit, named = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if ids := windows.get(tuple(w[i:i + size])):
                    hit.update(range(i, i + size))
                    named |= ids
        out.append((doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, term string")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, words int")
    return sorted(map(tuple, decontam.contamination(d, b).drop("h").collect()), key=str)


def cases():
    rng = random.Random(4)
    text = lambda n, k=40: " ".join(rng.choice(["Éa", "b", "the", "C3", "d-e", "日本"] + [f"w{i}" for i in range(k)]) for _ in range(n))
    items = [(i, text(rng.randrange(1, 40))) for i in range(12)] + [(None, "null id item"), (50, None), (51, ""), (3, "the the the the the the the the the the the the the the"), (52, "b")]
    docs = [(i, text(rng.randrange(0, 60)) + " " + (rng.choice(items)[1] or "") + "! " + text(5)) for i in range(60)]
    docs += [(None, docs[0][1]), (None, None), (7, docs[3][1]), (7, docs[3][1]), (100, ""), (101, "the " * 3000), (102, text(5000)), (103, items[0][1])]
    return docs, items


def test_equals_plain_search(spark):
    docs, items = cases()
    assert run(spark, docs, items) == plain(docs, items)


def test_blocks_of_windows_change_nothing(spark, monkeypatch):
    docs, items = cases()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    windows = decontam.benchmark_windows(spark.createDataFrame(items, "item_id long, text string")).select("window").distinct()
    key = lambda r: str(tuple(r))
    for whole, cut in zip(decontam.window_matches(d, windows, span=20), decontam.window_matches(d, windows, span=20, block=40)):
        assert sorted(whole.collect(), key=key) == sorted(cut.collect(), key=key)


def test_empty_sides(spark):
    docs, items = cases()
    assert run(spark, [], items) == []
    assert all(r[2] == 0 and not r[5] for r in run(spark, docs, []))


def test_odd_rows(spark, odd_docs):
    items = spark.createDataFrame([(1, "one two"), (2, None)], "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in decontam.contamination(odd_docs, items).collect()}
    assert {(4, 2, 2, True), (5, 2, 2, True), (1, 0, 0, False), (7, 1, 0, False)} <= got


def test_proximity(spark):
    docs = [(1, "alpha x x beta gamma"), (2, "gamma beta y alpha"), (3, "alpha " + "x " * 50 + "beta gamma"), (4, "alpha beta"), (5, None), (None, "beta Alpha GAMMA")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    p = spark.createDataFrame([(9, "alpha beta gamma"), (10, "zzz alpha"), (11, None)], "phrase_id long, text string")
    got = {(r.phrase_id, r.doc_id, r.start, r.end) for r in decontam.proximity_matches(d, p, 5).collect()}
    assert got == {(9, 1, 0, 4), (9, 2, 0, 3), (9, None, 0, 2)}


def plain_runs(docs, phrases, span):
    out = set()
    for doc_id, text in docs:
        w = words(text)
        for phrase_id, phrase in phrases:
            asked = set(words(phrase))
            for i in range(len(w)):
                for j in range(i, min(i + span, len(w))):
                    if w[i] in asked and asked <= set(w[i:j + 1]):
                        out.add((phrase_id, doc_id, i, j))
                        break
    return out


def test_proximity_equals_plain_search(spark):
    rng = random.Random(7)
    far = ["x"] * 20
    far[10], far[5], far[16], far[17] = "rare", "b", "b", "c"  # the nearest b is in no run, the other one is
    docs = [(i, " ".join(rng.choices(["a", "b", "c", "rare", "x", "y"], [5, 5, 3, 1, 4, 4], k=rng.randrange(0, 80)))) for i in range(30)]
    docs += [(100, " ".join(far)), (101, "b " * 30 + "rare"), (None, "c rare b")]
    phrases = [(1, "rare b c"), (2, "a b a"), (3, "x"), (4, "a b c rare y"), (5, "rare none"), (6, "")]
    d, p = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(phrases, "phrase_id long, text string")
    for span in (3, 8):
        want = plain_runs(docs, phrases, span)
        assert {(r.phrase_id, r.doc_id, r.start, r.end) for r in decontam.proximity_matches(d, p, span).collect()} == want
    assert (1, 100, 10, 17) in want


def test_near_items_equal_plain_search(spark):
    rng = random.Random(9)
    docs, items = cases()
    docs = docs[:40] + docs[60:]
    for i in range(8):  # an item's words in another order, with others among them
        w = words(items[i][1])[:13] + ["other"] * rng.randrange(0, 16)
        rng.shuffle(w)
        docs.append((200 + i, " ".join(w)))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    sets = {}
    for item_id, text in items:
        w = words(text)
        for i in range(max(len(w) - 12, 1) if w else 0):
            sets.setdefault(frozenset(w[i:i + 13]), set()).add(str(item_id) if item_id is not None else "")
    for span in (13, 26):
        want = []
        for doc_id, text in docs:
            w = words(text)
            runs = {frozenset(w[i:i + span]) for i in range(max(len(w) - span + 1, 1))}
            want.append((doc_id, len(set().union(*(ids for s, ids in sets.items() if any(s <= r for r in runs))))))
        got = decontam.contamination(d, b, span=span)
        assert sorted(((r.doc_id, r.n_near_items) for r in got.collect()), key=str) == sorted(want, key=str)
        assert all(r.n_near_items >= r.n_items for r in got.collect())
    assert any(r.n_near_items > r.n_items for r in got.collect())


def test_more_distinct_words_than_the_span(spark):
    d = spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")
    p = spark.createDataFrame([(1, "a b c d"), (None, "d c c")], "phrase_id long, text string")
    assert [tuple(r)[:2] for r in decontam.proximity_matches(d, p, 3).drop("h").collect()] == [(None, 1)]


@pytest.mark.parametrize("name", ["op7_decontamination"])
def test_oracle(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    got = Q.QUERIES[name](spark, d)
    want = con.sql(Q.ORACLE_SQL[name])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
