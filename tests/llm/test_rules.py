"""Operator 10: counts against a plain count, and the risk control."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from rentalytics.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))



LABELS = "doc_id long, quality int, toxic int"


def test_counts_equal_plain_counts(spark, odd_docs):
    rng = random.Random(3)
    def text():
        lines = [" ".join(rng.choice(["a", "b", "#c", "<d>", "é|", "\x0be"]) for _ in range(rng.randrange(0, 14))) for _ in range(rng.randrange(0, 8))]
        return "\n".join(lines + rng.choices(lines, k=rng.randrange(0, 5)) if lines else lines)
    rows = [(1000 + i, text()) for i in range(400)] + [(2000, "a " * 5000), (2001, "x y z q r s t u " * 2), (2002, "\n\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "lines": F.lit(1), "hashes": F.lit(2), "rule": F.lit("x")})
    docs = docs.unionByName(odd_docs.select("doc_id", "text", "lang"), allowMissingColumns=True)
    labels = spark.createDataFrame([], LABELS)
    got = rules.judge(docs, labels).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted(([r.doc_id, *(r[c] for c in columns)] for r in got), key=str) == \
        sorted(([r.doc_id, *plain(r.text)] for r in docs.select("doc_id", "text").collect()), key=str)
    assert all(r.kept != r.base_failed for r in got)  # without labels no rule is safe


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (50, 3, 0.2), (2000, 1, 0.005), (100_000, 90, 0.001), (1_000_000, 4000, 0.0045), (20, 19, 0.5)])
def test_binomial_tail(spark, n, k, p):
    got = spark.range(1).select(rules.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    if k >= n * p:
        assert got == 1.0
        return
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    assert got == pytest.approx(math.fsum(map(math.exp, log)), rel=1e-6)


def test_safe_cutoffs_reject_junk_alone(spark):
    good = [(i, f"g{i} " * 3 + "some plain words that make a text of more than twenty words so that the base keeps it as it is here", "en") for i in range(4000)]
    junk = [(10_000 + i, " ".join(f"w{i}x{k}***" for k in range(25)), "en") for i in range(50)]
    rare = [(20_000 + i, " ".join(f"w{i}x{k}***" for k in range(25)), "xx") for i in range(5)]
    docs = spark.createDataFrame(good + junk + rare, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(4000)] + [(10_000 + i, 0, 0) for i in range(50)] + [(10_000, 0, 0), (None, 1, 0), (5, None, 0)], LABELS)
    got = {r.doc_id: r for r in rules.judge(docs, labels).collect()}
    assert all(got[i].kept for i in range(4000))
    assert not any(got[10_000 + i].kept for i in range(50)) and "symbols" in got[10_000].failed_rules
    assert all(got[20_000 + i].kept for i in range(5))  # no labels of that stratum


def test_cutoffs_hold_the_risk(spark):
    """With 1 in 60 good documents full of symbols, no cutoff that rejects them is safe."""
    rows = [(i, ("*** " if i % 60 == 0 else "") * 40 + f"plain words {i} " * 12, "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cutoffs = rules.safe_cutoffs(rules.text_features(docs), docs.select("doc_id", F.lit(1).alias("quality")), risk=0.02)
    safe = {r.rule: r for r in cutoffs.collect()}
    assert "symbols" not in safe or all(r.k == 0 for r in safe.values())


def labelled_texts(spark, lang, n, bad=0):
    words = "some plain words that make a text of more than twenty words so that the base keeps it as it is here"
    rows = [(i, ("*** " * 40 if i < bad else "") + f"g{i} {words}", lang) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_labels_needed_are_enough(spark):
    """Cutoffs of a rule are tested in a fixed order, with no correction over them."""
    need = rules.labels_needed(1)
    assert need < 1500
    for n, some in ((need, True), (need - 1, False)):
        docs = labelled_texts(spark, "en", n)
        cutoffs = rules.safe_cutoffs(rules.text_features(docs), docs.select("doc_id", F.lit(1).alias("quality"))).collect()
        assert {r.rule for r in cutoffs} == (set(rules.RULES) if some else set())


def test_cutoffs_stop_at_the_first_failure(spark):
    docs = labelled_texts(spark, "en", 1500, bad=40)
    cutoffs = {r.rule: r for r in rules.safe_cutoffs(rules.text_features(docs), docs.select("doc_id", F.lit(1).alias("quality"))).collect()}
    # "***" in 40 of about 60 words: two symbols a word, which the cutoff 1.5 and stricter ones reject
    assert cutoffs["symbols"].cut == rules.RULES["symbols"][1].index(2.0) + 1 and cutoffs["symbols"].k == 0


def test_nothing(no_docs, spark):
    assert rules.judge(no_docs, spark.createDataFrame([], LABELS)).count() == 0
