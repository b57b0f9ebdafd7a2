"""Operator 10: quality rules whose thresholds are set under risk control.

Every rule is a score that is worse when higher, with a fixed grid of cutoffs.  For each stratum (language), rule and
cutoff, the labelled good documents are a holdout: n of them, of which the rule would reject k.  The cutoff is safe
if the exact (Clopper-Pearson) upper bound of its false rejection rate is at most ``risk / number of rules``, at a
confidence of 1 - delta / (strata * rules) (Bonferroni), and all laxer cutoffs of the rule are safe too: tested in this
fixed order up to the first failure, the cutoffs of a rule need no correction among themselves.  With probability
1 - delta, no stratum loses more than ``risk`` of its good documents to all rules together.  Each rule uses its strictest
safe cutoff in a stratum, and none where no cutoff is safe: ``labels_needed`` good labels let a cutoff pass that rejects
none of them.

DataFrame functions only.  A document's windows of eight words are hashed by doubling (pairs, fours, eights); only a
text with equal hashes has its windows compared as text.

Defined cases: null text has no words and fails the base; a null language is a stratum of its own; a doc_id with
several labels is good only if all say so, and null doc_ids are unlabelled; repeated rows are judged alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentalytics.llm.common import keep

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
RISK, DELTA = 0.02, 0.05
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

#: Score of each rule and its cutoffs, from lax to strict.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1]),
    "repeats": ("n_repeat_words / n_words", [0.25, 0.2, 0.15, 0.1, 0.05]),
    "dup_lines": ("n_dup_lines / n_lines", [0.8, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "long_words": ("word_chars / n_words", [40.0, 25.0, 18.0, 14.0, 12.0, 10.0, 9.0, 8.0]),
    "upper": ("n_upper / word_chars", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]),
    "exclaims": ("n_exclaims / n_words", [2.0, 1.5, 1.0, 0.7, 0.5, 0.3, 0.2, 0.1]),
}


def removed(text: Column, chars: str) -> Column:
    """How many of these characters a text has."""
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def neighbours(a: Column, distance: int, how) -> Column:
    """``how`` of each element and the one ``distance`` behind it."""
    n = F.greatest(F.size(a) - distance, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(distance + 1), n), how)


def text_features(docs: DataFrame) -> DataFrame:
    """doc_id, lang and the counts that base and rules are made of, without a shuffle."""
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"), removed(text, SYMBOLS).alias("n_symbols"),
        removed(text, UPPER).alias("n_upper"), removed(text, "!").alias("n_exclaims"), lines.alias("lines"))
    df = df.withColumns({
        "n_words": F.size("words").cast("long"), "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "hashes": F.transform("words", lambda w: F.xxhash64(w))}).drop("lines")
    for distance in (1, 2, 4):  # hashes of 2, 4 and 8 words
        df = df.withColumn("hashes", neighbours(F.col("hashes"), distance, lambda a, b: F.xxhash64(a, b)))
    # only where a hash comes again are the words themselves looked at
    df = df.withColumn("spelled", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.col("words"))
                       .otherwise(F.array().cast("array<string>"))).drop("words", "hashes")
    for distance in (1, 2, 4):
        df = df.withColumn("spelled", neighbours(F.col("spelled"), distance, lambda a, b: F.concat_ws(" ", a, b)))
    df = df.withColumn("sorted", F.array_sort(F.transform("spelled", lambda w, i: F.struct(w.alias("w"), i.alias("at"))))).drop("spelled")
    df = df.withColumn("same", neighbours(F.col("sorted"), 1, lambda a, b: a["w"] == b["w"]))
    no = F.array(F.lit(False))
    twice = F.zip_with(F.concat(no, "same"), F.concat("same", no), lambda a, b: a | b)
    df = df.withColumn("twice", twice).drop("same")
    at = F.zip_with("sorted", "twice", lambda s, t: F.when(t, s["at"]))
    df = df.withColumn("starts", F.array_sort(F.filter(at, lambda x: x.isNotNull()))).drop("sorted", "twice")
    covered = F.aggregate(neighbours(F.col("starts"), 1, lambda a, b: F.least(F.lit(WINDOW), b - a)), F.lit(0), lambda s, x: s + x)
    repeats = F.when(F.size("starts") > 0, covered + WINDOW).otherwise(0).cast("long")
    return df.withColumn("n_repeat_words", repeats).drop("starts")


def log_gamma(z: Column) -> Column:
    """ln of the gamma function for z >= 1, by Stirling's series at z + 8."""
    x = z + 8.0
    series = 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5) - 1 / (1680 * x ** 7)
    shift = F.ln(z)
    for i in range(1, 8):
        shift = shift + F.ln(z + float(i))
    return (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + series - shift


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), for k below the mean; 1 from the mean on.

    Terms are summed downwards from k, relative to the k-th; past 4000 terms the rest is bounded by a geometric
    series, so the value is never too low.
    """
    k, n, odds = k.cast("double"), n.cast("double"), (1 - p) / p
    first = log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    steps = F.sequence(F.lit(0), F.least(k, F.lit(4000.0)).cast("int"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    sums = F.aggregate(steps, start, lambda s, i: F.struct(
        (s["term"] * (k - i) / (n - k + i + 1) * odds).alias("term"), (s["total"] + s["term"]).alias("total")))
    ratio = k / (n - k + 1) * odds
    tail = F.exp(first) * (sums["total"] + sums["term"] / (1 - ratio))
    return F.when(k >= n * p, 1.0).otherwise(F.least(F.lit(1.0), tail))


def labels_needed(strata: int, risk: float = RISK, delta: float = DELTA) -> int:
    """Labelled good documents of a stratum from which on a cutoff that rejects none of them is safe."""
    return math.ceil(math.log(delta / (strata * len(RULES))) / math.log1p(-risk / len(RULES)))


def stratum() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("none"))


def rule_scores() -> Column:
    """The rules of a document: name, score, and at which cutoffs (from 1) it is rejected first."""
    def place(score: Column, cuts: list[float]) -> Column:
        # cutoffs fall, so those below the score are the last ones of the grid
        return F.lit(len(cuts) + 1) - F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < score))
    out = []
    for name, (score, cuts) in RULES.items():
        value = F.coalesce(F.expr(score.replace("/", "/ nullif(") + ", 0)").cast("double"), F.lit(0.0))
        out.append(F.struct(F.lit(name).alias("rule"), place(value, cuts).cast("int").alias("first_cut")))
    return F.array(*out)


def safe_cutoffs(features: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """stratum, rule, cut (its index from 1, the strictest safe one), n, k and p_value."""
    good = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id"))
    rows = features.select("doc_id", stratum().alias("stratum"), F.explode(rule_scores()).alias("r")).join(good, "doc_id")
    counts = keep(rows.groupBy("stratum", "r.rule", "r.first_cut").agg(F.count("*").alias("docs")), "rule-counts")
    grid = F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*(F.lit(len(c)) for _, c in RULES.values())))
    n = F.sum("docs").over(Window.partitionBy("stratum", "rule"))
    # k of a cutoff: documents that this cutoff or a laxer one rejects
    tests = (counts.withColumn("n", n).withColumn("cut", F.explode(F.sequence(F.col("first_cut"), grid[F.col("rule")] + 1)))
             .groupBy("stratum", "rule", "cut").agg(F.sum("docs").alias("k"), F.max("n").alias("n")))
    families = counts.select("stratum").distinct().count() * len(RULES)
    # a cutoff that rejects no good document has no row above: k is 0 there
    strata = counts.groupBy("stratum", "rule").agg(F.sum("docs").alias("n")).withColumn("cut", F.explode(F.sequence(F.lit(1), grid[F.col("rule")])))
    tests = (strata.join(tests.select("stratum", "rule", "cut", "k"), ["stratum", "rule", "cut"], "left")
             .withColumn("k", F.coalesce("k", F.lit(0))))
    tested = tests.withColumn("p_value", binomial_tail(F.col("k"), F.col("n"), risk / len(RULES)))
    # from lax to strict: a cutoff is safe if it and all laxer ones pass
    falling = Window.partitionBy("stratum", "rule").orderBy("cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = tested.withColumn("worst", F.max("p_value").over(falling)).where(F.col("worst") <= delta / max(families, 1))
    return (passed.groupBy("stratum", "rule")
            .agg(F.max(F.struct("cut", "n", "k", "p_value")).alias("best")).select("stratum", "rule", "best.*"))


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """Every document's counts, base_failed, kept, and the rules that reject it."""
    features = keep(text_features(docs), "rule-features")
    cutoffs = safe_cutoffs(features, labels, risk, delta).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cut"))).alias("cutoffs"))  # at most a row a rule
    failed = F.transform(F.filter(rule_scores(), lambda r: r["first_cut"] <= F.col("cutoffs")[r["rule"]]), lambda r: r["rule"])
    joined = features.withColumn("stratum", stratum()).join(cutoffs, "stratum", "left")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
                        F.coalesce(failed, F.array().cast("array<string>")).alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
