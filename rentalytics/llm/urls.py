"""Operator 4: URL filter by rules and gradient-boosted trees on lexical features.

A rule (verdict, host, path) fits its host and all subdomains where the URL's path starts with its path; the longest
fitting rule decides.  Other URLs are judged by boosted trees trained on a bounded sample of the URLs that the rules
label: length, depth, digits, entropy, parameters, labels and hyphens of the host, and how often the host's last
labels and the first path segment were blocked among the labelled URLs (smoothed; for a labelled URL among those of
other folds of hosts).

Defined cases: null URLs and those without ``://`` have empty host and path, fit no rule and go to the trees like any
other; if the labelled URLs are all of one verdict or none, the trees allow all; of rules of equal length the first
wins; repeated rows get equal verdicts; an empty table gives an empty result; only page_id and url are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import bounded_sample, keep

#: The production rules.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
TRAIN_ROWS, TREES, TREE_DEPTH, SMOOTH, THRESHOLD, FOLDS = 10_000, 12, 4, 20.0, 0.5, 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["length", "host_length", "depth", "digit_ratio", "entropy", "parameters", "host_labels", "hyphens",
            "suffix1_share", "suffix1_count", "suffix2_share", "suffix2_count", "segment_share", "segment_count"]


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(after_scheme(url), F.lit(""))
    return (F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), -rules.index(r))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def entropy(text: Column) -> Column:
    n = F.length(text)
    def part(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.ln(share)
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.coalesce(F.aggregate(F.transform(chars, part), F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def judged_by_rules(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, url, host, path, rule, rule_verdict, the parts that statistics are kept of, and the plain features."""
    host, path = host_path(F.col("url"))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    text = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return base.select(
        "page_id", "url", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"),
        F.substring_index("host", ".", -1).alias("suffix1"), F.substring_index("host", ".", -2).alias("suffix2"),
        F.regexp_extract("path", "^/([^/]*)/", 1).alias("segment"),
        F.length(text).cast("double").alias("length"), F.length("host").cast("double").alias("host_length"),
        F.size(F.filter(F.split("path", "/"), lambda s: s != "")).cast("double").alias("depth"),
        (F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1))).alias("digit_ratio"),
        entropy(text).alias("entropy"),
        F.size(F.filter(F.split(query, "&"), lambda s: s != "")).cast("double").alias("parameters"),
        F.size(F.filter(F.split("host", r"\."), lambda s: s != "")).cast("double").alias("host_labels"),
        (F.length("host") - F.length(F.replace("host", F.lit("-"), F.lit("")))).cast("double").alias("hyphens"))


def fold_of(host: Column) -> Column:
    return F.pmod(F.xxhash64(host), F.lit(FOLDS)).cast("int")


def with_statistics(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Join, for each part of a URL, the smoothed share of blocked labelled URLs that have it and their log count.  For a
    labelled URL those of its own fold of hosts don't count, so its shares know nothing of its own host's verdict."""
    blocked = F.sum((F.col("rule_verdict") == "block").cast("long"))
    prior = labelled.agg(F.coalesce(blocked / F.count("*"), F.lit(0.5))).first()[0]
    for part in ("suffix1", "suffix2", "segment"):
        own = keep(labelled.groupBy(part, "fold").agg(blocked.alias("own_blocked"), F.count("*").alias("own_n")), "url-shares")
        every = own.groupBy(part).agg(F.sum("own_blocked").alias("all_blocked"), F.sum("own_n").alias("all_n"))
        rows = rows.join(every, part, "left").join(own, [part, "fold"], "left")
        mine = F.col("rule_verdict").isNotNull()
        b, n = (F.coalesce(F.col(f"all_{c}"), F.lit(0)) - F.when(mine, F.coalesce(F.col(f"own_{c}"), F.lit(0))).otherwise(F.lit(0)) for c in ("blocked", "n"))
        rows = rows.withColumns({f"{part}_share": (b + SMOOTH * prior) / (n + SMOOTH), f"{part}_count": F.log1p(n)}).drop(
            "own_blocked", "own_n", "all_blocked", "all_n")
    return rows


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict (the rule's, else the trees') and p_block."""
    rows = keep(judged_by_rules(pages, rules).withColumn("fold", fold_of(F.col("host"))), "url-features")
    labelled = rows.where("rule_verdict is not null")
    full = with_statistics(rows, labelled)
    columns = ["page_id", "host", "path", "rule"]
    if labelled.select("rule_verdict").distinct().count() < 2:
        return full.select(*columns, F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"), F.lit(0.0).alias("p_block"))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    sample = bounded_sample(full.where("rule_verdict is not null"), "url", train_rows).select(*FEATURES, (F.col("rule_verdict") == "block").cast("double").alias("label"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.3, seed=7).fit(vectors.transform(keep(sample, "url-sample")))
    scored = trees.transform(vectors.transform(full)).withColumn("p_block", vector_to_array("probability")[1])
    verdict = F.coalesce("rule_verdict", F.when(F.col("p_block") >= THRESHOLD, "block").otherwise("allow"))
    return scored.select(*columns, verdict.alias("verdict"), "p_block")
