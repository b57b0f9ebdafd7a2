"""Operator 7: benchmark decontamination by a distributed positional inverted index.

The words of the training documents are counted for the benchmark's terms; each benchmark window then names its
rarest terms.  Of those terms the postings (term, document, position) are stored, with the words around the position
for terms that are the rarest of a window.  A window's occurrences are found from its rarest list: each posting less
the term's offset is a possible start; it stays if the list of the second rarest term holds the position that its
offset asks for; the words around confirm the phrase.  The same lists give proximity matches: the words around an
occurrence of the rarest term hold all words of the window within a span, in any order (``n_near_items``;
``proximity_matches`` for the places themselves).

Terms and windows are sent to all executors a block of ``BLOCK`` windows at a time, so what is broadcast has a fixed
bound; a larger benchmark takes more passes.  Documents are never shuffled as text.  DataFrame functions only.

Defined cases: null text has no words, and neither document nor item without words takes part in a match; a null
item_id counts as the empty id; repeated item_ids count once; rows of equal doc_id are told apart by their text, and
repeated rows get equal results; an empty table on either side gives no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentalytics.llm.common import keep

WIDTH = 13
#: Words within which a proximity match holds all words of a window: room for as many others among them.
SPAN = 2 * WIDTH
#: Windows whose terms are broadcast together: at most 13 words each.
BLOCK = 50_000
MIN_SHARE = 20  # contaminated if 20 * hit words >= words
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """A-Z in lower case, cut at ASCII characters other than digits and letters."""
    ascii_only = F.octet_length(text) == F.length(text)
    lower = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(lower, NOT_WORD), ""), F.array().cast("array<string>"))


def document_words(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), words_of(F.col("text")).alias("words"))


def benchmark_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """item_id, window (its words) of every window of every item; an item of fewer words is one window."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words"))
    last = F.greatest(F.size("words") - width, F.lit(0))
    return (words.where(F.size("words") > 0).withColumn("at", F.explode(F.sequence(F.lit(0), last)))
            .select("item_id", F.slice("words", F.col("at") + 1, F.lit(width)).alias("window")).distinct())


def term_counts(words: DataFrame, terms: DataFrame) -> DataFrame:
    """How often each of the terms comes in all documents; terms that never come have no row."""
    return (words.select(F.explode("words").alias("term")).join(F.broadcast(terms), "term")
            .groupBy("term").agg(F.count("*").alias("n")))


def anchored(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, with their rarest and second rarest term and the offsets of those."""
    # counts of a block's terms: at most 13 * BLOCK rows
    each = windows.select("window", F.posexplode("window").alias("at", "term")).join(F.broadcast(counts), "term", "left")
    ranked = each.groupBy("window").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term", "at"))).alias("rare"))  # a window's words
    return ranked.where(F.col("rare")[0]["n"] > 0).select(
        "window", F.col("rare")[0]["term"].alias("term"), F.col("rare")[0]["at"].alias("at"),
        F.get("rare", F.lit(1))["term"].alias("term2"), F.get("rare", F.lit(1))["at"].alias("at2"))


def postings(words: DataFrame, terms: DataFrame, around: int = 0) -> DataFrame:
    """term, doc_id, h, pos of every occurrence of the terms (term, full); where ``full``, also the words from
    ``around`` before to ``around`` after, as ``near``, which begins at word ``near_at``."""
    hits = words.select("doc_id", "h", "words", F.posexplode("words").alias("pos", "term")).join(F.broadcast(terms), "term")
    begin = F.greatest(F.col("pos") - around, F.lit(0))
    return hits.select("term", "doc_id", "h", "pos", begin.alias("near_at"),
                       F.when(F.col("full"), F.slice("words", begin + 1, F.col("pos") + around + 1 - begin)).alias("near"))


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """window, doc_id, h, start of each occurrence of ``phrases`` (as from ``anchored``) by the postings."""
    size = F.size("window")
    first = (index.where("near is not null").join(F.broadcast(phrases), "term").withColumn("start", F.col("pos") - F.col("at"))
             .where("start >= 0"))
    other = index.select(F.col("term").alias("term2"), "h", F.col("doc_id").alias("doc2"), F.col("pos").alias("pos2"))
    columns = ["window", "doc_id", "h", "start", "near", "near_at"]
    alone = first.where("term2 is null").select(columns)
    both = first.where("term2 is not null").withColumn("pos2", F.col("start") + F.col("at2")).alias("f").join(
        other.alias("o"), F.expr("f.term2 = o.term2 and f.h = o.h and f.pos2 = o.pos2 and f.doc_id <=> o.doc2"), "leftsemi").select(columns)
    whole = F.slice("near", F.col("start") - F.col("near_at") + 1, size) == F.col("window")
    return alone.unionByName(both).where((F.col("start") >= F.col("near_at")) & whole).select("window", "doc_id", "h", "start").distinct()


def all_within(window: Column, run: Column) -> Column:
    """Whether every word of the window is among the words of the run."""
    return F.size(F.array_except(window, run)) == 0


def near_candidates(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """Occurrences of a phrase's rarest term with all its words within reach, and ``starts``: the indices in ``near`` of
    the runs of ``span`` words that hold that occurrence and every word, whatever their order."""
    at = F.col("pos") - F.col("near_at")
    candidates = (index.where("near is not null").join(F.broadcast(phrases), "term")
                  .where((F.col("term2").isNull() | F.expr("array_contains(near, term2)")) & all_within(F.col("window"), F.col("near"))))
    first = F.greatest(at - (span - 1), F.lit(0))
    return candidates.withColumn("starts", F.filter(
        F.sequence(first, at), lambda i: all_within(F.col("window"), F.slice("near", i + 1, F.lit(span)))))


def near_documents(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """window, doc_id, h of the documents that hold every word of a window within ``span`` words."""
    return near_candidates(index, phrases, span).where("size(starts) > 0").select("window", "doc_id", "h").distinct()


def near_runs(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """window, doc_id, h, start, end of every run that begins and ends with a word of the window."""
    runs = near_candidates(index, phrases, span).withColumn("i", F.explode("starts")).where(
        F.expr("array_contains(window, near[i])"))
    run = F.slice("near", F.col("i") + 1, F.lit(span))
    last = F.array_max(F.transform("window", lambda w: F.array_position(run, w)))
    return runs.select("window", "doc_id", "h", (F.col("near_at") + F.col("i")).alias("start"),
                       (F.col("near_at") + F.col("i") + last - 1).cast("int").alias("end")).distinct()


def proximity_matches(docs: DataFrame, phrases: DataFrame, span: int, block: int = BLOCK) -> DataFrame:
    """phrase_id, doc_id, h, start, end: places where a run of at most ``span`` words holds every distinct word of a
    phrase (phrase_id, text), whatever their order.  Every occurrence of one of its words that begins such a run
    gives a row, with the least end.  Runs are found round the occurrences of the phrase's rarest word, in the words
    that are stored around it.  A phrase of more than ``span`` distinct words has none."""
    asked = keep(phrases.select("phrase_id", F.array_sort(F.array_distinct(words_of(F.col("text")))).alias("window"))
                 .where(F.size("window").between(1, span)), "proximity-phrases")
    found = None
    for index, some in indexed(docs, asked.select("window").distinct(), span, block):
        runs = near_runs(index, some, span)
        found = runs if found is None else found.unionByName(runs)
    return found.join(asked, "window").select("phrase_id", "doc_id", "h", "start", "end")


def indexed(docs: DataFrame, windows: DataFrame, reach: int, block: int) -> Iterator[tuple[DataFrame, DataFrame]]:
    """The postings for each block of the distinct ``windows``, with ``reach`` - 1 words on both sides of a rarest
    term, and the windows all of whose terms occur."""
    words = document_words(docs)
    blocks = max(1, -(-windows.count() // block))
    for b in range(blocks):
        some = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == b)
        counts = term_counts(words, some.select(F.explode("window").alias("term")).distinct())
        phrases = keep(anchored(some, counts), "decontam-phrases")
        terms = (phrases.select("term", F.lit(True).alias("full")).unionByName(phrases.where("term2 is not null").select(F.col("term2").alias("term"), F.lit(False).alias("full")))
                 .groupBy("term").agg(F.max("full").alias("full")))
        yield keep(postings(words, terms, reach - 1), "decontam-postings"), phrases


def window_matches(docs: DataFrame, windows: DataFrame, width: int = WIDTH, span: int | None = None, block: int = BLOCK) -> tuple[DataFrame, DataFrame | None]:
    """Of the distinct ``windows`` of at most ``width`` words: window, doc_id, h, start of every occurrence in the
    documents; and with a ``span`` window, doc_id, h of the documents with all its words within that many words."""
    exact = near = None
    for index, phrases in indexed(docs, windows, max(width, span or 0), block):
        here = phrase_matches(index, phrases)
        exact = here if exact is None else exact.unionByName(here)
        if span:
            around = near_documents(index, phrases, span)
            near = around if near is None else near.unionByName(around)
    return exact, near


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, span: int | None = None) -> DataFrame:
    """A row for each document: doc_id, h (hash of its text), n_words, n_hit, n_items, items_sha256, contaminated; and
    with a ``span`` also n_near_items, the items of which it holds all words of a window within that many words."""
    windows = keep(benchmark_windows(items, width), "decontam-windows")
    exact, near = window_matches(docs, windows.select("window").distinct(), width, span)
    matches = keep(exact, "decontam-matches")
    covered = matches.select("doc_id", "h", F.explode(F.sequence("start", F.col("start") + F.size("window") - 1)).alias("pos")).distinct()
    hits = covered.groupBy("doc_id", "h").agg(F.count("*").alias("n_hit"))
    named = matches.join(windows, "window").select("doc_id", "h", "item_id").distinct()
    by_doc = named.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("item_id")).alias("ids"))  # no more than the text holds
    found = hits.alias("x").join(by_doc.alias("y"), F.expr("x.doc_id <=> y.doc_id and x.h = y.h")).select(
        F.col("x.doc_id").alias("hit_id"), F.col("x.h").alias("hit_h"), "n_hit", "ids")
    each = document_words(docs).select("doc_id", "h", F.size("words").cast("long").alias("n_words"))
    joined = each.join(found, F.expr("doc_id <=> hit_id and h = hit_h"), "left")
    n_hit, none = F.coalesce("n_hit", F.lit(0)), F.array().cast("array<string>")
    ids = F.coalesce("ids", none)
    columns = [
        "doc_id", "h", "n_words", n_hit.cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((n_hit > 0) & (MIN_SHARE * n_hit >= F.col("n_words"))).alias("contaminated")]
    if span is None:
        return joined.select(columns)
    about = (near.join(windows, "window").select("doc_id", "h", "item_id").distinct().groupBy("doc_id", "h").agg(F.count("*").alias("n_near"))
             .select(F.col("doc_id").alias("near_id"), F.col("h").alias("near_h"), "n_near"))
    return joined.join(about, F.expr("doc_id <=> near_id and h = near_h"), "left").select(
        *columns, F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near_items"))
