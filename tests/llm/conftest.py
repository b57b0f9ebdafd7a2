import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    rng = random.Random(5)
    rows = [
        (1, None, None, None, None), (None, "alpha beta gamma delta epsilon zeta", "en", "s", 35), (2, "", "en", None, 0),
        (3, "   \n\t ", None, "s", 6), (4, "One two.", "en", "s", 8), (4, "One two.", "en", "s", 8), (5, "One two.", "de", "t", 8),
        (6, sentence(rng, 30_000), "en", "s", 1), (7, "x" * 50_000, "en", "s", 1), (None, None, None, None, None),
        (8, "Ünïcode – 日本語 テキスト mit Wörtern, 12.5% & mail a.b@c.de +1 (555) 123-4567", "de", "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F
    extras = {c: F.lit(i) for i, c in enumerate(["node", "n", "h", "key", "keep", "score", "words", "part", "rank", "label", "size", "pos", "term", "window"])}
    return df.withColumns(extras)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
