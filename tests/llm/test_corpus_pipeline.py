"""The pipeline: every stage's decisions against the operators' own results."""

import numpy as np
import pytest

import corpus_pipeline as P
from rentalytics.llm import decontam, ordermin, pii, quality
from rentalytics.llm.common import keep, table
from rentalytics.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [table(spark, SF, "documents")]
    for _, stage in P.STAGES:
        docs.append(keep(stage(spark, docs[-1], SF), "test-stage"))
    return docs


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[1:-1])


def test_quality(spark, steps):
    kept = quality.score(steps[0], quality.fit(steps[0], table(spark, SF, "labels")), ["doc_id"]).where("keep")
    assert ids(steps[1]) == ids(kept) and 0.6 * steps[0].count() < len(ids(kept)) < steps[0].count()


def test_one_of_each_class(steps):
    classes = ordermin.near_duplicates(steps[1])
    assert ids(steps[2]) == sorted({r.class_id for r in classes.collect()})


def test_contaminated_go(spark, steps):
    judged = decontam.contamination(steps[2], table(spark, SF, "benchmark")).collect()
    assert ids(steps[3]) == sorted(r.doc_id for r in judged if not r.contaminated)


def test_masked(steps):
    before = {r.doc_id: r.text for r in steps[3].collect()}
    for r in steps[4].collect():
        assert not pii.base_spans(r.text) or len(pii.base_spans(r.text)) < len(pii.base_spans(before[r.doc_id]))
        if not pii.TRIGGER.search(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_packed(steps):
    tokens = sum(r.doc_tokens for r in steps[5].select("doc_id", "doc_tokens").distinct().collect())
    pieces = steps[5].collect()
    assert sum(p.length for p in pieces) == tokens and {p.doc_id for p in pieces} == set(ids(steps[4]))
    by = {}
    for p in pieces:
        by[p.sequence_id] = by.get(p.sequence_id, 0) + p.length
    assert max(by.values()) <= 2048 and sum(v == 2048 for v in by.values()) >= len(by) - 11
    assert all(len(np.frombuffer(p.ids, "<u4")) == p.length for p in pieces)


def test_odd_rows(spark, odd_docs):
    """Every stage takes nulls, repeated rows and clashing names."""
    docs = odd_docs
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == odd_docs.columns, name
        docs = keep(docs, "test-odd")
    assert P.packing_stage(spark, docs, SF).count() >= docs.count() > 0
    empty = odd_docs.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_registered():
    import __spark_entry__ as E
    assert "pipeline" in E.queries() and set(QUERIES) <= set(E.queries())
    assert [int(n.split("_")[0][2:]) for n in sorted(QUERIES, key=lambda n: int(n.split("_")[0][2:]))] == list(range(1, 14))
