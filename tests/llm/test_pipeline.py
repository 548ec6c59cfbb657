"""The corpus pipeline: stage by stage against brute force."""

from __future__ import annotations

import corpus_pipeline
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_pii import plain as plain_spans
from tests.llm.test_simhash import plain_groups
from tripline.llm import simhash
from tripline.llm.common import table
from tripline.llm.queries import QUERIES
from tripline.sources.session import settle

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = settle(stage(spark, docs, SF), "test-stage")
        kept[name] = (before, docs)
        assert name == "packing" or docs.columns == columns

    before, after = kept["toxicity"]
    scores = {r.doc_id: r.score for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    assert {r.doc_id for r in after.collect()} == {
        r.doc_id for r in before.collect() if scores[r.doc_id] < 0.5}

    before, after = (x.collect() for x in kept["simhash"])
    groups = plain_groups([simhash.fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(
        min(before[i].doc_id for i in g) for g in groups)

    before, after = (x.collect() for x in kept["decontamination"])
    clean = {i for i, _, hit, _ in plain_hits([(r.doc_id, r.text) for r in before], items) if not hit}
    assert {r.doc_id for r in after} == clean

    before, after = ({r.doc_id: r for r in x.collect()} for x in kept["pii"])
    assert before.keys() == after.keys()
    for doc_id, row in before.items():
        if not plain_spans(row.text):
            assert after[doc_id] == row
        else:
            assert "[" in after[doc_id].text and after[doc_id].text != row.text

    before, after = (x.collect() for x in kept["packing"])
    assert {r.doc_id for r in after} == {r.doc_id for r in before}
    assert all(r.offset + r.length <= 2048 for r in after)


def test_no_document(spark, nothing):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), "test-stage")
    assert docs.count() == 0


def test_odd_documents(spark, edges):
    docs = edges
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, SF), "test-stage")
        assert name == "packing" or docs.columns == edges.columns
    assert docs.count() > 0
