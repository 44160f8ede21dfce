"""The corpus pipeline, stage by stage, on the smallest tables."""

import corpus_pipeline
from peerrank.llm.common import read_table, written

SF = "/root/testdata/sf0.001"


def test_each_stage_works_on_what_the_one_before_it_kept(spark):
    docs = read_table(spark, SF, "documents")
    columns, left = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns, name
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept and kept <= left, name
        left = kept
    size = docs.count()
    name, stage = corpus_pipeline.STAGES[-1]
    rows = stage(spark, docs, SF).orderBy("start").collect()
    assert len(rows) == size and [r.doc_id for r in rows] == sorted(r.doc_id for r in rows)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens >= 1
        at += r.n_tokens
