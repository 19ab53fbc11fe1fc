"""The stages in order, and on edge cases."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, simhash


def test_run(spark):
    sf = "/root/testdata/sf0.01"
    docs = common.table(spark, sf, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.kept(stage(spark, docs, sf), name)
        kept.append(docs.count())
        if name != "token_ids":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_dedup":
            assert before.join(docs, "doc_id", "left_semi").count() == kept[-1] == simhash.groups(before).select("root").distinct().count()
        if name == "decontamination":
            assert decontaminate.search(before, common.table(spark, sf, "benchmark")).select("doc_id").distinct().count() == kept[-2] - kept[-1]
    assert docs.agg(F.max(F.col("start") + F.col("n_tokens")), F.sum("n_tokens")).first()[0] == docs.agg(F.sum("n_tokens")).first()[0]
    assert kept[0] > kept[1] > kept[2] and kept[3] == kept[4]


def test_run_leaves_its_result_and_the_token_files(spark):
    import os

    sf = "/root/testdata/sf0.001"
    before = common.made(spark)
    got = corpus_pipeline.run(spark, sf)
    new = [p for p in common.made(spark) if p not in before]
    assert sorted(os.path.basename(p).rsplit("-", 1)[0] for p in new) == ["ids", "pipeline-token_ids"]
    assert got.count() == got.select("start").distinct().count() > 0
    common.remove(spark, new)
    assert not any(map(os.path.exists, new))


@pytest.mark.parametrize("empty", [False, True])
def test_edges(spark, edge_docs, no_docs, empty):
    docs = no_docs if empty else edge_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.kept(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert docs.columns == edge_docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001")
    assert last.count() == docs.count()
