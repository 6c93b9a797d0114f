"""The pipeline, stage by stage, against what the stages have to leave."""

import corpus_pipeline
from tallyspark.llm import exact_dedup, near_dedup
from tests.llm.data import awkward, empty
from tests.llm.test_queries import FOLDER


def test_stages_keep_the_columns_and_drop_what_they_decide(spark):
    docs = corpus_pipeline.read_table(spark, FOLDER, "documents")
    columns, whole = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.materialise(stage(spark, docs, FOLDER), name)
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns and set(after) <= before and len(after) == len(set(after))
        if name == "exact_dedup":
            assert exact_dedup.exact_duplicates(docs).filter("group_size > 1").count() == 0
        if name == "near_dedup":
            assert near_dedup.near_duplicates(docs).filter("not kept").count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert 0.6 * whole < last.count() == docs.count() < whole
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect()} == set(after)


def test_awkward_and_empty_documents_pass_through(spark):
    for docs in (awkward(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, FOLDER)
        assert docs.count() >= 0
