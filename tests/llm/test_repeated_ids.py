"""Rows of one id are one document for the Jaccard join and its stage of the pipeline."""

import corpus_pipeline
from logweft.llm import jaccard

A, B = (" ".join(f"{w}{k}" for k in range(40)) for w in "ab")


def test_texts_of_one_id_link_their_components(spark):
    rows = [(1, A), (5, A), (5, B), (7, B), (8, ""), (8, None), (9, ""), (9, B), (None, A)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for config in (jaccard.JaccardConfig(), jaccard.JaccardConfig(broadcast_rows=0, partners=1, slot_texts=2)):
        got = sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(frame, config).collect()), key=repr)
        assert got == sorted([(1, 1), (5, 1), (5, 1), (7, 1), (8, 8), (8, 8), (9, 1), (9, 1), (None, None)], key=repr)


def test_the_stage_keeps_one_row_of_a_kept_id(spark):
    rows = [(1, A, "en"), (1, A, "en"), (1, B, "en"), (2, A, "fr"), (3, "own text", None), (3, "own text", None), (None, A, "x"), (None, A, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.keep_one_of_each(spark, frame, "")
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(
        [(1, A, "en"), (3, "own text", None), (None, A, "x"), (None, A, "x")], key=repr)
