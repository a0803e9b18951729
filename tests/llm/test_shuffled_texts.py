"""Of the pipeline's join: texts stay where they are while few ids go."""

import corpus_pipeline


def test_texts_stay_where_few_ids_go(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    words = [f"w{k}" for k in range(40)]
    rows = [(1, " ".join(words)), (2, " ".join(words)), (3, "alone"), (4, None), (None, "x"), (5, "b"), (5, "a"), (5, "a")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents"))
    kept = corpus_pipeline.keep_one_of_each(spark, spark.read.parquet(str(tmp_path / "documents")), "")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert sorted(kept.collect(), key=repr) == sorted([(1, " ".join(words)), (3, "alone"), (4, None), (None, "x"), (5, "a")], key=repr)
