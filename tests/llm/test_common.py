from helpers import docs

from tapeworks.llm.common import without_ids


def test_texts_are_not_shuffled_to_drop_ids(spark, tmp_path):
    table = docs(spark, [(i, f"t{i}") for i in [*range(50), 7, 7, None]])
    # Written, as the operators' tables are; larger than the planner would broadcast.
    spark.range(3, 40, 2).union(spark.createDataFrame([(None,)], "id long")).write.parquet(str(tmp_path / "gone"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        left = without_ids(table, spark.read.parquet(str(tmp_path / "gone")))
        plan = left._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in left.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "hashpartitioning" not in plan
    assert rows == [(-1, "tNone"), *sorted((i, f"t{i}") for i in range(50) if i not in range(3, 40, 2))]
