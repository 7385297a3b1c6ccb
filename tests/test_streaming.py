from graphloom.streaming.merge import merge_nodes

SCHEMA = "id string, source_refs array<string>, confidence double, review_state string, pos bigint"


def test_micro_batches_add_each_id_once(spark, tmp_path):
    table, inbox = f"{tmp_path}/table", f"{tmp_path}/in"
    spark.createDataFrame([("a", ["s"], 0.9, "accepted", 0)], SCHEMA).write.parquet(f"{table}/batch=-1")
    rows = [("a", ["s"], 0.9, "accepted", 1), ("b", ["s"], 0.9, "", 2), ("b", ["s"], 0.9, "", 3), ("c", [], 0.9, "", 4), ("d", ["s"], 0.9, "rejected", 5)]
    for k, part in enumerate((rows, [("b", ["s"], 0.9, "", 6), ("e", ["s"], 0.5, "accepted", 7)])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        query = merge_nodes(spark.readStream.schema(SCHEMA).parquet(inbox), table, f"{tmp_path}/check")
        query.awaitTermination()
    got = sorted((r.id, r.pos) for r in spark.read.parquet(table).collect())
    assert got == [("a", 0), ("b", 2), ("e", 7)]
