from leafwright.streaming.landing import process_landing


def test_each_file_once(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "doc_id long, text string"
    for n in (1, 2):
        spark.createDataFrame([(n, "x")], schema).write.mode("append").parquet(src)
        q = process_landing(spark, src, schema, lambda df: df.selectExpr("doc_id", "length(text) AS n"), out, state)
        q.awaitTermination()
        assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == list(range(1, n + 1))
