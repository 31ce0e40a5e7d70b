from stepweave.streaming import fill


def test_only_new_keys_are_processed(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    schema = "k string, v int"
    for batch in ([("a", 1), ("b", 2)], [("b", 3), ("c", 4)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        fill.process_new(fill.read_appended(spark, src, schema), lambda df: df.selectExpr("k", "v * 10 as v"), out, "k", ck).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [("a", 10), ("b", 20), ("c", 40)]


def test_carried_forward(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "k string, i long, v string, last boolean"
    first = [("a", 0, None, False), ("a", 1, "x", False), ("b", 0, None, False)]
    second = [("a", 2, None, False), ("a", 3, "y", True), ("b", 1, None, True)]
    spark.createDataFrame(first, schema).coalesce(1).write.mode("append").parquet(src)
    got = fill.carried_forward(fill.read_appended(spark, src, schema, 1), "k", "i", "v", "last")
    q = got.writeStream.format("memory").queryName("carried").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    spark.createDataFrame(second, schema).coalesce(1).write.mode("append").parquet(src)
    q.processAllAvailable()
    q.stop()
    rows = sorted((r.k, r.i, r.v) for r in spark.sql("select * from carried").collect())
    assert rows == [("a", 0, "x"), ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("b", 0, None), ("b", 1, None)]
