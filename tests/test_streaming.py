from ledgermatch.streaming import ingest


def test_messages(spark):
    df = spark.createDataFrame([('{"schemaVersion":1,"id":5}',), ('{"schemaVersion":2,"id":5}',), ("x",), (None,)], "value string")
    good, bad = ingest.messages(df, "id int")
    assert [r["id"] for r in good.collect()] == [5] and bad.count() == 3


def test_a_batch_that_comes_again_adds_nothing(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k long, v string"
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], schema).coalesce(1).write.parquet(source)
    for i in range(2):
        ingest.register_stream(ingest.read_folder(spark, source, schema), table, ["k"], ["v"], str(tmp_path / f"c{i}")).awaitTermination()
    spark.createDataFrame([(2, "d"), (3, "e")], schema).coalesce(1).write.mode("append").parquet(source)
    ingest.register_stream(ingest.read_folder(spark, source, schema), table, ["k"], ["v"], str(tmp_path / "c1")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [(1, "a"), (2, "c"), (3, "e")]


def test_fetch(spark):
    def fetch(key):
        if key == "bad":
            raise TimeoutError
        return key.encode()

    out = ingest.fetch_all(spark.createDataFrame([("a",), ("bad",)], "document_id string"), fetch).orderBy("document_id").collect()
    assert [(r["content"], r["error"]) for r in out] == [(bytearray(b"a"), None), (None, "TimeoutError")]


def test_claims_keep_state_between_batches(spark, tmp_path):
    source, schema = str(tmp_path / "in"), "document_id string, outcome string"
    spark.createDataFrame([("a", None), ("b", None), ("b", "OK")], schema).coalesce(1).write.parquet(source)
    seen = []

    # Else the timeouts' batches without data never end.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def go():
        out = ingest.claim_stream(ingest.read_folder(spark, source, schema))
        keep = lambda batch, _: seen.extend(map(tuple, batch.collect()))
        query = out.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        assert query.awaitTermination(60)

    go()
    assert sorted(seen) == [("a", 1, "EN_CURSO"), ("b", 1, "OK")]
    spark.createDataFrame([("a", "REINTENTO"), ("b", "ERROR")], schema).coalesce(1).write.mode("append").parquet(source)
    seen.clear()
    go()
    assert sorted(seen) == [("a", 1, "REINTENTO"), ("b", 1, "OK")]
