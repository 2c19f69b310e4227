from pyspark.sql import functions as F

from lathework.streaming import sessions

DATA = "/root/testdata/sf0.001/events.parquet"


def events(spark, tmp_path):
    batch = spark.read.parquet(DATA)
    third = batch.count() // 3 + 1
    for i in range(3):
        batch.where(F.floor(F.col("event_id") / third) == i).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema(batch.schema).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    return batch, stream


def drained(df, tmp_path, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_stream_sessions_are_batch_sessions(spark, tmp_path):
    batch, stream = events(spark, tmp_path)
    want = {tuple(r) for r in sessions.sessionized(batch).collect()}
    got = {tuple(r) for r in drained(sessions.sessionized(stream), tmp_path, "sessions").collect()}
    assert got <= want and len(got) > 0.9 * len(want)


def test_stream_without_repeats(spark, tmp_path):
    batch, stream = events(spark, tmp_path)
    got = drained(sessions.without_repeats(stream.unionByName(stream)), tmp_path, "unique")
    assert got.count() == batch.count() == sessions.without_repeats(batch.unionByName(batch)).count()


def test_latest_wins_over_batches(spark, tmp_path):
    batch, stream = events(spark, tmp_path)
    slim = stream.select("user_id", "event_id", "event_type")
    q = slim.writeStream.foreachBatch(sessions.upsert_latest(str(tmp_path / "t"), "user_id", "event_id")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    last = spark.read.parquet(str(tmp_path / "t"))
    last = last.where(F.col("generation") == last.agg(F.max("generation")).first()[0])
    assert {(r.user_id, r.event_id) for r in last.collect()} == {tuple(r) for r in batch.groupBy("user_id").agg(F.max("event_id")).collect()}


def test_closed_sessions(spark, tmp_path):
    _, stream = events(spark, tmp_path)
    got = drained(sessions.closed_sessions(stream), tmp_path, "closed")
    assert got.columns == ["user_id", "n", "errors"]
