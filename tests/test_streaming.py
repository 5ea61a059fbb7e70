from parlance.streaming import activity

SCHEMA = "msg_id long, src string, sender string, ts timestamp"


def run(spark, tmp_path, make, name):
    rows = [(1, "s", "a", "2024-01-01 00:00:00"), (2, "s", "a ", "2024-01-01 00:10:00"), (2, "s", "a", "2024-01-01 00:10:00"), (3, "s", "a", "2024-01-01 01:00:00"), (4, "s", None, "2024-01-01 01:00:00"), (9, "s", "b", "2024-01-05 00:00:00")]
    spark.createDataFrame(rows, "msg_id long, src string, sender string, t string").selectExpr("msg_id", "src", "sender", "cast(t as timestamp) as ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    q = make(stream).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def test_hourly(spark, tmp_path):
    got = {(str(r.start), r.n) for r in run(spark, tmp_path, activity.hourly_volume, "hourly") if r.sender == "a"}
    assert ("2024-01-01 01:00:00", 1) in got


def test_sessions(spark, tmp_path):
    got = sorted((str(r.start), r.n) for r in run(spark, tmp_path, activity.live_sessions, "live") if r.sender == "a")
    assert got == [("2024-01-01 00:00:00", 2), ("2024-01-01 01:00:00", 1)]
