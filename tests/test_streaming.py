from grainfold.operators.timeseries import resample
from grainfold.streaming.resample import resample_stream


def test_stream_equals_batch(spark, events, tmp_path):
    events.select("ts", "event_type", "value").repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, event_type string, value double").parquet(str(tmp_path / "in"))
    out = resample_stream(stream, "ts", "value", "1 day", "60 days", ["event_type"])
    query = (
        out.writeStream.format("memory").queryName("daily").outputMode("update")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    got = {(r.event_type, r.bin): round(r["mean"], 6) for r in spark.table("daily").collect()}
    batch = resample(events, "ts", "value", "day", ["event_type"]).collect()
    assert got == {(r.event_type, r.bin): round(r["mean"], 6) for r in batch}
