import numpy as np
from pyspark.sql import functions as F

from scanloom.operators.pair import pair_nearest
from scanloom.streaming.pairing import nearest, pair_streams, rolling_frames, settled


def stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def finish(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_stream_pairs_equal_batch_pairs(spark, tmp_path):
    rng = np.random.default_rng(2)
    frames = [spark.createDataFrame(list(enumerate(sorted((rng.integers(0, 5000, 50) * 1000).tolist()))), "seq long, us long") for _ in range(2)]
    left, right = (stream(spark, df.select("seq", F.timestamp_micros("us").alias("ts")), str(tmp_path / n)) for df, n in zip(frames, "ab"))
    finish(
        pair_streams(left, right, 40, 500).writeStream.format("memory").queryName("pairs").option("checkpointLocation", str(tmp_path / "c")).start()
    )
    got = {(r["l_id"], r["r_id"]) for r in nearest(spark.table("pairs")).collect()}
    want = {(r["l_id"], r["r_id"]): max(r["l_us"], r["r_us"]) for r in pair_nearest(*frames, 40_000).collect()}
    assert got == want.keys() and got
    early = spark.table("pairs").filter("l_ts < timestamp_millis(3000) AND r_ts < timestamp_millis(3000)")
    done = {(r["l_id"], r["r_id"]) for r in settled(early, 3_000_000 - 1, 40).collect()}
    assert done == {k for k, us in want.items() if us + 40_000 <= 3_000_000 - 1}  # later messages change none of them


def test_rolling_frames_hold_the_last_scans(spark, tmp_path):
    df = spark.createDataFrame([("l2", i) for i in range(7)] + [("l1", 3), ("l1", 3)], "sensor string, scan_id long")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        finish(
            rolling_frames(
                stream(spark, df, str(tmp_path / "s")), 3
            ).writeStream.format("memory").queryName("frames").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
        )
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = {(r["sensor"], r["frame"], r["scan_id"]) for r in spark.table("frames").collect()}
    assert got == {("l2", f, s) for f in range(7) for s in range(max(0, f - 2), f + 1)} | {("l1", 3, 3)}
