"""Streaming forms on small file streams."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from isobar import streaming
from isobar.operators import learning

START = datetime(2026, 1, 1)


def test_windowed_errors_and_expiry(spark, tmp_path):
    rows = [("gfs", START + timedelta(minutes=10 * i), float(i)) for i in range(12)] + [("gfs", START + timedelta(hours=9), 1.0)]
    spark.createDataFrame(rows, "provider string, at timestamp, error double").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("provider string, at timestamp, error double").parquet(f"{tmp_path}/in")
    q = streaming.windowed_errors(stream, "at").writeStream.format("memory").queryName("errors").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["n"], r["mean_error"]) for r in spark.table("errors").collect())[:2] == [(6, 2.5), (6, 8.5)]


def test_state_batches(spark, tmp_path):
    write = streaming.state_writer(str(tmp_path), ["k"])
    write(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), 0)
    write(spark.createDataFrame([(2, 5.0)], "k int, v double"), 1)
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/version=1").collect()) == [(1, 1.0), (2, 5.0)]


def test_matches_within_ninety_minutes(spark):
    f = spark.createDataFrame([("E", START, 1), ("E", START + timedelta(hours=3), 2)], "station string, valid_time timestamp, f int")
    o = spark.createDataFrame([("E", START + timedelta(minutes=90), 7), ("F", START, 8)], "station string, observed_at timestamp, o int")
    assert sorted((r["f"], r["o"]) for r in streaming.matched(f, o).collect()) == [(1, 7), (2, 7)]


def test_running_totals_over_batches(spark, tmp_path):
    schema = "cell string, hour int, value double, running boolean"
    for k, rows in enumerate([[("a", 1, 1.0, True), ("a", 2, 3.0, True), ("b", 1, 5.0, False)], [("a", 3, 2.0, True), ("a", 4, 6.0, True)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        q = streaming.interval_amounts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted((r["cell"], r["hour"], r["amount"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 0.0), ("a", 4, 4.0), ("b", 1, 5.0)]


def streamed(spark, df, path, name):
    df.coalesce(1).write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_stream_of_matches(spark, tmp_path):
    f = spark.createDataFrame([("E", START, 1), ("E", START + timedelta(hours=3), 2), ("E", START + timedelta(hours=9), 3)], "station string, valid_time timestamp, f int")
    o = spark.createDataFrame([("E", START + timedelta(minutes=90), 7), ("F", START, 8), ("E", START + timedelta(hours=9), 9)], "station string, observed_at timestamp, o int")
    joined = streaming.matched(streamed(spark, f, f"{tmp_path}/f", "f"), streamed(spark, o, f"{tmp_path}/o", "o"))
    q = joined.writeStream.format("memory").queryName("pairs").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["f"], r["o"]) for r in spark.table("pairs").collect()) == [(1, 7), (2, 7), (3, 9)]


def test_stream_of_alerts_without_the_expired(spark, tmp_path):
    rows = [("a", START, START + timedelta(hours=1)), ("a", START, START + timedelta(hours=1)), ("b", START, START - timedelta(hours=1)), ("c", START, None)]
    df = spark.createDataFrame(rows, "id string, at timestamp, expires timestamp")
    q = streaming.unexpired(streamed(spark, df, f"{tmp_path}/in", "a"), "at", "expires").writeStream.format("memory").queryName("alerts").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["id"] for r in spark.table("alerts").collect()) == ["a", "c"]


def test_runs_with_failed_providers(spark, tmp_path):
    schema = "id string, provider string, status string"
    write = streaming.stale_writer(str(tmp_path), ["id", "provider"])
    told = []
    for k, rows in enumerate([[("a", "x", "ok"), ("b", "y", "ok")], [("c", "x", "ok"), (None, "y", "error")], [(None, "x", "error"), (None, "y", "error")]]):
        write(spark.createDataFrame(rows, schema), k)
        told.append(sorted((r["id"], r["stale"]) for r in spark.read.parquet(f"{tmp_path}/version={k}").collect()))
    assert not (tmp_path / "version=0").exists() and (tmp_path / "version=1").exists()
    assert told == [[("a", False), ("b", False)], [("b", True), ("c", False)], [("b", True), ("c", True)]]


def batches(spark, parts, schema, path, make, mode="append", restart=False):
    """What a stream writes of parts, one batch each; with restart, each in a run of its own from the checkpoint."""
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/in/{k:03d}")
        if restart or k + 1 == len(parts):
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in/*")
            q = make(stream).writeStream.outputMode(mode).option("checkpointLocation", f"{path}/ck")
            q = q.foreachBatch(lambda df, n: df.write.mode("append").parquet(f"{path}/out/run={k}_{n}")).trigger(availableNow=True).start()
            q.awaitTermination()
    return spark.read.parquet(f"{path}/out")


def test_nearest_matches_equal_the_batch_form(spark, tmp_path):
    """Ties, forecasts without an observation near them, rows out of order, and a restart between all batches."""
    rng = random.Random(4)
    at = lambda m: START + timedelta(minutes=m)
    rows = [(f"s{rng.randrange(3)}", at(rng.randrange(0, 2000, 15)), k, None) for k in range(160)] + [(f"s{rng.randrange(3)}", at(rng.randrange(0, 2000, 45)), None, 1000 + k) for k in range(60)] + [("s9", at(50), 777, None)]
    rows.sort(key=lambda r: (r[1] + timedelta(minutes=rng.randrange(-40, 40))))
    schema = "station string, at timestamp, f bigint, o bigint"
    parts = [rows[k : k + 40] for k in range(0, len(rows), 40)] + [[("end", at(9000), None, 1)], [("end", at(9001), None, 2)]]
    sides = lambda df: (df.filter("f is not null").select("station", F.col("at").alias("valid_time"), "f"), df.filter("o is not null").select("station", F.col("at").alias("observed_at"), "o"))

    def nearest(stream):
        return streaming.nearest_matches(*sides(stream), ["station"], "valid_time", "observed_at", "f", "o", late="100 minutes")

    got = batches(spark, parts, schema, str(tmp_path), nearest, restart=True)
    want = learning.nearest_in_time(*sides(spark.createDataFrame(rows, schema)), ["station"], "valid_time", "observed_at", "f", "o")
    told = lambda df: sorted((r["station"], r["f"], r["o"], r["observed_at"], r["gap"]) for r in df.collect())
    assert told(got) == told(want) and 777 not in [r["f"] for r in got.collect()]
    held = spark.read.format("statestore").option("stateVarName", "observed").load(f"{tmp_path}/ck")
    assert held.filter("key.station <> 'end'").count() == 0  # nothing is held for ever


def test_running_scores_equal_the_batch_form(spark, tmp_path):
    """Batch by batch with restarts; an entry ends when its last error is thirty days behind the watermark."""
    rng = random.Random(7)
    parts = [[(f"r{rng.randrange(2)}", f"p{rng.randrange(3)}", rng.choice((None, rng.random(), float("nan"))), f"{k:03d}", START) for k in range(30)] for _ in range(2)]
    parts += [[("end", "x", 1.0, "a", START + timedelta(days=40))], [("r0", "new", 0.5, "a", START + timedelta(days=39, hours=20))]]
    schema = "region string, provider string, error double, station string, at timestamp"
    got = batches(spark, parts, schema, str(tmp_path), lambda s: streaming.running_scores(s, ["region"], "provider", "error", "station", "at"), "update", restart=True)
    kinds = "region string, provider string, score double, sample_count bigint, history array<double>"
    state = spark.createDataFrame([], kinds)
    for rows in parts[:2]:
        state = spark.createDataFrame(learning.updated_scores(spark.createDataFrame(rows, schema), state, ["region"], "provider", "error", ["station"]).collect(), f"{kinds}, weight double")
    told = lambda df: sorted((r["region"], r["provider"], round(r["score"], 9), r["sample_count"], len(r["history"]), round(r["weight"], 9)) for r in df.collect())
    assert told(got.filter("run like '1_%'")) == told(state)
    assert [r["provider"] for r in got.filter("run like '3_%'").collect()] == ["new"]
    assert spark.read.format("statestore").option("stateVarName", "scores").load(f"{tmp_path}/ck").count() == 2


def test_running_totals_end(spark, tmp_path):
    schema = "cell string, hour int, value double, running boolean, at timestamp"
    at = lambda d: START + timedelta(days=d)
    parts = [[("a", 1, 5.0, True, at(0))], [("b", 1, 1.0, True, at(30))], [("a", 2, 7.0, True, at(30))]]
    got = batches(spark, parts, schema, str(tmp_path), lambda s: streaming.interval_amounts(s, "at"), restart=True)
    assert sorted((r["cell"], r["hour"], r["amount"]) for r in got.collect()) == [("a", 1, 5.0), ("a", 2, 7.0), ("b", 1, 1.0)]
