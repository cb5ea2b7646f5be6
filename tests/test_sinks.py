"""Writers and readers of runs, and inputs chosen from catalogs."""

from datetime import datetime

from pyspark.sql import functions as F

from isobar.sources import sinks


def test_runs_and_pointer(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, datetime(2026, 1, 1)), ("a", 2, datetime(2026, 1, 2)), ("b", 1, datetime(2026, 1, 1))], "tile string, hour int, ref timestamp")
    sinks.publish(df.filter("hour = 1"), str(tmp_path), "r1")
    sinks.publish(df, str(tmp_path), "r2", ["tile"])
    assert sinks.read_current(spark, str(tmp_path)).count() == 3
    told = {r["tile"]: (r["n"], r["hours"]) for r in sinks.manifest(df, ["tile"], "ref", "hour").collect()}
    assert told == {"a": (2, [1, 2]), "b": (1, [1])}


def test_partitioned_files(spark, tmp_path):
    df = spark.range(100).selectExpr("id % 3 as tile", "id as hour")
    sinks.write_partitioned(df, f"{tmp_path}/out", ["tile"], ["hour"])
    assert spark.read.parquet(f"{tmp_path}/out").filter("tile = 1").count() == 33
    lines = df.withColumn("geometry", F.lit(None).cast("string"))
    sinks.write_features(lines, f"{tmp_path}/geo", "tile", ["hour"])
    text = spark.read.text(f"{tmp_path}/geo/tile=0")
    assert text.count() == 34 and text.filter(F.col("value") == '{"type":"Feature","geometry":null,"properties":{"hour":0}}').count() == 1
