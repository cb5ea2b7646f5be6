"""Writers: partitioned outputs, versioned runs with a pointer written last, and manifests."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: list[str], order: list[str], files: int = 1) -> None:
    """Rows by partition columns, each partition in `files` files sorted by order; a large partition needs more files."""
    spread = F.pmod(F.xxhash64(*order), F.lit(files))
    df.repartition(*by, spread).sortWithinPartitions(*by, *order).write.mode("overwrite").partitionBy(*by).parquet(path)


def _files(spark: SparkSession, path: str):
    """The Hadoop path and the file system that it is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def removed(spark: SparkSession, path: str) -> bool:
    """Deletes a folder or file where there is one; says whether there was."""
    at, fs = _files(spark, path)
    return fs.delete(at, True)


def _pointer(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and run of the newest pointer under path; 0 and none where there is none."""
    at, fs = _files(spark, f"{path}/pointers")
    if not fs.exists(at):
        return 0, None
    newest = max((f.getPath().getName() for f in fs.listStatus(at) if not f.getPath().getName().startswith((".", "_"))), default=None)
    return (int(newest.split("-", 1)[0]), newest.split("-", 1)[1].removesuffix(".json")) if newest else (0, None)


def publish(df: DataFrame, path: str, run: str, by: list[str] | None = None, after: str | None = None) -> None:
    """The run's data first, then the pointer to it, so a reader never sees half a run or none.

    Pointers are small files with numbers that go up, `pointers/0000000007-<run>.json`. Each is written under a name that
    readers skip and then renamed, which takes place as a whole or not at all; the last two are kept. Of two writers
    that saw the same run before them, one makes the claim file of the next number and the other fails with FileExistsError.
    after names the run that this one must follow. A writer lost between claim and pointer blocks its number: delete the claim.
    """
    spark = df.sparkSession
    number, current = _pointer(spark, path)
    if after is not None and current != after:
        raise FileExistsError(f"the current run is {current}, not {after}")
    if "/" in run:
        raise ValueError(f"a run's name can't hold a slash: {run}")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/runs/{run}")
    claim, fs = _files(spark, f"{path}/claims/{number + 1:010d}")
    try:
        fs.create(claim, False).close()  # only one writer can make it
    except Exception as error:
        raise FileExistsError(f"another run was published after {current}") from error
    hidden, _ = _files(spark, f"{path}/pointers/.{number + 1:010d}-{run}.json")
    with_text = fs.create(hidden, True)
    with_text.write(bytearray(json.dumps({"run": run}).encode()))
    with_text.close()
    if not fs.rename(hidden, _files(spark, f"{path}/pointers/{number + 1:010d}-{run}.json")[0]):
        raise FileExistsError(f"another run was published after {current}")
    for f in fs.listStatus(_files(spark, f"{path}/pointers")[0]):  # readers that listed before still find the one before
        name = f.getPath().getName().lstrip(".")
        if name.split("-", 1)[0].isdigit() and int(name.split("-", 1)[0]) < number:
            fs.delete(f.getPath(), False)


def current_run(spark: SparkSession, path: str) -> str | None:
    return _pointer(spark, path)[1]


def read_current(spark: SparkSession, path: str) -> DataFrame:
    run = current_run(spark, path)
    if run is None:
        raise FileNotFoundError(f"nothing is published under {path}")
    return spark.read.parquet(f"{path}/runs/{run}")


def manifest(df: DataFrame, by: list[str], reference: str, hour: str) -> DataFrame:
    """by, rows, the latest reference time and the hours that there are."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.max(reference).alias("reference"), F.array_sort(F.collect_set(hour)).alias("hours"))


def features_json(df: DataFrame, properties: list[str], geometry: str = "geometry") -> Column:
    """GeoJSON text of a feature: properties without nulls, and the geometry (GeoJSON text) or null."""
    shape = F.coalesce(F.col(geometry), F.lit("null"))
    return F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'), F.to_json(F.struct(*properties)), F.lit("}"))


def write_features(df: DataFrame, path: str, output: str, properties: list[str]) -> None:
    """A folder for each output with a feature a line (any number of them), which every reader of GeoJSON lines takes."""
    df.select(output, features_json(df, properties).alias("value")).write.mode("overwrite").partitionBy(output).text(path)


def feature_collections(df: DataFrame, output: str, properties: list[str], order: list[str]) -> DataFrame:
    """output and document: one FeatureCollection text for each output. A document is one row, so this is for outputs that one
    reader loads as a whole (a web page, say); beyond that write_features has no such bound."""
    rows = df.groupBy(output).agg(F.array_sort(F.collect_list(F.struct(*order, features_json(df, properties).alias("_f")))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda x: x["_f"]), ",")
    return rows.select(output, F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("document"))


def write_observations(reports: DataFrame, stations: DataFrame, path: str) -> None:
    """path/observations and path/stations, a JSON document a line; both come from one normalised table."""
    reports.write.mode("overwrite").json(f"{path}/observations")
    stations.write.mode("overwrite").json(f"{path}/stations")


def write_forecasts(forecasts: DataFrame, path: str) -> None:
    """A folder of JSON lines for each provider: its forecasts at stations."""
    forecasts.write.mode("overwrite").partitionBy("provider").json(path)


def write_cities(cities: DataFrame, path: str) -> None:
    """Forecasts of cities (feeds.city_forecasts) as JSON lines."""
    cities.write.mode("overwrite").json(path)


def write_provider_hours(tiles: DataFrame, path: str) -> None:
    """Tiles (model, hour, tile and more) in a folder for each model and hour; of what was there before, only folders of
    the same models and hours are replaced. Rows are dealt by tile, so a model's hour isn't one task's work."""
    spread = tiles.repartition("model", "hour", "tile").sortWithinPartitions("model", "hour", "tile")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "hour").parquet(path)


def job_manifest(tiles: DataFrame) -> DataFrame:
    """job, reference (the latest), tiles, packs and hours of rows (job, reference, hour, tile, pack)."""
    counted = tiles.groupBy("job").agg(F.max("reference").alias("reference"), F.count_distinct("hour", "tile").alias("tiles"), F.count_distinct("hour", "pack").alias("packs"), F.array_sort(F.collect_set("hour")).alias("hours"))
    return counted
