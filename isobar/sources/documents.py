"""JSON and CSV documents with defaults, and which of several inputs is there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def first_present(readers: list, empty: DataFrame) -> DataFrame:
    """What the first reader gives whose path there is, else empty. A reader is a function without arguments that reads lazily;
    only a path that isn't there leads on to the next, any other error is raised."""
    for read in readers:
        try:
            return read()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return empty


def json_or_default(spark: SparkSession, path: str, schema: str | StructType, default: DataFrame | None = None) -> DataFrame:
    """A JSON document (of several lines), or default (no rows if not given) where there is none; faulty documents give nulls."""
    return first_present([lambda: spark.read.schema(schema).option("multiLine", True).json(path)], spark.createDataFrame([], schema) if default is None else default)


def skill_weights(spark: SparkSession, path: str) -> DataFrame:
    """model and weight (0 at least) of a document whose `weights` map models to numbers; none where it is missing or faulty."""
    rows = json_or_default(spark, path, "weights map<string,string>")
    return rows.select(F.explode("weights").alias("model", "_w")).select("model", F.col("_w").try_cast("double").alias("weight")).filter("weight is not null").withColumn("weight", F.greatest("weight", F.lit(0.0)))


def previous_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """type, geometry and properties of the first of the paths' feature collections; none where no path has one.

    A path that is missing, damaged or holds something else leads on to the next. To tell, the first rows of each path are
    looked at, in order, until one has a collection.
    """
    schema = "type string, features array<struct<type:string,geometry:string,properties:map<string,string>>>"
    empty = spark.createDataFrame([], schema)
    for path in paths:
        rows = first_present([lambda p=path: spark.read.schema(schema).option("multiLine", True).json(p)], empty).filter("type = 'FeatureCollection' and features is not null")
        if not rows.isEmpty():
            return rows.select(F.explode("features").alias("f")).select("f.*")
    return empty.select(F.explode("features").alias("f")).select("f.*")


def locations(spark: SparkSession, path: str) -> DataFrame:
    """country, city and city_id of a file of lines parted by semicolons, without its header."""
    return spark.read.option("sep", ";").option("header", True).option("enforceSchema", True).schema("country string, city string, city_id string").csv(path)


def scenes(spark: SparkSession, base: str) -> DataFrame:
    """The items of base/manifest.json (id, name, thumbnailUrl) with the document and the image (base/id.json and .webp) of each;
    null where there is none. scene_faults and mirrored_scenes take it from here."""
    items = spark.read.schema("id string, name string, thumbnailUrl string").option("multiLine", True).json(f"{base}/manifest.json")
    files = spark.read.format("binaryFile").load(base).select(F.regexp_extract("path", r"([^/]+)\.(?:json|webp)$", 1).alias("id"), F.col("path").endswith(".webp").alias("image"), "content").filter("id not in ('', 'manifest')")
    both = files.groupBy("id").agg(F.max(F.when(~F.col("image"), F.col("content"))).alias("_d"), F.max(F.when(F.col("image"), F.col("content"))).alias("img"))
    return items.join(both, "id", "left").select("id", "name", "thumbnailUrl", F.col("_d").cast("string").alias("doc"), "img")


def detections(spark: SparkSession, path: str, product: str) -> DataFrame:
    """Rows of a CSV of fire detections, all text, with the product's name."""
    return spark.read.option("header", True).csv(path).withColumn("product", F.lit(product))


def request_ids(stations: DataFrame, station: str = "station", size: int = 100) -> DataFrame:
    """batch (from 0) and ids: the different station ids in order, joined by commas, size of them a request and fewer in the last.

    Ids are numbered within their first two letters and start where the letters before end, so no task orders all of them.
    """
    ids = stations.select(F.col(station).alias("id")).filter("id is not null").distinct().withColumn("_p", F.substring("id", 1, 2))
    counts = ids.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))  # a row for two letters
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    numbered = ids.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy("id")) - 1).join(starts, "_p")
    return numbered.groupBy(F.floor((F.col("_s") + F.col("_k")) / size).alias("batch")).agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"))


def eligible_radar(catalogue: DataFrame) -> DataFrame:
    """Sources that are enabled and whose terms allow redistribution."""
    return catalogue.filter(F.coalesce(F.col("enabled") & F.col("redistribution.allowed"), F.lit(False)))
