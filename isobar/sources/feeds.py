"""Readers of observations and hazard feeds: CSV, GeoJSON, XML and nested JSON as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K

FEATURES = "features array<struct<id:string,geometry:string,properties:map<string,string>>>"


def observations(spark: SparkSession, path: str) -> DataFrame:
    """Gzipped or plain CSV with a header and # comments, all columns as text."""
    return spark.read.option("header", True).option("comment", "#").csv(path)


def normalised_observations(raw: DataFrame) -> DataFrame:
    """Observations from text columns under any of their names; rows without station, time or place are dropped."""

    def pick(*names: str) -> Column:
        have = [F.col(f"`{n}`") for n in names if n in raw.columns]
        return K.first_alias(*have) if have else F.lit(None).cast("string")

    rows = raw.select(
        pick("station_id", "icaoId", "station").alias("station"),
        pick("observation_time", "obsTime").alias("observed_at"),
        *[K.number(pick(*names)).alias(out) for out, names in {
            "latitude": ("latitude", "lat"), "longitude": ("longitude", "lon"), "temperature_c": ("temp_c", "temp"), "dewpoint_c": ("dewpoint_c", "dewp"), "wind_kt": ("wind_speed_kt", "wspd"),
            "pressure_hpa": ("sea_level_pressure_mb", "slp"), "altimeter_in_hg": ("altim_in_hg", "altim"), "precipitation_in": ("precip_in",),
        }.items()],
    )
    return rows.dropna(subset=["station", "observed_at", "latitude", "longitude"])


def geojson_features(raw: DataFrame, document: str = "document") -> DataFrame:
    """id, geometry (GeoJSON text) and properties of every feature of GeoJSON texts; a text that can't be read gives none.
    What follows a text's value isn't looked at here; payload_faults tells such texts."""
    parsed = F.from_json(document, FEATURES, {"mode": "PERMISSIVE"})
    return raw.select(F.explode(F.coalesce(parsed["features"], F.array().cast(FEATURES.removeprefix("features ")))).alias("f")).select("f.id", "f.geometry", "f.properties")


def xml_items(spark: SparkSession, path: str, tag: str = "item") -> DataFrame:
    return spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", True).load(path)


def stations_of(reports: DataFrame) -> DataFrame:
    """station, latitude and longitude of every station, as its last report (by time) says, in order of stations."""
    last = reports.groupBy("station").agg(F.max_by(F.struct("latitude", "longitude"), F.struct("observed_at", "latitude", "longitude")).alias("p"))
    return last.select("station", "p.*").orderBy("station")


def payload_faults(raw: DataFrame, kind: str, document: str = "document") -> DataFrame:
    """raw with failed: whether a payload is missing or isn't well-formed JSON (kind json) or XML (kind xml)."""
    good = K.well_formed_json(F.col(document)) if kind == "json" else F.from_xml(document, "_corrupt_record string, _ string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})["_corrupt_record"].isNull() & F.col(document).isNotNull()
    return raw.withColumn("failed", ~F.coalesce(good, F.lit(False)))


def provider_status(rows: DataFrame, provider: str, failed: str, configured: DataFrame | None = None, features: DataFrame | None = None) -> DataFrame:
    """provider and status: ok if no document failed; if some did, partial where there are features of the provider, else error.

    Without features, partial means that not all documents failed. configured (provider) are all that should be there: those
    without any document are skipped.
    """
    n = rows.groupBy(F.col(provider).alias("provider")).agg(F.count(F.lit(1)).alias("n"), F.count_if(failed).alias("f"))
    some = F.col("f") < F.col("n")
    if features is not None:
        n = n.join(features.select("provider").distinct().withColumn("_has", F.lit(True)), "provider", "left")
        some = F.coalesce("_has", F.lit(False))
    out = n.select("provider", F.when(F.col("f") == 0, "ok").when(some, "partial").otherwise("error").alias("status"))
    if configured is None:
        return out
    return configured.select("provider").distinct().join(out, "provider", "left").select("provider", F.coalesce("status", F.lit("skipped")).alias("status"))
