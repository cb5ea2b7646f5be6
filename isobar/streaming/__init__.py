"""Structured Streaming forms of the stateful operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.feeds import with_stale
from ..operators.learning import merged_state
from ..sources.sinks import removed
from .state import interval_amounts, nearest_matches, running_scores

__all__ = ["interval_amounts", "matched", "nearest_matches", "running_scores", "stale_writer", "state_writer", "unexpired", "windowed_errors"]


def matched(forecasts: DataFrame, observations: DataFrame, minutes: int = 90) -> DataFrame:
    """Stream-stream join of forecasts (station, valid_time) and observations (station, observed_at) within minutes; both watermarked."""
    f = forecasts.withWatermark("valid_time", f"{minutes} minutes")
    o = observations.withWatermark("observed_at", f"{minutes} minutes").withColumnRenamed("station", "_station")
    width = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    near = (F.col("station") == F.col("_station")) & (F.col("observed_at") >= F.col("valid_time") - width) & (F.col("observed_at") <= F.col("valid_time") + width)
    return f.join(o, near).drop("_station")


def windowed_errors(errors: DataFrame, at: str, late: str = "90 minutes", width: str = "1 hour") -> DataFrame:
    """provider, window, n and mean error of a stream of errors (provider, at, error)."""
    return errors.withWatermark(at, late).groupBy(F.window(at, width), "provider").agg(F.count(F.lit(1)).alias("n"), F.avg("error").alias("mean_error"))


def unexpired(alerts: DataFrame, at: str, expires: str, late: str = "10 minutes") -> DataFrame:
    """Alerts that hadn't expired when they were sent, once each by id."""
    return alerts.withWatermark(at, late).filter(F.coalesce(F.col(expires) >= F.col(at), F.lit(True))).dropDuplicatesWithinWatermark(["id"])


def state_writer(path: str, keys: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch's rows replace those of the same keys; version n is written beside n - 1, so a batch can run
    again, and n - 2 goes. It reads all state a batch: for scores of many groups use running_scores, whose state is keyed."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        merged = batch if epoch == 0 else merged_state(spark.read.parquet(f"{path}/version={epoch - 1}"), batch, keys)
        merged.write.mode("overwrite").parquet(f"{path}/version={epoch}")
        removed(spark, f"{path}/version={epoch - 2}")

    return write


def stale_writer(path: str, features: list[str]) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch is a run of all providers; version n holds its features (the columns features, with provider)
    and, marked stale, those of version n - 1 whose provider failed in it. A failed provider is a row with status `error` and
    no id; a batch can run again, and version n - 2 goes."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = batch.filter("id is not null").select(*features).withColumn("stale", F.lit(False))
        if epoch:
            fresh = with_stale(fresh, spark.read.parquet(f"{path}/version={epoch - 1}"), batch.select("provider", "status"))
        fresh.write.mode("overwrite").parquet(f"{path}/version={epoch}")
        removed(spark, f"{path}/version={epoch - 2}")

    return write
