"""Choice of inputs: candidate runs, messages of an index, and which inputs exist."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def candidate_runs(requests: DataFrame, run: str, lead: str, back: int = 5, hours: int = 6) -> DataFrame:
    """Each request with attempt 0 to back - 1: attempt i is the run i * hours earlier, with as many more hours of lead."""
    tried = requests.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(back - 1))))
    return tried.withColumn(run, F.col(run) - F.make_dt_interval(F.lit(0), F.col("attempt") * hours)).withColumn(lead, F.col(lead) + F.col("attempt") * hours)


def first_available(candidates: DataFrame, available: DataFrame, request: list[str], on: list[str]) -> DataFrame:
    """Of each request's candidates the one with the least attempt that is in available; requests without one are left out."""
    there = candidates.join(available.select(*on).distinct(), on, "left_semi")
    values = [c for c in there.columns if c not in request]
    return there.groupBy(*request).agg(F.min_by(F.struct(*values), "attempt").alias("_v")).select(*request, "_v.*")


def index_lines(text: DataFrame, by: list[str], line: str = "line") -> DataFrame:
    """number, offset and description of `number:offset:description` lines."""
    parts = F.split(F.col(line), ":", 3)
    return text.select(*by, F.get(parts, F.lit(0)).try_cast("int").alias("number"), F.get(parts, F.lit(1)).try_cast("bigint").alias("offset"), F.get(parts, F.lit(2)).alias("description")).filter("offset is not null")


def first_message(ranged: DataFrame, by: list[str], tokens: list[str]) -> DataFrame:
    """Of each file the first message whose description holds all tokens."""
    has: Column = F.lit(True)
    for token in tokens:
        has = has & F.col("description").contains(token)
    values = [c for c in ranged.columns if c not in by]
    return ranged.filter(has).groupBy(*by).agg(F.min_by(F.struct(*values), "number").alias("_v")).select(*by, "_v.*")
