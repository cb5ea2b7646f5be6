"""Consensus of several models per cell: weighted lower median, votes, wet probability, spread and confidence.

Rows are long: one per cell and model. Values of a cell are counted together before they are sorted, so a cell with many
equal values costs one row each value; a cell's different values are sorted in one task, and AQE parts the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import conditions
from ..functions.fields import FAMILIES, QUALITY_FIELDS, looked_up
from ..functions.units import clip, round_even

#: Spread at which confidence is gone.
TOLERANCE = {"temperature": 8.0, "dewpoint": 8.0, "wind_u": 12.0, "wind_v": 12.0, "wind_gust": 15.0, "pressure": 2500.0, "humidity": 0.5, "cloud_cover": 0.7, "precipitation": 8.0, "snowfall": 5.0, "visibility": 15000.0, "condition_code": 4.0, "precipitation_probability": 1.0}


def finite(x: Column) -> Column:
    """Whether a number is there and is neither NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))


def weighted_median(df: DataFrame, by: list[str], value: str, weight: str, out: str) -> DataFrame:
    """by and out: the least value at which the weights so far are half of all or more. Missing and infinite values have no
    weight; a group without weight gives null."""
    w = F.when(finite(F.col(value)), F.greatest(F.col(weight), F.lit(0)))
    counted = df.groupBy(*by, value).agg(F.sum(w).alias("_w"))
    group = Window.partitionBy(*by)
    before = group.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    summed = counted.withColumns({"_c": F.sum("_w").over(before), "_t": F.sum("_w").over(group)})
    return summed.groupBy(*by).agg(F.min(F.when((F.col("_w") > 0) & (2 * F.col("_c") >= F.col("_t")), F.col(value))).alias(out))


def weighted_vote(df: DataFrame, by: list[str], code: str, weight: str, out: str) -> DataFrame:
    """by and out: the code with the most weight; of equals the larger code."""
    counted = df.filter(F.col(code).isNotNull()).groupBy(*by, code).agg(F.sum(weight).alias("_w"))
    return counted.groupBy(*by).agg(F.max_by(code, F.struct("_w", code)).alias(out))


def two_level_vote(df: DataFrame, by: list[str], code: str, family: str, weight: str, out: str) -> DataFrame:
    """by and out: the vote among families, then among the codes of the family that won."""
    counted = df.filter(F.col(code).isNotNull()).groupBy(*by, family, code).agg(F.sum(weight).alias("_w"))
    families = counted.groupBy(*by, family).agg(F.sum("_w").alias("_f"), F.max_by(code, F.struct("_w", code)).alias("_code"))
    return families.groupBy(*by).agg(F.max_by("_code", F.struct("_f", family)).alias(out))


def family_balanced(df: DataFrame, by: list[str], family: str, skill: str, out: str, least: float = 0.01) -> DataFrame:
    """df with out: the skill (1 if there is none, least at least) over the number of the family's rows in the group."""
    siblings = F.count(F.lit(1)).over(Window.partitionBy(*by, family))
    return df.withColumn(out, F.greatest(F.coalesce(F.col(skill), F.lit(1.0)), F.lit(least)) / siblings)


def several_families(df: DataFrame, by: list[str], family: str, least: int = 2) -> DataFrame:
    """The groups of df that least families or more take part in, with n_families."""
    counted = df.groupBy(*by, family).agg(F.lit(1).alias("_one")).groupBy(*by).agg(F.count(F.lit(1)).alias("n_families")).filter(F.col("n_families") >= least)
    return df.join(counted, by)


def wet_statistics(df: DataFrame, by: list[str], amount: str, weight: str, wet: float = 0.05) -> DataFrame:
    """by, wet_probability (0 if nothing is known) and amount (the median of wet rows if the probability is a half or more, else 0)."""
    known = F.when(F.col(amount).isNotNull(), F.col(weight))
    shares = df.groupBy(*by).agg(F.coalesce(F.try_divide(F.sum(F.when(F.col(amount) >= wet, F.col(weight)).otherwise(F.lit(0))), F.sum(known)), F.lit(0.0)).alias("wet_probability"))
    median = weighted_median(df.filter(F.col(amount) >= wet), by, amount, weight, "_median")
    joined = shares.join(median, by, "left")
    return joined.select(*by, "wet_probability", F.when(F.col("wet_probability") >= 0.5, F.coalesce("_median", F.lit(0.0))).otherwise(F.lit(0.0)).alias("amount"))


def confidence(spread: Column, families: Column, field: str | Column) -> Column:
    """1 where models agree and three families take part, 0 at the field's tolerance or more; null without a spread."""
    tolerance = F.lit(TOLERANCE[field]) if isinstance(field, str) else looked_up(TOLERANCE, field)
    return (1 - clip(spread / tolerance, 0.0, 1.0)) * F.least(families / 3, F.lit(1.0))


def clamped_bias(value: Column, bias: Column, samples: Column, low: Column, high: Column, least: int = 3) -> Column:
    """value moved by a bias of least samples or more, but not out of the contributors' range; null stays null."""
    b = F.when(samples >= least, bias).otherwise(F.lit(0.0))
    return F.when(value.isNotNull(), F.least(F.greatest(value + b, low), high))


def skill_of(skills: DataFrame) -> DataFrame:
    """model and skill (0 at least) of a table of model and weight; weights that aren't numbers are left out."""
    known = skills.select("model", F.col("weight").try_cast("double").alias("skill")).filter("skill is not null")
    return known.withColumn("skill", F.greatest("skill", F.lit(0.0)))


def field_consensus(cells: DataFrame, tile: list[str], cell: list[str], quality: bool = True) -> DataFrame:
    """The consensus of all fields: tile, cell, field, value, spread, families and confidence, long.

    cells has tile and cell columns, model, field, value and skill (null: 1). A field of a tile counts only where models of
    two families or more carry it, which is asked of the whole plane and not of a cell; a model that carries the plane has
    its share in a family's weight even where its cell is missing. Condition codes are voted, by family of codes first, with
    missing ones as Unknown; of precipitation the probability is a field of its own, and amounts under even odds are 0; all
    others are weighted lower medians. spread: of what is finite, but of codes only where all are there. With quality,
    confidence is given for the fields that have it; without, spread, families and confidence are left out.
    """
    rows = cells.withColumn("family", looked_up(FAMILIES, F.col("model"))).filter("family is not null")
    carried = rows.groupBy(*tile, "field", "family").agg(F.count_distinct("model").alias("_siblings"))
    planes = carried.groupBy(*tile, "field").agg(F.count(F.lit(1)).alias("families"), F.collect_list(F.struct("family", "_siblings")).alias("_f")).filter("families >= 2")
    siblings = planes.select(*tile, "field", "families", F.explode("_f").alias("_f")).select(*tile, "field", "families", "_f.*")
    rows = rows.join(siblings, [*tile, "field", "family"])
    rows = rows.withColumn("_w", F.greatest(F.coalesce("skill", F.lit(1.0)), F.lit(0.01)) / F.col("_siblings"))
    known = finite(F.col("value"))
    by = [*tile, *cell, "field"]
    plain = weighted_median(rows.filter("field not in ('condition_code', 'precipitation')"), by, "value", "_w", "value")
    codes = rows.filter("field = 'condition_code'").withColumn("_code", F.when(known, F.rint("value")).otherwise(0).cast("int"))
    voted = two_level_vote(codes.withColumn("_group", conditions.family(F.col("_code"))), by, "_code", "_group", "_w", "value").withColumn("value", F.col("value").cast("double"))
    wet = wet_statistics(rows.filter("field = 'precipitation'").withColumn("_v", F.when(known, F.col("value"))), by, "_v", "_w")
    amounts = wet.withColumn("value", F.col("amount")).select(*by, "value")
    odds = wet.select(*tile, *cell, F.lit("precipitation_probability").alias("field"), F.col("wet_probability").alias("value"))
    out = plain.unionByName(voted).unionByName(amounts).unionByName(odds).withColumn("value", round_even(F.col("value"), 3))
    if not quality:
        return out
    value = F.when(known, F.col("value"))
    whole = (F.col("field") != "condition_code") | (F.count(value) == F.count(F.lit(1)))
    figures = rows.groupBy(*by).agg(F.when(whole, F.max(value) - F.min(value)).alias("spread"), F.max("families").alias("families"))
    figures = figures.withColumn("confidence", F.when(F.col("field").isin(*QUALITY_FIELDS), round_even(confidence(F.col("spread"), F.col("families"), F.col("field")), 3)))
    return out.join(figures, by, "left")


def corrected_temperature(consensus: DataFrame, cells: DataFrame, tile: list[str], cell: list[str], bias: DataFrame) -> DataFrame:
    """consensus (field, value) with temperatures moved by their tile's bias (tile columns, value, samples), within what the
    models of the cell say. A bias of under three samples and a null value change nothing."""
    temperatures = cells.filter("field = 'temperature'").withColumn("_v", F.when(finite(F.col("value")), F.col("value")))
    ranges = temperatures.groupBy(*tile, *cell).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high")).withColumn("field", F.lit("temperature"))
    joined = consensus.join(ranges, [*tile, *cell, "field"], "left").join(bias.select(*tile, F.col("value").alias("_bias"), F.col("samples").alias("_n")), tile, "left")
    moved = clamped_bias(F.col("value"), F.coalesce("_bias", F.lit(0.0)), F.coalesce("_n", F.lit(0)), F.col("_low"), F.col("_high"))
    value = F.when((F.col("field") == "temperature") & (F.coalesce("_bias", F.lit(0.0)) != 0), round_even(moved, 3)).otherwise(F.col("value"))
    return joined.withColumn("value", value).drop("_low", "_high", "_bias", "_n")
