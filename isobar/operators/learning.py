"""Learning of providers' skill: nearest forecasts, errors, running scores, biases and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.units import HPA_PER_INHG, KMH_PER_KNOT, MM_PER_INCH, round_even
from .consensus import finite


def nearest_in_time(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, left_id: str, right_id: str, minutes: int = 90) -> DataFrame:
    """Each left row with the right row of the same keys nearest in time, within minutes; of equals the least right_id.

    Times are dealt into buckets of that width. A bucket's right rows stand in it in order, and for its two neighbours only
    the last and the first of them do, as no other can be the nearest; within a bucket the rows of both sides are put in
    order together, once by ascending and once by descending time, and each left row takes the last right row before it in
    either order. Both are running values: no pairs are made, the time grows with a bucket's rows (and their sorting), and a
    bucket has rows by rate and width, not by the table's length.
    """
    width = minutes * 60 * 1_000_000
    values = [c for c in right.columns if c not in on]
    a = left.withColumn("_t", F.unix_micros(F.col(left_time).cast("timestamp"))).withColumn("_b", F.floor(F.col("_t") / width))
    b = right.withColumn("_t", F.unix_micros(F.col(right_time).cast("timestamp"))).filter("_t is not null").withColumn("_b", F.floor(F.col("_t") / width))
    # of equal times the least id stands for all
    b = b.groupBy(*on, "_b", "_t").agg(F.min_by(F.struct(*values), F.col(right_id)).alias("_r"))
    ends = b.groupBy(*on, "_b").agg(F.max_by(F.struct("_t", "_r"), "_t").alias("_z"), F.min_by(F.struct("_t", "_r"), "_t").alias("_a"))
    over = ends.select(*on, (F.col("_b") + 1).alias("_b"), "_z._t", "_z._r").unionByName(ends.select(*on, (F.col("_b") - 1).alias("_b"), "_a._t", "_a._r"))
    own = a.select(*on, "_b", "_t", F.struct(*[F.col(c) for c in left.columns]).alias("_l"))
    both = own.unionByName(b.unionByName(over), allowMissingColumns=True)
    seen = F.when(F.col("_r").isNotNull(), F.struct("_t", "_r"))
    upto = lambda order: F.last(seen, ignorenulls=True).over(Window.partitionBy(*on, "_b").orderBy(order).rangeBetween(Window.unboundedPreceding, 0))
    both = both.withColumn("_before", upto(F.asc("_t"))).withColumn("_after", upto(F.desc("_t")))
    rows = both.filter("_l is not null").withColumns({"_g": F.col("_t") - F.col("_before._t"), "_h": F.col("_after._t") - F.col("_t")})
    nearer = (F.col("_g") < F.col("_h")) | F.col("_h").isNull() | ((F.col("_g") == F.col("_h")) & (F.col(f"_before._r.{right_id}") <= F.col(f"_after._r.{right_id}")))
    best = rows.withColumn("_n", F.when(F.coalesce(nearer, F.lit(False)), F.col("_before._r")).otherwise(F.col("_after._r"))).withColumn("_gap", F.least("_g", "_h")).filter(F.col("_gap") <= width)
    rest = [F.col(f"_l.{c}").alias(c) for c in left.columns if c != left_id and c not in on]
    return best.select(F.col(f"_l.{left_id}").alias(left_id), *on, *rest, *[F.col(f"_n.{c}").alias(c) for c in values], (F.col("_gap") / 1e6).alias("gap"))


def forecast_error(forecast: dict[str, Column], observed: dict[str, Column], wet: tuple[float, float] = (0.05, 0.1)) -> Column:
    """Mean of the errors that can be had: temperature over 2, wind over 10, dewpoint over 3, pressure over 4, and 1 for the wrong wetness."""
    terms = [F.abs(forecast[k] - observed[k]) / s for k, s in (("temperature", 2.0), ("wind", 10.0), ("dewpoint", 3.0), ("pressure", 4.0)) if k in forecast and k in observed]
    if "precipitation" in forecast and "precipitation" in observed:
        terms.append(((forecast["precipitation"] >= wet[0]) != (observed["precipitation"] >= wet[1])).cast("double"))
    known = F.filter(F.array(*terms), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def ema_fold(df: DataFrame, by: list[str], value: str, order: list[str], alpha: float, places: int, out: str, previous: DataFrame | None = None, pieces: Column | None = None) -> DataFrame:
    """by, out and samples: the running mean a + alpha (x - a) over values in order, rounded at the end, and how many went in.

    previous (by, out, samples) is where it starts; without, at 0 with none. The mean is a sum with powers of 1 - alpha by
    the number of later values, so no group is held as one array. pieces is a column that never decreases in the order (a
    day, say): the rows of a piece are numbered in a task of their own, and only one row a piece is summed up over them.
    Null values are left out. Groups of previous without new values keep theirs.
    """
    keep = 1 - alpha
    rows = df.filter(F.col(value).isNotNull()).withColumn("_piece", F.lit(0) if pieces is None else pieces)
    later = F.row_number().over(Window.partitionBy(*by, "_piece").orderBy(*[F.col(c).desc() for c in order])) - 1
    parts = rows.withColumn("_later", later).groupBy(*by, "_piece").agg(F.sum(alpha * F.col(value) * F.pow(F.lit(keep), F.col("_later"))).alias("_v"), F.count(F.lit(1)).alias("_n"))
    after = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy(F.col("_piece").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = parts.withColumn("_after", after).groupBy(*by).agg(F.sum(F.col("_v") * F.pow(F.lit(keep), F.col("_after"))).alias("_v"), F.sum("_n").alias("_n"))
    if previous is None:
        return sums.select(*by, round_even(F.col("_v"), places).alias(out), F.col("_n").alias("samples"))
    joined = sums.join(previous.select(*by, F.col(out).alias("_old"), F.col("samples").alias("_before")), by, "full")
    n = F.coalesce("_n", F.lit(0))
    folded = F.coalesce("_old", F.lit(0.0)) * F.pow(F.lit(keep), n) + F.coalesce("_v", F.lit(0.0))
    return joined.select(*by, round_even(folded, places).alias(out), (F.coalesce("_before", F.lit(0)) + n).cast("long").alias("samples"))


#: Fixed value: errors that a history holds.
HISTORY = 48


def last_values(values: Column, n: int = HISTORY) -> Column:
    return F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), F.lit(n))


def updated_scores(samples: DataFrame, state: DataFrame, by: list[str], provider: str, error: str, order: list[str], alpha: float = 0.15) -> DataFrame:
    """by, provider, score, sample_count, history and weight from new errors and the state before (same columns).

    The score moves by alpha to the mean error (from 1 without a state), the history holds the last 48 errors; the weight is
    exp(-(half the score + half the history's median)), with floors, as shares of the group.
    """
    good = samples.filter(finite(F.col(error)))
    recent = F.row_number().over(Window.partitionBy(*by, provider).orderBy(*[F.col(c).desc() for c in order]))
    last = good.withColumn("_k", recent).filter(F.col("_k") <= HISTORY)  # Spark keeps so many rows a group before it shuffles them
    lists = last.groupBy(*by, provider).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(error).alias("_e")))).alias("_l"))
    new = good.groupBy(*by, provider).agg(F.avg(error).alias("_mean"), F.count(F.lit(1)).alias("_n")).join(lists, [*by, provider])
    both = new.join(state.select(*by, provider, F.col("score").alias("_s"), F.col("sample_count").alias("_c"), F.col("history").alias("_h")), [*by, provider], "full")
    old = F.coalesce("_s", F.lit(1.0))
    history = last_values(F.concat(F.coalesce("_h", F.array().cast("array<double>")), F.coalesce(F.transform("_l", lambda x: x["_e"]), F.array().cast("array<double>"))))
    df = both.select(*by, provider, F.when(F.col("_mean").isNull(), old).otherwise(alpha * F.col("_mean") + (1 - alpha) * old).alias("score"), (F.coalesce("_c", F.lit(0)) + F.coalesce("_n", F.lit(0))).cast("long").alias("sample_count"), history.alias("history"))
    ordered = F.array_sort("history")
    n = F.size("history")
    median = (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2
    f = F.greatest(F.exp(-(0.5 * F.col("score") + 0.5 * F.coalesce(median, F.col("score")))), F.lit(0.01))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    df = df.withColumn("_f", f).withColumn("_w", F.greatest(F.col("_f") / F.sum("_f").over(group), F.lit(0.02)))
    return df.withColumn("weight", F.col("_w") / F.sum("_w").over(group)).drop("_f", "_w")


def grouped_errors(df: DataFrame, region: str, bucket: str, provider: str, error: str) -> DataFrame:
    """Counts and least and largest errors per region, bucket and provider and, with region and bucket `*`, per provider."""
    sets = df.groupingSets([[F.col(region), F.col(bucket), F.col(provider)], [F.col(provider)]], F.col(region), F.col(bucket), F.col(provider))
    out = sets.agg(F.count(F.lit(1)).alias("n"), F.min(error).alias("least"), F.max(error).alias("most"), F.grouping(region).alias("_g"))
    star = lambda c: F.when(F.col("_g") == 1, "*").otherwise(F.col(c).cast("string")).alias(c)
    return out.select(star(region), star(bucket), provider, "n", "least", "most")


def merged_state(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both by keys; a new row's values count before the old one's."""
    values = [c for c in old.columns if c not in keys]
    renamed = new.select(*keys, *[F.col(c).alias(f"_{c}") for c in values])
    return old.join(renamed, keys, "full").select(*keys, *[F.coalesce(f"_{c}", c).alias(c) for c in values])


def regional_or_global(df: DataFrame, regional: DataFrame, everywhere: DataFrame, keys: list[str], provider: str, weight: str, out: str) -> DataFrame:
    """df with out: the weight of the region's own map where the region has one (even if it lacks the provider), else the global weight."""
    has = regional.select(*keys).distinct().withColumn("_own", F.lit(True))
    joined = df.join(has, keys, "left").join(regional.select(*keys, provider, F.col(weight).alias("_r")), [*keys, provider], "left").join(everywhere.select(provider, F.col(weight).alias("_g")), provider, "left")
    return joined.withColumn(out, F.when(F.col("_own"), F.col("_r")).otherwise(F.col("_g"))).drop("_own", "_r", "_g")


def validation(df: DataFrame, by: list[str], predicted: str, observed: str, probability: str, event: str) -> DataFrame:
    """Mean absolute error, bias, Brier score and accuracy per group, each over the rows that have it."""
    d = F.col(predicted) - F.col(observed)
    return df.groupBy(*by).agg(
        F.avg(F.abs(d)).alias("mae"),
        F.avg(d).alias("bias"),
        F.avg(F.pow(F.col(probability) - F.col(event), F.lit(2.0))).alias("brier"),
        F.avg((F.col(predicted) == F.col(observed)).cast("double")).alias("accuracy"),
        F.count(d).alias("n"),
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the row that comes last in order."""
    values = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v"))
    return last.select(*keys, "_v.*")


#: Fields that forecasts and observations share, and their names in forecast_error.
SHARED = {"temperature_c": "temperature", "wind_kmh": "wind", "dewpoint_c": "dewpoint", "pressure_hpa": "pressure", "precipitation_mm": "precipitation"}


def observation_values(reports: DataFrame) -> DataFrame:
    """reports with the SHARED fields in the units of forecasts, from temperature_c, wind_kt, dewpoint_c, pressure_hpa,
    altimeter_in_hg (only where there is no pressure) and precipitation_in."""
    return reports.withColumns(
        {
            "wind_kmh": F.col("wind_kt") * KMH_PER_KNOT,
            "pressure_hpa": F.coalesce("pressure_hpa", F.col("altimeter_in_hg") * HPA_PER_INHG),
            "precipitation_mm": F.col("precipitation_in") * MM_PER_INCH,
        }
    )


def station_errors(observations: DataFrame, forecasts: DataFrame, minutes: int = 90) -> DataFrame:
    """A row for each observed station and provider with a forecast near in time: station, provider, region, bucket, holdout,
    observed_at, longitude, error, and both sides' fields (forecast ones as f_...).

    observations: station, observed_at, latitude, longitude and the SHARED fields; a station's last one (by time, then by its
    values) counts. forecasts: provider, station, valid_time, lead_hours, ordinal (which of equally near ones is first) and
    the SHARED fields. Stations without a place are left out.
    """
    own = latest_per_key(observations.select("station", "observed_at", "latitude", "longitude", *SHARED), ["station"], ["observed_at", *SHARED]).filter("latitude is not null and longitude is not null")
    renamed = forecasts.select("provider", "station", "valid_time", "lead_hours", "ordinal", *[F.col(c).alias(f"f_{c}") for c in SHARED])
    pairs = own.join(renamed.select("station", "provider").distinct(), "station").withColumn("_pair", F.struct("station", "provider"))
    near = nearest_in_time(pairs, renamed, ["station", "provider"], "observed_at", "valid_time", "_pair", "ordinal", minutes)
    error = forecast_error({n: F.col(f"f_{c}") for c, n in SHARED.items()}, {n: F.col(c) for c, n in SHARED.items()})
    return near.select(
        "station", "provider", K.region_key(F.col("latitude"), F.col("longitude")).alias("region"), K.lead_bucket(F.col("lead_hours")).alias("bucket"), K.is_holdout(F.col("station")).alias("holdout"),
        "observed_at", "longitude", error.alias("error"), *SHARED, *[f"f_{c}" for c in SHARED],
    )


def holdout_errors(errors: DataFrame) -> DataFrame:
    """Errors of held-out stations (region, bucket, provider, station, error), and as provider `consensus` that of the plain
    median of two providers or more, in every bucket that one of them stands in."""
    held = errors.filter("holdout")
    group = ["station", "region", "observed_at"]
    blended = held.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.collect_set("bucket").alias("_buckets"), *[F.max(c).alias(c) for c in SHARED], *[F.median(f"f_{c}").alias(f"f_{c}") for c in SHARED]).filter("_n >= 2")
    error = forecast_error({n: F.col(f"f_{c}") for c, n in SHARED.items()}, {n: F.col(c) for c, n in SHARED.items()})
    consensus = blended.select("region", F.explode("_buckets").alias("bucket"), F.lit("consensus").alias("provider"), "station", error.alias("error"))
    return held.select("region", "bucket", "provider", "station", "error").unionByName(consensus).filter("error is not null")


def bias_samples(errors: DataFrame) -> DataFrame:
    """region, period (day or night by the solar hour), station, observed_at and sample: the observed temperature less the median of two
    providers or more, at stations that aren't held out."""
    rows = errors.filter("not holdout and temperature_c is not null")
    grouped = rows.groupBy("region", "station", "observed_at", "longitude", "temperature_c").agg(F.median("f_temperature_c").alias("_m"), F.count("f_temperature_c").alias("_n")).filter("_n >= 2")
    period = F.when(K.is_night(F.col("observed_at"), F.col("longitude")), "night").otherwise("day")
    return grouped.select("region", period.alias("period"), "station", "observed_at", (F.col("temperature_c") - F.col("_m")).alias("sample"))


def scored_providers(errors: DataFrame, scores: DataFrame, biases: DataFrame, alpha: float = 0.15) -> dict[str, DataFrame]:
    """The learning state after the errors of station_errors: skill, bias and validation.

    skill: region, bucket, provider, score, sample_count, history and weight, with region and bucket `*` over all regions;
    scores is the skill before. Only stations that aren't held out count; errors are taken in the order of stations. bias:
    region, period, value and samples, from biases (the same) and bias_samples. validation: region, bucket, provider and mae
    of held-out stations and of their consensus, of these errors only.
    """
    known = errors.filter("not holdout and error is not null").select("region", "bucket", "provider", "station", "error")
    every = known.withColumns({"region": F.lit("*"), "bucket": F.lit("*")})
    skill = updated_scores(known.unionByName(every), scores, ["region", "bucket"], "provider", "error", ["station"], alpha)
    bias = ema_fold(bias_samples(errors), ["region", "period"], "sample", ["station", "observed_at"], 0.2, 3, "value", biases, F.substring("station", 1, 3))  # stations of three letters a task
    regions = skill.filter("region <> '*'").select("region").unionByName(bias.select("region")).distinct()
    periods = regions.select("region", F.explode(F.array(F.lit("day"), F.lit("night"))).alias("period"))
    bias = periods.join(bias, ["region", "period"], "left").select("region", "period", F.coalesce("value", F.lit(0.0)).alias("value"), F.coalesce("samples", F.lit(0)).cast("long").alias("samples"))
    mae = holdout_errors(errors).groupBy("region", "bucket", "provider").agg(round_even(F.avg("error"), 4).alias("mae"))
    return {"skill": skill, "bias": bias, "validation": mae}


def holdout_stations(observations: DataFrame) -> DataFrame:
    """One row: how many observed stations are held out, with a place or not."""
    return observations.select("station").distinct().agg(F.count_if(K.is_holdout(F.col("station"))).alias("holdout_stations"))


def validated_hours(forecasts: DataFrame, observations: DataFrame) -> DataFrame:
    """One row of figures of hourly forecasts (valid_time, ordinal, temperature_c, wind_kmh, probability, condition) against the
    nearest observations (observed_at, ordinal and the same) within 90 minutes, each over the hours that have both."""
    left = forecasts.select(F.col("ordinal").alias("_id"), "valid_time", *[F.col(c).alias(f"f_{c}") for c in ("temperature_c", "wind_kmh", "probability", "condition")])
    right = observations.select("ordinal", "observed_at", "temperature_c", "wind_kmh", "precipitation_mm", "condition")
    near = nearest_in_time(left, right, [], "valid_time", "observed_at", "_id", "ordinal")
    d, w = F.col("f_temperature_c") - F.col("temperature_c"), F.col("f_wind_kmh") - F.col("wind_kmh")
    wet = F.when(F.col("precipitation_mm").isNotNull(), (F.col("precipitation_mm") >= 0.1).cast("double"))
    return near.agg(
        F.count(F.lit(1)).alias("matched_hours"), F.avg(F.abs(d)).alias("temperature_mae_c"), F.avg(d).alias("temperature_bias_c"), F.avg(F.abs(w)).alias("wind_mae_kmh"), F.avg(w).alias("wind_bias_kmh"),
        F.avg(F.pow(F.col("f_probability") - wet, F.lit(2.0))).alias("rain_brier_score"), F.avg((F.col("f_condition") == F.col("condition")).cast("double")).alias("condition_accuracy"),
    )
