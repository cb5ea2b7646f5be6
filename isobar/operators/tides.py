"""Tides: which stations tides can be made for, their index, and those of subordinate stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.units import round_up


def subordinate_tides(events: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tides of subordinate stations from those of their reference: shifted by minutes, heights times a ratio or plus a fixed offset.

    events: station, time, type (high or low), height; stations: id, reference, high_minutes, low_minutes, high_height,
    low_height, height_kind (ratio or fixed). Second: the stations whose reference has no events or whose kind is unknown.
    """
    known = stations.join(events.select(F.col("station").alias("reference")).distinct(), "reference", "left_semi").filter("height_kind in ('ratio', 'fixed')")
    wrong = stations.join(known.select("id"), "id", "left_anti")
    joined = known.join(events, known["reference"] == events["station"])
    return joined.select("id", _shifted("time").alias("time"), "type", _scaled(F.col("height")).alias("height")), wrong


def _of_type(what: str) -> Column:
    return F.when(F.col("type") == "high", F.col(f"high_{what}")).otherwise(F.col(f"low_{what}"))


def _shifted(time: str) -> Column:
    return F.col(time) + F.make_dt_interval(F.lit(0), F.lit(0), _of_type("minutes").cast("int"))


def _scaled(height: Column) -> Column:
    return round_up(F.when(F.col("height_kind") == "ratio", height * _of_type("height")).otherwise(height + _of_type("height")), 3)


def subordinate_ranges(events: DataFrame, stations: DataFrame) -> DataFrame:
    """id, n, first, highest and lowest of the tides that subordinate_tides gives, without a row for each of them.

    Shifting keeps the order of times; scaling and rounding keep the order of heights or turn it round. So of each reference
    and type the first time and the outermost heights stand for all (NaN and infinite ones beside the finite ones), and
    stations meet a row a type of their reference instead of all its events.
    """
    h = F.col("height").cast("double")
    number, finite = F.when(~F.isnan(h), h), F.when(~F.isnan(h) & (F.abs(h) < float("inf")), h)
    ends = events.groupBy("station", F.when(F.col("type") == "high", "high").otherwise("low").alias("type")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("time").alias("_first"), F.array(F.min(h), F.max(h), F.max(number), F.min(finite), F.max(finite)).alias("_ends")
    )
    known = stations.filter("height_kind in ('ratio', 'fixed')")
    rows = known.join(ends, known["reference"] == ends["station"]).select("id", "_n", _shifted("_first").alias("_first"), F.transform("_ends", _scaled).alias("_ends"))
    return rows.groupBy("id").agg(F.sum("_n").alias("n"), F.min("_first").alias("first"), F.max(F.array_max("_ends")).alias("highest"), F.min(F.array_min("_ends")).alias("lowest"))


def tide_height(constituents: Column, hours: Column) -> Column:
    """Sum of amplitude * cos(speed * hours - phase) over constituents (structs; speed and phase in degrees)."""
    return F.aggregate(constituents, F.lit(0.0), lambda a, c: a + c["amplitude"] * F.cos(F.radians(c["speed"] * hours - c["phase"])))


def tide_slope(constituents: Column, hours: Column) -> Column:
    """Change of tide_height, up to a positive factor."""
    return F.aggregate(constituents, F.lit(0.0), lambda a, c: a - c["amplitude"] * c["speed"] * F.sin(F.radians(c["speed"] * hours - c["phase"])))


def harmonic_extremes(stations: DataFrame, start: Column, days: int, epoch: Column, minutes: int = 10, halvings: int = 20) -> DataFrame:
    """id, time, type (high or low) and height: the turns of each station's tide in days from start (a timestamp).

    stations: id, harmonics (structs of amplitude, speed and phase, in degrees an hour from epoch) and offset (height of mean
    sea level, 0 if null). A row is a station's day, dealt by both; its slope is looked at every `minutes`, and a change of
    sign is halved `halvings` times (10 minutes over 2^20 are under a thousandth of a second). Turns nearer together than
    minutes can be missed; a turn on a step's edge belongs to the step that begins with it. Stations without harmonics and
    flat tides have none.
    """
    step, steps = minutes / 60.0, 1440 // minutes
    c = F.col("harmonics")
    dealt = stations.filter(F.size("harmonics") > 0).select("id", "harmonics", F.coalesce("offset", F.lit(0.0)).alias("offset"), F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("_day")).repartition("id", "_day")
    base = (F.unix_micros(start) - F.unix_micros(epoch)) / 3.6e9
    slopes = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda k: tide_slope(c, F.col("_from") + k * F.lit(step)))
    sided = dealt.withColumn("_from", base + F.col("_day") * 24.0).withColumn("_s", slopes)
    turns = F.filter(F.sequence(F.lit(1), F.lit(steps)), lambda k: ((F.get("_s", k - 1) > 0) & (F.get("_s", k) <= 0)) | ((F.get("_s", k - 1) < 0) & (F.get("_s", k) >= 0)))
    rows = sided.select("id", "harmonics", "offset", "_from", "_s", F.explode(turns).alias("_k")).select("id", "harmonics", "offset", (F.get("_s", F.col("_k") - 1) > 0).alias("_high"), (F.col("_from") + (F.col("_k") - 1) * step).alias("_low"))

    def halved(side: Column, _: Column) -> Column:
        middle = (side["a"] + side["b"]) / 2
        rising = (tide_slope(c, middle) > 0) == F.col("_high")
        return F.struct(F.when(rising, middle).otherwise(side["a"]).alias("a"), F.when(rising, side["b"]).otherwise(middle).alias("b"))

    at = F.aggregate(F.sequence(F.lit(1), F.lit(halvings)), F.struct(F.col("_low").alias("a"), (F.col("_low") + step).alias("b")), halved)
    found = rows.withColumn("_at", (at["a"] + at["b"]) / 2)
    micros = F.unix_micros(epoch) + F.round(F.col("_at") * 3.6e9).cast("long")
    return found.select("id", F.timestamp_micros(micros).alias("time"), F.when(F.col("_high"), "high").otherwise("low").alias("type"), (F.col("offset") + tide_height(c, F.col("_at"))).alias("height"))


def predictable(station: DataFrame) -> DataFrame:
    """Stations that tides can be made for: references with harmonics, or subordinates with a reference and all offsets."""
    reference = (F.col("kind") == "reference") & (F.size("harmonics") > 0)
    offsets = F.col("reference").isNotNull() & F.col("high_minutes").isNotNull() & F.col("low_minutes").isNotNull() & F.col("high_height").isNotNull() & F.col("low_height").isNotNull()
    return station.filter(F.coalesce(reference, F.lit(False)) | ((F.col("kind") == "subordinate") & offsets))


def selected_stations(stations: DataFrame, *, commercial_only: bool = True, ids: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Stations that tides can be made for, references first, then by id; commercial_only: whose licence allows commercial use;
    ids: a table of the ids asked for; most: so many of them at most (a feature of the job, not a limit of its own)."""
    out = predictable(stations)
    if commercial_only:
        out = out.filter(F.coalesce(F.col("commercial_use"), F.lit(False)))
    if ids is not None:
        out = out.join(ids.select("id").distinct(), "id", "left_semi")
    out = out.orderBy(F.when(F.col("kind") == "reference", 0).otherwise(1), F.collate("id", "UNICODE"), "id")
    return out if most is None else out.limit(most)


def datum_offset(datums: Column, chart_datum: Column) -> Column:
    """Mean sea level (0 if not given) less the chart datum; 0 where that isn't a number."""
    chart = F.try_element_at(datums, chart_datum)
    return F.when(chart.isNotNull(), F.coalesce(F.try_element_at(datums, F.lit("MSL")), F.lit(0.0)) - chart).otherwise(0.0)


def station_index(stations: DataFrame, names: DataFrame, quality: DataFrame) -> DataFrame:
    """Twenty columns that tell of a station; names (id, name) replace its own, quality (id, accepted) is false where missing."""
    rows = stations.join(names.select("id", F.col("name").alias("_name")), "id", "left").join(quality.select("id", "accepted"), "id", "left")
    c = F.col
    return rows.select(
        "id", F.coalesce("_name", "name").alias("name"), c("source.name").alias("sourceName"), c("source.id").alias("sourceId"), c("source.url").alias("sourceUrl"), c("license.type").alias("license"), c("license.url").alias("licenseUrl"),
        F.coalesce(c("commercial_use"), F.lit(False)).alias("commercialUse"), c("kind").alias("stationType"), c("reference").alias("referenceStationId"), "country", "region", "continent", F.coalesce("timezone", F.lit("UTC")).alias("timezone"),
        "latitude", "longitude", c("chart_datum").alias("chartDatum"), c("datums_source").alias("datumsSource"), F.coalesce("accepted", F.lit(False)).alias("qualityAccepted"), K.given(c("disclaimers"), F.lit("No obvious issues")).alias("quality"),
    )


def event_files(index: DataFrame, events: DataFrame, now: Column, days: int = 45) -> DataFrame:
    """The index with eventPath, eventCount and the station's events of the days from the start of now's day, by time.

    A station has a few events a day, so its array grows with days alone; one without events has an empty one.
    """
    first, last = K.day_start(now), K.day_start(now, days)
    inside = events.filter((F.col("time") >= first) & (F.col("time") <= last)).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("time", "type", "height"))).alias("events"))
    rows = index.join(inside, "id", "left").withColumn("events", F.coalesce("events", F.array().cast("array<struct<time:timestamp,type:string,height:double>>")))
    return rows.withColumns({"eventPath": F.concat(F.lit("events/"), K.file_id(F.col("id")), F.lit(".json")), "eventCount": F.size("events")})


def write_events(files: DataFrame, path: str) -> None:
    """A folder for each station below path/events, and the index without the events beside them."""
    files.withColumn("station", K.file_id(F.col("id"))).write.mode("overwrite").partitionBy("station").json(f"{path}/events")
    files.drop("events").write.mode("overwrite").json(f"{path}/stations")
