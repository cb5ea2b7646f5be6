"""Products of gridded forecasts: provider fields, tiles and packs, station samples, daily extremes and storm layers.

Grids are long: a row for each cell, by its row and column (y, x), with lat and lon. Values of fields are columns where one
model's fields are worked out from each other, and rows (field, value) where models meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import conditions, fields, units
from ..functions import keys as K
from . import grids
from .consensus import finite

#: Size of a tile and of its overview's stride, hours that a limited model reaches, decimal places of fields.
TILE, STRIDE, LIMITED_HOURS = 20, 4, 120
THREE_PLACES = ("humidity", "precipitation", "snowfall")


def first_field(df: DataFrame, names: tuple[str, ...]) -> Column | None:
    """The first of the names that is a column of df."""
    have = [n for n in names if n in df.columns]
    return F.col(have[0]) if have else None


def provider_fields(raw: DataFrame, by: list[str], hour: str = "hour") -> DataFrame:
    """by, hour and the fields of a model in one set of units, from a wide grid with columns under any of fields.ALIASES.

    temperature (K) must be there. Amounts of rain and snow become millimetres (by precipitation_units and snowfall_units,
    where there are such columns) and, where start_step is 0 and end_step isn't, amounts since the hour before. Percentages
    become fractions; humidity follows from the dewpoint where it is missing; a condition code is derived. A field that no
    alias carries isn't there.
    """
    found = {name: first_field(raw, names) for name, names in fields.ALIASES.items()}
    have = {name: c for name, c in found.items() if c is not None}
    df = raw.select(*by, hour, F.col("temperature"), *[c.cast("double").alias(n) for n, c in have.items()], *[c for c in ("precipitation_units", "snowfall_units", "start_step", "end_step") if c in raw.columns])
    for name in ("precipitation", "snowfall"):
        if name in have:
            if f"{name}_units" in raw.columns:
                df = df.withColumn(name, units.precipitation_mm(F.col(name), F.col(f"{name}_units")))
            if "start_step" in raw.columns:
                running = (F.col("start_step") == 0) & F.coalesce(F.col("end_step") != 0, F.lit(False))
                df = grids.interval_amounts(df.withColumn("_running", F.coalesce(running, F.lit(False))), by, hour, name, "_running", name).drop("_running")
    if "cloud_cover" in have:
        df = df.withColumn("cloud_cover", units.fraction(F.col("cloud_cover")))
    if "humidity" in have:
        df = df.withColumn("humidity", units.fraction(F.col("humidity")))
    elif "dewpoint" in have:
        df = df.withColumn("humidity", units.humidity(F.col("temperature") - 273.15, F.col("dewpoint") - 273.15))
    get = lambda n: F.col(n) if n in have else None
    df = df.withColumn("condition_code", conditions.condition(get("cloud_cover"), get("precipitation"), get("convective"), get("snowfall"), F.col("temperature"), get("dewpoint")).cast("double"))
    return df.select(*by, hour, *[n for n in fields.CHANNELS if n in df.columns])


def long_fields(wide: DataFrame, by: list[str]) -> DataFrame:
    """by, field and value of the fields that wide has as columns, rounded as tiles are (three places for fractions and
    amounts, one for others); missing values stay."""
    have = [n for n in fields.CHANNELS if n in wide.columns]
    rows = wide.select(*by, F.explode(F.array(*[F.struct(F.lit(n).alias("field"), units.round_even(F.col(n).cast("double"), 3 if n in THREE_PLACES else 1).alias("value")) for n in have])).alias("f"))
    return rows.select(*by, "f.field", "f.value")


def within_reach(df: DataFrame, model: str, hour: str) -> DataFrame:
    """Without the hours that a limited model doesn't reach."""
    return df.filter((F.col(model) != "icon") | (F.col(hour) <= LIMITED_HOURS))


def layer_components(df: DataFrame, by: list[str], kind: str, job: str = "", low: str | None = None, high: str | None = None, models: dict[str, str] | None = None) -> DataFrame:
    """by, channel and value of a map layer: channels 2 and 3 of a vector (columns u and v), else channel 0 (column value) and,
    for temperatures, 10 and 11 from the columns low and high and the models' channels from the columns that models names.
    Missing values become 0, as in map tiles."""
    places = 3 if job in ("snow", "smoke", "dust", "air_quality") else 1
    if kind == "vector":
        parts = {2: ("u", 1), 3: ("v", 1)}
    else:
        parts = {0: ("value", places)}
        if job == "temp" and low and high:
            parts |= {10: (low, places), 11: (high, places)} | {fields.MAP_CHANNELS[m]: (c, places) for m, c in (models or {}).items() if m != "gfs"}
    value = lambda c, p: units.grid_value(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), p, preserve=False)
    rows = df.select(*by, F.explode(F.array(*[F.struct(F.lit(k).alias("channel"), value(c, p).alias("value")) for k, (c, p) in parts.items()])).alias("p"))
    return rows.select(*by, "p.channel", "p.value")


def tiled(cells: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """cells with tile_lat, tile_lon, tile, pack_lat and pack_lon; a cell on the border of tiles is in each of them."""
    south = lambda x, low, high: F.array_distinct(F.filter(F.array(F.floor((x - low) / TILE) * TILE + low, F.ceil((x - low) / TILE) * TILE + low - TILE), lambda s: (s >= low) & (s < high)))
    rows = cells.withColumn("tile_lat", F.explode(south(F.col(lat), -90, 90))).withColumn("tile_lon", F.explode(south(F.col(lon), -180, 180)))
    rows = rows.withColumns({"tile_lat": F.col("tile_lat").cast("int"), "tile_lon": F.col("tile_lon").cast("int")})
    pack_lat, pack_lon = K.pack_origin(F.col("tile_lat"), F.col("tile_lon"))
    name = F.concat(K.corner_label(F.col("tile_lat"), "N", "S"), F.lit("_"), K.corner_label(F.col("tile_lon"), "E", "W"))
    return rows.withColumns({"tile": name, "pack_lat": pack_lat, "pack_lon": pack_lon})


def planes(cells: DataFrame, by: list[str], channel: str = "channel", value: str = "value") -> DataFrame:
    """by, channel, lon0, lat0, dx, dy, width, height and plane of cells (lat, lon): rows from north to south, each from west to
    east. A cell that isn't there is null. by names one tile or overview, whose size bounds its plane."""
    geometry = cells.groupBy(*by).agg(F.array_sort(F.collect_set("lon")).alias("_lons"), F.reverse(F.array_sort(F.collect_set("lat"))).alias("_lats"))
    step = lambda a: F.when(F.size(a) > 1, (F.element_at(a, -1) - F.get(a, F.lit(0))) / (F.size(a) - 1)).otherwise(1.0)
    listed = cells.groupBy(*by, channel).agg(F.map_from_entries(F.collect_list(F.struct(F.struct(F.col("lat").alias("a"), F.col("lon").alias("b")), F.col(value)))).alias("_m"))
    joined = listed.join(geometry, by)
    plane = F.flatten(F.transform("_lats", lambda a: F.transform("_lons", lambda b: F.try_element_at("_m", F.struct(a.alias("a"), b.alias("b"))))))
    return joined.select(*by, channel, F.get("_lons", F.lit(0)).alias("lon0"), F.get("_lats", F.lit(0)).alias("lat0"), step(F.col("_lons")).alias("dx"), step(F.col("_lats")).alias("dy"), F.size("_lons").alias("width"), F.size("_lats").alias("height"), plane.alias("plane"))


def overview_cells(cells: DataFrame, by: list[str]) -> DataFrame:
    """Cells (tiled) of a pack's overview: every STRIDE-th row and column, from north and west, of all its tiles' cells; key is
    the overview's name."""
    own = [*by, "pack_lat", "pack_lon"]
    rows = cells.dropDuplicates([*own, "lat", "lon", *(["channel"] if "channel" in cells.columns else [])])
    lats = rows.select(*own, "lat").distinct().withColumn("_y", F.row_number().over(Window.partitionBy(*own).orderBy(F.col("lat").desc())) - 1).filter(F.col("_y") % STRIDE == 0)
    lons = rows.select(*own, "lon").distinct().withColumn("_x", F.row_number().over(Window.partitionBy(*own).orderBy("lon")) - 1).filter(F.col("_x") % STRIDE == 0)
    kept = rows.join(lats.drop("_y"), [*own, "lat"]).join(lons.drop("_x"), [*own, "lon"])
    return kept.withColumn("key", K.overview_key(F.col("pack_lat"), F.col("pack_lon")))


def copied_into(targets: DataFrame, sources: DataFrame, by: list[str], extent: list[str]) -> DataFrame:
    """targets (by, lat, lon) with value of the source cell (by, extent columns, lat0, lon0, dx, dy, width, height, plane) nearest
    to it, for the sources whose extent holds the target within 1e-4; of several the one with the largest extent columns.

    by names a pack, so a target meets the few tiles of its pack only.
    """
    joined = targets.join(sources, by)
    far_lon, far_lat = F.col("lon0") + F.col("dx") * (F.col("width") - 1), F.col("lat0") + F.col("dy") * (F.col("height") - 1)
    inside = lambda x, a, z: (x >= F.least(a, z) - 1e-4) & (x <= F.greatest(a, z) + 1e-4)
    hit = joined.filter(inside(F.col("lon"), F.col("lon0"), far_lon) & inside(F.col("lat"), F.col("lat0"), far_lat))
    index = lambda x, x0, d, n: F.least(F.greatest(F.rint((x - x0) / d).cast("int"), F.lit(0)), n - 1)
    value = F.get("plane", index(F.col("lat"), F.col("lat0"), F.col("dy"), F.col("height")) * F.col("width") + index(F.col("lon"), F.col("lon0"), F.col("dx"), F.col("width")))
    best = hit.groupBy(*by, "lat", "lon").agg(F.max_by(value, F.struct(*extent)).alias("value"))
    return targets.join(best, [*by, "lat", "lon"], "left")


def horizons(tiles: DataFrame, by: list[str] = ["model", "tile"]) -> DataFrame:  # noqa: B006
    """A row for each model and tile with its hours in order, and days: the tile's hours are one pack."""
    return tiles.groupBy(*by).agg(F.array_sort(F.collect_set("hour")).alias("hours"), (F.floor(F.max("hour") / 24) + 1).cast("int").alias("days"))


def models_manifest(channels: DataFrame) -> DataFrame:
    """model, hours, day_count and fields (in channel order) of the rows (model, tile, hour, channel) that tiles' headers give."""
    names = F.create_map(*[F.lit(x) for n, c in fields.CHANNELS.items() for x in (c, n)])
    told = channels.groupBy("model").agg(F.array_sort(F.collect_set("hour")).alias("hours"), (F.floor(F.max("hour") / 24) + 1).cast("int").alias("day_count"), F.array_sort(F.collect_set("channel")).alias("_c"))
    return told.select("model", "hours", "day_count", F.filter(F.transform("_c", lambda c: F.try_element_at(names, c.cast("int"))), lambda n: n.isNotNull()).alias("fields"))


def tile_index(paths: DataFrame, path: str = "path") -> DataFrame:
    """paths with model, hour, day and tile read from names such as `gfs/6h_N50_W20.gtile`; other names are left out."""
    pattern = r"([^/]+)/(\d+)h_([NS]\d+_[EW]\d+)\.gtile$"
    part = lambda k: F.regexp_extract(path, pattern, k)
    rows = paths.filter(F.col(path).rlike(pattern)).withColumns({"model": part(1), "hour": part(2).cast("int"), "tile": part(3)})
    return rows.withColumn("day", K.forecast_day(F.col("hour")))


def packs_present(files: DataFrame, models: DataFrame) -> DataFrame:
    """tile and the models (in the order of models: model, ordinal) whose pack of it exists (files: model, tile)."""
    there = files.select("model", "tile").distinct().join(models, "model")
    return there.groupBy("tile").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "model"))), lambda x: x["model"]).alias("models"))


def station_samples(planes: DataFrame, stations: DataFrame, reference: Column) -> DataFrame:
    """Forecasts at stations (station, latitude, longitude) from planes (provider, tile, hour, field, lon0, lat0, dx, dy, width,
    height, plane): bilinear values of the tile that holds the station, in the units of observations.

    Stations are put into tiles by their place, so a plane meets its own tile's stations only.
    """
    placed = stations.withColumn("tile", K.tile_name(F.col("latitude"), F.col("longitude")))
    wanted = ("temperature", "dewpoint", "wind_u", "wind_v", "pressure", "precipitation")
    joined = planes.filter(F.col("field").isin(*wanted)).join(placed, "tile")
    x, y = (F.col("longitude") - F.col("lon0")) / F.col("dx"), (F.col("latitude") - F.col("lat0")) / F.col("dy")
    value = grids.bilinear(F.col("plane"), F.col("width"), F.col("height"), x, y)
    rows = joined.groupBy("provider", "station", "latitude", "longitude", F.col("hour").alias("lead_hours")).agg(*[F.max(F.when(F.col("field") == n, value)).alias(n) for n in wanted])
    return forecast_values(rows.withColumn("valid_time", K.valid_time(reference, F.col("lead_hours"))))


def forecast_values(rows: DataFrame) -> DataFrame:
    """rows with temperature_c, dewpoint_c, wind_kmh, pressure_hpa and precipitation_mm instead of K, m/s, Pa and mm."""
    out = {
        "temperature_c": F.col("temperature") - 273.15, "dewpoint_c": F.col("dewpoint") - 273.15, "wind_kmh": units.wind_speed(F.col("wind_u"), F.col("wind_v")) * 3.6,
        "pressure_hpa": F.col("pressure") / 100.0, "precipitation_mm": F.col("precipitation"),
    }
    return rows.withColumns(out).drop("temperature", "dewpoint", "wind_u", "wind_v", "pressure", "precipitation")


def daily_products(cells: DataFrame, blend: DataFrame, by: list[str], cell: list[str], last_day: int = 14) -> DataFrame:
    """by, cell, day, field, model, channel_high, channel_low, high and low: daily extremes of five fields of each model, and of
    the blend.

    cells and blend are wide (by, cell, hour and fields; cells with model). A model's day counts only where its hours cover
    it (grids.covered_days), asked of the tile and not of a cell; the blend's always does. Values that aren't plausible are
    missing; days from 0 to last_day.
    """
    hours = cells.select(*by, "model", "hour").distinct()
    covered = grids.covered_days(hours, [*by, "model"], "hour").select(*by, "model", "day")
    rows = cells.withColumn("day", K.forecast_day(F.col("hour"))).join(covered, [*by, "model", "day"], "left_semi")
    rows = rows.unionByName(blend.withColumns({"model": F.lit("blend"), "day": K.forecast_day(F.col("hour"))}), allowMissingColumns=True).filter(F.col("day").between(0, last_day))
    value = {"wind_speed": units.wind_speed(F.col("wind_u"), F.col("wind_v"))} | {n: F.col(n) for n in ("temperature", "wind_gust", "pressure", "humidity")}
    limit = {n: "gust" if n == "wind_gust" else n for n in fields.DAILY}
    told = F.array(*[F.struct(F.lit(n).alias("field"), F.when(finite(value[n]), units.plausible(value[n].cast("double"), limit[n])).alias("v")) for n in fields.DAILY])
    long = rows.select(*by, *cell, "day", "model", F.explode(told).alias("f")).select(*by, *cell, "day", "model", "f.field", "f.v")
    places = lambda c: F.when(F.col("field") == "humidity", units.round_even(c, 3)).otherwise(units.round_even(c, 1))
    out = long.groupBy(*by, *cell, "day", "field", "model").agg(F.max("v").alias("high"), F.min("v").alias("low"))
    channel = lambda e: fields.daily_channel(F.col("field"), F.lit(e), F.col("model"))
    return out.withColumns({"high": places(F.col("high")), "low": places(F.col("low")), "channel_high": channel("high"), "channel_low": channel("low")})


def storm_layer(required: dict[str, DataFrame], optional: dict[str, DataFrame], on: list[str], wind: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """on and storm_potential (0 to 100), or with wind (its two parts) u and v times the potential (0 to 1).

    required has cape and composite_reflectivity; optional any of cin, precipitation_rate, convective_precipitation_rate,
    precipitable_water, dewpoint, wind_u_500, wind_v_500, wind_u_850 and wind_v_850, all as on and value. A cell must be in
    all that are given; an input that isn't given leaves its factor out (shear needs all four winds).
    """
    joined = grids.aligned(required | optional, on, "value")
    get = lambda n: F.col(n) if n in optional else None
    winds = [get(f"wind_{c}_{level}") for level in ("500", "850") for c in "uv"]
    shear = None if any(w is None for w in winds) else F.hypot(winds[0] - winds[2], winds[1] - winds[3])
    score = conditions.storm_index(F.col("cape"), F.col("composite_reflectivity"), rate=get("precipitation_rate"), convective_rate=get("convective_precipitation_rate"), pwat=get("precipitable_water"), dewpoint=get("dewpoint"), cin=get("cin"), shear=shear)
    if wind is None:
        return joined.select(*on, (score * 100.0).alias("storm_potential"))
    u, v = wind
    rows = joined.select(*on, score.alias("_s")).join(u.select(*on, F.col("value").alias("_u")), on).join(v.select(*on, F.col("value").alias("_v")), on)
    return rows.select(*on, (F.col("_u") * F.col("_s")).alias("u"), (F.col("_v") * F.col("_s")).alias("v"))
