"""Grids: quantisation, sampling, regridding, daily extremes and accumulations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MISSING = -32768


def quantised(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """df with scale, offset and raw: values of a channel (by) as 16-bit numbers between its least and its largest, missing ones as -32768.

    Ranges are aggregated before the join, so a channel of any size is never in one task.
    """
    v = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    ranges = df.groupBy(*by).agg(F.min(v).alias("_low"), F.max(v).alias("_high"))
    flat = F.coalesce(F.col("_high") <= F.col("_low"), F.lit(True))
    ranges = ranges.select(*by, F.when(flat, 1.0).otherwise((F.col("_high") - F.col("_low")) / 65534).alias("scale"), F.coalesce(F.when(flat, F.col("_low")).otherwise((F.col("_high") + F.col("_low")) / 2), F.lit(0.0)).alias("offset"))
    raw = F.greatest(F.least(F.rint((v - F.col("offset")) / F.col("scale")), F.lit(32767.0)), F.lit(-32767.0)).cast("int")
    return df.join(ranges, by).withColumn("raw", F.when(v.isNull(), F.lit(MISSING)).otherwise(raw))


def dequantised(raw: Column, scale: Column, offset: Column) -> Column:
    return F.when(raw != MISSING, raw * scale + offset)


def bilinear(plane: Column, width: int | Column, height: int | Column, x: Column, y: Column) -> Column:
    """Value of a plane (row by row) at column x and row y: corners weighted by nearness, missing ones left out, null if none is left."""
    last = lambda n: n - 1 if isinstance(n, Column) else F.lit(n - 1)
    cx, cy = F.least(F.greatest(x, F.lit(0.0)), last(width).cast("double")), F.least(F.greatest(y, F.lit(0.0)), last(height).cast("double"))
    x0, y0 = F.floor(cx).cast("int"), F.floor(cy).cast("int")
    x1, y1 = F.least(x0 + 1, last(width)), F.least(y0 + 1, last(height))
    fx, fy = cx - x0, cy - y0
    corners = [(x0, y0, (1 - fx) * (1 - fy)), (x1, y0, fx * (1 - fy)), (x0, y1, (1 - fx) * fy), (x1, y1, fx * fy)]
    value = lambda i, j: F.nanvl(F.get(plane, j * width + i).cast("double"), F.lit(None).cast("double"))
    top = sum(F.coalesce(value(i, j) * w, F.lit(0.0)) for i, j, w in corners)
    bottom = sum(F.when(value(i, j).isNotNull(), w).otherwise(0.0) for i, j, w in corners)
    return F.when(bottom > 0, top / bottom)


def nearest_cell(lat: Column, lat0: float, dy: float) -> Column:
    """Row (or column) of the nearest grid line: grids are joined on these numbers, never on coordinates."""
    return F.rint((lat - lat0) / dy).cast("int")


def regridded(source: DataFrame, target: DataFrame, origin: tuple[float, float], step: tuple[float, float], values: list[str]) -> DataFrame:
    """target (lat, lon and more) with the values of the nearest source cell (y, x); null where there is none."""
    t = target.withColumn("y", nearest_cell(F.col("lat"), origin[0], step[0])).withColumn("x", nearest_cell(F.col("lon"), origin[1], step[1]))
    return t.join(source.select("y", "x", *values), ["y", "x"], "left")


def first_variable(df: DataFrame, axes: tuple[str, ...] = ("y", "x", "lat", "lon")) -> str:
    """The first column that isn't an axis; a grid without any raises ValueError."""
    for name in df.columns:
        if name not in axes:
            return name
    raise ValueError(f"no variable besides {', '.join(df.columns)}")


def single_field(source: DataFrame, target: DataFrame, origin: tuple[float, float], step: tuple[float, float], out: str = "value") -> DataFrame:
    """target with the first variable of source (y, x and variables), whatever its name, at the nearest cell; null where there is none."""
    found = source.select("y", "x", F.col(f"`{first_variable(source)}`").cast("double").alias(out))
    return regridded(found, target, origin, step, [out])


def regridded_linear(source: DataFrame, target: DataFrame, by: list[str], key: list[str], origin: tuple[float, float], step: tuple[float, float], value: str, columns: int | None = None) -> DataFrame:
    """by, key and value: of each plane (by) of source (by, y, x, value) the bilinear value at each row of target (key, lat, lon).

    A target's place gives four integer corners with weights, which are joined on their numbers: planes of any size stay rows.
    Missing corners (no row, null or NaN) are left out and the others' weights count for all; where none is left there is no
    row. columns is the number of a whole circle's columns: x then wraps. Else places beyond the edge are left out by a step.
    Weights of 0 take part in nothing. Each plane is asked for all targets; a target may have a plane (by) of its own instead.
    """
    y, x = (F.col("lat") - origin[0]) / step[0], (F.col("lon") - origin[1]) / step[1]
    own = [c for c in by if c in target.columns]
    placed = target.withColumns({"_fy": y - F.floor(y), "_fx": x - F.floor(x), "_y": F.floor(y).cast("int"), "_x": F.floor(x).cast("int")})
    corners = F.array(*[F.struct((F.col("_y") + j).alias("y"), (F.col("_x") + i).alias("x"), ((F.col("_fy") if j else 1 - F.col("_fy")) * (F.col("_fx") if i else 1 - F.col("_fx"))).alias("w")) for j in (0, 1) for i in (0, 1)])
    rows = placed.select(*dict.fromkeys([*own, *key]), F.inline(corners)).filter("w > 0")
    if columns is not None:
        rows = rows.withColumn("x", F.pmod("x", F.lit(columns)))
    known = source.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*by, "y", "x", F.col(value).cast("double").alias("_v"))
    joined = rows.join(known, [*own, "y", "x"])
    group = list(dict.fromkeys([*by, *key]))
    return joined.groupBy(*group).agg((F.sum(F.col("_v") * F.col("w")) / F.sum("w")).alias(value))


def overview(plane: Column, width: int, height: int, stride: int = 4) -> Column:
    """Every stride-th row and column of a plane."""
    return F.filter(plane, lambda _, i: (F.floor(i / width) % stride == 0) & (i % width % stride == 0))


def covered_days(df: DataFrame, by: list[str], hour: str) -> DataFrame:
    """The days (of 24 lead hours) that a group covers: three different hours of day or more, the first at 9 or before, the last at 12 or later, 12 apart or more."""
    of_day = F.pmod(F.col(hour), F.lit(24))
    figures = df.groupBy(*by, F.floor(F.col(hour) / 24).cast("int").alias("day")).agg(F.count_distinct(of_day).alias("n_hours"), F.min(of_day).alias("first"), F.max(of_day).alias("last"))
    return figures.filter("n_hours >= 3 and first <= 9 and last >= 12 and last - first >= 12")


def daily_extremes(df: DataFrame, by: list[str], hour: str, fields: list[str], last_day: int = 14) -> DataFrame:
    """by, day and high_ and low_ of each field."""
    day = F.floor(F.col(hour) / 24).cast("int").alias("day")
    return df.groupBy(*by, day).agg(*[f for c in fields for f in (F.max(c).alias(f"high_{c}"), F.min(c).alias(f"low_{c}"))]).filter(F.col("day").between(0, last_day))


def interval_amounts(df: DataFrame, by: list[str], order: str, value: str, running: str, out: str) -> DataFrame:
    """df with out: where running is true the amount since the last running row (never under 0; the first as it is), elsewhere the value."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col(running), F.col(value)), ignorenulls=True).over(w)
    return df.withColumn(out, F.when(F.col(running) & last.isNotNull() & F.col(value).isNotNull(), F.greatest(F.col(value) - last, F.lit(0.0))).otherwise(F.col(value)))


def byte_ranges(df: DataFrame, by: list[str], order: str, offset: str) -> DataFrame:
    """df with range_end: the byte before the next message of the file; null for the last."""
    return df.withColumn("range_end", F.lead(offset).over(Window.partitionBy(*by).orderBy(order)) - 1)


def aligned(models: dict[str, DataFrame], on: list[str], value: str) -> DataFrame:
    """The cells that all models have, with a column of each model's values."""
    out = None
    for name, df in models.items():
        own = df.select(*on, F.col(value).alias(name))
        out = own if out is None else out.join(own, on)
    return out


def model_range(df: DataFrame, plane: list[str], cell: list[str], model: str, value: str) -> DataFrame:
    """plane, cell, low, high and n_models of the cells that all models of a plane have; a plane of one model is its own range."""
    here = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    carried = here.select(*plane, model).distinct().groupBy(*plane).agg(F.count(F.lit(1)).alias("n_models"))
    ranges = here.groupBy(*plane, *cell).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count_distinct(model).alias("_n"))
    return ranges.join(carried, plane).filter(F.col("_n") == F.col("n_models")).drop("_n")


def with_channels(tiles: DataFrame, extra: DataFrame, on: list[str], channel: str) -> DataFrame:
    """tiles and those channels of extra that stand for a tile's key and aren't in it yet."""
    wanted = extra.join(tiles.select(*on).distinct(), on, "left_semi").join(tiles.select(*on, channel), [*on, channel], "left_anti")
    return tiles.unionByName(wanted.select(*tiles.columns))


def on_geometry(plane: Column, source: Column, target: Column) -> Column:
    """A plane as it is where both geometries (structs of lon0, lat0, dx, dy, width, height) are alike, else sampled by bilinear weights at the target's cells."""
    n = target["width"] * target["height"]

    def cell(i: Column) -> Column:
        lon, lat = target["lon0"] + i % target["width"] * target["dx"], target["lat0"] + F.floor(i / target["width"]) * target["dy"]
        return bilinear(plane, source["width"], source["height"], (lon - source["lon0"]) / source["dx"], (lat - source["lat0"]) / source["dy"])

    return F.when(source == target, plane.cast("array<double>")).otherwise(F.transform(F.sequence(F.lit(0), n - 1), cell))
