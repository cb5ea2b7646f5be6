"""Spatial, temporal and textual keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Characters that count as white space.
SPACES = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _clamped(x: Column, size: int, low: int, high: int) -> Column:
    return F.least(F.greatest(F.floor(x / size) * size, F.lit(low)), F.lit(high)).cast("int")


def region_key(lat: Column, lon: Column, size: int = 20) -> Column:
    """South-west corner of the region of size degrees, as `+50_-020`; null without both coordinates."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.printf(F.lit("%+03d_%+04d"), _clamped(lat + 90, size, 0, 160) - 90, _clamped(lon + 180, size, 0, 340) - 180))


def corner_label(degrees: Column, positive: str, negative: str) -> Column:
    return F.concat(F.when(degrees >= 0, F.lit(positive)).otherwise(F.lit(negative)), F.abs(degrees).cast("string"))


def tile_name(lat: Column, lon: Column, size: int = 20) -> Column:
    """Name of the tile of size degrees that holds a point, as `N50_W20`."""
    south = F.least(F.greatest(F.floor((lat + 90) / size) * size - 90, F.lit(-90)), F.lit(90 - size)).cast("int")
    west = F.least(F.greatest(F.floor((lon + 180) / size) * size - 180, F.lit(-180)), F.lit(180 - size)).cast("int")
    return F.concat(corner_label(south, "N", "S"), F.lit("_"), corner_label(west, "E", "W"))


def pack_origin(lat: Column, lon: Column) -> tuple[Column, Column]:
    """South-west corner of the pack of 60 x 80 degrees that holds a tile: rows from multiples of 60, columns anchored at -120."""
    south = F.least(F.greatest(F.floor(lat / 60) * 60, F.lit(-90)), F.lit(60))
    west = F.least(F.greatest(F.floor((lon + 120) / 80) * 80 - 120, F.lit(-180)), F.lit(120))
    return south.cast("int"), west.cast("int")


def tile_file(job: Column | str, hour: Column, lat: Column, lon: Column, ending: str = "gtile") -> Column:
    """Name of the file of a job's tile or pack at an hour: `temp_6h_N50_W20.gtile`."""
    job = F.lit(job) if isinstance(job, str) else job
    return F.concat(job, F.lit("_"), hour.cast("string"), F.lit("h_"), corner_label(lat, "N", "S"), F.lit("_"), corner_label(lon, "E", "W"), F.lit(f".{ending}"))


def overview_key(lat: Column, lon: Column, suffix: str = "_60") -> Column:
    return F.concat(corner_label(lat, "N", "S"), F.lit("_"), corner_label(lon, "E", "W"), F.lit(suffix))


def valid_time(reference: Column, hours: Column) -> Column:
    return reference + F.make_dt_interval(F.lit(0), hours.cast("int"))


def day_start(at: Column, days: int = 0) -> Column:
    """The start of the UTC day (the session's zone), days later."""
    return F.date_trunc("day", at) + F.make_dt_interval(F.lit(days))


def feed_region(url: Column) -> Column:
    """What stands after the last `-` of an URL's path: the feed's country."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*", ""), r"[?#].*$", "")
    return F.element_at(F.split(path, "-"), -1)


def lead_bucket(hours: Column) -> Column:
    """Bucket of a lead time, whose part of an hour doesn't count."""
    h = F.coalesce(hours.cast("int"), F.lit(0))
    return F.when(h <= 24, "0-24").when(h <= 72, "25-72").when(h <= 168, "73-168").otherwise("169+")


def forecast_day(hours: Column) -> Column:
    return F.floor(hours / 24).cast("int")


def is_night(at: Column, lon: Column) -> Column:
    """Whether the solar hour (UTC hour + longitude / 15, minutes left out) is 21 or later, or before 6."""
    solar = F.pmod(F.hour(at) + lon / 15, F.lit(24.0))
    return (solar >= 21) | (solar < 6)


def model_cycle(now: Column) -> Column:
    """The six-hour cycle that is out at a time: the floor of the time less four and a half hours."""
    t = now - F.expr("INTERVAL '4:30' HOUR TO MINUTE")
    return F.date_trunc("day", t) + F.make_dt_interval(F.lit(0), (F.floor(F.hour(t) / 6) * 6).cast("int"))


def parse_utc(x: Column) -> Column:
    """ISO text as a timestamp (without a zone: UTC, which the session must have); null if it can't be read."""
    return x.try_cast("timestamp")


def iso_or_text(x: Column) -> Column:
    """ISO text in UTC to the second (`2024-01-01T00:00:00+00:00`); what can't be read stays as it is, without outer space; null if nothing is left."""
    text = F.nullif(F.trim(x), F.lit(""))
    return F.coalesce(F.date_format(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text).try_cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), text)


def filled(x: Column) -> Column:
    """A text, or null if it is empty. Other than by nullif, x is made once, however deep it is nested."""
    return F.get(F.array_remove(F.array(x.cast("string")), ""), F.lit(0))


def given(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[filled(c) for c in columns])


def compact_text(x: Column) -> Column:
    """White space runs (Unicode's too) as one space, no outer space; null if nothing is left."""
    return filled(F.trim(F.regexp_replace(x, SPACES, " ")))


def first_alias(*columns: Column) -> Column:
    """The first value that isn't null, empty or `M`."""
    return F.coalesce(*[F.nullif(F.nullif(F.trim(c), F.lit("")), F.lit("M")) for c in columns])


def number(x: Column) -> Column:
    return x.try_cast("double")


def stable_id(*parts: Column) -> Column:
    """Parts joined by bars, runs of other characters than letters, digits, _ and - as one -, none outside, 180 characters at most."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.concat_ws("|", *parts), "[^A-Za-z0-9_-]+", "-"), "^-+|-+$", ""), 1, 180)


def well_formed_json(x: Column) -> Column:
    """Whether a text is one JSON value and nothing more. The parser stops at a value's end, so the text is read as the first
    item of a list whose second is its own digest, which comes second only if the text is whole."""
    digest = F.sha2(x, 256)
    listed = F.try_parse_json(F.concat(F.lit("["), x, F.lit(',"'), digest, F.lit('"]')))
    return F.coalesce(F.try_variant_get(listed, "$[1]", "string") == digest, F.lit(False))


def file_id(x: Column) -> Column:
    return F.replace(x, F.lit("/"), F.lit("__"))


def is_holdout(station: Column, below: int = 26) -> Column:
    """Whether the first byte of the station's SHA-256 is under below."""
    return F.conv(F.substring(F.sha2(station, 256), 1, 2), 16, 10).cast("int") < below
