"""Fields, models and channel numbers of tiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Channel of each field in a model's tile.
CHANNELS = {"temperature": 0, "dewpoint": 1, "wind_u": 2, "wind_v": 3, "wind_gust": 4, "pressure": 5, "humidity": 6, "cloud_cover": 7, "precipitation": 8, "snowfall": 9, "visibility": 10, "condition_code": 11, "precipitation_probability": 12}
#: Models, their families, and the channel of a model's temperature in a map tile.
FAMILIES = {"gfs": "noaa", "aigfs": "noaa", "ifs": "ecmwf", "aifs": "ecmwf", "icon": "dwd"}
MAP_CHANNELS = {"gfs": 0, "ifs": 12, "aifs": 13, "aigfs": 14, "icon": 15}
#: Fields with quality channels, and where these begin (the field's number is added).
QUALITY_FIELDS = ("temperature", "precipitation", "condition_code")
QUALITY_FROM = {"confidence": 40, "spread": 60, "families": 80}
#: Channels of the daily extremes of each field and model (the blend of all is one of them).
DAILY = {
    "temperature": {"high": {"ifs": 20, "aifs": 21, "aigfs": 22, "icon": 23, "gfs": 28, "blend": 30}, "low": {"ifs": 24, "aifs": 25, "aigfs": 26, "icon": 27, "gfs": 29, "blend": 31}},
    "wind_speed": {"high": {"ifs": 100, "aifs": 101, "aigfs": 102, "icon": 103, "gfs": 104, "blend": 140}, "low": {"ifs": 105, "aifs": 106, "aigfs": 107, "icon": 108, "gfs": 109, "blend": 141}},
    "wind_gust": {"high": {"ifs": 110, "aifs": 111, "aigfs": 112, "icon": 113, "gfs": 114, "blend": 142}, "low": {"ifs": 115, "aifs": 116, "aigfs": 117, "icon": 118, "gfs": 119, "blend": 143}},
    "pressure": {"high": {"ifs": 120, "aifs": 121, "aigfs": 122, "icon": 123, "gfs": 124, "blend": 144}, "low": {"ifs": 125, "aifs": 126, "aigfs": 127, "icon": 128, "gfs": 129, "blend": 145}},
    "humidity": {"high": {"ifs": 130, "aifs": 131, "aigfs": 132, "icon": 133, "gfs": 134, "blend": 146}, "low": {"ifs": 135, "aifs": 136, "aigfs": 137, "icon": 138, "gfs": 139, "blend": 147}},
}
#: Names under which models carry a field; the first that is there counts.
ALIASES = {
    "dewpoint": ("d2m", "2d"), "wind_u": ("u10", "10u", "u"), "wind_v": ("v10", "10v", "v"), "wind_gust": ("fg10", "gust", "GUST"), "pressure": ("msl", "prmsl", "PRMSL"), "humidity": ("r2", "rh2m", "RH"),
    "cloud_cover": ("tcc", "clct", "TCDC"), "precipitation": ("tp", "tot_prec", "APCP"), "snowfall": ("sf", "snow_gsp", "ASNOW"), "visibility": ("vis", "visibility", "VIS"), "convective": ("cp", "rain_con", "ACPCP"),
}


def looked_up(table: dict, key: Column) -> Column:
    """The table's value for a key; null for any other."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def quality_channel(kind: str, field: Column) -> Column:
    return looked_up({f: QUALITY_FROM[kind] + k for k, f in enumerate(CHANNELS)}, field)


def daily_channel(field: Column, extreme: Column, model: Column) -> Column:
    """Channel of a field's daily high or low of a model or the blend."""
    return looked_up({f"{f} {e} {m}": c for f, of in DAILY.items() for e, models in of.items() for m, c in models.items()}, F.concat_ws(" ", field, extreme, model))


def daily_channels(field: str) -> list[int]:
    """All channels of a field's daily extremes."""
    return sorted(c for models in DAILY[field].values() for c in models.values())
