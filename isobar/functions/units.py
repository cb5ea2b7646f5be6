"""Unit conversions, plausibility limits and three kinds of rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Factors of observation units, and plausible ranges of grid fields (Kelvin, m/s, Pa, fraction).
KMH_PER_KNOT, HPA_PER_INHG, MM_PER_INCH = 1.852, 33.8638866667, 25.4
LIMITS = {"temperature": (180.0, 340.0), "dewpoint": (180.0, 340.0), "wind_speed": (0.0, 150.0), "gust": (0.0, 200.0), "pressure": (80000.0, 110000.0), "humidity": (0.0, 1.0)}


def clip(x: Column, low: float, high: float) -> Column:
    """Null stays null."""
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def plausible(x: Column, field: str) -> Column:
    low, high = LIMITS[field]
    return F.when(x.between(low, high), x)


def fraction(x: Column) -> Column:
    """Percent or fraction as a fraction between 0 and 1."""
    return clip(F.when(x > 1.5, x / 100).otherwise(x), 0.0, 1.0)


def wind_speed(u: Column, v: Column) -> Column:
    return F.when(u.isNotNull() & v.isNotNull(), F.sqrt(u * u + v * v))


def humidity(temperature_c: Column, dewpoint_c: Column) -> Column:
    """Relative humidity by the Magnus formula (17.625, 243.04)."""
    part = lambda t: F.exp(17.625 * t / (243.04 + t))
    return clip(part(dewpoint_c) / part(temperature_c), 0.0, 1.0)


def pressure_hpa(hpa: Column, inches: Column) -> Column:
    return F.coalesce(hpa, inches * HPA_PER_INHG)


def precipitation_mm(x: Column, units: Column) -> Column:
    return F.when(F.lower(units).isin("m", "metre", "meter"), x * 1000).otherwise(x)


def wrapped_longitude(lon: Column) -> Column:
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def round_even(x: Column, places: int) -> Column:
    """Halves go to the even digit."""
    return F.rint(x * 10.0**places) / 10.0**places


def round_up(x: Column, places: int) -> Column:
    """Halves go up, also below zero."""
    return F.floor(x * 10.0**places + 0.5) / 10.0**places


def grid_value(x: Column, places: int, preserve: bool = True) -> Column:
    """Rounded; missing values stay missing, or become 0 without preserve."""
    r = round_even(x, places)
    return r if preserve else F.coalesce(r, F.lit(0.0))


def field_places(field: Column) -> Column:
    return F.when(field.isin("snow", "smoke", "dust", "air_quality"), 3).otherwise(1)
