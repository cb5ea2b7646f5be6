"""Weather conditions from grid fields, from WMO codes, and the storm potential index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fields import looked_up
from .units import clip, fraction

#: Condition codes.
CODES = {
    "Unknown": 0, "Clear": 1, "MostlyClear": 2, "PartlyCloudy": 3, "MostlyCloudy": 4, "Cloudy": 5, "Drizzle": 6, "Rain": 7, "HeavyRain": 8,
    "Snow": 9, "HeavySnow": 10, "Sleet": 11, "FreezingRain": 12, "Thunderstorms": 13, "Foggy": 14, "Hail": 15,
}
#: The family that a code is first voted in.
FAMILIES = {0: 0, 1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 14: 3, 6: 4, 7: 4, 8: 4, 9: 5, 10: 5, 11: 5, 12: 5, 13: 6, 15: 6}


def family(code: Column) -> Column:
    out = F.lit(None).cast("int")
    for k, v in FAMILIES.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def condition_name(code: Column) -> Column:
    """Name of a condition code, rounded to the nearest whole number; null for any other number."""
    return looked_up({v: k for k, v in CODES.items()}, F.rint(code).cast("int"))


def condition(cloud: Column | None, precip: Column | None, convective: Column | None, snow: Column | None, temperature_k: Column | None, dewpoint_k: Column | None) -> Column:
    """Code of the strongest rule that holds, from thunder down to cloud cover; without cloud cover or rain Unknown.

    A field that isn't there is None. Where there is no snow field, cold rain freezes; where it is there but a cell is
    missing, nothing says that the cell has no snow, so it doesn't.
    """
    dry = F.lit(True) if snow is None else snow < 0.05
    cloud, precip, convective, snow, temperature_k, dewpoint_k = (F.lit(None).cast("double") if x is None else x for x in (cloud, precip, convective, snow, temperature_k, dewpoint_k))
    c = fraction(cloud)
    rules = [
        (convective >= 0.5, "Thunderstorms"),
        ((precip >= 0.05) & (temperature_k <= 273.65) & dry, "FreezingRain"),
        ((snow >= 0.05) & (precip - snow >= 0.05), "Sleet"),
        (snow >= 5, "HeavySnow"),
        (snow >= 0.05, "Snow"),
        (precip >= 8, "HeavyRain"),
        (precip >= 0.25, "Rain"),
        (precip > 0.01, "Drizzle"),
        ((F.abs(temperature_k - dewpoint_k) <= 1) & (c >= 0.75), "Foggy"),
        (c < 0.12, "Clear"),
        (c < 0.32, "MostlyClear"),
        (c < 0.68, "PartlyCloudy"),
        (c < 0.88, "MostlyCloudy"),
        (c >= 0.88, "Cloudy"),
    ]
    out = F.lit(CODES["Unknown"])
    for holds, name in reversed(rules):
        out = F.when(holds, CODES[name]).otherwise(out)
    return out


def wmo_condition(code: Column, otherwise: Column) -> Column:
    """Condition of a WMO weather code, rounded to the nearest whole number."""
    c, code = CODES, F.rint(code)
    return (
        F.when(code.isin(96, 99), c["Hail"])
        .when(code.between(95, 99), c["Thunderstorms"])
        .when(code.between(68, 79) | code.between(85, 86), c["Snow"])
        .when(code.isin(66, 67), c["FreezingRain"])
        .when(code.between(61, 65) | code.between(80, 82), c["Rain"])
        .when(code.between(51, 57), c["Drizzle"])
        .when(code.between(45, 48), c["Foggy"])
        .otherwise(otherwise)
    )


def packed_pair(low: Column, high: Column) -> Column:
    """Two codes of four bits in one byte."""
    return low.bitwiseAND(15).bitwiseOR(F.shiftleft(high.bitwiseAND(15), 4))


def storm_index(cape: Column, reflectivity: Column, rate: Column | None = None, convective_rate: Column | None = None, pwat: Column | None = None, dewpoint: Column | None = None, cin: Column | None = None, shear: Column | None = None) -> Column:
    """Storm potential between 0 and 1; an input that isn't given leaves its factor out. Rates in kg/m2/s, dewpoint in K or C."""
    scaled = lambda x, low, width: clip((x - low) / width, 0.0, 1.0)
    energy = scaled(cape, 250, 1750)
    signals = [scaled(reflectivity, 18, 37)]
    if rate is not None:
        signals.append(scaled(rate * 3600, 0.25, 8))
    if convective_rate is not None:
        signals.append(scaled(convective_rate * 3600, 0.1, 5))
    signal = F.greatest(*signals) if len(signals) > 1 else signals[0]
    index = 0.25 * energy + 0.55 * F.sqrt(energy) * F.pow(signal, F.lit(0.7)) + 0.2 * signal * energy
    moist = []
    if pwat is not None:
        moist.append(scaled(pwat, 20, 25))
    if dewpoint is not None:
        moist.append(scaled(F.when(dewpoint > 150, dewpoint - 273.15).otherwise(dewpoint), 12, 12))
    if moist:
        index = index * (0.55 + 0.45 * (F.greatest(*moist) if len(moist) > 1 else moist[0]))
    if cin is not None:
        index = index * (0.35 + 0.65 * (1 - scaled(F.abs(cin), 25, 175)))
    if shear is not None:
        index = index * (0.85 + 0.30 * scaled(F.abs(shear), 8, 18))
    return clip(index, 0.0, 1.0)
