"""Severities, categories and fields of natural-hazard reports."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import compact_text

#: Order of severities, and the words that give one.
RANK = {"unknown": 0, "minor": 1, "moderate": 2, "severe": 3, "extreme": 4}
WORDS = {"yellow": "minor", "low": "minor", "orange": "moderate", "medium": "moderate", "red": "severe", "high": "severe", "exceptional": "extreme"}
#: Substrings that give a category; the first category with one of its own counts.
CATEGORIES = (
    ("earthquake", ("quake", "seismic")),
    ("tropical", ("hurricane", "typhoon", "cyclone", "tropical storm")),
    ("fire", ("fire",)),
    ("flood", ("flood",)),
    ("storm", ("tornado", "thunderstorm", "convective", "hail")),
    ("winter", ("snow", "ice", "blizzard", "winter")),
    ("temperature", ("heat", "hot", "cold", "freeze")),
    ("wind", ("wind", "gale", "storm force")),
)
#: Names of the warning codes of one agency.
WARNING_NAMES = {
    "02": "Storm surge warning", "03": "Heavy rain warning", "04": "Flood warning", "05": "Storm warning", "06": "Heavy snow warning",
    "07": "High waves warning", "10": "Heavy rain advisory", "12": "Heavy snow advisory", "13": "Gale advisory", "14": "Thunderstorm advisory",
    "15": "Dense fog advisory", "16": "Dry air advisory", "17": "Avalanche advisory", "18": "Snow accretion advisory", "19": "Frost advisory",
    "20": "Low temperature advisory", "21": "Meltwater advisory", "22": "Flood advisory", "23": "Storm surge advisory", "24": "High waves advisory",
    "32": "Storm surge emergency warning", "33": "Heavy rain emergency warning", "35": "Storm emergency warning", "36": "Heavy snow emergency warning",
    "37": "High waves emergency warning",
}


def warning_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in WARNING_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), F.concat(F.lit("JMA warning code "), code))


def warning_severity(code: Column) -> Column:
    """By the code's first digit: 3 extreme, 0 (02 to 07) severe, 1 and 2 moderate."""
    return F.when(code.startswith("3"), "extreme").when(code.isin("02", "03", "04", "05", "06", "07"), "severe").when(code.startswith("1") | code.startswith("2"), "moderate").otherwise("unknown")


def severity(x: Column) -> Column:
    v = F.lower(compact_text(x))
    out = F.when(v.isin(*RANK), v)
    for word, name in WORDS.items():
        out = out.when(v == word, name)
    return out.otherwise("unknown")


def priority(level: Column) -> Column:
    out = F.lit(0)
    for k, v in RANK.items():
        out = F.when(level == k, v).otherwise(out)
    return out


def category_of(lowered: Column) -> Column:
    """Category of a text in lower case, which should be a column: it is looked at once for each substring."""
    out = F.lit("weather")
    for name, parts in reversed(CATEGORIES):
        out = F.when(reduce(or_, [lowered.contains(p) for p in parts]), name).otherwise(out)
    return out


def category(text: Column) -> Column:
    return F.get(F.transform(F.array(F.lower(compact_text(text))), category_of), F.lit(0))  # the text is made once


def magnitude_severity(m: Column) -> Column:
    """By steps at 5, 6 and 7; text that isn't a number is unknown, and `nan` reaches no step."""
    v = m.try_cast("double")
    return F.when(F.isnan(v), "minor").when(v >= 7, "extreme").when(v >= 6, "severe").when(v >= 5, "moderate").when(v.isNotNull(), "minor").otherwise("unknown")


def bulletin_severity(kind: Column, name: Column | None = None) -> Column:
    """By the words of a bulletin's kind and name."""
    k = F.lower(F.concat_ws(" ", kind, *([] if name is None else [name])))
    return F.when(k.contains("warning"), "severe").when(k.contains("watch"), "moderate").when(k.contains("advisory") | k.contains("statement"), "minor").otherwise("unknown")


def acquisition_time(day: Column, hhmm: Column) -> Column:
    return F.try_to_timestamp(F.concat(day, F.lit(" "), F.lpad(hhmm.cast("string"), 4, "0")), F.lit("yyyy-MM-dd HHmm"))


def is_active(expires: Column, now: Column) -> Column:
    """Not expired at now; without a readable expiry it is kept."""
    return F.coalesce(expires.try_cast("timestamp") >= now, F.lit(True))


def is_recent(at: Column, now: Column, hours: int = 72) -> Column:
    return F.coalesce(at.try_cast("timestamp") >= now - F.make_dt_interval(F.lit(0), F.lit(hours)), F.lit(True))
