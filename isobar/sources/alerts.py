"""Normalisers of hazard feeds: payload texts, a row each, to rows of the fields of operators.feeds.

A payload that can't be read gives no rows; status_of tells which sources failed. Values that aren't there are null.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import hazards as H
from ..functions import keys as K
from ..operators.feeds import features
from .feeds import geojson_features


def _p(*names: str) -> Column:
    """The first of the properties that is neither null nor empty."""
    return K.given(*[F.col("properties")[n] for n in names])


def weather_alerts(raw: DataFrame, provider: str = "NOAA_NWS", country: str = "US", attribution: str = "NOAA/National Weather Service") -> DataFrame:
    """GeoJSON alerts whose properties carry the fields under their usual names."""
    return features(geojson_features(raw), provider, F.col("geometry"), {
        "id": K.given(F.col("properties")["id"], F.col("id")), "sourceUrl": _p("@id", "uri"), "event": _p("event"), "severity": _p("severity"), "urgency": _p("urgency"), "certainty": _p("certainty"),
        "status": _p("status"), "headline": _p("headline"), "description": _p("description"), "instruction": _p("instruction"), "areaName": _p("areaDesc"), "country": F.lit(country),
        "region": _p("senderName"), "effective": _p("effective"), "onset": _p("onset"), "expires": _p("expires"), "updated": _p("sent"), "attribution": F.lit(attribution),
    })


def bilingual_alerts(raw: DataFrame, url: str, provider: str = "CANADA_MSC", attribution: str = "Environment and Climate Change Canada / MSC GeoMet") -> DataFrame:
    """GeoJSON alerts in English or, where that is missing, French."""
    name = _p("alert_name_en", "alert_name_fr")
    level = H.bulletin_severity(F.coalesce(F.col("properties")["alert_type"], F.lit("")), F.coalesce(F.col("properties")["alert_name_en"], F.lit("")))
    return features(geojson_features(raw), provider, F.col("geometry"), {
        "id": K.given(F.col("properties")["id"], F.col("id")), "sourceUrl": F.lit(url), "event": name, "severity": level, "status": _p("alert_type"), "headline": name,
        "description": _p("alert_text_en", "alert_text_fr"), "areaName": _p("alert_area_name_en", "alert_area_name_fr"), "country": F.lit("CA"), "effective": _p("validity_datetime"),
        "onset": _p("validity_datetime"), "expires": _p("expiration_datetime"), "updated": _p("publication_datetime"), "attribution": F.lit(attribution),
    })


def warning_summaries(summaries: DataFrame, details: DataFrame, url: str, provider: str = "HKO", attribution: str = "Hong Kong Observatory") -> DataFrame:
    """Warnings of a summary (a map by key) with the details of their code; of several details of a code the last counts."""
    value = "name string, code string, actionCode string, type string, issueTime string, updateTime string, expireTime string"
    rows = summaries.select(F.explode(F.from_json("document", "map<string,string>")).alias("key", "text")).filter("text like '{%'").select("key", F.from_json("text", value).alias("v"))
    item = "details array<struct<warningStatementCode:string,subtype:string,code:string,contents:string>>"
    told = details.select(F.posexplode(F.from_json("document", item)["details"]).alias("at", "d")).select("at", K.given(F.col("d.warningStatementCode"), F.col("d.subtype"), F.col("d.code")).alias("_code"), F.col("d.contents").alias("contents"))
    told = told.filter("_code is not null").groupBy("_code").agg(F.max_by("contents", "at").alias("contents"))
    rows = rows.withColumn("_code", K.given(F.col("v.code"), F.col("key"))).join(told, "_code", "left")
    name, action, issued = K.given(F.col("v.name"), F.col("contents"), F.col("key")), K.given(F.col("v.actionCode"), F.col("v.type")), F.col("v.issueTime")
    return features(rows, provider, F.lit(None).cast("string"), {
        "id": F.concat(F.lit("HKO:"), F.col("key"), F.lit(":"), F.coalesce(K.given(issued, F.col("v.updateTime")), F.lit("None"))), "sourceUrl": F.lit(url), "event": name,
        "severity": F.when(F.upper(action).isin("ISSUE", "REISSUE"), "severe").otherwise("moderate"), "status": action, "headline": name, "description": K.given(F.col("contents"), name),
        "areaName": F.lit("Hong Kong"), "country": F.lit("HK"), "effective": issued, "expires": F.col("v.expireTime"), "updated": K.given(F.col("v.updateTime"), issued), "attribution": F.lit(attribution),
    })


def area_forecasts(raw: DataFrame, url: str, provider: str = "DATA_GOV_SG", attribution: str = "data.gov.sg / Meteorological Service Singapore") -> DataFrame:
    """Forecasts by area, with the place of the area where the payload names it."""
    schema = (
        "data struct<area_metadata:array<struct<name:string,label_location:struct<latitude:double,longitude:double>>>,valid_period:struct<start:string,`end`:string>,updated_timestamp:string,"
        "items:array<struct<update_timestamp:string,forecasts:array<struct<area:string,forecast:string>>>>>"
    )
    whole = raw.select(F.from_json("document", schema)["data"].alias("d"))
    places = F.map_from_entries(F.transform("d.area_metadata", lambda m: F.struct(m["name"], m["label_location"])))
    rows = whole.select("d.valid_period", "d.updated_timestamp", F.coalesce(places, F.create_map().cast("map<string,struct<latitude:double,longitude:double>>")).alias("places"), F.explode("d.items").alias("item"))
    rows = rows.select("*", F.explode("item.forecasts").alias("f")).select("*", F.try_element_at("places", "f.area").alias("at"))
    area, text, updated = F.col("f.area"), F.col("f.forecast"), K.given(F.col("item.update_timestamp"), F.col("updated_timestamp"))
    return features(rows, provider, G.point(F.col("at.longitude"), F.col("at.latitude")), {
        "id": F.concat(F.lit("SG:"), area, F.lit(":"), F.coalesce(updated, F.lit("None"))), "sourceUrl": F.lit(url), "event": text,
        "severity": F.when(F.lower(text).rlike("thunder|showers|rain"), "minor").otherwise("unknown"), "headline": F.concat(area, F.lit(": "), text),
        "description": F.concat(F.lit("Two-hour forecast for "), area, F.lit(": "), text), "areaName": area, "country": F.lit("SG"), "effective": F.col("valid_period.start"),
        "expires": F.col("valid_period.end"), "updated": updated, "layer": F.lit("regional_forecast"), "attribution": F.lit(attribution),
    })


#: Groups of an area table, later ones count, and statuses of warnings that are over or were never there.
AREA_GROUPS = ("centers", "offices", "class10s", "class15s", "class20s")
OVER = ("解除", "発表警報・注意報はなし")


def area_names(raw: DataFrame) -> DataFrame:
    """code, name, enName and officeName of every area of a table of five groups; a later group's area replaces an earlier one's."""
    area = "map<string,struct<name:string,enName:string,officeName:string>>"
    groups = raw.select(F.from_json("document", ", ".join(f"{g} {area}" for g in AREA_GROUPS)).alias("d"))
    listed = F.array(*[F.struct(F.lit(k).alias("ordinal"), F.col(f"d.{g}").alias("areas")) for k, g in enumerate(AREA_GROUPS)])
    rows = groups.select(F.explode(listed).alias("g")).select("g.ordinal", F.explode("g.areas").alias("code", "a"))
    return rows.groupBy("code").agg(F.max_by("a", "ordinal").alias("a")).select("code", "a.*")


def area_warnings(raw: DataFrame, areas: DataFrame, url: str, now: Column, provider: str = "JMA", attribution: str = "Japan Meteorological Agency") -> DataFrame:
    """Warnings of the last 72 hours by report, area type and area, without those that are over, with the names of their areas."""
    schema = "array<struct<reportDatetime:string,areaTypes:array<struct<areas:array<struct<code:string,warnings:array<struct<code:string,status:string>>>>>>>>"
    reports = raw.select(F.explode(F.from_json("document", schema)).alias("r")).filter(H.is_recent(F.col("r.reportDatetime"), now))
    rows = reports.select(F.col("r.reportDatetime").alias("at"), F.explode("r.areaTypes").alias("t")).select("at", F.explode("t.areas").alias("a"))
    rows = rows.select("at", F.coalesce("a.code", F.lit("None")).alias("code"), F.explode("a.warnings").alias("w")).filter(~F.coalesce(F.col("w.status").isin(*OVER), F.lit(False)))
    rows = rows.join(areas, "code", "left")
    area, kind, event = K.given(F.col("enName"), F.col("name"), F.col("code")), F.coalesce(F.col("w.code"), F.lit("None")), H.warning_name(F.coalesce(F.col("w.code"), F.lit("None")))
    status = F.coalesce(F.col("w.status"), F.lit("None"))
    return features(rows, provider, F.lit(None).cast("string"), {
        "id": F.concat_ws(":", F.lit("JMA"), F.col("code"), kind, F.coalesce("at", F.lit("None"))), "sourceUrl": F.lit(url), "event": event, "severity": H.warning_severity(kind), "status": F.col("w.status"),
        "headline": F.concat(event, F.lit(" for "), area), "description": F.concat(event, F.lit("; JMA status: "), status, F.lit("; area code: "), F.col("code")), "areaName": area,
        "country": F.lit("JP"), "region": F.col("officeName"), "updated": F.col("at"), "attribution": F.lit(attribution),
    })


def earthquakes(raw: DataFrame, url: str, provider: str = "USGS_EARTHQUAKES", attribution: str = "U.S. Geological Survey") -> DataFrame:
    """GeoJSON earthquakes: times in milliseconds, severity by magnitude."""
    millis = F.col("properties")["time"].try_cast("bigint")
    at = F.when(millis != 0, F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    shown = lambda name: F.coalesce(F.col("properties")[name], F.lit("None"))
    return features(geojson_features(raw), provider, F.col("geometry"), {
        "id": F.col("id"), "sourceUrl": F.coalesce(_p("url"), F.lit(url)), "event": F.lit("Earthquake"), "category": F.lit("earthquake"), "severity": H.magnitude_severity(F.col("properties")["mag"]),
        "headline": _p("title"), "description": F.concat(F.lit("Magnitude "), shown("mag"), F.lit("; place: "), shown("place")), "areaName": _p("place"), "effective": at, "onset": at, "updated": at,
        "layer": F.lit("earthquakes"), "attribution": F.lit(attribution),
    })


_CAP = "identifier string, status string, sent string, event string, severity string, urgency string, certainty string, headline string, description string, instruction string, areaDesc string, effective string, onset string, expires string, polygon array<string>"
_INFO = "event:string,severity:string,urgency:string,certainty:string,headline:string,description:string,instruction:string,effective:string,onset:string,expires:string,area:array<struct<areaDesc:string,polygon:array<string>>>"
_ENTRY = f"{_CAP}, id string, title string, summary string, updated string, point string, link array<struct<_href:string,_type:string>>, info array<struct<{_INFO}>>"


def cap_feeds(raw: DataFrame, provider: str = "METEOALARM", attribution: str = "Meteoalarm/EUMETNET and participating national meteorological services") -> DataFrame:
    """Entries of Atom feeds of CAP alerts (url, document), or of documents that are one alert; a feed that can't be read gives none."""
    one = "struct<" + ",".join(f"{f.split(' ', 1)[0]}:{f.split(' ', 1)[1]}" for f in _split_fields(_ENTRY)) + ">"
    options = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
    feeds = raw.select("url", "document", F.from_xml("document", f"entry array<{one}>", options)["entry"].alias("entries"))
    alone = F.when(F.col("document").rlike(r"^\s*(<\?[^>]*>\s*|<!--.*?-->\s*)*<([\w.-]+:)?alert[\s>]"), F.array(F.from_xml("document", _ENTRY, options)))
    # outer, as plain explode's filter on its input would have each document parsed once more for each of its conditions
    rows = feeds.select("url", F.explode_outer(F.coalesce(F.filter("entries", lambda e: e.isNotNull()), alone)).alias("e")).filter("e is not null")

    def text(*names: str) -> Column:
        found = []
        for n in names:
            c = F.get("e.info", F.lit(0))[n.removeprefix("info.")] if n.startswith("info.") else F.col(f"e.{n}")
            found.append(K.compact_text(c))
        return F.coalesce(*found)

    both = lambda n: text(n, f"info.{n}")
    inner = F.flatten(F.transform(F.coalesce("e.info", F.array().cast(f"array<struct<{_INFO}>>")), lambda i: F.flatten(F.transform(F.coalesce(i["area"], F.array().cast("array<struct<areaDesc:string,polygon:array<string>>>")), lambda a: F.coalesce(a["polygon"], F.array().cast("array<string>"))))))
    outlines = F.concat(F.coalesce("e.polygon", F.array().cast("array<string>")), inner)
    shape = F.coalesce(G.cap_polygons(outlines), G.georss(F.col("e.point"), F.get("e.polygon", F.lit(0))))
    links = F.filter(F.coalesce("e.link", F.array().cast("array<struct<_href:string,_type:string>>")), lambda x: F.coalesce(x["_href"] != "", F.lit(False)))
    cap = F.filter(links, lambda x: F.coalesce(x["_type"] == "application/cap+xml", F.lit(False)))
    link = F.when(F.size(cap) > 0, F.element_at(cap, -1)["_href"]).when(F.size(links) > 0, F.get(links, F.lit(0))["_href"])
    area = F.coalesce(text("areaDesc"), K.compact_text(F.get(F.get("e.info", F.lit(0))["area"], F.lit(0))["areaDesc"]))
    return features(rows, provider, shape, {
        "id": text("id", "identifier"), "sourceUrl": F.coalesce(link, F.col("url")), "event": text("event", "info.event", "title"), "severity": both("severity"), "urgency": both("urgency"),
        "certainty": both("certainty"), "status": text("status"), "headline": text("headline", "info.headline", "title"), "description": text("description", "info.description", "summary"),
        "instruction": both("instruction"), "areaName": area, "region": K.feed_region(F.col("url")), "effective": both("effective"), "onset": both("onset"), "expires": both("expires"),
        "updated": text("updated", "sent"), "attribution": F.lit(attribution),
    })


def _split_fields(schema: str) -> list[str]:
    """Fields of a schema text, at commas outside brackets."""
    out, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(schema[last:i].strip())
            last = i + 1
    return [*out, schema[last:].strip()]


def disaster_items(raw: DataFrame, url: str, provider: str = "GDACS", attribution: str = "Global Disaster Alert and Coordination System (GDACS)") -> DataFrame:
    """Items of an RSS feed; elements of other name spaces count only as places."""
    item = "struct<title:string,link:string,guid:string,severity:string,description:string,pubDate:string,`georss:point`:string,`georss:polygon`:string>"
    rows = raw.select(F.explode(F.from_xml("document", f"channel struct<item:array<{item}>>", {"mode": "PERMISSIVE"})["channel"]["item"]).alias("i")).filter("i is not null")
    text = lambda n: K.compact_text(F.col(f"i.{n}"))
    return features(rows, provider, G.georss(F.col("i.`georss:point`"), F.col("i.`georss:polygon`")), {
        "id": F.coalesce(text("guid"), text("link")), "sourceUrl": F.coalesce(text("link"), F.lit(url)), "event": text("title"), "category": H.category(text("title")), "severity": text("severity"),
        "headline": text("title"), "description": text("description"), "updated": text("pubDate"), "attribution": F.lit(attribution),
    })


def placemarks(raw: DataFrame) -> DataFrame:
    """ordinal, url, at, name, description and the texts point, line and polygon of the placemarks of KML or KMZ payloads
    (ordinal, url, content); a KMZ holds its first .kml. A payload that can't be read gives one row with only an error."""
    names = ["ordinal", "url", "at", "name", "description", "point", "line", "polygon", "error"]
    kml = "{http://www.opengis.net/kml/2.2}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for ordinal, url, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                try:
                    if url.endswith(".kmz") or content[:2] == b"PK":
                        with zipfile.ZipFile(io.BytesIO(content)) as z:
                            content = z.read(next(n for n in z.namelist() if n.lower().endswith(".kml")))
                    marks = ElementTree.fromstring(content.decode("utf-8", "replace")).iter(f"{kml}Placemark")
                    at = {"k": kml.strip("{}")}
                    paths = (".//k:Point/k:coordinates", ".//k:LineString/k:coordinates", ".//k:Polygon//k:LinearRing/k:coordinates")
                    out += [(ordinal, url, k, *(m.findtext(p, None, at) for p in ("k:name", "k:description", *paths)), None) for k, m in enumerate(marks)]
                except Exception as error:  # noqa: BLE001  one source's fault is a row of its own
                    out.append((ordinal, url, -1, None, None, None, None, None, str(error)))
            cols = list(zip(*out, strict=True)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.string(), pa.int32(), *[pa.string()] * 6], strict=True)], names=names)

    return raw.select(F.col("ordinal").cast("int"), "url", "content").mapInArrow(run, "ordinal int, url string, at int, " + ", ".join(f"{n} string" for n in names[3:]))


def cyclone_products(raw: DataFrame, provider: str = "NOAA_NHC", attribution: str = "NOAA/National Hurricane Center") -> DataFrame:
    """Placemarks of the first payload (by ordinal) that has any; those without a name, a description and a place don't count."""
    rows = placemarks(raw).filter("error is null").withColumn("shape", G.placemark(F.col("point"), F.col("line"), F.col("polygon")))
    rows = rows.withColumns({"name": K.compact_text(F.col("name")), "description": K.compact_text(F.col("description"))}).filter("name is not null or description is not null or shape is not null")
    first = rows.agg(F.min("ordinal").alias("ordinal"))
    rows = rows.join(F.broadcast(first), "ordinal")  # one row
    return features(rows, provider, F.col("shape"), {
        "id": F.concat(F.col("url"), F.lit("#"), F.coalesce("name", F.col("at").cast("string"))), "sourceUrl": F.col("url"), "event": F.coalesce("name", F.lit("Tropical cyclone product")), "category": F.lit("tropical"),
        "severity": F.lit("unknown"), "headline": F.col("name"), "description": F.col("description"), "layer": F.lit("tropical"), "attribution": F.lit(attribution),
    })


def fire_detections(rows: DataFrame, provider: str = "NASA_FIRMS", attribution: str = "NASA FIRMS", url: str = "https://www.earthdata.nasa.gov/data/tools/firms") -> DataFrame:
    """CSV rows (all text, with the product's name as product); rows without a place are left out."""
    have = {c for c in rows.columns}
    c = lambda n: F.col(n) if n in have else F.lit(None).cast("string")
    lat, lon = c("latitude").try_cast("double"), c("longitude").try_cast("double")
    at = F.date_format(H.acquisition_time(c("acq_date"), F.coalesce(c("acq_time"), F.lit(""))), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    shown = lambda x: F.coalesce(x, F.lit("None"))
    return features(rows.filter(lat.isNotNull() & lon.isNotNull()), provider, G.point(lon, lat), {
        "id": F.concat_ws(":", c("product"), c("latitude"), c("longitude"), shown(c("acq_date")), shown(c("acq_time"))), "sourceUrl": F.lit(url), "event": F.lit("Active fire detection"), "category": F.lit("fire"),
        "severity": F.when(F.lower(c("confidence")).isin("h", "high"), "moderate").otherwise("unknown"), "headline": F.concat(F.lit("Active fire detection ("), c("product"), F.lit(")")),
        "description": F.concat(F.lit("Confidence: "), shown(c("confidence")), F.lit("; brightness: "), shown(K.given(c("bright_ti4"), c("brightness")))), "updated": at, "layer": F.lit("fires"), "attribution": F.lit(attribution),
    })


def geojson_alerts(raw: DataFrame, provider: str, url: str, attribution: str) -> DataFrame:
    """GeoJSON of any further source, whose properties are named as the fields are."""
    named = ("severity", "urgency", "certainty", "status", "description", "instruction", "country", "region", "effective", "onset", "expires", "updated")
    fields = {n: _p(n) for n in named}
    return features(geojson_features(raw), provider, F.col("geometry"), fields | {
        "id": K.given(F.col("properties")["id"], F.col("id")), "sourceUrl": F.coalesce(_p("sourceUrl"), F.lit(url)), "event": _p("event", "headline", "title"), "headline": _p("headline", "title"),
        "areaName": _p("areaName", "areaDesc"), "attribution": F.lit(attribution),
    })
