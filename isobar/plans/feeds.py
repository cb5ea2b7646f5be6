"""Queries of the feed normalisers: payloads are made of whole tables (GeoJSON, nested JSON, XML, KML, CSV columns), read by
isobar.sources and told field by field; SQL says the same of the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import feeds
from ..sources import alerts, documents
from ..sources import feeds as sources
from .consensus import t
from .hazards import CASE_SQL, NAMES_SQL, compact_sql

C = F.col
LEVELS = ("Minor", "orange", "RED ", "exceptional", "what")
#: Fields that may be long, which are told by their digests.
LONG = ("event", "headline", "description")


def told(rows: DataFrame, *fields: str) -> DataFrame:
    """Fields of normalised rows, and lon and lat where geometry is asked for."""
    out = [F.sha2(n, 256).alias(n) if n in LONG else C(n) for n in fields if n != "geometry"]
    if "geometry" in fields:
        out += [F.get_json_object("geometry", f"$.coordinates[{i}]").try_cast("double").alias(n) for i, n in enumerate(("lon", "lat"))]
    return rows.select(*out)


def level(id: str) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LEVELS]), (C(id) % len(LEVELS) + 1).cast("int"))


def collection(id: Column, properties: Column, geometry: Column | None = None) -> Column:
    """The text of a collection of one feature."""
    return F.to_json(F.struct(F.array(F.struct(id.alias("id"), *([] if geometry is None else [geometry.alias("geometry")]), properties.alias("properties"))).alias("features")))


def place(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon.cast("double"), lat.cast("double")).alias("coordinates"))


def xml_text(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def tag(name: str, x: Column) -> Column:
    """An element, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), xml_text(x), F.lit(f"</{name}>")), F.lit(""))


def feed_weather_alerts(spark, d):
    """One document in 50 is cut and gives no rows."""
    p = F.struct(C("text").alias("event"), level("doc_id").alias("severity"), C("text").alias("description"), C("lang").alias("areaDesc"), C("source").alias("senderName"), F.lit("2024-01-01T02:00:00+02:00").alias("effective"), F.lit("soon").alias("sent"))
    text = collection(C("doc_id").cast("string"), p, place(C("doc_id") % 180, C("doc_id") % 90))
    raw = t(spark, d, "documents").select(F.when(C("doc_id") % 50 == 0, F.substr(text, F.lit(1), F.length(text) - 3)).otherwise(text).alias("document"))
    return told(alerts.weather_alerts(raw), "id", "provider", "category", "event", "severity", "priority", "headline", "description", "areaName", "region", "effective", "updated", "geometry")


def feed_bilingual_alerts(spark, d):
    kind = F.element_at(F.array(*[F.lit(x) for x in ("watch", "Warning", "statement", "x")]), (C("doc_id") % 4 + 1).cast("int"))
    p = F.struct(kind.alias("alert_type"), F.when(C("doc_id") % 3 == 0, "").otherwise(C("text")).alias("alert_name_en"), C("source").alias("alert_name_fr"), C("text").alias("alert_text_fr"), C("lang").alias("alert_area_name_en"), F.lit("2024-02-01T00:00:00Z").alias("validity_datetime"))
    raw = t(spark, d, "documents").select(collection(C("doc_id").cast("string"), p).alias("document"))
    return told(alerts.bilingual_alerts(raw, "u"), "id", "status", "category", "event", "severity", "priority", "description", "areaName", "onset", "updated")


def feed_warning_summaries(spark, d):
    """A summary for every nation's customers; of two details of a code the later one counts."""
    value = F.struct(F.when(C("c_custkey") % 3 == 0, C("c_name")).alias("name"), F.concat(F.lit("W"), C("c_custkey") % 40).alias("code"), F.when(C("c_custkey") % 2 == 0, "Issue").otherwise("CANCEL").alias("actionCode"), F.lit("2024-01-01T08:00:00+08:00").alias("issueTime"))
    entries = t(spark, d, "customer").select("c_nationkey", F.struct(F.concat(F.lit("k"), C("c_custkey")).alias("key"), value.alias("value")).alias("e"))
    summaries = entries.groupBy("c_nationkey").agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("document"))
    code = F.concat(F.lit("W"), C("s_suppkey").cast("string"))
    items = F.array(F.struct(F.lit("").alias("warningStatementCode"), code.alias("subtype"), F.lit("old").alias("contents")), F.struct(code.alias("warningStatementCode"), F.lit(None).cast("string").alias("subtype"), F.concat("s_name", F.lit(" very  hot")).alias("contents")))
    details = t(spark, d, "supplier").select(F.to_json(F.struct(items.alias("details"))).alias("document"))
    return told(alerts.warning_summaries(summaries, details, "u"), "id", "category", "event", "severity", "status", "description", "effective", "expires")


def feed_area_forecasts(spark, d):
    """A payload for every customer's orders; only places of even orders are named."""
    area = F.concat(F.lit("A"), C("o_orderkey").cast("string"))
    meta = F.when(C("o_orderkey") % 2 == 0, F.struct(area.alias("name"), F.struct((C("o_orderkey") % 90).cast("double").alias("latitude"), (C("o_orderkey") % 180).cast("double").alias("longitude")).alias("label_location")))
    forecast = F.struct(area.alias("area"), F.when(C("o_orderkey") % 3 == 0, "Light  Rain").otherwise(C("o_orderpriority")).alias("forecast"))
    data = F.struct(F.collect_list(meta).alias("area_metadata"), F.struct(F.lit("2024-01-01T08:00:00+08:00").alias("start"), F.lit("later").alias("end")).alias("valid_period"), F.lit("t").alias("updated_timestamp"), F.array(F.struct(F.lit("").alias("update_timestamp"), F.collect_list(forecast).alias("forecasts"))).alias("items"))
    raw = t(spark, d, "orders").groupBy("o_custkey").agg(F.to_json(F.struct(data.alias("data"))).alias("document"))
    return told(alerts.area_forecasts(raw, "u"), "id", "event", "severity", "headline", "areaName", "effective", "expires", "updated", "layer", "geometry")


def feed_area_warnings(spark, d):
    """A report for every order, an area for every line; class 20 names replace those of offices."""
    name = lambda x: F.struct(F.concat(F.lit(x), C("s_name")).alias("name"), F.when(C("s_suppkey") % 2 == 0, C("s_name")).alias("enName"), F.concat(F.lit(x), C("s_nationkey").cast("string")).alias("officeName"))
    group = lambda x, by: F.create_map(C("s_suppkey").cast("string"), name(x)).alias(by)
    areas = alerts.area_names(t(spark, d, "supplier").filter("s_suppkey % 5 > 0").select(F.to_json(F.struct(group("old ", "offices"), group("", "class20s"))).alias("document")))
    status = F.when(C("l_returnflag") == "R", alerts.OVER[0]).otherwise(C("l_returnflag"))
    warning = F.struct(F.lpad((C("l_partkey") % 40).cast("string"), 2, "0").alias("code"), status.alias("status"))
    area = F.struct(C("l_suppkey").cast("string").alias("code"), F.array(warning).alias("warnings"))
    reports = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("reportDatetime"), F.array(F.struct(F.collect_list(area).alias("areas"))).alias("areaTypes"))
    raw = reports.select(F.to_json(F.array(F.struct("reportDatetime", "areaTypes"))).alias("document"))
    return told(alerts.area_warnings(raw, areas, "u", F.lit("1996-01-04 00:00:00").cast("timestamp")), "id", "event", "severity", "status", "headline", "areaName", "region", "updated")


def feed_earthquakes(spark, d):
    """Fifty events a payload."""
    p = F.struct(F.when(C("event_id") % 9 == 0, "none").otherwise((C("event_id") % 80 / 10).cast("string")).alias("mag"), C("event_type").alias("place"), F.unix_millis(C("ts").cast("timestamp")).alias("time"), F.when(C("event_id") % 2 == 0, C("props")).alias("title"))
    feature = F.struct(C("event_id").cast("string").alias("id"), place(C("event_id") % 180, C("event_id") % 90).alias("geometry"), p.alias("properties"))
    raw = t(spark, d, "events").groupBy(F.floor(C("event_id") / 50).alias("b")).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("document"))
    return told(alerts.earthquakes(raw, "u"), "id", "category", "severity", "headline", "description", "areaName", "onset", "layer", "geometry")


def feed_cap_entries(spark, d):
    """Atom feeds of one entry for two documents of three, single alerts for the others; one in 50 isn't well formed."""
    space = 'xmlns:cap="urn:oasis:names:tc:emergency:cap:1.2" xmlns:georss="http://www.georss.org/georss"'
    entry = F.concat(tag("id", C("doc_id").cast("string")), tag("title", C("text")), tag("summary", C("text")), F.lit('<link href="http://x/1"/><link type="application/cap+xml" href="http://x/cap"/>'), tag("cap:severity", level("doc_id")), tag("cap:areaDesc", C("lang")), tag("georss:point", F.concat_ws(" ", C("doc_id") % 90, C("doc_id") % 180)))
    feed = F.concat(F.lit(f'<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" {space}><entry>'), entry, F.when(C("doc_id") % 50 == 1, "").otherwise("</entry></feed>"))
    info = F.concat(F.lit("<info>"), tag("event", C("source")), tag("severity", level("doc_id")), tag("description", C("text")), F.lit("<area>"), tag("areaDesc", C("lang")), F.lit("<polygon>0,0 0,1 1,1</polygon></area></info>"))
    alone = F.concat(F.lit('<alert xmlns="urn:oasis:names:tc:emergency:cap:1.2">'), tag("identifier", C("doc_id").cast("string")), tag("sent", F.lit("2024-01-02T00:00:00Z")), info, F.lit("</alert>"))
    raw = t(spark, d, "documents").select(F.concat(F.lit("https://f/atom-"), C("lang")).alias("url"), F.when(C("doc_id") % 3 == 0, alone).otherwise(feed).alias("document"))
    return told(alerts.cap_feeds(raw), "id", "sourceUrl", "category", "event", "severity", "description", "areaName", "region", "updated", "geometry").drop("lat")


def feed_disaster_items(spark, d):
    item = F.concat(F.lit("<item>"), tag("title", C("text")), tag("link", F.concat(F.lit("http://x/"), C("doc_id").cast("string"))), tag("guid", F.when(C("doc_id") % 2 == 0, C("doc_id").cast("string"))), tag("gdacs:severity", F.lit("Red")), tag("pubDate", F.lit("2024-01-01")), tag("georss:point", F.concat_ws(" ", C("doc_id") % 90, C("doc_id") % 180)), F.lit("</item>"))
    text = F.concat(F.lit('<rss xmlns:georss="http://www.georss.org/georss" xmlns:gdacs="http://www.gdacs.org"><channel>'), item, F.lit("</channel></rss>"))
    return told(alerts.disaster_items(t(spark, d, "documents").select(text.alias("document")), "u"), "id", "sourceUrl", "category", "event", "severity", "updated", "geometry")


def kml(marks: Column) -> Column:
    return F.encode(F.concat(F.lit('<kml xmlns="http://www.opengis.net/kml/2.2"><Document>'), marks, F.lit("</Document></kml>")), "UTF-8")


def feed_placemarks(spark, d):
    """Two placemarks a document, whose second has a line only; one document in 50 can't be read."""
    one = F.concat(F.lit("<Placemark>"), tag("name", C("lang")), tag("description", C("text")), F.lit("<Point>"), tag("coordinates", F.concat_ws(",", C("doc_id") % 180, C("doc_id") % 90)), F.lit("</Point></Placemark>"))
    content = F.when(C("doc_id") % 50 == 0, F.encode(F.lit("<kml"), "UTF-8")).otherwise(kml(F.concat(one, F.lit("<Placemark><LineString><coordinates>1,2 3,4</coordinates></LineString></Placemark>"))))
    raw = t(spark, d, "documents").select(C("doc_id").alias("ordinal"), C("source").alias("url"), content.alias("content"))
    return alerts.placemarks(raw).select("ordinal", "url", "at", "name", F.sha2(K.compact_text(C("description")), 256).alias("description"), "point", "line", "polygon", C("error").isNotNull().alias("failed"))


def feed_cyclones(spark, d):
    """A payload for each nation's suppliers; that of the first counts that has any, and those of two in three have none."""
    mark = F.concat(F.lit("<Placemark>"), tag("name", F.when(C("s_suppkey") % 2 == 0, C("s_name"))), tag("description", C("s_name")), F.lit("<LineString><coordinates>1,2 3,4</coordinates></LineString></Placemark>"))
    marks = t(spark, d, "supplier").select("s_nationkey", F.when(C("s_nationkey") % 3 == 2, mark).alias("m"), "s_suppkey").groupBy("s_nationkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "m"))), lambda x: x["m"]), "").alias("m"))
    return told(alerts.cyclone_products(marks.select(C("s_nationkey").alias("ordinal"), F.lit("a.kml").alias("url"), kml(C("m")).alias("content"))), "id", "category", "event", "severity", "headline", "description", "layer")


def feed_fires(spark, d):
    c = lambda x: x.cast("string")
    rows = t(spark, d, "events").select(
        F.lit("VIIRS").alias("product"), F.when(C("event_id") % 10 == 0, "x").otherwise(c(C("event_id") % 90)).alias("latitude"), c(C("event_id") % 180).alias("longitude"), F.date_format("ts", "yyyy-MM-dd").alias("acq_date"),
        c(C("event_id") % 24 * 100).alias("acq_time"), C("event_type").substr(1, 1).alias("confidence"), F.when(C("event_id") % 4 > 0, c(C("event_id") % 400)).alias("bright_ti4"),
    )
    return told(alerts.fire_detections(rows), "id", "category", "severity", "headline", "description", "updated", "layer", "geometry")


def feed_geojson_alerts(spark, d):
    p = F.struct(F.when(C("doc_id") % 2 == 0, C("source")).alias("event"), C("text").alias("title"), level("doc_id").alias("severity"), C("lang").alias("areaDesc"), F.when(C("doc_id") % 3 == 0, F.lit("http://x")).otherwise("").alias("sourceUrl"), F.lit("2024-01-01T00:00:00-05:00").alias("expires"))
    raw = t(spark, d, "documents").select(collection(F.when(C("doc_id") % 5 > 0, C("doc_id").cast("string")), p).alias("document"))
    return told(alerts.geojson_alerts(raw, "BOM", "u", "Bureau"), "id", "sourceUrl", "category", "event", "severity", "headline", "areaName", "expires", "attribution")


def feed_status(spark, d):
    """Providers are sources; src0's documents are all cut, src1's partly, and nothing was asked of the last one."""
    text = F.to_json(F.struct("text"))
    cut = (C("source") == "src0") | ((C("source") == "src1") & (C("doc_id") % 2 == 0))
    raw = t(spark, d, "documents").select(C("source").alias("provider"), F.when(cut, F.substr(text, F.lit(2))).otherwise(text).alias("document"))
    named = t(spark, d, "documents").select(C("source").alias("provider")).union(t(spark, d, "region").select(C("r_name").alias("provider")))
    return sources.provider_status(sources.payload_faults(raw, "json"), "provider", "failed", named)


def feed_observations(spark, d):
    """Reports under two sets of names; M and empty are missing values."""
    c = lambda x: x.cast("string")
    raw = t(spark, d, "events").select(
        F.when(C("event_id") % 2 == 0, c(C("user_id"))).alias("station_id"), F.when(C("event_id") % 2 == 1, c(C("user_id"))).otherwise("M").alias("icaoId"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("obsTime"),
        F.when(C("event_id") % 7 == 0, "M").otherwise(c(C("user_id") % 90)).alias("lat"), c(C("user_id") % 180).alias("longitude"), F.when(C("event_id") % 5 == 0, "").otherwise(c(C("event_id") % 40)).alias("temp_c"), F.lit("oops").alias("dewp"),
    )
    return sources.normalised_observations(raw)


def feed_stations(spark, d):
    """The place that a station's last report tells."""
    return sources.stations_of(t(spark, d, "events").select(C("user_id").alias("station"), C("event_id").alias("observed_at"), (C("event_id") % 90).cast("double").alias("latitude"), (C("event_id") % 180).cast("double").alias("longitude")))


def feed_city_forecasts(spark, d):
    """Orders of a customer as the days of a city; one document in nine is cut."""
    day = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("forecastDate"), C("o_orderkey").cast("string").alias("maxTemp"), F.lit("").alias("minTemp"), (C("o_orderkey") % 100).alias("weatherIcon"))
    by = t(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", day.alias("day")))).alias("days"))
    days = F.transform("days", lambda x: x["day"])
    city = F.struct((C("o_custkey") % 90).cast("string").alias("cityLatitude"), F.lit("1").alias("cityLongitude"), F.struct(F.lit("org").alias("orgName")).alias("member"), F.struct(days.alias("forecastDay")).alias("forecast"))
    text = F.to_json(F.struct(city.alias("city")))
    raw = by.select(C("o_custkey").cast("string").alias("city_id"), F.when(C("o_custkey") % 9 == 0, F.substr(text, F.lit(2))).otherwise(text).alias("document"))
    names = t(spark, d, "customer").select(C("c_custkey").cast("string").alias("city_id"), C("c_name").alias("city"))
    out = feeds.city_forecasts(raw, names)
    return out.select("name", "lat", "src", F.array_join("forecastDate", ",").alias("days"), F.array_join("maxTemp", ",").alias("highs"), F.array_join(F.transform("weatherIcon", lambda x: x.cast("string")), ",").alias("icons"))


def feed_request_ids(spark, d):
    return documents.request_ids(t(spark, d, "orders").select(F.concat("o_orderpriority", F.lit("/"), (C("o_custkey") % 500).cast("string")).alias("station")), size=100)


LEVEL_SQL = "['minor', 'moderate', 'severe', 'extreme', 'unknown'][doc_id % 5 + 1]"
RANK_SQL = "[1, 2, 3, 4, 0][doc_id % 5 + 1]::int"
POINT_SQL = "(doc_id % 180)::double lon, (doc_id % 90)::double lat"
TEXT_SQL = f"sha256({compact_sql('text')})"


def category_sql(e: str) -> str:
    """The category of coalesced texts; a blank one is weather."""
    return f"(select coalesce({CASE_SQL}, 'weather') from (select {e} e))"


PLANS = {
    "feed_weather_alerts": (feed_weather_alerts, f"""select doc_id::varchar id, 'NOAA_NWS' provider, {category_sql("text")} category, {TEXT_SQL} "event", {LEVEL_SQL} severity, {RANK_SQL} priority, null::varchar headline, {TEXT_SQL} description, lang "areaName", source region,
        '2024-01-01T00:00:00+00:00' effective, 'soon' updated, {POINT_SQL} from documents where doc_id % 50 <> 0"""),
    "feed_bilingual_alerts": (feed_bilingual_alerts, f"""with b as (select *, ['watch', 'Warning', 'statement', 'x'][doc_id % 4 + 1] kind, coalesce(nullif(case when doc_id % 3 = 0 then '' else text end, ''), source) n from documents),
        k as (select *, lower(kind || ' ' || case when doc_id % 3 = 0 then '' else coalesce(text, '') end) l from b), s as (select *, case when contains(l, 'warning') then 3 when contains(l, 'watch') then 2 when contains(l, 'advisory') or contains(l, 'statement') then 1 else 0 end r from k)
        select doc_id::varchar id, kind status, {category_sql("n")} category, sha256({compact_sql("n")}) "event", ['unknown', 'minor', 'moderate', 'severe'][r + 1] severity, r::int priority, {TEXT_SQL} description, lang "areaName", '2024-02-01T00:00:00+00:00' onset, null::varchar updated from s"""),
    "feed_warning_summaries": (feed_warning_summaries, f"""with c as (select *, s_name || ' very hot' told from customer left join supplier on c_custkey % 40 = s_suppkey), n as (select *, coalesce(case when c_custkey % 3 = 0 then c_name end, told, 'k' || c_custkey) n from c)
        select 'HKO:k' || c_custkey || ':2024-01-01T08:00:00+08:00' id, {category_sql("n")} category, sha256(n) "event", case when c_custkey % 2 = 0 then 'severe' else 'moderate' end severity, case when c_custkey % 2 = 0 then 'Issue' else 'CANCEL' end status, sha256(coalesce(told, n)) description,
        '2024-01-01T00:00:00+00:00' effective, null::varchar expires from n"""),
    "feed_area_forecasts": (feed_area_forecasts, """with f as (select 'A' || o_orderkey a, o_orderkey k, case when o_orderkey % 3 = 0 then 'Light Rain' else o_orderpriority end e from orders)
        select 'SG:' || a || ':t' id, sha256(e) "event", case when k % 3 = 0 then 'minor' else 'unknown' end severity, sha256(a || ': ' || e) headline, a "areaName", '2024-01-01T00:00:00+00:00' effective, 'later' expires, 't' updated, 'regional_forecast' layer,
        case when k % 2 = 0 then (k % 180)::double end lon, case when k % 2 = 0 then (k % 90)::double end lat from f"""),
    "feed_area_warnings": (feed_area_warnings, f"""with r as (select *, min(l_shipdate) over (partition by l_orderkey) w from lineitem), w as (select l_suppkey k, lpad((l_partkey % 40)::varchar, 2, '0') c, l_returnflag status, strftime(w, '%Y-%m-%dT%H:%M:%S') told from r where w >= timestamp '1996-01-01' and l_returnflag <> 'R'),
        n as (select *, {NAMES_SQL} e, coalesce(s_name, k::varchar) area from w left join supplier on s_suppkey = k and s_suppkey % 5 > 0)
        select 'JMA:' || k || ':' || c || ':' || told || 'Z' id, sha256(e) "event", case when c[1] = '3' then 'extreme' when c in ('02','03','04','05','06','07') then 'severe' when c[1] in ('1', '2') then 'moderate' else 'unknown' end severity, status, sha256(e || ' for ' || area) headline,
        area "areaName", s_nationkey::varchar region, told || '+00:00' updated from n"""),
    "feed_earthquakes": (feed_earthquakes, """with m as (select *, case when event_id % 9 <> 0 then event_id % 80 end m, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') told from events)
        select event_id::varchar id, 'earthquake' category, case when m is null then 'unknown' when m >= 70 then 'extreme' when m >= 60 then 'severe' when m >= 50 then 'moderate' else 'minor' end severity, sha256(case when event_id % 2 = 0 then props end) headline,
        sha256('Magnitude ' || coalesce((m // 10) || '.' || (m % 10), 'none') || '; place: ' || event_type) description, event_type "areaName", told onset, 'earthquakes' layer, (event_id % 180)::double lon, (event_id % 90)::double lat from m"""),
    "feed_cap_entries": (feed_cap_entries, f"""select doc_id::varchar id, case when doc_id % 3 = 0 then 'https://f/atom-' || lang else 'http://x/cap' end "sourceUrl", {category_sql("case when doc_id % 3 = 0 then source else text end")} category, sha256({compact_sql("case when doc_id % 3 = 0 then source else text end")}) "event", {LEVEL_SQL} severity, {TEXT_SQL} description,
        lang "areaName", lang region, case when doc_id % 3 = 0 then '2024-01-02T00:00:00+00:00' end updated, case when doc_id % 3 > 0 then (doc_id % 180)::double end lon from documents where doc_id % 3 = 0 or doc_id % 50 <> 1"""),
    "feed_disaster_items": (feed_disaster_items, f"""select case when doc_id % 2 = 0 then doc_id::varchar else 'http://x/' || doc_id end id, 'http://x/' || doc_id "sourceUrl", {category_sql("text")} category, {TEXT_SQL} "event", 'unknown' severity, '2024-01-01T00:00:00+00:00' updated, {POINT_SQL} from documents"""),
    "feed_placemarks": (feed_placemarks, f"""select doc_id::int ordinal, source url, k "at", case when k = 0 then lang end "name", case when k = 0 then {TEXT_SQL} end description, case when k = 0 then (doc_id % 180) || ',' || (doc_id % 90) end point, case when k = 1 then '1,2 3,4' end line, null::varchar polygon, k = -1 failed
        from documents, (values (0), (1), (-1)) a(k) where (doc_id % 50 = 0) = (k = -1)"""),
    "feed_cyclones": (feed_cyclones, """with f as (select *, row_number() over (order by s_suppkey) - 1 k from supplier where s_nationkey = (select min(s_nationkey) from supplier where s_nationkey % 3 = 2))
        select 'a.kml#' || case when s_suppkey % 2 = 0 then s_name else k::varchar end id, 'tropical' category, sha256(case when s_suppkey % 2 = 0 then s_name else 'Tropical cyclone product' end) "event", 'unknown' severity, sha256(case when s_suppkey % 2 = 0 then s_name end) headline,
        sha256(s_name) description, 'tropical' layer from f"""),
    "feed_fires": (feed_fires, """with f as (select *, strftime(ts, '%Y-%m-%d') d, event_id % 24 h from events where event_id % 10 <> 0)
        select 'VIIRS:' || (event_id % 90) || ':' || (event_id % 180) || ':' || d || ':' || (h * 100) id, 'fire' category, case when event_type[1] = 'h' then 'moderate' else 'unknown' end severity, sha256('Active fire detection (VIIRS)') headline,
        sha256('Confidence: ' || event_type[1] || '; brightness: ' || case when event_id % 4 > 0 then (event_id % 400)::varchar else 'None' end) description, d || 'T' || lpad(h::varchar, 2, '0') || ':00:00+00:00' updated, 'fires' layer, (event_id % 180)::double lon, (event_id % 90)::double lat from f"""),
    "feed_geojson_alerts": (feed_geojson_alerts, f"""with e as (select *, coalesce(case when doc_id % 2 = 0 then source end, nullif(text, '')) e from documents)
        select case when doc_id % 5 > 0 then doc_id::varchar else substr(regexp_replace(regexp_replace('BOM|' || coalesce({compact_sql("e")}, '') || '|' || lang || '|', '[^A-Za-z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 180) end id, case when doc_id % 3 = 0 then 'http://x' else 'u' end "sourceUrl",
        {category_sql("x")} category, sha256({compact_sql("e")}) "event", {LEVEL_SQL} severity, {TEXT_SQL} headline, lang "areaName", '2024-01-01T05:00:00+00:00' expires, 'Bureau' attribution from (select *, e x from e)"""),
    "feed_status": (feed_status, """with s as (select source p, count(*) n, count(*) filter (source = 'src0' or source = 'src1' and doc_id % 2 = 0) f from documents group by 1)
        select p provider, case when f = 0 then 'ok' when f < n then 'partial' else 'error' end status from s union all select r_name, 'skipped' from region"""),
    "feed_observations": (feed_observations, """select user_id::varchar station, strftime(ts, '%Y-%m-%d %H:%M:%S') observed_at, (user_id % 90)::double latitude, (user_id % 180)::double longitude, case when event_id % 5 <> 0 then (event_id % 40)::double end temperature_c, null::double dewpoint_c, null::double wind_kt, null::double pressure_hpa,
        null::double altimeter_in_hg, null::double precipitation_in from events where event_id % 7 <> 0"""),
    "feed_request_ids": (feed_request_ids, """with i as (select distinct o_orderpriority || '/' || (o_custkey % 500) id from orders), k as (select id, (row_number() over (order by id) - 1) // 100 batch from i)
        select batch::bigint batch, string_agg(id, ',' order by id) ids from k group by 1"""),
    "feed_stations": (feed_stations, "select user_id station, (max(event_id) % 90)::double latitude, (max(event_id) % 180)::double longitude from events group by 1"),
    "feed_city_forecasts": (feed_city_forecasts, """select c_name as "name", (o_custkey % 90)::varchar lat, 'org' src, string_agg(strftime(o_orderdate, '%Y-%m-%d'), ',' order by o_orderkey) as days, string_agg(o_orderkey::varchar, ',' order by o_orderkey) highs, string_agg((o_orderkey % 100)::varchar, ',' order by o_orderkey) icons
        from orders join customer on c_custkey = o_custkey where o_custkey % 9 <> 0 group by c_name, o_custkey"""),
}
