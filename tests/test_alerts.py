"""Normalisers of hazard feeds on small payloads."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from isobar.functions import keys
from isobar.operators import feeds
from isobar.sources import alerts, documents, sinks
from isobar.sources import feeds as sources


def raw(spark, *payloads):
    return spark.createDataFrame([(p if isinstance(p, str) or p is None else json.dumps(p),) for p in payloads], "document string")


def rows(df):
    return [{k: v for k, v in r.asDict().items() if v is not None} for r in df.collect()]


def test_weather_alerts(spark):
    one = {"id": "f1", "geometry": {"type": "Point", "coordinates": [1.5, 2]}, "properties": {"id": "", "@id": "http://a", "event": "Flood  Watch", "severity": "Severe", "areaDesc": "Here", "effective": "2024-01-01T02:00:00+02:00", "sent": "Mon, 1 Jan"}}
    got = rows(alerts.weather_alerts(raw(spark, {"features": [one]}, "{broken", None)))
    assert len(got) == 1 and got[0] | {"geometry": None} == {"id": "f1", "provider": "NOAA_NWS", "sourceUrl": "http://a", "category": "flood", "event": "Flood Watch", "severity": "severe", "areaName": "Here", "country": "US", "effective": "2024-01-01T00:00:00+00:00", "updated": "Mon, 1 Jan", "layer": "alerts", "priority": 3, "attribution": "NOAA/National Weather Service", "geometry": None}
    assert json.loads(got[0]["geometry"]) == {"type": "Point", "coordinates": [1.5, 2]}


def test_bilingual_alerts(spark):
    p = [{"alert_type": "watch", "alert_name_en": "", "alert_name_fr": "Veille"}, {"alert_type": "x", "alert_name_en": "Wind Warning", "alert_text_fr": "Vent", "validity_datetime": "2024-01-01"}]
    got = rows(alerts.bilingual_alerts(raw(spark, {"features": [{"properties": x} for x in p]}), "u"))
    assert [(g["event"], g["severity"], g.get("description"), g.get("onset")) for g in got] == [("Veille", "moderate", None, None), ("Wind Warning", "severe", "Vent", "2024-01-01T00:00:00+00:00")]


def test_warning_summaries(spark):
    summary = {"WTS": {"name": "Thunderstorm", "code": "WTS", "actionCode": "issue", "issueTime": "2024-01-01T00:00:00+08:00"}, "WHOT": {"code": "WHOT"}, "note": "text"}
    detail = {"details": [{"warningStatementCode": "WHOT", "contents": "old"}, {"subtype": "WHOT", "contents": "Very hot"}]}
    got = {g["id"]: g for g in rows(alerts.warning_summaries(raw(spark, summary), raw(spark, detail), "u"))}
    assert set(got) == {"HKO:WTS:2024-01-01T00:00:00+08:00", "HKO:WHOT:None"}
    assert (got["HKO:WHOT:None"]["event"], got["HKO:WHOT:None"]["severity"], got["HKO:WHOT:None"]["category"]) == ("Very hot", "moderate", "temperature")
    assert got["HKO:WTS:2024-01-01T00:00:00+08:00"]["severity"] == "severe"


def test_area_forecasts(spark):
    p = {"data": {"area_metadata": [{"name": "Bedok", "label_location": {"latitude": 1.3, "longitude": 103.9}}], "valid_period": {"start": "2024-01-01T00:00:00+08:00"}, "updated_timestamp": "t", "items": [{"update_timestamp": "", "forecasts": [{"area": "Bedok", "forecast": "Light Rain"}, {"area": "Yishun", "forecast": "Cloudy"}]}]}}
    got = {g["areaName"]: g for g in rows(alerts.area_forecasts(raw(spark, p), "u"))}
    assert (got["Bedok"]["severity"], got["Bedok"]["id"], json.loads(got["Bedok"]["geometry"])["coordinates"], got["Bedok"]["layer"]) == ("minor", "SG:Bedok:t", [103.9, 1.3], "regional_forecast")
    assert got["Yishun"]["severity"] == "unknown" and "geometry" not in got["Yishun"]


def test_area_warnings(spark):
    areas = alerts.area_names(raw(spark, {"offices": {"1": {"name": "old"}}, "class20s": {"1": {"name": "n", "enName": "Town", "officeName": "Office"}, "2": {"name": "village"}}}))
    def report(at, warnings):
        return {"reportDatetime": at, "areaTypes": [{"areas": [{"code": "1", "warnings": warnings}, {"code": "3", "warnings": []}]}]}
    p = [report("2024-01-10T00:00:00+09:00", [{"code": "33", "status": "発表"}, {"code": "15", "status": "解除"}, {"code": "99"}]), report("2023-01-01T00:00:00Z", [{"code": "02", "status": "x"}])]
    got = rows(alerts.area_warnings(raw(spark, p), areas, "u", F.lit("2024-01-10 12:00:00").cast("timestamp")))
    assert [(g["event"], g["severity"], g["areaName"], g["region"]) for g in got] == [("Heavy rain emergency warning", "extreme", "Town", "Office"), ("JMA warning code 99", "unknown", "Town", "Office")]


def test_earthquakes(spark):
    p = {"features": [{"id": "q", "geometry": None, "properties": {"mag": 6.1, "place": "Sea", "time": 1704067200123, "title": "M 6.1"}}, {"id": "r", "properties": {"mag": None}}]}
    got = rows(alerts.earthquakes(raw(spark, p), "u"))
    assert (got[0]["severity"], got[0]["onset"], got[0]["description"], got[0]["layer"]) == ("severe", "2024-01-01T00:00:00+00:00", "Magnitude 6.1; place: Sea", "earthquakes")
    assert got[1]["severity"] == "unknown" and "onset" not in got[1]


FEED = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:cap="urn:oasis:names:tc:emergency:cap:1.2" xmlns:georss="http://www.georss.org/georss">
<entry><id>e1</id><title>Orange wind</title><link href="http://x/1" type="text/html"/><link href="http://x/cap" type="application/cap+xml"/><cap:event>Wind  gusts</cap:event><cap:severity>Severe</cap:severity><cap:areaDesc>Coast</cap:areaDesc><cap:polygon>1,2 3,4 5,6</cap:polygon><updated>2024-01-01T00:00:00Z</updated></entry>
<entry><id>e2</id><title>Snow</title><summary>deep</summary><georss:point>10 20</georss:point></entry></feed>"""
ALERT = """<alert xmlns="urn:oasis:names:tc:emergency:cap:1.2"><identifier>a1</identifier><sent>2024-01-02T00:00:00Z</sent><status>Actual</status><info><event>Fog</event><severity>Minor</severity><area><areaDesc>Valley</areaDesc><polygon>0,0 0,1 1,1</polygon><polygon>5,5 5,6 6,6</polygon></area></info></alert>"""


def test_cap_feeds(spark):
    df = spark.createDataFrame([("https://f/atom-france", FEED), ("https://f/atom-spain", ALERT), ("https://f/bad", "<feed><entry>")], "url string, document string")
    got = {g.get("id"): g for g in rows(alerts.cap_feeds(df))}
    assert (got["e1"]["event"], got["e1"]["sourceUrl"], got["e1"]["region"], got["e1"]["areaName"], got["e1"]["severity"]) == ("Wind gusts", "http://x/cap", "france", "Coast", "severe")
    assert json.loads(got["e1"]["geometry"])["type"] == "Polygon" and json.loads(got["e2"]["geometry"]) == {"type": "Point", "coordinates": [20.0, 10.0]}
    assert (got["e2"]["event"], got["e2"]["description"], got["e2"]["category"]) == ("Snow", "deep", "winter")
    assert (got["a1"]["event"], got["a1"]["status"], got["a1"]["areaName"], got["a1"]["updated"]) == ("Fog", "Actual", "Valley", "2024-01-02T00:00:00+00:00") and json.loads(got["a1"]["geometry"])["type"] == "MultiPolygon"
    faults = sources.payload_faults(df, "xml").withColumn("provider", F.lit("METEOALARM"))
    status = sources.provider_status(faults, "provider", "failed", spark.createDataFrame([("METEOALARM",), ("X",)], "provider string"), alerts.cap_feeds(df))
    assert {r["provider"]: r["status"] for r in status.collect()} == {"METEOALARM": "partial", "X": "skipped"}


def test_cap_feeds_read_documents_once(spark):
    """A document is parsed as a feed in one place of the plan and as an alert in another; compacting writes a text down once."""
    df = spark.createDataFrame([("u", FEED), ("u", None), (None, "<feed>"), ("u", "<alert")], "url string, document string")
    found = alerts.cap_feeds(df)
    parsed = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "from_xml(" in x]
    assert sum(x.count("from_xml(") for x in parsed) == 2
    text = spark.range(1).select(F.coalesce(keys.compact_text(F.col("id").cast("string")), keys.given(keys.compact_text(F.concat("id", F.lit(" b "))))).alias("x"))
    assert text._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 2 and text.first()["x"] == "0"
    assert [r["x"] for r in spark.createDataFrame([("",), (None,), (" \t",), (" a  b",)], "x string").select(keys.compact_text(F.col("x")).alias("x")).collect()] == [None, None, None, "a b"]
    assert {r["id"] for r in found.collect()} >= {"e2"}


def test_disaster_items(spark):
    rss = """<rss xmlns:georss="http://www.georss.org/georss" xmlns:gdacs="http://www.gdacs.org"><channel><item><title>Cyclone A</title><guid>g1</guid><gdacs:severity>Red</gdacs:severity><pubDate>Wed, 01 May 2024</pubDate><georss:point>1 2</georss:point></item><item><title>b</title><link>l2</link></item></channel></rss>"""
    got = rows(alerts.disaster_items(raw(spark, rss, "<rss>"), "u"))
    assert [(g["id"], g["category"], g["severity"], g.get("updated"), "geometry" in g) for g in got] == [("g1", "tropical", "unknown", "Wed, 01 May 2024", True), ("l2", "weather", "unknown", None, False)]


KML = """<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Folder><Placemark><name>Track</name><LineString><coordinates>1,2 3,4</coordinates></LineString></Placemark><Placemark/><Placemark><description>cone</description><Polygon><outerBoundaryIs><LinearRing><coordinates>0,0 1,0 1,1</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark></Folder></Document></kml>"""


def test_cyclone_products(spark):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("doc.kml", KML)
    df = spark.createDataFrame([(0, "a.kml", b"<kml"), (1, "b.kmz", buffer.getvalue()), (2, "c.kml", KML.encode())], "ordinal int, url string, content binary")
    got = rows(alerts.cyclone_products(df))
    assert [(g["id"], g["event"], json.loads(g["geometry"])["type"]) for g in got] == [("b.kmz#Track", "Track", "LineString"), ("b.kmz#2", "Tropical cyclone product", "Polygon")]
    assert alerts.placemarks(df).filter("error is not null").count() == 1


def test_fire_detections(spark, tmp_path):
    (tmp_path / "fires.csv").write_text("latitude,longitude,acq_date,acq_time,confidence,bright_ti4\n1.5,2.5,2024-01-01,35,h,300\nx,2,2024-01-01,1,n,1\n")
    got = rows(alerts.fire_detections(documents.detections(spark, str(tmp_path / "fires.csv"), "VIIRS")))
    assert [(g["id"], g["severity"], g["updated"], json.loads(g["geometry"])["coordinates"], g["description"]) for g in got] == [("VIIRS:1.5:2.5:2024-01-01:35", "moderate", "2024-01-01T00:35:00+00:00", [2.5, 1.5], "Confidence: h; brightness: 300")]


def test_geojson_alerts(spark):
    got = rows(alerts.geojson_alerts(raw(spark, {"features": [{"id": 7, "properties": {"title": "Storm", "areaDesc": "X"}}]}), "BOM", "u", "Bureau"))
    assert got[0]["event"] == "Storm" and got[0]["id"] == "7" and got[0]["areaName"] == "X" and got[0]["sourceUrl"] == "u"


def test_run_with_stale_features(spark):
    fresh = alerts.earthquakes(raw(spark, {"features": [{"id": "q", "properties": {"mag": 5}}]}), "u")
    old = fresh.withColumns({"provider": F.lit("GDACS"), "output": F.lit("earthquakes"), "stale": F.lit(False), "expires": F.lit("2000-01-01")})
    status = spark.createDataFrame([("USGS_EARTHQUAKES", "ok"), ("GDACS", "error")], "provider string, status string")
    out = feeds.hazard_outputs(fresh, old, status, F.lit("2024-01-01").cast("timestamp"))
    assert sorted((r["provider"], r["stale"], r["output"]) for r in out.collect()) == [("GDACS", True, "earthquakes"), ("USGS_EARTHQUAKES", False, "earthquakes")]
    told = {(r["kind"], r["name"]): (r["features"], r["status"]) for r in feeds.hazard_manifest(out, status).collect()}
    assert told["output", "earthquakes"] == (2, None) and told["output", "fires"] == (0, None) and told["provider", "GDACS"] == (0, "error") and told["provider", "USGS_EARTHQUAKES"] == (1, "ok")
    document = json.loads(sinks.feature_collections(out.filter("not stale"), "output", [*feeds.FIELDS, "stale"], ["id"]).first()["document"])
    assert document["type"] == "FeatureCollection" and document["features"][0]["properties"]["severity"] == "moderate" and "areaName" not in document["features"][0]["properties"]


def test_documents(spark, tmp_path):
    (tmp_path / "w.json").write_text('{"weights": {"gfs": 0.5,\n "ifs": "-1", "x": "no"}}')
    (tmp_path / "old.json").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"provider": "a"}}]}')
    (tmp_path / "cities.txt").write_text("country;city;id\nSpain;Madrid;12\n")
    assert {r["model"]: r["weight"] for r in documents.skill_weights(spark, str(tmp_path / "w.json")).collect()} == {"gfs": 0.5, "ifs": 0.0}
    assert documents.skill_weights(spark, str(tmp_path / "none.json")).count() == 0
    assert documents.previous_features(spark, [str(tmp_path / "none.json"), str(tmp_path / "old.json")]).first()["properties"] == {"provider": "a"}
    assert documents.previous_features(spark, [str(tmp_path / "none.json")]).count() == 0
    cities = documents.locations(spark, str(tmp_path / "cities.txt"))
    assert [tuple(r) for r in cities.collect()] == [("Spain", "Madrid", "12")]
    day = {"forecastDate": "2024-01-01", "maxTemp": "20", "minTemp": "", "weatherIcon": 2401}
    payload = spark.createDataFrame([("12", json.dumps({"city": {"cityLatitude": "40", "cityLongitude": "-3", "member": {"orgName": "AEMET"}, "forecast": {"forecastDay": [day, day]}}})), ("13", None)], "city_id string, document string")
    got = feeds.city_forecasts(payload, cities).collect()
    assert [(r["name"], r["src"], r["maxTemp"], r["weatherIcon"]) for r in got] == [("Madrid", "AEMET", ["20", "20"], [2401, 2401])]
    assert sorted(r["ids"] for r in documents.request_ids(spark.createDataFrame([("EGLL",), ("EGCC",), ("EGLL",), ("LFPG",)], "station string"), size=1).collect()) == ["EGCC", "EGLL", "LFPG"]
    radar = spark.createDataFrame([("a", True, (True,)), ("b", True, (False,)), ("c", None, (True,))], "id string, enabled boolean, redistribution struct<allowed:boolean>")
    assert [r["id"] for r in documents.eligible_radar(radar).collect()] == ["a"]


def test_scene_mirror(spark):
    good = spark.createDataFrame([("a-1", "{}", b"RIFF1234WEBPx", "old")], "id string, doc string, img binary, thumbnailUrl string")
    assert feeds.mirrored_scenes(good, "id", "doc", "img", "thumbnailUrl", "https://m/").first()["thumbnailUrl"] == "https://m/a-1.webp"
    bad = good.withColumn("id", F.lit("Bad Id"))
    try:
        feeds.mirrored_scenes(bad, "id", "doc", "img", "thumbnailUrl", "https://m").collect()
    except Exception as error:  # noqa: BLE001
        assert "invalid id of scene Bad Id" in str(error)
    else:
        raise AssertionError("a faulty scene went through")


def test_scene_files(spark, tmp_path):
    (tmp_path / "manifest.json").write_text('[{"id": "a-1", "name": "A", "thumbnailUrl": "old"},\n{"id": "b"}]')
    (tmp_path / "a-1.json").write_text("{}")
    (tmp_path / "a-1.webp").write_bytes(b"RIFF1234WEBPx")
    rows = documents.scenes(spark, str(tmp_path))
    faults = {r["id"]: r["fault"] for r in feeds.scene_faults(rows, "id", "doc", "img").collect()}
    assert faults == {"a-1": None, "b": "document"}


def test_written_observations(spark, tmp_path):
    reports = spark.createDataFrame([("B", "2024-01-01", 1.0, 2.0)], "station string, observed_at string, latitude double, longitude double")
    sinks.write_observations(reports, sources.stations_of(reports), str(tmp_path))
    assert spark.read.json(f"{tmp_path}/stations").first()["station"] == "B" and spark.read.json(f"{tmp_path}/observations").count() == 1
    sinks.write_forecasts(reports.withColumn("provider", F.lit("gfs")), f"{tmp_path}/f")
    assert spark.read.json(f"{tmp_path}/f").filter("provider = 'gfs'").count() == 1


def test_stations(spark):
    reports = spark.createDataFrame([("B", "2024-01-01", 1.0, 2.0), ("A", "2024-01-01", 3.0, 4.0), ("B", "2024-01-02", 5.0, 6.0)], "station string, observed_at string, latitude double, longitude double")
    assert [tuple(r) for r in sources.stations_of(reports).collect()] == [("A", 3.0, 4.0), ("B", 5.0, 6.0)]


def test_well_formed_json(spark):
    texts = ['{"a": 1}', '{"a": 1} more', '"a":1}', "1],[2", '1,"x"', "", " ", "[1, 2]", "null", "{", None]
    got = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, document string")
    told = {r["k"]: r["failed"] for r in sources.payload_faults(got, "json").collect()}
    assert [k for k in sorted(told) if not told[k]] == [0, 7, 8]
