"""Vectors with known results for operators, and cases that the tables don't have."""

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isobar.functions import conditions, fields, geometry, hazards, keys, units
from isobar.operators import consensus, feeds, grids, learning, products, tides
from isobar.sources import feeds as sources
from isobar.sources import sinks, tiles


def one(spark, column, **values):
    return spark.range(1).select(column.alias("x")).first()["x"]


def long(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_weighted_median_of_four_models(spark):
    rows = [(1, 1, m, "temperature", v, None) for m, v in (("gfs", 280.0), ("aigfs", 282.0), ("ifs", 290.0), ("icon", 292.0))]
    cells = long(spark, rows, "tile int, cell int, model string, field string, value double, skill double")
    out = consensus.field_consensus(cells, ["tile"], ["cell"]).first()
    assert (out["value"], out["families"], out["spread"], out["confidence"]) == (290.0, 3, 12.0, 0.0)


CELLS = "tile int, cell int, model string, field string, value double, skill double"


def test_field_consensus_by_planes(spark):
    """Two families must carry the plane, not each cell; codes are voted, rain has odds of its own."""
    rows = [(1, 1, "gfs", "wind_u", 3.0, None), (1, 2, "ifs", "wind_u", 5.0, None), (1, 1, "gfs", "humidity", 0.5, None), (1, 1, "aigfs", "humidity", 0.7, None)]
    rows += [(1, 1, m, "condition_code", v, None) for m, v in (("gfs", 1.0), ("aigfs", 2.0), ("ifs", 7.0), ("icon", 5.0))]
    rows += [(1, 1, m, "precipitation", v, None) for m, v in (("gfs", 0.0), ("ifs", 0.2), ("icon", 1.0))]
    out = {(r["cell"], r["field"]): r for r in consensus.field_consensus(long(spark, rows, CELLS), ["tile"], ["cell"]).collect()}
    assert set(out) == {(1, "wind_u"), (2, "wind_u"), (1, "condition_code"), (1, "precipitation"), (1, "precipitation_probability")}
    assert (out[1, "wind_u"]["value"], out[2, "wind_u"]["value"], out[1, "wind_u"]["confidence"]) == (3.0, 5.0, None)
    assert (out[1, "condition_code"]["value"], out[1, "precipitation"]["value"], out[1, "precipitation_probability"]["value"]) == (7.0, 0.2, 0.667)
    assert set(consensus.field_consensus(long(spark, rows, CELLS), ["tile"], ["cell"], quality=False).columns) == {"tile", "cell", "field", "value"}


def test_learned_consensus_stays_within_its_models(spark):
    rows = long(spark, [(1, 1, "gfs", "temperature", 280.0, 0.1), (1, 1, "ifs", "temperature", 284.0, 0.9)], CELLS)
    plain = consensus.field_consensus(rows, ["tile"], ["cell"], quality=False)
    for samples, want in ((3, 284.0), (2, 284.0)):
        bias = long(spark, [(1, 1.0, samples)], "tile int, value double, samples bigint")
        assert consensus.corrected_temperature(plain, rows, ["tile"], ["cell"], bias).first()["value"] == want
    low = long(spark, [(1, -1.0, 3)], "tile int, value double, samples bigint")
    assert consensus.corrected_temperature(plain, rows, ["tile"], ["cell"], low).first()["value"] == 283.0


def test_infinite_values_have_no_weight(spark):
    df = long(spark, [(1, math.inf), (1, 280.0), (1, -math.inf), (1, 282.0)], "g int, v double").withColumn("w", F.lit(1))
    assert consensus.weighted_median(df, ["g"], "v", "w", "m").first()["m"] == 280.0


def test_weighted_median_leaves_missing_out(spark):
    df = long(spark, [(1, 280.0), (1, math.nan), (1, None), (1, 290.0), (2, math.nan)], "g int, v double").withColumn("w", F.lit(1))
    assert {r["g"]: r["m"] for r in consensus.weighted_median(df, ["g"], "v", "w", "m").collect()} == {1: 280.0, 2: None}


def test_family_balanced_weights(spark):
    df = long(spark, [("n", 0.75), ("n", 0.25), ("e", 0.4), ("d", 0.8)], "f string, s double").withColumn("g", F.lit(1))
    assert sorted(r["w"] for r in consensus.family_balanced(df, ["g"], "f", "s", "w").collect()) == [0.125, 0.375, 0.4, 0.8]


def test_two_level_vote_tie_goes_to_later_family(spark):
    df = long(spark, [(1,), (2,), (7,), (5,)], "code int").withColumns({"g": F.lit(1), "w": F.when(F.col("code") < 3, 0.5).otherwise(1.0)})
    df = df.withColumn("f", conditions.family(F.col("code")))
    assert consensus.two_level_vote(df, ["g"], "code", "f", "w", "c").first()["c"] == 7


def test_precipitation(spark):
    df = long(spark, [(1, 0.0), (1, 0.2), (1, 1.0), (2, None)], "g int, a double").withColumn("w", F.lit(1))
    out = {r["g"]: (round(r["wet_probability"], 3), r["amount"]) for r in consensus.wet_statistics(df, ["g"], "a", "w").collect()}
    assert out == {1: (0.667, 0.2), 2: (0.0, 0.0)}


def test_confidence_and_clamp(spark):
    assert one(spark, consensus.confidence(F.lit(4.0), F.lit(2), "temperature")) == pytest.approx(1 / 3)
    assert one(spark, consensus.clamped_bias(F.lit(283.6), F.lit(1.0), F.lit(3), F.lit(280.0), F.lit(284.0))) == 284.0
    assert one(spark, consensus.clamped_bias(F.lit(None).cast("double"), F.lit(1.0), F.lit(3), F.lit(280.0), F.lit(284.0))) is None


@pytest.mark.parametrize(("lat", "lon", "key"), [(53.8, -1.5, "+50_-020"), (-89.0, 179.0, "-90_+160"), (90.0, 180.0, "+70_+160")])
def test_region_keys(spark, lat, lon, key):
    assert one(spark, keys.region_key(F.lit(lat), F.lit(lon))) == key


def test_packs(spark):
    south, west = keys.pack_origin(F.lit(-70), F.lit(-180))
    assert (one(spark, south), one(spark, west)) == (-90, -180)
    south, west = keys.pack_origin(F.lit(-10), F.lit(60))
    assert (one(spark, south), one(spark, west)) == (-60, 40)


def test_night_by_solar_hour(spark):
    at = F.lit("2026-01-01 20:00:00").cast("timestamp")
    assert one(spark, keys.is_night(at, F.lit(15.0))) and not one(spark, keys.is_night(at, F.lit(14.0)))


def test_times_and_texts(spark):
    assert one(spark, keys.parse_utc(F.lit("2026-07-13T06:00:00.123456789"))).microsecond == 123456
    assert one(spark, keys.iso_or_text(F.lit("Wed, 01 May 2024"))) == "Wed, 01 May 2024"
    assert one(spark, keys.compact_text(F.lit("  \n"))) is None
    assert one(spark, keys.stable_id(F.lit("a b"), F.lit("/c/"))) == "a-b-c"
    assert one(spark, keys.number(keys.first_alias(F.lit("M"), F.lit(""), F.lit("1.5")))) == 1.5
    assert one(spark, keys.model_cycle(F.lit("2026-01-02 03:00:00").cast("timestamp"))) == datetime(2026, 1, 1, 18)


@pytest.mark.parametrize(("name", "held"), [("EGLL", False), ("EGCC", True)])
def test_holdout(spark, name, held):
    assert one(spark, keys.is_holdout(F.lit(name))) is held


def test_rounding(spark):
    assert one(spark, units.round_up(F.lit(-1.2345), 3)) == -1.234
    assert one(spark, units.round_even(F.lit(2.5), 0)) == 2.0
    assert one(spark, units.plausible(F.lit(400.0), "temperature")) is None


def test_conditions(spark):
    lit = [F.lit(x) for x in (1.0, 9.0, 0.6, 0.0, 290.0, 280.0)]
    assert one(spark, conditions.condition(*lit)) == 13
    assert one(spark, conditions.wmo_condition(F.lit(96), F.lit(0))) == 15
    assert one(spark, conditions.condition(*[F.lit(None).cast("double")] * 6)) == 0
    cold = [F.lit(1.0), F.lit(0.1), None, None, F.lit(270.0), None]
    assert one(spark, conditions.condition(*cold)) == 12  # no snow field: it freezes
    assert one(spark, conditions.condition(*cold[:3], F.lit(None).cast("double"), *cold[4:])) == 6  # a missing cell says nothing
    assert one(spark, conditions.wmo_condition(F.lit(70.6), F.lit(0))) == 9


def test_categories(spark):
    assert one(spark, hazards.category(F.lit("Public notice"))) == "winter"
    assert one(spark, hazards.magnitude_severity(F.lit("none"))) == "unknown"
    assert one(spark, hazards.magnitude_severity(F.lit("nan"))) == "minor"
    assert one(spark, hazards.bulletin_severity(F.lit("x"), F.lit("Wind WARNING"))) == "severe"
    assert one(spark, hazards.category(F.lit("a tropical\n storm"))) == "tropical"


def shape(spark, column):
    found = one(spark, column)
    return None if found is None else (json.loads(found)["type"], json.loads(found)["coordinates"])


def test_geometries(spark):
    none = F.lit(None).cast("string")
    assert shape(spark, geometry.cap_polygons(F.array(F.lit("1,2 3,4 5,6 x,7 8")))) == ("Polygon", [[[2, 1], [4, 3], [6, 5], [2, 1]]])
    assert shape(spark, geometry.cap_polygons(F.array(F.lit("1,2,9 3,4 1,2"), F.lit("0,0 0,1 1,1")))) == ("MultiPolygon", [[[[2, 1], [4, 3], [2, 1]]], [[[0, 0], [1, 0], [1, 1], [0, 0]]]])
    assert shape(spark, geometry.cap_polygons(F.array(F.lit("1,2 3,4")))) is None
    assert shape(spark, geometry.georss(F.lit("10 20"), F.lit("0 0 0 1 1 1"))) == ("Point", [20, 10])
    assert shape(spark, geometry.georss(none, F.lit("0 0 0 1 1 1 5"))) == ("Polygon", [[[0, 0], [1, 0], [1, 1], [0, 0]]])
    assert shape(spark, geometry.georss(none, F.lit("0 0 0 1"))) is None
    assert shape(spark, geometry.placemark(F.lit("1,2,3 4,5"), none, none)) == ("Point", [1, 2])
    assert shape(spark, geometry.placemark(F.lit("x"), F.lit("1,2 3,4,0"), none)) == ("LineString", [[1, 2], [3, 4]])
    assert shape(spark, geometry.placemark(none, F.lit("1,2"), F.lit("0,0 1,0 1,1"))) == ("Polygon", [[[0, 0], [1, 0], [1, 1], [0, 0]]])
    assert shape(spark, geometry.placemark(none, none, F.lit("0,0 1,0"))) is None


def test_features(spark):
    lit = lambda **v: {k: F.lit(x) for k, x in v.items()}
    row = spark.range(1).select(*feeds.feature("nws", F.lit(None).cast("string"), lit(event="Flood", areaName="A  b", effective="2024-01-01T00:00:00Z", severity="\tRed ", urgency=" "))).first()
    other = spark.range(1).select(*feeds.feature("nws", F.lit(None).cast("string"), lit(event="Flood", areaName="C", effective="2024-01-01T00:00:00Z"))).first()
    assert (row["id"], row["severity"], row["priority"], row["category"], row["urgency"], row["layer"], row["headline"]) == ("nws-Flood-A-b-2024-01-01T00-00-00-00-00", "severe", 3, "flood", None, "alerts", None)
    assert other["id"] != row["id"] and set(feeds.FIELDS) | {"geometry"} == set(row.asDict())
    nothing = spark.range(1).select(*feeds.feature("p", F.lit(None).cast("string"), {})).first()
    assert (nothing["event"], nothing["category"], nothing["severity"], nothing["id"]) == (None, "weather", "unknown", "p")


def test_stale_rows_of_failed_sources_stay(spark):
    fresh = long(spark, [("a", 1, False)], "provider string, id int, stale boolean")
    old = long(spark, [("b", 2, False), ("a", 3, False)], "provider string, id int, stale boolean")
    status = long(spark, [("b", "error"), ("a", "partial")], "provider string, status string")
    assert sorted((r["id"], r["stale"]) for r in feeds.with_stale(fresh, old, status).collect()) == [(1, False), (2, True)]


def test_quantise(spark):
    df = long(spark, [(1, 1.0), (1, math.nan), (1, 3.0), (2, 5.0), (2, 5.0), (3, None)], "c int, v double")
    out = grids.quantised(df, ["c"], "v").withColumn("back", grids.dequantised(F.col("raw"), F.col("scale"), F.col("offset"))).collect()
    assert sorted((r["c"], r["raw"]) for r in out) == [(1, -32768), (1, -32767), (1, 32767), (2, 0), (2, 0), (3, -32768)]
    assert {round(r["back"], 3) for r in out if r["back"] is not None} == {1.0, 3.0, 5.0}


def test_bilinear_leaves_missing_corners_out(spark):
    plane = F.array(F.lit(1.0), F.lit(float("nan")), F.lit(3.0), F.lit(float("nan")))
    assert one(spark, grids.bilinear(plane, 2, 2, F.lit(0.5), F.lit(0.5))) == 2.0


def test_coverage(spark):
    hours = [("a", h) for h in (24, 30, 36, 42)] + [("b", 120)] + [("c", h) for h in (30, 36)]
    assert [r["g"] for r in grids.covered_days(long(spark, hours, "g string, h int"), ["g"], "h").collect()] == ["a"]


def test_intervals(spark):
    df = long(spark, [(1, 1.0), (2, 3.0), (3, 2.0)], "h int, v double").withColumns({"g": F.lit(1), "run": F.lit(True)})
    assert [r["x"] for r in grids.interval_amounts(df, ["g"], "h", "v", "run", "x").orderBy("h").collect()] == [1.0, 2.0, 0.0]


def test_scores(spark):
    state = long(spark, [("gfs", 2.0, 3, [0.0])], "provider string, score double, sample_count bigint, history array<double>")
    new = long(spark, [("gfs", 0.0, i) for i in range(60)], "provider string, error double, k int")
    row = learning.updated_scores(new, state, [], "provider", "error", ["k"], alpha=0.25).first()
    assert (row["score"], row["sample_count"], len(row["history"]), row["weight"]) == (1.5, 63, 48, 1.0)


def test_running_bias_is_rounded_once(spark):
    rng = random.Random(3)
    rows = [(g, k, round(rng.uniform(-4, 4), 2)) for g in range(40) for k in range(30)]
    want = {}
    for g, _, x in rows:
        want[g] = 0.8 * want.get(g, 0.0) + 0.2 * x
    df = long(spark, rows, "g int, k int, x double")
    for pieces in (None, F.floor(F.col("k") / 7)):
        out = {r["g"]: (r["b"], r["samples"]) for r in learning.ema_fold(df, ["g"], "x", ["k"], 0.2, 3, "b", None, pieces).collect()}
        assert all(abs(out[g][0] - round(v, 3)) < 1e-9 and out[g][1] == 30 for g, v in want.items())
    old = long(spark, [(0, 2.0, 5), (99, 1.0, 2)], "g int, b double, samples bigint")
    out = {r["g"]: (r["b"], r["samples"]) for r in learning.ema_fold(df.filter("g = 0 and k < 1"), ["g"], "x", ["k"], 0.2, 3, "b", old).collect()}
    assert out == {0: (round(1.6 + 0.2 * rows[0][2], 3), 6), 99: (1.0, 2)}


def test_scoring_of_two_providers(spark):
    """Two stations, one of them held out; the nearer provider gets the larger weight."""
    at = datetime(2026, 7, 12, 12)
    none = dict.fromkeys(("dewpoint_c", "pressure_hpa", "precipitation_mm"))
    obs = [dict(station=s, observed_at=at, latitude=la, longitude=lo, temperature_c=t, wind_kt=w, altimeter_in_hg=None, precipitation_in=None, dewpoint_c=None, pressure_hpa=None) for s, la, lo, t, w in (("EGLL", 51.47, -0.45, 20.0, 5.4), ("EGCC", 53.35, -2.27, 21.0, 6.0))]
    schema = "station string, observed_at timestamp, latitude double, longitude double, temperature_c double, wind_kt double, altimeter_in_hg double, precipitation_in double, dewpoint_c double, pressure_hpa double"
    reports = learning.observation_values(long(spark, obs, schema))
    rows = [dict(provider=p, station=s, valid_time=at, lead_hours=48, ordinal=k, temperature_c=t, wind_kmh=w, **none) for k, (p, t, w) in enumerate((("gfs", 20.0, 10.0), ("icon", 24.0, 30.0))) for s in ("EGLL", "EGCC")]
    fc = long(spark, rows, "provider string, station string, valid_time timestamp, lead_hours int, ordinal int, temperature_c double, wind_kmh double, dewpoint_c double, pressure_hpa double, precipitation_mm double")
    errors = learning.station_errors(reports, fc)
    scores = long(spark, [], "region string, bucket string, provider string, score double, sample_count bigint, history array<double>")
    state = learning.scored_providers(errors, scores, long(spark, [], "region string, period string, value double, samples bigint"), alpha=1.0)
    weight = {(r["region"], r["bucket"], r["provider"]): r["weight"] for r in state["skill"].collect()}
    assert weight["+50_-020", "25-72", "gfs"] > weight["+50_-020", "25-72", "icon"] and weight["*", "*", "gfs"] > weight["*", "*", "icon"]
    assert {r["provider"] for r in state["validation"].collect()} == {"gfs", "icon", "consensus"} and learning.holdout_stations(reports).first()[0] == 1
    assert {(r["region"], r["period"]): (r["value"], r["samples"]) for r in state["bias"].collect()} == {("+50_-020", "day"): (-0.4, 1), ("+50_-020", "night"): (0.0, 0)}


def test_nearest_in_time_against_brute_force(spark):
    rng = random.Random(9)
    a = [(i, rng.choice("xy"), datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(4000))) for i in range(150)] + [(900, "x", None)]
    b = [(i, rng.choice("xy"), datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(0, 4000, 10))) for i in range(80)] + [(901, "x", None)]
    want = {}
    for i, s, at in a:
        near = sorted((abs(at - u), k) for k, r, u in b if at and u and r == s and abs(at - u) <= timedelta(minutes=90))
        if near:
            want[i] = near[0][1]
    out = learning.nearest_in_time(long(spark, a, "aid int, s string, t timestamp"), long(spark, b, "bid int, s string, u timestamp"), ["s"], "t", "u", "aid", "bid").collect()
    assert {r["aid"]: r["bid"] for r in out} == want and len(out) == len(want)


def test_nearest_forecast_out_of_reach(spark):
    a = long(spark, [(1, "E", datetime(2026, 1, 1, 12))], "oid int, s string, t timestamp")
    b = long(spark, [(1, "E", datetime(2026, 1, 1, 16)), (2, "E", datetime(2026, 1, 1, 13, 30)), (3, "E", datetime(2026, 1, 1, 10, 30))], "fid int, s string, u timestamp")
    assert learning.nearest_in_time(a, b, ["s"], "t", "u", "oid", "fid").first()["fid"] == 2
    assert learning.nearest_in_time(a, b.filter("fid = 1"), ["s"], "t", "u", "oid", "fid").count() == 0


def test_tiles_and_packs(spark):
    rows = [("N50_W20", 0.0, 1.0, 1.0, -1.0, 2, 2, c, 0.5, 10.0, [0, 2, -32768, 4]) for c in (1, 0)]
    channels = long(spark, rows, f"key string, {tiles.CELLS}")
    tile = tiles.encoded(channels, ["key"]).first()["tile"]
    pack = long(spark, [(tiles.make_pack([("0", bytes(tile)), ("6", bytes(tile))]),), (tiles.make_pack([]),)], "content binary")
    out = tiles.decoded(tiles.unpacked(pack)).orderBy("key", "channel").collect()
    assert [(r["key"], r["channel"], r["raw"]) for r in out] == [(k, c, [0, 2, -32768, 4]) for k in "06" for c in (0, 1)]


def test_observations(spark):
    raw = long(spark, [("EGLL", "2026-07-12T12:00:00Z", "51.47", "-0.45", "20", "M"), ("EGLL", "", "51", "0", "1", "2")], "station_id string, observation_time string, latitude string, lon string, temp_c string, wind_speed_kt string")
    out = sources.normalised_observations(raw).collect()
    assert [(r["station"], r["longitude"], r["wind_kt"], r["dewpoint_c"]) for r in out] == [("EGLL", -0.45, None, None)]


def test_geojson(spark):
    raw = long(spark, [('{"features": [{"id": "x", "geometry": {"type": "Point", "coordinates": [1, 2]}, "properties": {"event": "Flood"}}]}',), ("{broken",)], "document string")
    assert [(r["id"], r["properties"]["event"]) for r in sources.geojson_features(raw).collect()] == [("x", "Flood")]


def test_tides(spark):
    ev = long(spark, [("R", datetime(2026, 1, 1), "high", 2.0)], "station string, time timestamp, type string, height double")
    st = long(spark, [("S", "R", 30, 0, 0.5, 0.5, "ratio"), ("T", "Q", 0, 0, 1.0, 1.0, "fixed")], "id string, reference string, high_minutes int, low_minutes int, high_height double, low_height double, height_kind string")
    good, wrong = tides.subordinate_tides(ev, st)
    assert [(r["id"], r["time"], r["height"]) for r in good.collect()] == [("S", datetime(2026, 1, 1, 0, 30), 1.0)]
    assert [r["id"] for r in wrong.collect()] == ["T"]


def test_geometries_read_texts_once(spark):
    """A text is split in one place of the plan, however often its points are looked at."""
    df = long(spark, [("1 2", "0 0 0 1 1 1", ["0,0 0,1 1,1"])], "a string, b string, c array<string>")
    for shape, n in ((geometry.georss(F.col("a"), F.col("b")), 2), (geometry.placemark(F.col("a"), F.col("b"), F.col("b")), 6), (geometry.cap_polygons(F.col("c")), 2)):
        assert df.select(shape.alias("g"))._jdf.queryExecution().optimizedPlan().toString().count("split(") == n


def test_tide_ranges(spark):
    """The same figures as from all tides, with odd heights, types and offsets."""
    rng = random.Random(4)
    odd = (None, float("nan"), float("inf"), float("-inf"))
    heights = lambda r: rng.choice(odd) if r in "EF" and rng.random() < 0.3 else rng.uniform(-3, 3)
    ev = long(spark, [(r, datetime(2026, 1, 1) + timedelta(minutes=rng.randint(0, 9000)), rng.choice(("high", "low", None, "x")), heights(r)) for r in "ABCDEF" for _ in range(40)] + [("G", datetime(2026, 1, 1), "low", None)], "station string, time timestamp, type string, height double")
    number = lambda: rng.choice((None, 0.0, -1.5, 0.5, 2.0, 1.2345))
    st = long(spark, [(i % 70, "ABCDEFGH"[i % 8], rng.choice((None, 30, -20)), rng.randint(-90, 90), number(), number(), rng.choice(("ratio", "fixed", "other"))) for i in range(80)], "id int, reference string, high_minutes int, low_minutes int, high_height double, low_height double, height_kind string")
    whole = tides.subordinate_tides(ev, st)[0].groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min("time").alias("first"), F.max("height").alias("highest"), F.min("height").alias("lowest"))
    assert sorted(map(repr, tides.subordinate_ranges(ev, st).collect())) == sorted(map(repr, whole.collect()))
    plan = tides.subordinate_ranges(ev, st)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate")  # events are summed up before stations meet them


def test_outdated_runs(spark):
    rules = long(spark, [("a", 10), ("a/b", 400), ("a/b", 300), ("", 20), (None, 1)], "prefix string, days int")
    old, new = datetime(2026, 1, 1), datetime(2026, 2, 25)
    runs = long(spark, [("a/b/1", old), ("a/c", old), ("a/c", old), ("a/c", new), ("z", old), (None, old), ("z", None)], "key string, written timestamp")
    out = feeds.outdated_runs(runs, rules, F.lit("2026-03-01").cast("timestamp"))
    assert sorted((r["key"], r["days"]) for r in out.collect()) == [("a/c", 10), ("a/c", 10), ("z", 20)]  # a run a row
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()  # keys aren't written out a prefix a row
    assert feeds.outdated_runs(runs, rules.filter("false"), F.lit("2026-03-01").cast("timestamp")).count() == 0


def test_tide_stations_and_files(spark):
    assert one(spark, tides.datum_offset(F.create_map(F.lit("MSL"), F.lit(1.5), F.lit("LAT"), F.lit(0.25)), F.lit("LAT"))) == 1.25
    assert one(spark, tides.datum_offset(F.create_map(F.lit("MSL"), F.lit(1.5)), F.lit("LAT"))) == 0.0
    index = long(spark, [("a/b",), ("c",)], "id string")
    ev = long(spark, [("a/b", datetime(2026, 1, 2), "high", 2.0), ("a/b", datetime(2026, 1, 1), "low", 0.5), ("a/b", datetime(2027, 1, 1), "low", 0.5)], "id string, time timestamp, type string, height double")
    out = {r["id"]: (r["eventPath"], r["eventCount"], [e["type"] for e in r["events"]]) for r in tides.event_files(index, ev, F.lit("2026-01-01 15:00:00").cast("timestamp")).collect()}
    assert out == {"a/b": ("events/a__b.json", 2, ["low", "high"]), "c": ("events/c.json", 0, [])}
    st = long(spark, [("b", "reference", True), ("a", "subordinate", True), ("c", "reference", False)], "id string, kind string, commercial_use boolean")
    st = st.withColumns({"harmonics": F.array(F.lit(1)), "reference": F.lit("b"), **{k: F.lit(1) for k in ("high_minutes", "low_minutes", "high_height", "low_height")}})
    assert [r["id"] for r in tides.selected_stations(st).collect()] == ["b", "a"]
    assert [r["id"] for r in tides.selected_stations(st, commercial_only=False, most=2).collect()] == ["b", "c"]
    assert [r["id"] for r in tides.selected_stations(st, ids=long(spark, [("a",)], "id string")).collect()] == ["a"]


def test_provider_fields(spark):
    raw = long(spark, [(1, 3, 280.0, 50.0, 0.001), (1, 6, 281.0, 0.4, 0.003)], "cell int, hour int, temperature double, TCDC double, tp double").withColumns({"precipitation_units": F.lit("m"), "start_step": F.lit(0), "end_step": F.col("hour"), "prmsl": F.lit(101300.0)})
    out = products.provider_fields(raw, ["cell"]).orderBy("hour").collect()
    assert [(r["cloud_cover"], round(r["precipitation"], 6), r["pressure"]) for r in out] == [(0.5, 1.0, 101300.0), (0.4, 2.0, 101300.0)] and "humidity" not in out[0].asDict()
    rows = products.long_fields(products.provider_fields(raw, ["cell"]), ["cell", "hour"])
    assert {(r["hour"], r["field"]): r["value"] for r in rows.collect()}[6, "temperature"] == 281.0


def test_tiles_of_a_layer(spark):
    cells = spark.range(9 * 17).select((F.lit(80.0) - F.floor(F.col("id") / 17) * 2.5).alias("lat"), (F.col("id") % 17 * 2.5 - 20).alias("lon"), F.col("id").cast("double").alias("value"))
    tiled = products.tiled(products.layer_components(cells, ["lat", "lon"], "scalar", "temp"))
    sizes = {(r["tile"], r["channel"]): (r["width"], r["height"], r["lon0"], r["lat0"], r["dx"], r["dy"]) for r in products.planes(tiled, ["tile"]).collect()}
    assert sizes["N50_W20", 0] == (9, 5, -20.0, 70.0, 2.5, -2.5) and sizes["N70_E0", 0] == (9, 5, 0.0, 80.0, 2.5, -2.5)
    assert {r["tile"] for r in tiled.filter("lat = 70 and lon = 0").collect()} == {"N70_W20", "N70_E0", "N50_W20", "N50_E0"}
    over = products.planes(products.overview_cells(tiled, []), ["key"]).collect()
    assert sorted((r["key"], r["width"], r["height"], r["dx"], r["dy"]) for r in over) == [("N0_W40_60", 5, 2, 10.0, -10.0), ("N60_W40_60", 5, 2, 10.0, -10.0)]
    vector = products.layer_components(cells.select("lat", "lon", F.col("value").alias("u"), F.lit(None).cast("double").alias("v")), ["lat", "lon"], "vector")
    assert {(r["channel"], r["value"]) for r in vector.filter("lat = 80 and lon = -17.5").collect()} == {(2, 1.0), (3, 0.0)}
    quantised = tiles.quantised_planes(products.planes(tiled.withColumnRenamed("tile", "key"), ["key"]), ["key"])
    pack = tiles.packed(tiles.encoded(quantised, ["key"]).withColumn("group", F.lit(1)), ["group"]).select(F.col("pack").alias("content"))
    back = tiles.decoded(tiles.unpacked(pack)).withColumn("v", F.transform("raw", lambda x: grids.dequantised(x, F.col("scale"), F.col("offset")))).filter("key = 'N50_W20'").first()
    assert max(abs(a - b) for a, b in zip(back["v"], [float(17 * y + x) for y in range(4, 9) for x in range(9)], strict=True)) < 0.01
    assert {(r["key"], r["channel"]) for r in tiles.headers(tiles.unpacked(pack)).collect()} == {(t, 0) for t in ("N50_W40", "N50_W20", "N50_E0", "N50_E20", "N70_W40", "N70_W20", "N70_E0", "N70_E20")}


def test_details_copied_into_an_overview(spark):
    target = long(spark, [(1, 1.0, 0.0), (1, 0.0, 1.0), (1, 0.0, 5.0)], "pack int, lat double, lon double")
    source = long(spark, [(1, "N0_E0", 0.0, 1.0, 1.0, -1.0, 2, 2, [1.0, 2.0, 3.0, 284.0])], "pack int, tile string, lon0 double, lat0 double, dx double, dy double, width int, height int, plane array<double>")
    out = {(r["lat"], r["lon"]): r["value"] for r in products.copied_into(target, source, ["pack"], ["tile"]).collect()}
    assert out == {(1.0, 0.0): 1.0, (0.0, 1.0): 284.0, (0.0, 5.0): None}


def test_catalogs_of_tiles(spark):
    paths = long(spark, [("x/gfs/6h_N50_W20.gtile",), ("x/ifs/30h_N50_W20.gtile",), ("x/readme.txt",)], "path string")
    index = products.tile_index(paths)
    assert sorted((r["model"], r["hour"], r["day"], r["tile"]) for r in index.collect()) == [("gfs", 6, 0, "N50_W20"), ("ifs", 30, 1, "N50_W20")]
    assert [(r["model"], r["hours"], r["days"]) for r in products.horizons(index).orderBy("model").collect()] == [("gfs", [6], 1), ("ifs", [30], 2)]
    models = long(spark, [("ifs", 0), ("gfs", 1)], "model string, ordinal int")
    assert products.packs_present(index, models).first()["models"] == ["ifs", "gfs"]
    assert one(spark, keys.tile_file("temp", F.lit(6), F.lit(50), F.lit(-20))) == "temp_6h_N50_W20.gtile" and one(spark, keys.overview_key(F.lit(-30), F.lit(40))) == "S30_E40_60"
    assert one(spark, keys.feed_region(F.lit("https://x.eu/feeds/atom-united-kingdom?a=b-c"))) == "kingdom"


def test_channels():
    assert fields.daily_channels("temperature") == [20, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31]
    assert len({c for f in fields.DAILY for c in fields.daily_channels(f)}) == 60


def test_units_of_sources(spark):
    assert one(spark, units.precipitation_mm(F.lit(0.002), F.lit("Metre"))) == 2.0 and one(spark, units.precipitation_mm(F.lit(2.0), F.lit("kg m**-2"))) == 2.0
    assert one(spark, units.grid_value(F.lit(None).cast("double"), 1)) is None and one(spark, units.grid_value(F.lit(None).cast("double"), 1, preserve=False)) == 0.0
    assert one(spark, units.field_places(F.lit("snow"))) == 3 and one(spark, keys.forecast_day(F.lit(47))) == 1


def test_first_variable(spark):
    assert grids.first_variable(spark.createDataFrame([(0, 0, 1.0, 2.0)], "y int, x int, `a b` double, c double")) == "a b"
    with pytest.raises(ValueError, match="no variable"):
        grids.first_variable(spark.createDataFrame([(0, 0)], "y int, x int"))


def test_written_hours_and_cities(spark, tmp_path):
    tiles = spark.createDataFrame([("gfs", 3, "N50_W20", 1), ("gfs", 6, "N50_W20", 2)], "model string, hour int, tile string, v int")
    sinks.write_provider_hours(tiles, f"{tmp_path}/t")
    sinks.write_provider_hours(tiles.filter("hour = 6").withColumn("v", F.lit(9)), f"{tmp_path}/t")
    assert sorted((r["hour"], r["v"]) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [(3, 1), (6, 9)]
    sinks.write_cities(spark.createDataFrame([("Madrid", ["20"])], "name string, maxTemp array<string>"), f"{tmp_path}/c")
    assert spark.read.json(f"{tmp_path}/c").first()["maxTemp"] == ["20"]
