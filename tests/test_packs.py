"""Packs as a data source, messages by ranges, one parameter a file, pointers, linear regridding and harmonic tides."""

import bz2
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isobar.operators import grids, tides
from isobar.sources import documents, messages, packs, sinks, tiles

CHANNELS = "pack string, key string, lon0 float, lat0 float, dx float, dy float, width int, height int, channel int, scale float, offset float, raw array<int>"


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    """10,000 tiles of two channels in 20 packs."""
    path = str(tmp_path_factory.mktemp("packs"))
    rows = spark.range(20_000).select((F.col("id") % 20).cast("string").alias("pack"), F.format_string("t%d_%03d", F.floor(F.col("id") / 2000), F.floor(F.col("id") / 2) % 1000).alias("key"), *[F.lit(float(k)).cast("float").alias(c) for k, c in enumerate(("lon0", "lat0", "dx", "dy"), 1)], F.lit(4).alias("width"), F.lit(3).alias("height"), (F.col("id") % 2 * 7 + 1).cast("int").alias("channel"), F.lit(0.5).cast("float").alias("scale"), F.lit(2.0).cast("float").alias("offset"), F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: (k * 3 - F.col("id") % 900).cast("int")).alias("raw"))
    rows = rows.withColumn("pack", F.concat(F.lit("p"), F.substring("key", -2, 1)))
    encoded = tiles.encoded(rows, ["pack", "key"])
    packs.write_packs(encoded, path, "pack")
    return path, rows, encoded


def test_packs_round_trip(spark, packed):
    path, rows, encoded = packed
    back = packs.read_packs(spark, path)
    cols = ["key", "channel", "lon0", "dy", "width", "height", "scale", "offset", "raw"]
    assert back.count() == 20_000 and back.select(*cols).exceptAll(rows.select(*cols)).isEmpty()
    assert {r[0].rsplit("/", 1)[1] for r in back.select("path").distinct().collect()} == {f"p{k}.gpack" for k in range(10)}
    old = tiles.decoded(tiles.unpacked(spark.read.format("binaryFile").load(f"{path}/*.gpack")))  # the same bytes as before
    assert old.select("key", "channel", "raw").exceptAll(rows.select("key", "channel", "raw")).isEmpty()


def test_packs_read_what_is_asked_for(spark, packed):
    back = packs.read_packs(spark, packed[0])
    read = lambda df: df.agg(F.sum("bytes_read"), F.count("*")).first()
    (all_, n), (channel, m), (keys, k), (hours, h) = read(back), read(back.filter("channel = 8")), read(back.filter("key in ('t3_041', 't4_041')")), read(back.filter("hour >= 990 and hour < 992 and channel = 1"))
    assert (n, m, k, h) == (20_000, 10_000, 4, 20)
    assert channel < all_ and keys < all_ / 3 and hours < all_ / 2  # tables are read, other entries are not
    plan = back.filter("channel = 8 and width = 4")._jdf.queryExecution().executedPlan().toString()
    assert "width" in plan and back.filter("channel = 8 and width = 5").count() == 0  # the rest is Spark's to test


def test_packs_are_written_as_a_whole(spark, packed, tmp_path):
    one = packed[2].filter("pack = 'p1'")
    packs.write_packs(one, str(tmp_path), "pack")
    packs.write_packs(packed[2].filter("pack = 'p2'"), str(tmp_path), "pack", overwrite=False)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["p1.gpack", "p2.gpack"]
    broken = one.withColumn("tile", F.when(F.rand() < 2, F.raise_error(F.lit("no tile"))).cast("binary"))
    with pytest.raises(Exception, match="no tile"):
        packs.write_packs(broken, str(tmp_path), "pack")
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith("_")) == ["p1.gpack", "p2.gpack"]
    with pytest.raises(Exception, match="not a pack"):
        (tmp_path / "p9.gpack").write_bytes(b"nothing of the kind")
        packs.read_packs(spark, str(tmp_path)).collect()


def test_messages_by_ranges(spark, tmp_path):
    for name in ("a", "b"):
        parts = [f"<{name}{k}>".encode() * (50 + k) for k in range(6)]
        (tmp_path / f"{name}.grib").write_bytes(b"".join(parts))
        at = [sum(map(len, parts[:k])) for k in range(6)]
        (tmp_path / f"{name}.grib.idx").write_text("\n".join(f"{k + 1}:{at[k]}:d=2026:{('TMP', 'RH', 'TMP', 'UGRD', 'TMP', 'APCP')[k]}:{(2, 2, 2, 10, 80, 0)[k]} m above ground:" for k in range(6)) + "\nnot an entry")
    (tmp_path / "gone.grib.idx").write_text("1:0:d=2026:TMP:2 m above ground:\n")
    out = messages.indexed_messages(spark, f"{tmp_path}/*.idx", [[":TMP:", "2 m above"], [":APCP:"], [":SNOW:"]])
    got = {(r["path"].rsplit("/", 1)[1], r["asked"]): (r["number"], None if r["content"] is None else bytes(r["content"])) for r in out.collect()}
    assert got == {("a.grib", 0): (1, b"<a0>" * 50), ("b.grib", 0): (1, b"<b0>" * 50), ("a.grib", 1): (6, b"<a5>" * 55), ("b.grib", 1): (6, b"<b5>" * 55), ("gone.grib", 0): (1, None)}
    assert out.filter("error is not null").count() == 1


def test_one_parameter_a_file(spark, tmp_path):
    for k, name in enumerate(("t2m", "rh", "u10", "v10")):
        (tmp_path / f"icon_{name}.json.bz2").write_bytes(bz2.compress(f'{{"run":"r","parameter":"{name}","cells":[{k},{k + 1}]}}'.encode()))
    (tmp_path / "icon_bad.json.bz2").write_bytes(b"not bz2")
    payloads = messages.unpacked_payloads(spark, f"{tmp_path}/*.bz2")
    assert payloads.filter("error is not null and content is null").count() == 1
    rows = payloads.filter("error is null").select(F.from_json(F.col("content").cast("string"), "run string, parameter string, cells array<double>").alias("j")).select("j.run", "j.parameter", F.posexplode("j.cells").alias("cell", "value"))
    expected = spark.createDataFrame([("r", p) for p in ("t2m", "rh", "u10", "v10", "tp")], "run string, parameter string")
    grid, status = messages.joined_parameters(rows, expected, ["run"], "parameter", ["cell"], "value")
    assert sorted((r["cell"], r["fields"]) for r in grid.collect()) == [(c, {"t2m": 0.0 + c, "rh": 1.0 + c, "u10": 2.0 + c, "v10": 3.0 + c}) for c in (0, 1)]
    assert {r["parameter"]: r["status"] for r in status.collect()} == {"t2m": "ok", "rh": "ok", "u10": "ok", "v10": "ok", "tp": "missing"}


def test_pointers(spark, tmp_path):
    path, df = str(tmp_path), spark.range(3)
    with pytest.raises(FileNotFoundError):
        sinks.read_current(spark, path)
    for k in range(12):
        sinks.publish(df.withColumn("k", F.lit(k)), path, f"r-{k}", after=f"r-{k - 1}" if k else None)
        assert sinks.current_run(spark, path) == f"r-{k}" and sinks.read_current(spark, path).first()["k"] == k
    assert len([p for p in (tmp_path / "pointers").iterdir() if not p.name.startswith(".")]) == 2
    with pytest.raises(FileExistsError):  # another writer came first
        sinks.publish(df, path, "late", after="r-3")
    (tmp_path / "claims" / f"{13:010d}").touch()
    with pytest.raises(FileExistsError):
        sinks.publish(df, path, "second")
    assert sinks.current_run(spark, path) == "r-11"


def test_previous_run_after_a_broken_one(spark, tmp_path):
    (tmp_path / "broken.json").write_text('{"type": "FeatureColl')
    (tmp_path / "other.json").write_text('{"type": "Topology", "features": null}')
    (tmp_path / "good.json").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": null, "properties": {"id": "x"}}]}')
    rows = documents.previous_features(spark, [f"{tmp_path}/{n}.json" for n in ("missing", "broken", "other", "good")]).collect()
    assert [r["properties"]["id"] for r in rows] == ["x"] and documents.previous_features(spark, [f"{tmp_path}/other.json"]).count() == 0


def test_linear_regrid(spark):
    rng = random.Random(2)
    plane = [None if rng.random() < 0.2 else rng.random() for _ in range(7 * 5)]
    source = spark.createDataFrame([("p", k // 7, k % 7, v) for k, v in enumerate(plane)], "plane string, y int, x int, v double")
    points = [(k, 40 + rng.uniform(0, 2), -10 + rng.uniform(0, 3)) for k in range(80)] + [(90, 41.0, -9.0), (91, 42.0, -7.0)]
    target = spark.createDataFrame(points, "id int, lat double, lon double")
    got = {r["id"]: r["v"] for r in grids.regridded_linear(source, target, ["plane"], ["id"], (40.0, -10.0), (0.5, 0.5), "v").collect()}
    whole = target.withColumn("plane", F.array(*[F.lit(v) for v in plane]))
    want = {r["id"]: r["v"] for r in whole.select("id", grids.bilinear(F.col("plane"), 7, 5, (F.col("lon") + 10) / 0.5, (F.col("lat") - 40) / 0.5).alias("v")).filter("v is not null").collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in got)
    circle = spark.createDataFrame([("p", 0, x, float(x)) for x in range(4)], "plane string, y int, x int, v double")
    wrapped = grids.regridded_linear(circle, spark.createDataFrame([(1, 0.0, 315.0), (2, 0.0, -90.0)], "id int, lat double, lon double"), ["plane"], ["id"], (0.0, 0.0), (90.0, 90.0), "v", 4)
    assert sorted((r["id"], r["v"]) for r in wrapped.collect()) == [(1, 1.5), (2, 3.0)]


def test_harmonic_extremes(spark):
    tide = [(1.2, 28.984104, 40.0), (0.4, 30.0, 75.0), (0.3, 15.041069, 200.0)]
    start = datetime(2026, 1, 1)
    stations = spark.createDataFrame([("a", tide, 2.0), ("flat", [], None)], "id string, harmonics array<struct<amplitude:double,speed:double,phase:double>>, offset double")
    out = sorted((r["time"], r["type"], r["height"]) for r in tides.harmonic_extremes(stations, F.lit(start), 3, F.lit(datetime(2025, 12, 1))).collect())
    height = lambda s: 2.0 + sum(a * math.cos(math.radians(v * (744 + s / 3600) - p)) for a, v, p in tide)
    dense = [height(s) for s in range(-1, 3 * 86_400 + 1)]
    want = [(start + timedelta(seconds=s), "high" if dense[s + 1] > dense[s] else "low") for s in range(3 * 86_400) if (dense[s + 1] - dense[s]) * (dense[s + 2] - dense[s + 1]) <= 0]
    assert len(out) == len(want) and all(abs((t - w).total_seconds()) <= 1 and kind == k for (t, kind, _), (w, k) in zip(out, want, strict=True))
    assert all(abs(h - height((t - start).total_seconds())) < 1e-6 for t, _, h in out)
