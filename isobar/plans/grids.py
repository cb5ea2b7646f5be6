"""Grid queries. Planes are embeddings (8 x 8), channels return flags, lead hours days since the first event."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from ..functions import conditions, units
from ..functions import keys as K
from ..operators import grids as G
from ..sources import packs, tiles
from .consensus import t


def quantize_roundtrip(spark, d):
    rows = G.quantised(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice")
    return rows.select("l_orderkey", "l_linenumber", "raw", F.round(G.dequantised(F.col("raw"), F.col("scale"), F.col("offset")), 6).alias("value"))


def _point():
    return F.col("vec_id") * 3 % 32 / F.lit(4.0), F.col("vec_id") * 5 % 28 / F.lit(4.0)


def bilinear_sample(spark, d):
    return t(spark, d, "embeddings").select("vec_id", F.round(G.bilinear(F.col("embedding"), 8, 8, *_point()), 9).alias("value"))


def regrid_linear(spark, d):
    """Planes as long tables with a fifth of the cells missing, each looked up at a place of its own."""
    cells = t(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("k", "value")).filter("k % 5 <> vec_id % 5")
    source = cells.select("vec_id", F.floor(F.col("k") / 8).cast("int").alias("y"), (F.col("k") % 8).alias("x"), "value")
    x, y = _point()
    out = G.regridded_linear(source, t(spark, d, "embeddings").select("vec_id", y.alias("lat"), x.alias("lon")), ["vec_id"], ["vec_id"], (0.0, 0.0), (1.0, 1.0), "value")
    return out.select("vec_id", F.round("value", 9).alias("value"))


def pack_channels(spark, d):
    """Planes as tiles, written as packs to the shared folder and read back by hours and channels."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="packs-")
    place = {"lon0": "float", "lat0": "float", "dx": "float", "dy": "float"}
    rows = t(spark, d, "embeddings").select(
        F.concat(F.lit("p"), F.col("vec_id") % 7).alias("pack"), F.format_string("v%d_%03d", "vec_id", F.col("vec_id") % 48).alias("key"), F.lit(8).alias("width"), F.lit(8).alias("height"), F.col("label").alias("channel"),
        F.transform("embedding", lambda v: F.floor(v.cast("double") * 1000).cast("int")).alias("raw"), F.lit(0.001).cast("float").alias("scale"), F.lit(0.0).cast("float").alias("offset"), *[F.lit(1.0).cast(k).alias(c) for c, k in place.items()],
    )
    path = f"{folder}/packs-{uuid.uuid4().hex}"
    packs.write_packs(tiles.encoded(rows, ["pack", "key"]), path, "pack")
    found = packs.read_packs(spark, path).filter("hour >= 6 and hour < 30 and channel in (1, 2, 3)")
    return found.select("key", "channel", F.aggregate("raw", F.lit(0), lambda a, v: a + v).cast("long").alias("total"), F.element_at("raw", -1).alias("last"))


def overview_stride(spark, d):
    return t(spark, d, "embeddings").select("vec_id", F.posexplode(G.overview(F.col("embedding"), 8, 8)).alias("k", "value"))


def _hours(spark, d):
    hour = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - 1704067200000000) / 3600000000).cast("int")
    return t(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value", hour.alias("hour"))


HOURS = "select *, floor((epoch_us(ts) - 1704067200000000) / 3600000000.0)::int h from events"


def daily_extrema_coverage(spark, d):
    return G.covered_days(_hours(spark, d), ["user_id"], "hour").select("user_id", "day", "n_hours", "first", "last")


def daily_high_low(spark, d):
    return G.daily_extremes(_hours(spark, d), ["event_type"], "hour", ["value"])


def interval_accumulation(spark, d):
    rows = _hours(spark, d).withColumn("running", F.col("event_type") != "click")
    return G.interval_amounts(rows, ["user_id"], "event_id", "value", "running", "amount").select("event_id", "amount")


def idx_byte_ranges(spark, d):
    rows = t(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") * 100).alias("offset"))
    return G.byte_ranges(rows, ["o_custkey"], "o_orderkey", "offset")


def regrid_nearest(spark, d):
    target = t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 181 - 90 + 0.3).cast("double").alias("lat"), (F.col("c_custkey") * 7 % 360 - 180 + 0.2).cast("double").alias("lon"))
    source = t(spark, d, "part").select((F.col("p_partkey") % 46).cast("int").alias("y"), (F.col("p_partkey") % 91).cast("int").alias("x"), "p_retailprice").groupBy("y", "x").agg(F.max("p_retailprice").alias("price"))
    return G.regridded(source, target, (-90.0, -180.0), (4.0, 4.0), ["price"]).select("c_custkey", "y", "x", "price")


def single_field(spark, d):
    """A grid of one variable, under a name that isn't asked for."""
    target = t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 181 - 90 + 0.3).cast("double").alias("lat"), (F.col("c_custkey") * 7 % 360 - 180 + 0.2).cast("double").alias("lon"))
    source = t(spark, d, "supplier").select((F.col("s_suppkey") % 46).cast("int").alias("y"), (F.col("s_suppkey") % 91).cast("int").alias("x"), "s_acctbal").groupBy("y", "x").agg(F.max("s_acctbal").alias("any name"))
    return G.single_field(source, target, (-90.0, -180.0), (4.0, 4.0)).select("c_custkey", "y", "x", "value")


def time_keys(spark, d):
    """Night by the sun, the day, the run that is out and a forecast's valid time of every event."""
    at = C("ts").cast("timestamp")
    shown = lambda x: F.date_format(x, "yyyy-MM-dd HH:mm")
    return t(spark, d, "events").select("event_id", K.is_night(at, (C("user_id") % 360 - 180).cast("double")).alias("night"), shown(K.day_start(at, 2)).alias("day"), shown(K.model_cycle(at)).alias("run"), shown(K.valid_time(F.date_trunc("hour", at), C("user_id") % 240)).alias("valid"))


def file_keys(spark, d):
    """Names of tiles, packs and overviews of every order's place."""
    lat, lon = (C("o_orderkey") % 1801 / 10 - 90).cast("double"), (C("o_custkey") % 3601 / 10 - 180).cast("double")
    south, west = K.pack_origin(lat, lon)
    return t(spark, d, "orders").select("o_orderkey", K.tile_name(lat, lon).alias("tile"), K.tile_file("temp", C("o_orderkey") % 48, south, west, "gpack").alias("file"), K.overview_key(south, west).alias("overview"))


def model_envelope(spark, d):
    rows = t(spark, d, "lineitem").select((C("l_partkey") % 211).alias("tile"), (C("l_orderkey") % 3).alias("cell"), (C("l_suppkey") % 4).alias("model"), "l_extendedprice")
    return G.model_range(rows, ["tile"], ["cell"], "model", "l_extendedprice")


C = F.col
def _fields():
    """Cloud, rain, convective rain, snow, temperature and dewpoint."""
    return C("l_tax") * 12.5, C("l_quantity") / 5 - 2, C("l_discount") * 6, C("l_linenumber") / 10 - 0.3, 263.15 + C("l_quantity"), 260.15 + C("l_quantity") + C("l_linenumber")


def aligned_models(spark, d):
    rows = t(spark, d, "lineitem").groupBy("l_partkey", "l_returnflag").agg(F.max("l_quantity").alias("v"))
    return G.aligned({f: rows.filter(C("l_returnflag") == f) for f in ("A", "N", "R")}, ["l_partkey"], "v")


def added_channels(spark, d):
    rows = t(spark, d, "lineitem").groupBy((C("l_partkey") % 500).alias("tile"), C("l_linenumber").alias("channel")).agg(F.max("l_extendedprice").alias("v"))
    return G.with_channels(rows.filter("tile < 200 and channel <> tile % 7"), rows.filter("channel <= 4"), ["tile"], "channel")


def resampled_planes(spark, d):
    at = lambda lon, n: F.struct(F.lit(lon).alias("lon0"), F.lit(1.0).alias("lat0"), F.lit(1.0).alias("dx"), F.lit(-1.0).alias("dy"), F.lit(n).alias("width"), F.lit(n).alias("height"))
    planes = t(spark, d, "embeddings").select("vec_id", G.on_geometry(C("embedding"), at(0.0, 8), at(0.5, 4)).alias("p"))
    return planes.select("vec_id", F.size("p").alias("n"), F.round(F.get("p", F.lit(5)), 9).alias("fifth"))


def condition_from_fields(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", conditions.condition(*_fields()).alias("condition"))


def wmo_code(spark, d):
    return t(spark, d, "events").select("event_id", conditions.wmo_condition(C("event_id") % 100 + 0.25, (C("event_id") % 5 + 1).cast("int")).alias("condition"))


def condition_pairs(spark, d):
    return t(spark, d, "events").select("event_id", conditions.packed_pair((C("event_id") % 16).cast("int"), (C("event_id") % 13).cast("int")).alias("pair"))


def storm_index(spark, d):
    x = conditions.storm_index(C("l_extendedprice") / 20, C("l_quantity"), rate=C("l_discount") / 100, convective_rate=C("l_tax") / 100, pwat=C("l_quantity"), dewpoint=C("l_quantity") / 2, cin=C("l_linenumber") * -30.0, shear=C("l_quantity") - 20)
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(x, 6).alias("storm"))


def humidity_magnus(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(units.humidity(C("l_quantity"), C("l_quantity") - C("l_linenumber")), 6).alias("humidity"))


def unit_conversions(spark, d):
    return t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(C("l_quantity") * units.KMH_PER_KNOT, 6).alias("kmh"),
        F.round(units.pressure_hpa(F.when(C("l_linenumber") > 3, C("l_quantity") + 980), C("l_quantity") / 10 + 27), 6).alias("hpa"),
        F.round(units.wind_speed(C("l_quantity"), C("l_discount")) * 3.6, 6).alias("wind"), units.fraction(C("l_quantity")).alias("cloud"),
        F.round(units.wrapped_longitude(C("l_quantity") * 10), 6).alias("lon"), units.round_even(C("l_quantity") / 8, 1).alias("even"), units.round_up(C("l_quantity") / -8, 1).alias("up"),
    )


def plausibility_filter(spark, d):
    return t(spark, d, "orders").select("o_orderkey", units.plausible(C("o_totalprice"), "pressure").alias("pressure"))


COND = """case when l_discount * 6 >= 0.5 then 13 when l_quantity / 5 - 2 >= 0.05 and 263.15::double + l_quantity <= 273.65 and l_linenumber / 10.0::double - 0.3::double < 0.05 then 12
    when l_linenumber / 10.0::double - 0.3::double >= 0.05 and l_quantity / 5 - 2 - (l_linenumber / 10.0::double - 0.3::double) >= 0.05 then 11 when l_linenumber / 10.0::double - 0.3::double >= 5 then 10 when l_linenumber / 10.0::double - 0.3::double >= 0.05 then 9
    when l_quantity / 5 - 2 >= 8 then 8 when l_quantity / 5 - 2 >= 0.25 then 7 when l_quantity / 5 - 2 > 0.01 then 6
    when abs((263.15::double + l_quantity) - (260.15::double + l_quantity + l_linenumber)) <= 1 and l_tax * 12.5 >= 0.75 then 14 when l_tax * 12.5 < 0.12 then 1 when l_tax * 12.5 < 0.32 then 2 when l_tax * 12.5 < 0.68 then 3 when l_tax * 12.5 < 0.88 then 4 else 5 end"""
clip = lambda x: f"least(greatest({x}, 0.0::double), 1.0::double)"
PLANS = {
    "quantize_roundtrip": (quantize_roundtrip, """with r as (select l_returnflag, min(l_extendedprice) lo, max(l_extendedprice) hi from lineitem group by 1), s as (select *, case when hi <= lo then 1.0::double else (hi - lo) / 65534.0::double end sc, case when hi <= lo then lo else (hi + lo) / 2 end o from r),
        q as (select l_orderkey, l_linenumber, greatest(least(round_even((l_extendedprice - o) / sc, 0), 32767), -32767)::int as raw, sc, o from lineitem join s using (l_returnflag)) select l_orderkey, l_linenumber, raw, round(raw * sc + o, 6) as value from q"""),
    "bilinear_sample": (bilinear_sample, """with a as (select vec_id, embedding e, least(greatest((vec_id * 3 % 32) / 4.0::double, 0), 7) x, least(greatest((vec_id * 5 % 28) / 4.0::double, 0), 7) y from embeddings),
        b as (select *, floor(x)::int x0, floor(y)::int y0, x - floor(x) fx, y - floor(y) fy from a), c as (select *, least(x0 + 1, 7) x1, least(y0 + 1, 7) y1 from b)
        select vec_id, round((e[y0*8+x0+1]::double * ((1-fx)*(1-fy)) + e[y0*8+x1+1]::double * (fx*(1-fy)) + e[y1*8+x0+1]::double * ((1-fx)*fy) + e[y1*8+x1+1]::double * (fx*fy)) / ((1-fx)*(1-fy) + fx*(1-fy) + (1-fx)*fy + fx*fy), 9) as value from c"""),
    "regrid_linear": (regrid_linear, """with c as (select vec_id, k, embedding[k + 1]::double v from embeddings, range(64) r(k) where k % 5 <> vec_id % 5), p as (select vec_id, (vec_id * 3 % 32) / 4.0::double x, (vec_id * 5 % 28) / 4.0::double y from embeddings),
        q as (select vec_id, floor(x) + i x, floor(y) + j y, (case i when 1 then x - floor(x) else 1 - (x - floor(x)) end) * (case j when 1 then y - floor(y) else 1 - (y - floor(y)) end) w from p, range(2) a(i), range(2) b(j))
        select q.vec_id, round(sum(v * w) / sum(w), 9) as value from q join c on q.vec_id = c.vec_id and c.k = q.y * 8 + q.x where q.x < 8 and q.y < 8 and w > 0 group by 1"""),
    "pack_channels": (pack_channels, """with e as (select vec_id, label, list_transform(embedding, lambda v: floor(v::double * 1000)::int) raw from embeddings where vec_id % 48 between 6 and 29 and label in (1, 2, 3))
        select printf('v%d_%03d', vec_id, vec_id % 48) as key, label as channel, list_sum(raw)::bigint total, raw[64] as last from e"""),
    "overview_stride": (overview_stride, "select vec_id, k::int k, embedding[[1, 5, 33, 37][k + 1]] as value from embeddings, range(4) r(k)"),
    "daily_extrema_coverage": (daily_extrema_coverage, f"""select * from (select user_id, (h // 24)::int "day", count(distinct h % 24) n_hours, min(h % 24) "first", max(h % 24) "last" from ({HOURS}) group by all) where n_hours >= 3 and "first" <= 9 and "last" >= 12 and "last" - "first" >= 12"""),
    "daily_high_low": (daily_high_low, f"""select event_type, (h // 24)::int "day", max(value) high_value, min(value) low_value from ({HOURS}) where h // 24 between 0 and 14 group by all"""),
    "interval_accumulation": (interval_accumulation, """select event_id, case when event_type <> 'click' and p is not null then greatest(value - p, 0) else value end amount from (select *, last_value(case when event_type <> 'click' then value end ignore nulls) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) p from events)"""),
    "idx_byte_ranges": (idx_byte_ranges, """select o_custkey, o_orderkey, o_orderkey * 100 as "offset", lead(o_orderkey * 100) over (partition by o_custkey order by o_orderkey) - 1 as range_end from orders"""),
    "regrid_nearest": (regrid_nearest, """with s as (select (p_partkey % 46)::int y, (p_partkey % 91)::int x, max(p_retailprice) price from part group by all), g as (select c_custkey, round_even(((c_custkey % 181 - 90 + 0.3)::double + 90) / 4, 0)::int y, round_even(((c_custkey * 7 % 360 - 180 + 0.2)::double + 180) / 4, 0)::int x from customer) select c_custkey, y, x, price from g left join s using (y, x)"""),
    "single_field": (single_field, """with s as (select (s_suppkey % 46)::int y, (s_suppkey % 91)::int x, max(s_acctbal) "value" from supplier group by all), g as (select c_custkey, round_even(((c_custkey % 181 - 90 + 0.3)::double + 90) / 4, 0)::int y, round_even(((c_custkey * 7 % 360 - 180 + 0.2)::double + 180) / 4, 0)::int x from customer) select c_custkey, y, x, "value" from g left join s using (y, x)"""),
    "time_keys": (time_keys, """with e as (select *, (hour(ts) * 15 + user_id % 360 - 180 + 720) % 360 s, ts - interval 270 minute c from events)
        select event_id, s >= 315 or s < 90 night, strftime(date_trunc('day', ts) + interval 2 day, '%Y-%m-%d %H:%M') as "day", strftime(date_trunc('day', c), '%Y-%m-%d ') || lpad((hour(c) // 6 * 6)::varchar, 2, '0') || ':00' run, strftime(date_trunc('hour', ts) + to_hours(user_id % 240), '%Y-%m-%d %H:%M') valid from e"""),
    "file_keys": (file_keys, """with a as (select o_orderkey, o_orderkey % 1801 y, o_custkey % 3601 x from orders), b as (select *, least(y // 200 * 20 - 90, 70) ts, least(x // 200 * 20 - 180, 160) tw, case when y < 300 then -90 when y < 900 then -60 when y < 1500 then 0 else 60 end s, greatest(least((x + 200) // 800 * 80 - 200, 120), -180) w from a),
        n as (select *, case when s >= 0 then 'N' else 'S' end || abs(s) || '_' || case when w >= 0 then 'E' else 'W' end || abs(w) p from b)
        select o_orderkey, case when ts >= 0 then 'N' else 'S' end || abs(ts) || '_' || case when tw >= 0 then 'E' else 'W' end || abs(tw) tile, 'temp_' || (o_orderkey % 48) || 'h_' || p || '.gpack' file, p || '_60' overview from n"""),
    "model_envelope": (model_envelope, "with l as (select l_partkey % 211 tile, l_orderkey % 3 cell, l_suppkey % 4 model, l_extendedprice v from lineitem), n as (select tile, count(distinct model) n_models from l group by 1) select tile, cell, min(v) low, max(v) high, n_models from l join n using (tile) group by tile, cell, n_models having count(distinct model) = n_models"),
    "aligned_models": (aligned_models, """select * from (select l_partkey, max(l_quantity) filter (l_returnflag = 'A') "A", max(l_quantity) filter (l_returnflag = 'N') "N", max(l_quantity) filter (l_returnflag = 'R') "R" from lineitem group by 1) where "A" is not null and "N" is not null and "R" is not null"""),
    "added_channels": (added_channels, """with r as (select l_partkey % 500 tile, l_linenumber channel, max(l_extendedprice) v from lineitem group by all), a as (select * from r where tile < 200 and channel <> tile % 7)
        select * from a union all select * from r where channel <= 4 and tile in (select tile from a) and (tile, channel) not in (select (tile, channel) from a)"""),
    "resampled_planes": (resampled_planes, "select vec_id, 16 as n, round((embedding[10]::double * 0.5 + embedding[11]::double * 0.5) / 1.0, 9) as fifth from embeddings"),
    "condition_from_fields": (condition_from_fields, f"select l_orderkey, l_linenumber, {COND} as condition from lineitem"),
    "wmo_code": (wmo_code, "with e as (select event_id, event_id % 100 c from events) select event_id, (case when c in (96, 99) then 15 when c between 95 and 99 then 13 when c between 68 and 79 or c between 85 and 86 then 9 when c in (66, 67) then 12 when c between 61 and 65 or c between 80 and 82 then 7 when c between 51 and 57 then 6 when c between 45 and 48 then 14 else event_id % 5 + 1 end)::int as condition from e"),
    "condition_pairs": (condition_pairs, "select event_id, ((event_id % 16) + (event_id % 13) * 16)::int as pair from events"),
    "storm_index": (storm_index, f"""with a as (select *, {clip("(l_extendedprice / 20 - 250) / 1750")} en, greatest({clip("(l_quantity - 18) / 37")}, {clip("(l_discount / 100 * 3600 - 0.25) / 8")}, {clip("(l_tax / 100 * 3600 - 0.1) / 5")}) sg from lineitem),
        b as (select *, (0.25::double * en + 0.55::double * sqrt(en) * pow(sg, 0.7) + 0.2::double * sg * en) * (0.55::double + 0.45::double * greatest({clip("(l_quantity - 20) / 25")}, {clip("(l_quantity / 2 - 12) / 12")})) * (0.35::double + 0.65::double * (1 - {clip("(l_linenumber * 30.0::double - 25) / 175")})) * (0.85::double + 0.30::double * {clip("(abs(l_quantity - 20) - 8) / 18")}) v from a)
        select l_orderkey, l_linenumber, round({clip("v")}, 6) as storm from b"""),
    "humidity_magnus": (humidity_magnus, f"""with a as (select *, exp(17.625::double * (l_quantity - l_linenumber) / (243.04::double + (l_quantity - l_linenumber))) / exp(17.625::double * l_quantity / (243.04::double + l_quantity)) v from lineitem) select l_orderkey, l_linenumber, round({clip("v")}, 6) as humidity from a"""),
    "unit_conversions": (unit_conversions, """select l_orderkey, l_linenumber, round(l_quantity * 1.852::double, 6) kmh, round(case when l_linenumber > 3 then l_quantity + 980 else (l_quantity / 10 + 27) * 33.8638866667::double end, 6) hpa, round(sqrt(l_quantity * l_quantity + l_discount * l_discount) * 3.6::double, 6) wind,
        least(greatest(case when l_quantity > 1.5 then l_quantity / 100 else l_quantity end, 0.0::double), 1.0::double) cloud, round(fmod(l_quantity * 10 + 180, 360.0::double) - 180, 6) lon, round_even(l_quantity / 8 * 10.0::double, 0) / 10.0::double as "even", floor(l_quantity / -8 * 10.0::double + 0.5::double) / 10.0::double as "up" from lineitem"""),
    "plausibility_filter": (plausibility_filter, "select o_orderkey, case when o_totalprice between 80000 and 110000 then o_totalprice end as pressure from orders"),
}
