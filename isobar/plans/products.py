"""Product queries: consensus of all fields, daily extremes, provider fields, tiles, station samples and storm layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import conditions, fields
from ..operators import consensus as C
from ..operators import feeds, products, tides
from ..sources import sinks
from .consensus import FAMILY_SQL, t
from .grids import HOURS, _hours
from .hazards import CASE_SQL, OUTPUT_SQL

MODELS = ("gfs", "aigfs", "ifs", "aifs", "icon")
c = F.col


def _pick(names, key):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (key + 1).cast("int"))


def _cells(spark, d):
    """Tiles and cells from parts, fields from orders, models from suppliers; skill only where it is a power of two."""
    rows = t(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_suppkey", "l_quantity", "l_discount")
    field = _pick(("temperature", "precipitation", "condition_code", "wind_u"), c("l_orderkey") % 4)
    value = F.when(c("l_orderkey") % 4 == 1, c("l_discount")).when(c("l_orderkey") % 4 == 2, c("l_quantity") % 16).otherwise(c("l_quantity"))
    value = F.when(c("l_quantity") == 50, F.lit(float("nan"))).when(c("l_quantity") == 49, F.lit(float("inf"))).otherwise(value)
    rows = rows.select((c("l_partkey") % 97).alias("tile"), (c("l_partkey") % 5).alias("cell"), field.alias("field"), _pick(MODELS, c("l_suppkey") % 5).alias("model"), "l_orderkey", "l_suppkey", value.alias("value"))
    one = rows.groupBy("tile", "cell", "field", "model").agg(F.max_by("value", F.struct("l_orderkey", "l_suppkey", "value")).alias("value"))
    return one.withColumn("skill", F.when(c("model") == "icon", 0.5).when(c("model") == "ifs", 2.0))


CELLS = """l as (select l_partkey % 97 tile, l_partkey % 5 cell, ['temperature', 'precipitation', 'condition_code', 'wind_u'][l_orderkey % 4 + 1] field, ['gfs', 'aigfs', 'ifs', 'aifs', 'icon'][l_suppkey % 5 + 1] model, l_orderkey, l_suppkey,
        case when l_quantity = 50 then 'nan'::double when l_quantity = 49 then 'inf'::double when l_orderkey % 4 = 1 then l_discount when l_orderkey % 4 = 2 then l_quantity % 16 else l_quantity end v from lineitem),
    m as (select tile, cell, field, model, arg_max(v, {'o': l_orderkey, 's': l_suppkey, 'v': v}) v from l group by all),
    c0 as (select *, case model when 'gfs' then 'noaa' when 'aigfs' then 'noaa' when 'ifs' then 'ecmwf' when 'aifs' then 'ecmwf' else 'dwd' end fam, case model when 'icon' then 0.5::double when 'ifs' then 2.0::double else 1.0::double end sk, not isnan(v) and not isinf(v) known from m),
    pl as (select tile, field, fam, count(distinct model) sib from c0 group by all), pf as (select tile, field, count(*) families from pl group by all having count(*) >= 2),
    r as (select c0.*, sk / sib w, families from c0 join pl using (tile, field, fam) join pf using (tile, field)),
    a1 as (select tile, cell, field, min(v) filter (2 * cw >= tw) as v from (select tile, cell, field, v, sum(w) over (partition by tile, cell, field order by v) cw, sum(w) over (partition by tile, cell, field) tw from (select tile, cell, field, v, sum(w) w from r where known and field not in ('condition_code', 'precipitation') group by all)) group by all),
    a0 as (select distinct tile, cell, field from r where field not in ('condition_code', 'precipitation')),
    k as (select tile, cell, field, case when known then round_even(v, 0)::int else 0 end code, w from r where field = 'condition_code'),
    """ + f"kf as (select tile, cell, field, code, {FAMILY_SQL} fam, sum(w) w from k group by all), kg as (select tile, cell, field, fam, sum(w) fw, arg_max(code, {{'w': w, 'c': code}}) code from kf group by all)," + """
    a2 as (select tile, cell, field, arg_max(code, {'w': fw, 'f': fam})::double v from kg group by all),
    p as (select * from r where field = 'precipitation'), pp as (select tile, cell, coalesce(sum(w) filter (known and v >= 0.05) / sum(w) filter (known), 0) pr from p group by all),
    pm as (select tile, cell, min(v) filter (2 * cw >= tw) as v from (select tile, cell, v, sum(w) over (partition by tile, cell order by v) cw, sum(w) over (partition by tile, cell) tw from (select tile, cell, v, sum(w) w from p where known and v >= 0.05 group by all)) group by all),
    f as (select tile, cell, field, v from a0 left join a1 using (tile, cell, field) union all select * from a2 union all select tile, cell, 'precipitation', case when pr >= 0.5 then coalesce(pm.v, 0) else 0 end from pp left join pm using (tile, cell) union all select tile, cell, 'precipitation_probability', pr from pp),
    x as (select tile, cell, field, round_even(v * 1000.0::double, 0) / 1000.0::double as "value" from f)"""


def field_consensus(spark, d):
    out = C.field_consensus(_cells(spark, d), ["tile"], ["cell"])
    return out.select("tile", "cell", "field", "value", "spread", "families", "confidence")


def learned_consensus(spark, d):
    cells = _cells(spark, d)
    bias = spark.range(97).select(c("id").alias("tile"), (c("id") % 9 - 4).cast("double").alias("value"), (c("id") % 6).alias("samples"))
    plain = C.field_consensus(cells, ["tile"], ["cell"], quality=False)
    return C.corrected_temperature(plain, cells, ["tile"], ["cell"], bias).filter("field = 'temperature'").select("tile", "cell", "value")


def daily_products(spark, d):
    rows = _hours(spark, d).select((c("user_id") % 6).alias("tile"), _pick(MODELS, c("user_id") % 5).alias("model"), "hour", (c("value") * 2 + 170).alias("temperature"), F.floor("value").alias("wind_u"), F.lit(0.0).alias("wind_v"), (c("value") / 100).alias("humidity"))
    rows = rows.withColumns({"cell": c("hour") % 2, "wind_gust": c("temperature"), "pressure": c("temperature") * 400})
    return products.daily_products(rows, rows.filter("model = 'icon'").drop("model"), ["tile"], ["cell"])


def _lines(spark, d):
    """A row for each order and line number: the one with the most, of its prices."""
    rows = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.struct("l_extendedprice", "l_quantity", "l_discount", "l_tax").alias("v"))
    return rows.groupBy("l_orderkey", "l_linenumber").agg(F.max("v").alias("v")).select("l_orderkey", "l_linenumber", "v.*")


LINES = "(select l_orderkey, l_linenumber, v.* from (select l_orderkey, l_linenumber, max(row(l_extendedprice, l_quantity, l_discount, l_tax)::struct(l_extendedprice double, l_quantity double, l_discount double, l_tax double)) v from lineitem group by all))"


def provider_fields(spark, d):
    rows = _lines(spark, d).select(
        "l_orderkey", "l_linenumber", (c("l_quantity") + 263).alias("temperature"), (c("l_quantity") + 261 - c("l_linenumber")).alias("2d"), (c("l_tax") * 1000).alias("tcc"), (c("l_quantity") / 1000).alias("tp"), F.lit("m").alias("precipitation_units"),
        F.lit(0).alias("start_step"), (c("l_linenumber") % 4).alias("end_step"), (c("l_discount") * 6).alias("cp"), c("l_linenumber").alias("hour"),
    )
    out = products.provider_fields(rows, ["l_orderkey"])
    return out.select("l_orderkey", "hour", "temperature", "dewpoint", "cloud_cover", F.round("precipitation", 6).alias("precipitation"), F.round("humidity", 6).alias("humidity"), "condition_code")


def tiled_layer(spark, d):
    """Counts of a layer's cells in tiles, packs and overviews; borders belong to two tiles."""
    cells = t(spark, d, "part").select((c("p_partkey") % 37 * 5 - 90).cast("double").alias("lat"), (c("p_partkey") % 72 * 5 - 180).cast("double").alias("lon"), "p_retailprice").groupBy("lat", "lon").agg(F.max("p_retailprice").alias("value"))
    tiled = products.tiled(cells)
    over = products.overview_cells(tiled, []).groupBy(c("key").alias("tile")).agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("highest"))
    return tiled.groupBy("tile", "pack_lat", "pack_lon").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("highest")).unionByName(over, allowMissingColumns=True)


def station_samples(spark, d):
    """Planes are embeddings (8 x 8 over 20 degrees), stations customers."""
    lat, lon = c("vec_id") % 9 * 20 - 90, F.floor(c("vec_id") / 9) % 18 * 20 - 180
    field = _pick(("temperature", "wind_u", "wind_v", "pressure"), c("vec_id") % 4)
    south = F.concat(F.when(lat >= 0, "N").otherwise("S"), F.abs(lat).cast("string"), F.lit("_"), F.when(lon >= 0, "E").otherwise("W"), F.abs(lon).cast("string"))
    planes = t(spark, d, "embeddings").select(F.lit("gfs").alias("provider"), south.alias("tile"), F.lit(6).alias("hour"), field.alias("field"), lon.cast("double").alias("lon0"), (lat + 20).cast("double").alias("lat0"), F.lit(2.5).alias("dx"), F.lit(-2.5).alias("dy"), F.lit(8).alias("width"), F.lit(8).alias("height"), c("embedding").alias("plane"), "vec_id")
    planes = planes.groupBy("provider", "tile", "hour", "field").agg(F.max_by(F.struct("lon0", "lat0", "dx", "dy", "width", "height", "plane"), "vec_id").alias("p")).select("provider", "tile", "hour", "field", "p.*")
    stations = t(spark, d, "customer").select(c("c_custkey").alias("station"), (c("c_custkey") % 179 - 89).cast("double").alias("latitude"), (c("c_custkey") * 7 % 359 - 179).cast("double").alias("longitude"))
    out = products.station_samples(planes, stations, F.lit("2026-01-01 00:00:00").cast("timestamp"))
    return out.select("provider", "station", "lead_hours", F.unix_micros("valid_time").alias("valid_us"), *[F.round(x, 6).alias(x) for x in ("temperature_c", "wind_kmh", "pressure_hpa")])


def storm_layer(spark, d):
    rows = _lines(spark, d)
    on = ["l_orderkey", "l_linenumber"]
    get = lambda v, keep="true": rows.filter(keep).select(*on, v.alias("value"))
    required = {"cape": get(c("l_extendedprice") / 20), "composite_reflectivity": get(c("l_quantity"))}
    winds = {f"wind_{k}_{level}": get(c("l_quantity") * s) for k, level, s in (("u", 500, 1.0), ("v", 500, 0.0), ("u", 850, 0.5), ("v", 850, 0.0))}
    out = products.storm_layer(required, {"precipitation_rate": get(c("l_discount") / 100, "l_linenumber < 4")} | winds, on)
    return out.select(*on, F.round("storm_potential", 6).alias("storm_potential"))


def model_horizons(spark, d):
    rows = t(spark, d, "lineitem").select(_pick(MODELS, c("l_suppkey") % 5).alias("model"), (c("l_orderkey") % 340).cast("int").alias("hour"), (c("l_linenumber") * 2 - 1).cast("int").alias("channel"))
    out = products.models_manifest(products.within_reach(rows, "model", "hour"))
    return out.select("model", F.size("hours").alias("n_hours"), F.element_at("hours", -1).alias("last_hour"), "day_count", F.array_join("fields", ",").alias("fields"))


def hazard_run(spark, d):
    """Documents as features of their sources: the expired go, failed sources keep the documents that labels names."""
    docs = t(spark, d, "documents").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") % 30).cast("int")).cast("string"))
    status = docs.select(c("source").alias("provider")).distinct().withColumn("status", F.when(c("provider").isin("src1", "src3"), "error").otherwise("ok"))
    named = lambda df: feeds.features(df, c("source"), F.lit(None).cast("string"), {"id": c("doc_id").cast("string"), "event": c("text"), "expires": F.when(c("doc_id") % 4 > 0, c("day"))})
    failed = c("source").isin("src1", "src3")
    old = named(docs.filter(failed).join(t(spark, d, "labels").select("doc_id"), "doc_id", "left_semi"))
    old = old.withColumn("output", feeds.output_of(c("category"))).withColumn("stale", F.lit(False))
    out = feeds.hazard_outputs(named(docs.filter(~failed | failed.isNull())), old, status, F.lit("2024-01-15").cast("timestamp"))
    return feeds.hazard_manifest(out, status)


def job_manifests(spark, d):
    rows = t(spark, d, "orders").select(c("o_orderpriority").alias("job"), c("o_orderdate").cast("timestamp").alias("reference"), (c("o_orderkey") % 30).cast("int").alias("hour"), (c("o_custkey") % 50).alias("tile"), (c("o_custkey") % 7).alias("pack"))
    return sinks.job_manifest(rows).select("job", F.unix_micros("reference").alias("reference_us"), "tiles", "packs", F.size("hours").alias("n_hours"))


def tide_index(spark, d):
    s = t(spark, d, "supplier")
    of = lambda *pairs: F.struct(*[v.alias(k) for k, v in pairs])
    name, none = c("s_name"), F.lit(None).cast("string")
    stations = s.select(
        name.alias("id"), F.concat(F.lit("at "), name).alias("name"), of(("name", none), ("id", none), ("url", none)).alias("source"), of(("type", F.lit("cc")), ("url", none)).alias("license"), (c("s_suppkey") % 3 > 0).alias("commercial_use"),
        F.when(c("s_suppkey") % 2 == 0, "reference").otherwise("subordinate").alias("kind"), F.when(c("s_suppkey") % 4 == 1, F.lit("r")).alias("reference"), F.when(c("s_suppkey") % 5 > 0, F.array(F.lit(1.0))).alias("harmonics"), F.lit(1).alias("high_minutes"), F.lit(2).alias("low_minutes"), F.lit(0.5).alias("high_height"), F.lit(0.5).alias("low_height"), F.lit("ratio").alias("height_kind"),
        F.lit("x").alias("country"), none.alias("region"), none.alias("continent"), F.when(c("s_suppkey") % 7 == 0, "CET").alias("timezone"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit("LAT").alias("chart_datum"), none.alias("datums_source"), F.when(c("s_suppkey") % 9 == 0, "").otherwise(none).alias("disclaimers"),
    )
    names = s.filter("s_suppkey % 10 = 0").select(name.alias("id"), F.lit("renamed").alias("name"))
    quality = s.filter("s_suppkey % 6 < 3").select(name.alias("id"), (c("s_suppkey") % 6 == 0).alias("accepted"))
    out = tides.station_index(tides.selected_stations(stations), names, quality)
    return out.select("id", "name", "stationType", "referenceStationId", "timezone", "qualityAccepted", "quality", "commercialUse")


clip = lambda x: f"least(greatest({x}, 0.0::double), 1.0::double)"
DAILY_SQL = " union all ".join(f"select tile, cell, day, model, '{f}' field, {v} v from a" for f, v in (
    ("temperature", "case when tk between 180 and 340 then tk end"), ("wind_speed", "case when floor(value) between 0 and 150 then floor(value) end"), ("wind_gust", "case when tk between 0 and 200 then tk end"),
    ("pressure", "case when tk * 400 between 80000 and 110000 then tk * 400 end"), ("humidity", "case when value / 100 between 0 and 1 then value / 100 end"),
))
CHANNEL_SQL = {e: "case field || ' ' || model " + " ".join(f"when '{f} {m}' then {k}" for f, of in fields.DAILY.items() for m, k in of[e].items()) + " end" for e in ("high", "low")}
def condition_names(spark, d):
    return t(spark, d, "events").select("event_id", conditions.condition_name(c("event_id") % 17 + 0.25).alias("name"))


PLANS = {
    "condition_names": (condition_names, "select event_id, [" + ", ".join(f"'{k}'" for k, _ in sorted(conditions.CODES.items(), key=lambda x: x[1])) + "][event_id % 17 + 1] as \"name\" from events"),
    "field_consensus": (field_consensus, f"""with {CELLS}, s as (select tile, cell, field, case when field <> 'condition_code' or count_if(not known) = 0 then max(v) filter (known) - min(v) filter (known) end spread, max(families) families from r group by tile, cell, field)
        select tile, cell, x.field, x."value", spread, families, case when spread is not null and x.field in ('temperature', 'precipitation', 'condition_code') then round_even((1 - {clip("spread / case x.field when 'condition_code' then 4.0::double else 8.0::double end")}) * least(families / 3.0::double, 1.0::double) * 1000.0::double, 0) / 1000.0::double end confidence from x left join s using (tile, cell, field)"""),
    "learned_consensus": (learned_consensus, f"""with {CELLS}, g as (select tile, cell, min(v) filter (known) lo, max(v) filter (known) hi from m join c0 using (tile, cell, field, model, v) where field = 'temperature' group by all), b as (select tile, cell, "value" v, case when tile % 6 >= 3 then tile % 9 - 4 else 0 end bias, lo, hi from x join g using (tile, cell) where field = 'temperature')
        select tile, cell, case when v is null or bias = 0 then v else least(greatest(v + bias, lo), hi) end as "value" from b"""),
    "daily_products": (daily_products, f"""with h as (select user_id % 6 tile, ['gfs', 'aigfs', 'ifs', 'aifs', 'icon'][user_id % 5 + 1] model, h, h % 2 cell, h // 24 as day, value, value * 2 + 170 tk from ({HOURS})),
        cv as (select tile, model, day from h group by all having count(distinct h % 24) >= 3 and min(h % 24) <= 9 and max(h % 24) >= 12 and max(h % 24) - min(h % 24) >= 12),
        a as (select h.* from h join cv using (tile, model, day) where day between 0 and 14 union all select tile, 'blend', h, cell, day, value, tk from h where model = 'icon' and day between 0 and 14), l as ({DAILY_SQL}),
        o as (select tile, cell, day::int as day, field, model, max(v) hi, min(v) lo from l group by all)
        select tile, cell, day, field, model, round_even(hi * case field when 'humidity' then 1000.0::double else 10.0::double end, 0) / case field when 'humidity' then 1000.0::double else 10.0::double end high, round_even(lo * case field when 'humidity' then 1000.0::double else 10.0::double end, 0) / case field when 'humidity' then 1000.0::double else 10.0::double end low,
        {CHANNEL_SQL["high"]} channel_high, {CHANNEL_SQL["low"]} channel_low from o"""),
    "provider_fields": (provider_fields, f"""with a as (select l_orderkey, l_linenumber "hour", l_quantity + 263 temperature, l_quantity + 261 - l_linenumber dewpoint, {clip("case when l_tax * 1000 > 1.5 then l_tax * 1000 / 100 else l_tax * 1000 end")} cloud_cover, l_quantity / 1000 * 1000 mm, l_linenumber % 4 <> 0 run, l_discount * 6 cp from {LINES}),
        b as (select *, last_value(case when run then mm end ignore nulls) over (partition by l_orderkey order by "hour" rows between unbounded preceding and 1 preceding) p from a), e as (select *, case when run and p is not null then greatest(mm - p, 0) else mm end precipitation from b)
        select l_orderkey, "hour", temperature, dewpoint, cloud_cover, round(precipitation, 6) precipitation, round({clip("exp(17.625::double * (dewpoint - 273.15::double) / (243.04::double + (dewpoint - 273.15::double))) / exp(17.625::double * (temperature - 273.15::double) / (243.04::double + (temperature - 273.15::double)))")}, 6) humidity,
        (case when cp >= 0.5 then 13 when precipitation >= 0.05 and temperature <= 273.65 then 12 when precipitation >= 8 then 8 when precipitation >= 0.25 then 7 when precipitation > 0.01 then 6 when abs(temperature - dewpoint) <= 1 and cloud_cover >= 0.75 then 14 when cloud_cover < 0.12 then 1 when cloud_cover < 0.32 then 2 when cloud_cover < 0.68 then 3 when cloud_cover < 0.88 then 4 else 5 end)::double condition_code from e"""),
    "tiled_layer": (tiled_layer, """with p as (select p_partkey % 37 * 5 - 90 lat, p_partkey % 72 * 5 - 180 lon, max(p_retailprice) v from part group by all),
        i as (select * from p, (select unnest(range(-90, 90, 20)) s) a, (select unnest(range(-180, 180, 20)) w) b where lat between s and s + 20 and lon between w and w + 20),
        k as (select *, least(greatest(floor(s / 60.0)::int * 60, -90), 60) ps, least(greatest(floor((w + 120) / 80.0)::int * 80 - 120, -180), 120) pw from i),
        n as (select *, (case when s >= 0 then 'N' else 'S' end) || abs(s) || '_' || (case when w >= 0 then 'E' else 'W' end) || abs(w) tile from k),
        u as (select distinct ps, pw, lat, lon, v from k), y as (select *, dense_rank() over (partition by ps, pw order by lat desc) - 1 y, dense_rank() over (partition by ps, pw order by lon) - 1 x from u)
        select tile, ps::int pack_lat, pw::int pack_lon, count(*) n, max(v) highest from n group by all union all
        select (case when ps >= 0 then 'N' else 'S' end) || abs(ps) || '_' || (case when pw >= 0 then 'E' else 'W' end) || abs(pw) || '_60', null, null, count(*), max(v) from y where y % 4 = 0 and x % 4 = 0 group by ps, pw"""),
    "station_samples": (station_samples, """with e as (select vec_id % 9 * 20 - 90 lat, vec_id // 9 % 18 * 20 - 180 lon, ['temperature', 'wind_u', 'wind_v', 'pressure'][vec_id % 4 + 1] field, arg_max(embedding, vec_id) p from embeddings group by all),
        s as (select c_custkey station, (c_custkey % 179 - 89)::double la, (c_custkey * 7 % 359 - 179)::double lo from customer),
        j as (select station, field, p, least(greatest((lo - lon) / 2.5::double, 0), 7) x, least(greatest((la - (lat + 20)) / -2.5::double, 0), 7) y from s join e on lat = least(greatest(floor((la + 90) / 20)::int * 20 - 90, -90), 70) and lon = least(greatest(floor((lo + 180) / 20)::int * 20 - 180, -180), 160)),
        q as (select *, floor(x)::int x0, floor(y)::int y0, least(floor(x)::int + 1, 7) x1, least(floor(y)::int + 1, 7) y1, x - floor(x) fx, y - floor(y) fy from j),
        v as (select station, field, (p[y0*8+x0+1]::double * ((1-fx)*(1-fy)) + p[y0*8+x1+1]::double * (fx*(1-fy)) + p[y1*8+x0+1]::double * ((1-fx)*fy) + p[y1*8+x1+1]::double * (fx*fy)) / ((1-fx)*(1-fy) + fx*(1-fy) + (1-fx)*fy + fx*fy) v from q),
        w as (select station, max(v) filter (field = 'temperature') tk, max(v) filter (field = 'wind_u') u, max(v) filter (field = 'wind_v') vv, max(v) filter (field = 'pressure') pa from v group by 1)
        select 'gfs' provider, station, 6 lead_hours, 1767225600000000 + 21600000000 valid_us, round(tk - 273.15::double, 6) temperature_c, round(sqrt(u * u + vv * vv) * 3.6::double, 6) wind_kmh, round(pa / 100, 6) pressure_hpa from w"""),
    "storm_layer": (storm_layer, f"""with a as (select *, {clip("(l_extendedprice / 20 - 250) / 1750")} en, greatest({clip("(l_quantity - 18) / 37")}, {clip("(l_discount / 100 * 3600 - 0.25) / 8")}) sg from {LINES} where l_linenumber < 4),
        b as (select *, (0.25::double * en + 0.55::double * sqrt(en) * pow(sg, 0.7) + 0.2::double * sg * en) * (0.85::double + 0.30::double * {clip("(l_quantity * 0.5::double - 8) / 18")}) v from a) select l_orderkey, l_linenumber, round({clip("v")} * 100, 6) storm_potential from b"""),
    "model_horizons": (model_horizons, """with r as (select ['gfs', 'aigfs', 'ifs', 'aifs', 'icon'][l_suppkey % 5 + 1] model, l_orderkey % 340 h, l_linenumber * 2 - 1 k from lineitem), q as (select * from r where model <> 'icon' or h <= 120),
        n as (select distinct model, k, ['dewpoint', 'wind_v', 'pressure', 'cloud_cover', 'snowfall', 'condition_code', null][(k + 1) // 2] f from q)
        select model, n_hours, last_hour, last_hour // 24 + 1 day_count, fields from (select model, count(distinct h)::int n_hours, max(h)::int last_hour from q group by 1) join (select model, string_agg(f, ',' order by k) fields from n group by 1) using (model)"""),
    "hazard_run": (hazard_run, f"""with e as (select doc_id, source, {CASE_SQL} category, doc_id % 4 = 0 or doc_id % 30 >= 14 active from (select doc_id, source, text e from documents)), o as (select *, {OUTPUT_SQL} o from e),
        a as (select o, source, false stale from o where source not in ('src1', 'src3') and active union all select o, source, true from o where source in ('src1', 'src3') and doc_id in (select doc_id from labels))
        select 'output' kind, n "name", (select count(*) from a where a.o = n) features, null::varchar status from (select unnest(['alerts', 'tropical', 'fires', 'floods', 'earthquakes']) n) union all
        select 'provider', s, (select count(*) from a where a.source = s and not stale), case when s in ('src1', 'src3') then 'error' else 'ok' end from (select distinct source s from documents)"""),
    "job_manifests": (job_manifests, "select o_orderpriority job, max(epoch_us(o_orderdate)) reference_us, count(distinct (o_orderkey % 30, o_custkey % 50)) tiles, count(distinct (o_orderkey % 30, o_custkey % 7)) packs, count(distinct o_orderkey % 30)::int n_hours from orders group by 1"),
    "tide_index": (tide_index, """select s_name id, case when s_suppkey % 10 = 0 then 'renamed' else 'at ' || s_name end as "name", case when s_suppkey % 2 = 0 then 'reference' else 'subordinate' end "stationType", case when s_suppkey % 4 = 1 then 'r' end "referenceStationId", case when s_suppkey % 7 = 0 then 'CET' else 'UTC' end timezone, s_suppkey % 6 = 0 "qualityAccepted", 'No obvious issues' quality, true "commercialUse"
        from supplier where s_suppkey % 3 > 0 and case when s_suppkey % 2 = 0 then s_suppkey % 5 > 0 else s_suppkey % 4 = 1 end"""),
}
