"""Learning queries. Observations and forecasts are events of two types, stations users, errors values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import learning as L
from .consensus import t


def _events(spark, d):
    return t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def nearest_forecast(spark, d):
    e = _events(spark, d)
    obs = e.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("obs_id"), F.col("ts").alias("observed_at"))
    fc = e.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("fc_id"), F.col("ts").alias("valid_time"))
    return L.nearest_in_time(obs, fc, ["user_id"], "observed_at", "valid_time", "obs_id", "fc_id").select("obs_id", "fc_id", F.round(F.col("gap") * 1e6).cast("long").alias("gap_us"))


def nearest_observation_global(spark, d):
    e = _events(spark, d)
    a = e.filter("event_type = 'signup'").select(F.col("event_id").alias("a_id"), F.col("ts").alias("a_ts"))
    b = e.filter("event_type = 'error'").select(F.col("event_id").alias("b_id"), F.col("ts").alias("b_ts"))
    return L.nearest_in_time(a, b, [], "a_ts", "b_ts", "a_id", "b_id").select("a_id", "b_id")


def ema_fold(spark, d):
    e = _events(spark, d)
    old = e.select("user_id").distinct().filter("user_id % 2 = 0").select("user_id", (F.col("user_id") % 7).cast("double").alias("bias"), (F.col("user_id") % 3).cast("long").alias("samples"))
    return L.ema_fold(e.select("user_id", "value", "ts", "event_id"), ["user_id"], "value", ["ts", "event_id"], 0.2, 3, "bias", old, F.to_date("ts"))


def robust_scores(spark, d):
    """Whole-number errors, so that means don't depend on the order of summing."""
    e = _events(spark, d).select((F.col("user_id") % 5).alias("grp"), F.col("event_type").alias("provider"), "ts", "event_id", F.floor(F.col("value") % 4).cast("double").alias("error"))
    state = spark.createDataFrame([], "grp bigint, provider string, score double, sample_count bigint, history array<double>")
    out = L.updated_scores(e, state, ["grp"], "provider", "error", ["ts", "event_id"])
    return out.select("grp", "provider", F.round("score", 6).alias("score"), "sample_count", F.size("history").alias("n_history"), F.round("weight", 6).alias("weight"))


def state_full_outer_merge(spark, d):
    e = _events(spark, d).select("user_id", "event_type", "ts")
    half = lambda c: e.filter(c).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return L.merged_state(half("ts < timestamp'2024-01-16'"), half("ts >= timestamp'2024-01-16'"), ["user_id", "event_type"])


def grouped_errors_grouping_sets(spark, d):
    rows = t(spark, d, "lineitem").select(F.col("l_returnflag").alias("region"), F.col("l_linestatus").alias("bucket"), F.col("l_suppkey").alias("provider"), F.col("l_quantity").alias("error"))
    return L.grouped_errors(rows, "region", "bucket", "provider", "error")


def holdout_split(spark, d):
    return t(spark, d, "supplier").select("s_suppkey", K.is_holdout(F.col("s_name")).alias("holdout"))


def lead_bucket(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", K.lead_bucket(F.when(F.col("l_orderkey") % 11 > 0, F.col("l_orderkey") % 240 + 0.5)).alias("bucket"))


def _place():
    return (F.col("c_custkey") % 181 - 90).cast("double"), (F.col("c_custkey") * 7 % 360 - 180).cast("double")


def region_key(spark, d):
    return t(spark, d, "customer").select("c_custkey", K.region_key(*_place()).alias("region"))


def tile_pack_keys(spark, d):
    south, west = K.pack_origin(*_place())
    return t(spark, d, "customer").select("c_custkey", K.tile_name(*_place()).alias("tile"), south.alias("pack_lat"), west.alias("pack_lon"))


def latest_per_key(spark, d):
    return L.latest_per_key(t(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value"), ["user_id"], ["ts", "event_id"])


def validation_metrics(spark, d):
    rows = t(spark, d, "labels").join(t(spark, d, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    rows = rows.select("lang", "quality", "toxic", (F.col("n_chars") % 5 / F.lit(4.0)).alias("p"))
    out = L.validation(rows, ["lang"], "quality", "toxic", "p", "toxic")
    return out.select("lang", *[F.round(c, 9).alias(c) for c in ("mae", "bias", "brier", "accuracy")], "n")


def regional_weights(spark, d):
    c = t(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 12).alias("region"), (F.col("c_custkey") % 5).alias("provider"))
    s = t(spark, d, "supplier").select((F.col("s_suppkey") % 7).alias("region"), (F.col("s_suppkey") % 4).alias("provider"), F.col("s_acctbal").alias("weight"))
    regional = s.groupBy("region", "provider").agg(F.max("weight").alias("weight"))
    return L.regional_or_global(c, regional, s.groupBy("provider").agg(F.min("weight").alias("weight")), ["region"], "provider", "weight", "weight").select("c_custkey", "weight")


def forecast_errors(spark, d):
    a = {"temperature": F.col("l_quantity"), "wind": F.when(F.col("l_linenumber") > 3, F.col("l_quantity") * 2), "precipitation": F.col("l_discount")}
    b = {"temperature": F.lit(25.0), "wind": F.lit(40.0), "precipitation": F.col("l_tax")}
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.round(L.forecast_error(a, b), 9).alias("error"))


def _station_errors(spark, d):
    """Users are stations: their last error is the observation, events of other types are forecasts of providers, near within a day."""
    e = _events(spark, d).withColumn("station", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    none = {c: F.lit(None).cast("double").alias(c) for c in L.SHARED}
    own = none | {"temperature_c": F.floor(F.col("value") % 30).cast("double").alias("temperature_c"), "precipitation_mm": (F.col("event_id") % 4 / 10).alias("precipitation_mm")}
    obs = e.filter("event_type = 'error'").select("station", F.col("ts").alias("observed_at"), (F.col("user_id") * 7 % 180 - 90).cast("double").alias("latitude"), (F.col("user_id") * 11 % 360 - 180).cast("double").alias("longitude"), *own.values())
    fc = e.filter("event_type <> 'error'").select(F.col("event_type").alias("provider"), "station", F.col("ts").alias("valid_time"), (F.col("event_id") % 240 + 0.5).alias("lead_hours"), F.col("event_id").alias("ordinal"), *own.values())
    return L.station_errors(obs, fc, 1440)


def _learned(spark, d):
    scores = spark.createDataFrame([("*", "*", "click", 2.0, 3, [1.0, 3.0])], "region string, bucket string, provider string, score double, sample_count bigint, history array<double>")
    biases = spark.createDataFrame([("+10_+000", "day", 1.5, 4)], "region string, period string, value double, samples bigint")
    return L.scored_providers(_station_errors(spark, d), scores, biases)


def station_errors(spark, d):
    return _station_errors(spark, d).select("station", "provider", "region", "bucket", "holdout", "error")


def provider_skill(spark, d):
    return _learned(spark, d)["skill"].select("region", "bucket", "provider", F.round("score", 6).alias("score"), "sample_count", F.size("history").alias("n_history"), F.round("weight", 6).alias("weight"))


def provider_bias(spark, d):
    return _learned(spark, d)["bias"]


def provider_validation(spark, d):
    return _learned(spark, d)["validation"]


def validated_hours(spark, d):
    e = _events(spark, d)
    shared = [F.floor(F.col("value") % 30).alias("temperature_c"), F.floor(F.col("value") % 50).alias("wind_kmh"), (F.col("event_id") % 16).alias("condition")]
    fc = e.filter("event_type = 'signup'").select(F.col("event_id").alias("ordinal"), F.col("ts").alias("valid_time"), (F.col("event_id") % 5 / 4).alias("probability"), *shared)
    obs = e.filter("event_type = 'error'").select(F.col("event_id").alias("ordinal"), F.col("ts").alias("observed_at"), F.when(F.col("event_id") % 3 > 0, F.col("event_id") % 4 / 10).alias("precipitation_mm"), *shared)
    out = L.validated_hours(fc, obs)
    return out.select("matched_hours", *[F.round(c, 9).alias(c) for c in out.columns if c != "matched_hours"])


NEAR = """select {l}, {r} {extra} from (select {l}, {r}, g, row_number() over (partition by {l} order by g, {r}) k from (select a.*, b.*, abs(epoch_us(t0) - epoch_us(t1)) g from a join b on {on}) where g <= 5400000000) where k = 1"""
ERRORS = """ob as (select * from (select 'u' || user_id station, user_id, ts t0, floor(value % 30) ot, event_id % 4 / 10.0::double op, row_number() over (partition by user_id order by ts desc, floor(value % 30) desc, event_id % 4 desc) k from events where event_type = 'error') where k = 1),
    f as (select 'u' || user_id station, event_type provider, ts t1, event_id, event_id % 240 lead, floor(value % 30) ft, event_id % 4 / 10.0::double fp from events where event_type <> 'error'),
    n as (select *, row_number() over (partition by station, provider order by abs(epoch_us(t0) - epoch_us(t1)), event_id) kk from ob join f using (station) where abs(epoch_us(t0) - epoch_us(t1)) <= 86400000000),
    e as (select station, provider, t0, user_id * 11 % 360 - 180 lon, ot, op, ft, fp, printf('%+03d_%+04d', least(greatest(floor((user_id * 7 % 180) / 20.0)::int * 20, 0), 160) - 90, least(greatest(floor((user_id * 11 % 360) / 20.0)::int * 20, 0), 340) - 180) region,
        case when lead <= 24 then '0-24' when lead <= 72 then '25-72' when lead <= 168 then '73-168' else '169+' end bucket, ('0x' || substr(sha256(station), 1, 2))::int < 26 holdout, (abs(ft - ot) / 2.0::double + ((fp >= 0.05) <> (op >= 0.1))::int) / 2.0::double error from n where kk = 1)"""
PLANS = {
    "nearest_forecast": (nearest_forecast, "with a as (select user_id u, event_id obs_id, ts t0 from events where event_type = 'error'), b as (select user_id v, event_id fc_id, ts t1 from events where event_type = 'purchase') " + NEAR.format(l="obs_id", r="fc_id", extra=", g as gap_us", on="u = v")),
    "nearest_observation_global": (nearest_observation_global, "with a as (select event_id a_id, ts t0 from events where event_type = 'signup'), b as (select event_id b_id, ts t1 from events where event_type = 'error') " + NEAR.format(l="a_id", r="b_id", extra="", on="abs(epoch_us(t0) - epoch_us(t1)) <= 5400000000")),
    "ema_fold": (ema_fold, """with s as (select user_id, (user_id % 7)::double v, (user_id % 3)::bigint n from (select distinct user_id from events) where user_id % 2 = 0),
        f as (select user_id, list_reduce(list_prepend(coalesce(s.v, 0.0::double), list(value order by ts, event_id)), lambda a, x: 0.8::double * a + 0.2::double * x) x, count(*) + coalesce(s.n, 0) samples from events left join s using (user_id) group by user_id, s.v, s.n)
        select user_id, round_even(x * 1000.0::double, 0) / 1000.0::double bias, samples from f"""),
    "robust_scores": (robust_scores, """with e as (select user_id % 5 grp, event_type provider, ts, event_id, floor(value % 4)::double error from events),
        r as (select *, row_number() over (partition by grp, provider order by ts desc, event_id desc) k from e),
        s as (select grp, provider, 0.15::double * (sum(error) / count(*)) + 0.85::double as score, count(*) sample_count, least(count(*), 48)::int n_history, median(error) filter (k <= 48) m from r group by all),
        f as (select *, greatest(exp(-(0.5::double * score + 0.5::double * m)), 0.01::double) f from s),
        w as (select *, greatest(f / sum(f) over (partition by grp), 0.02::double) w from f)
        select grp, provider, round(score, 6) score, sample_count, n_history, round(w / sum(w) over (partition by grp), 6) weight from w"""),
    "state_full_outer_merge": (state_full_outer_merge, "with a as (select user_id, event_type, count(*) n from events where ts < '2024-01-16' group by all), b as (select user_id, event_type, count(*) n from events where ts >= '2024-01-16' group by all) select coalesce(a.user_id, b.user_id) user_id, coalesce(a.event_type, b.event_type) event_type, coalesce(b.n, a.n) n from a full join b on a.user_id = b.user_id and a.event_type = b.event_type"),
    "grouped_errors_grouping_sets": (grouped_errors_grouping_sets, "select coalesce(l_returnflag, '*') region, coalesce(l_linestatus, '*') bucket, l_suppkey provider, count(*) n, min(l_quantity) least, max(l_quantity) most from lineitem group by grouping sets ((l_returnflag, l_linestatus, l_suppkey), (l_suppkey))"),
    "holdout_split": (holdout_split, "select s_suppkey, ('0x' || substr(sha256(s_name), 1, 2))::int < 26 as holdout from supplier"),
    "lead_bucket": (lead_bucket, "select l_orderkey, l_linenumber, case when l_orderkey % 11 = 0 or l_orderkey % 240 <= 24 then '0-24' when l_orderkey % 240 <= 72 then '25-72' when l_orderkey % 240 <= 168 then '73-168' else '169+' end as bucket from lineitem"),
    "region_key": (region_key, "select c_custkey, printf('%+03d_%+04d', least(greatest(floor((c_custkey % 181) / 20.0)::int * 20, 0), 160) - 90, least(greatest(floor((c_custkey * 7 % 360) / 20.0)::int * 20, 0), 340) - 180) as region from customer"),
    "tile_pack_keys": (tile_pack_keys, """with p as (select c_custkey, (c_custkey % 181 - 90) lat, (c_custkey * 7 % 360 - 180) lon from customer), q as (select *, least(greatest(floor((lat + 90) / 20.0)::int * 20 - 90, -90), 70) s, least(greatest(floor((lon + 180) / 20.0)::int * 20 - 180, -180), 160) w from p)
        select c_custkey, (case when s >= 0 then 'N' else 'S' end) || abs(s)::varchar || '_' || (case when w >= 0 then 'E' else 'W' end) || abs(w)::varchar as tile, least(greatest(floor(lat / 60.0)::int * 60, -90), 60) pack_lat, least(greatest(floor((lon + 120) / 80.0)::int * 80 - 120, -180), 120) pack_lon from q"""),
    "station_errors": (station_errors, f"with {ERRORS} select station, provider, region, bucket, holdout, error from e"),
    "provider_skill": (provider_skill, f"""with {ERRORS}, s as (select region, bucket, provider, station, error from e where not holdout union all select '*', '*', provider, station, error from e where not holdout),
        r as (select *, row_number() over (partition by region, bucket, provider order by station desc) k from s),
        o as (select region, bucket, provider, coalesce(avg(error), 0) m, count(*) n, list(error order by station) filter (k <= 48) h from r group by all),
        j as (select *, region = '*' and provider = 'click' as has from o),
        g as (select region, bucket, provider, 0.15::double * m + 0.85::double * case when has then 2.0::double else 1.0::double end score, n + case when has then 3 else 0 end sample_count, list_slice(case when has then list_concat([1.0::double, 3.0::double], h) else h end, -48, -1) h from j),
        x as (select *, greatest(exp(-(0.5::double * score + 0.5::double * list_aggregate(h, 'median'))), 0.01::double) f from g), w as (select *, greatest(f / sum(f) over (partition by region, bucket), 0.02::double) w from x)
        select region, bucket, provider, round(score, 6) score, sample_count, len(h)::int n_history, round(w / sum(w) over (partition by region, bucket), 6) weight from w"""),
    "provider_bias": (provider_bias, f"""with {ERRORS}, b as (select region, station, t0, ot - median(ft) x, (hour(t0) + lon / 15.0::double) h from e where not holdout group by region, station, t0, lon, ot having count(*) >= 2),
        p as (select region, station, t0, x, case when fmod(h + 48, 24.0::double) >= 21 or fmod(h + 48, 24.0::double) < 6 then 'night' else 'day' end period from b),
        k as (select region, period, list(x order by station, t0) xs from p group by all), o as (select '+10_+000' region, 'day' period, 1.5::double v, 4 n),
        u as (select coalesce(k.region, o.region) region, coalesce(k.period, o.period) period, list_reduce(list_prepend(coalesce(v, 0.0::double), coalesce(xs, []::double[])), lambda a, y: 0.8::double * a + 0.2::double * y) v, coalesce(n, 0) + len(coalesce(xs, []::double[])) n from k full join o on k.region = o.region and k.period = o.period),
        q as (select distinct region from (select region from e where not holdout union all select region from u))
        select q.region, d.period, coalesce(round_even(v * 1000.0::double, 0) / 1000.0::double, 0.0::double) as "value", coalesce(n, 0)::bigint samples from q cross join (values ('day'), ('night')) d(period) left join u on u.region = q.region and u.period = d.period"""),
    "provider_validation": (provider_validation, f"""with {ERRORS}, c as (select station, region, list(distinct bucket) bs, (abs(median(ft) - ot) / 2.0::double + ((median(fp) >= 0.05) <> (op >= 0.1))::int) / 2.0::double error from e where holdout group by station, region, t0, ot, op having count(*) >= 2),
        a as (select region, bucket, provider, error from e where holdout union all select region, unnest(bs), 'consensus', error from c) select region, bucket, provider, round_even(avg(error) * 10000.0::double, 0) / 10000.0::double mae from a group by all"""),
    "validated_hours": (validated_hours, """with a as (select event_id a_id, ts t0, event_id % 5 / 4.0::double p, floor(value % 30) ft, floor(value % 50) fw, event_id % 16 fc from events where event_type = 'signup'),
        b as (select event_id b_id, ts t1, case when event_id % 3 > 0 then event_id % 4 / 10.0::double end op, floor(value % 30) ot, floor(value % 50) ow, event_id % 16 oc from events where event_type = 'error'),
        n as (select *, row_number() over (partition by a_id order by abs(epoch_us(t0) - epoch_us(t1)), b_id) k from a join b on abs(epoch_us(t0) - epoch_us(t1)) <= 5400000000)
        select count(*) matched_hours, round(avg(abs(ft - ot)), 9) temperature_mae_c, round(avg(ft - ot), 9) temperature_bias_c, round(avg(abs(fw - ow)), 9) wind_mae_kmh, round(avg(fw - ow), 9) wind_bias_kmh, round(avg(pow(p - (op >= 0.1)::int, 2)), 9) rain_brier_score, round(avg((fc = oc)::int), 9) condition_accuracy from n where k = 1"""),
    "latest_per_key": (latest_per_key, "select user_id, event_id, ts, event_type, value from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) k from events) where k = 1"),
    "validation_metrics": (validation_metrics, "select lang, round(avg(abs(quality - toxic)), 9) mae, round(avg(quality - toxic), 9) bias, round(avg(pow((n_chars % 5) / 4.0::double - toxic, 2)), 9) brier, round(avg((quality = toxic)::int), 9) accuracy, count(*) n from labels join documents using (doc_id) group by lang"),
    "regional_weights": (regional_weights, """with s as (select s_suppkey % 7 region, s_suppkey % 4 provider, s_acctbal weight from supplier), r as (select region, provider, max(weight) weight from s group by all), g as (select provider, min(weight) weight from s group by 1)
        select c_custkey, case when c_custkey % 12 in (select region from r) then r.weight else g.weight end weight from customer left join r on r.region = c_custkey % 12 and r.provider = c_custkey % 5 left join g on g.provider = c_custkey % 5"""),
    "forecast_errors": (forecast_errors, "select l_orderkey, l_linenumber, round((abs(l_quantity - 25.0::double) / 2.0::double + case when l_linenumber > 3 then abs(l_quantity * 2 - 40.0::double) / 10.0::double else 0 end + ((l_discount >= 0.05) <> (l_tax >= 0.1))::int) / (2 + (l_linenumber > 3)::int), 9) error from lineitem"),
}
