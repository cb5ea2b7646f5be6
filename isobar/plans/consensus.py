"""Consensus queries. Models are suppliers, their families regions, cells parts, values prices and skills quantities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import conditions
from ..operators import consensus as C


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def models(spark: SparkSession, d: str) -> DataFrame:
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    suppliers = t(spark, d, "supplier").select("s_suppkey", "s_nationkey").join(t(spark, d, "nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "n_regionkey")


MODELS = "select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, n_regionkey from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"


def median_sql(src: str, by: str, value: str, weight: str, out: str) -> str:
    return f"""select {by}, min(v) filter (w > 0 and 2 * c >= s) as {out} from (select {by}, v, w, sum(w) over (partition by {by} order by v) c, sum(w) over (partition by {by}) s
        from (select {by}, {value} v, sum({weight}) w from {src} group by all)) group by {by}"""


def weighted_median_consensus(spark, d):
    return C.weighted_median(t(spark, d, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity"), ["l_partkey"], "l_extendedprice", "l_quantity", "consensus")


def family_balanced_weights(spark, d):
    out = C.family_balanced(models(spark, d), ["l_partkey"], "n_regionkey", "l_quantity", "weight")
    return out.select("l_orderkey", "l_linenumber", "weight")


#: Rows that a task of the consensus takes, about: its sorts and sums hold some 1,400 bytes for each.
ROWS_A_TASK = 250_000


def family_balanced_consensus(spark, d):
    """Exact decimal weights, so that sums don't depend on their order. Parts are dealt once, to as many tasks as rows need."""
    tasks = max(t(spark, d, "lineitem").count() // ROWS_A_TASK + 1, spark.sparkContext.defaultParallelism)
    cells = models(spark, d).repartition(tasks, "l_partkey")
    rows = C.family_balanced(C.several_families(cells, ["l_partkey"], "n_regionkey"), ["l_partkey"], "n_regionkey", "l_quantity", "w")
    rows = rows.withColumn("w", F.round("w", 6).cast("decimal(18,6)"))
    figures = rows.groupBy("l_partkey").agg(F.max("n_families").alias("n_families"), F.count_distinct("l_suppkey").alias("n_models"), (F.max("l_extendedprice") - F.min("l_extendedprice")).alias("spread"))
    return C.weighted_median(rows, ["l_partkey"], "l_extendedprice", "w", "consensus").join(figures, "l_partkey")


CONSENSUS_SQL = f"""with m as ({MODELS}), g as (select l_partkey, count(distinct n_regionkey) n_families from m group by 1 having count(distinct n_regionkey) >= 2),
    r as (select m.*, n_families, cast(round(greatest(l_quantity, 0.01) / count(*) over (partition by l_partkey, n_regionkey), 6) as decimal(18,6)) wt from m join g using (l_partkey)),
    f as (select l_partkey, max(n_families) n_families, count(distinct l_suppkey) n_models, max(l_extendedprice) - min(l_extendedprice) spread from r group by 1)
    select x.*, n_families, n_models, spread from ({median_sql("r", "l_partkey", "l_extendedprice", "wt", "consensus")}) x join f using (l_partkey)"""


def consensus_min_families(spark, d):
    return C.several_families(models(spark, d), ["l_partkey"], "n_regionkey", 4).select("l_orderkey", "l_linenumber", "l_partkey", "n_families")


def _votes(spark, d):
    return t(spark, d, "events").select("user_id", (F.col("event_id") % 16).cast("int").alias("code"), (F.col("event_id") % 7 + 1).alias("weight"))


VOTES = "select user_id, cast(event_id % 16 as int) code, event_id % 7 + 1 weight from events"


def weighted_vote_ties(spark, d):
    return C.weighted_vote(_votes(spark, d), ["user_id"], "code", "weight", "winner")


def two_level_vote(spark, d):
    rows = _votes(spark, d).withColumn("family", conditions.family(F.col("code")))
    return C.two_level_vote(rows, ["user_id"], "code", "family", "weight", "winner")


FAMILY_SQL = "case " + " ".join(f"when code = {k} then {v}" for k, v in conditions.FAMILIES.items()) + " end"


def wet_probability(spark, d):
    return C.wet_statistics(t(spark, d, "lineitem").select("l_partkey", "l_discount", "l_quantity"), ["l_partkey"], "l_discount", "l_quantity")


def spread_confidence(spark, d):
    rows = models(spark, d).groupBy("l_partkey").agg((F.max("l_quantity") - F.min("l_quantity")).alias("spread"), F.count_distinct("n_regionkey").alias("families"))
    return rows.select("l_partkey", "spread", "families", C.confidence(F.col("spread"), F.col("families"), "wind_gust").alias("confidence"))


def bias_clamped_consensus(spark, d):
    rows = t(spark, d, "lineitem").groupBy("l_partkey").agg(F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"), F.max_by("l_quantity", F.struct("l_extendedprice", "l_quantity")).alias("value"), F.count(F.lit(1)).alias("n"))
    bias = (F.col("l_partkey") % 21 - 10).cast("double")
    return rows.select("l_partkey", C.clamped_bias(F.col("value"), bias, F.col("n"), F.col("low"), F.col("high")).alias("consensus"))


PLANS = {
    "weighted_median_consensus": (weighted_median_consensus, median_sql("lineitem", "l_partkey", "l_extendedprice", "l_quantity", "consensus")),
    "family_balanced_weights": (family_balanced_weights, f"select l_orderkey, l_linenumber, greatest(l_quantity, 0.01::double) / count(*) over (partition by l_partkey, n_regionkey) as weight from ({MODELS})"),
    "family_balanced_consensus": (family_balanced_consensus, CONSENSUS_SQL),
    "consensus_min_families": (consensus_min_families, f"with m as ({MODELS}) select l_orderkey, l_linenumber, l_partkey, n_families from m join (select l_partkey, count(distinct n_regionkey) n_families from m group by 1) using (l_partkey) where n_families >= 4"),
    "weighted_vote_ties": (weighted_vote_ties, f"select user_id, arg_max(code, {{'w': w, 'c': code}}) winner from (select user_id, code, sum(weight)::bigint w from ({VOTES}) group by all) group by 1"),
    "two_level_vote": (two_level_vote, f"""with c as (select user_id, code, {FAMILY_SQL} fam, sum(weight)::bigint w from ({VOTES}) group by all), f as (select user_id, fam, sum(w)::bigint fw, arg_max(code, {{'w': w, 'c': code}}) code from c group by all)
        select user_id, arg_max(code, {{'w': fw, 'f': fam}}) winner from f group by 1"""),
    "wet_probability": (wet_probability, f"""with p as (select l_partkey, coalesce(sum(case when l_discount >= 0.05 then l_quantity else 0 end) / sum(l_quantity), 0) wet_probability from lineitem group by 1)
        select p.l_partkey, wet_probability, case when wet_probability >= 0.5 then coalesce(m, 0.0::double) else 0.0::double end amount from p left join ({median_sql("(select * from lineitem where l_discount >= 0.05)", "l_partkey", "l_discount", "l_quantity", "m")}) using (l_partkey)"""),
    "spread_confidence": (spread_confidence, f"""select l_partkey, spread, families, (1 - least(greatest(spread / 15.0::double, 0), 1)) * least(families / 3.0::double, 1.0::double) as confidence from (select l_partkey, max(l_quantity) - min(l_quantity) spread, count(distinct n_regionkey) families from ({MODELS}) group by 1)"""),
    "bias_clamped_consensus": (bias_clamped_consensus, """select l_partkey, least(greatest(v + case when n >= 3 then (l_partkey % 21 - 10)::double else 0 end, low), high) as consensus from
        (select l_partkey, min(l_quantity) low, max(l_quantity) high, arg_max(l_quantity, {'p': l_extendedprice, 'q': l_quantity}) v, count(*) n from lineitem group by 1)"""),
}
