"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Only built-in DataFrame functions. The row number n of N rows gives perm(n) in [0, N); shard = perm(n) mod shards and
slot = perm(n) div shards, so both can be computed for any row number without the table, and shards differ by one row at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from .common import free_name

ROUNDS = 6
#: Rows of a bucket, about.
BUCKET_ROWS = 1 << 18


def row_numbers(df: DataFrame, out: str, total: str, buckets: int | None = None) -> DataFrame:
    """df with out, a number from 0 to total - 1 of its own for each row, and total, the count of rows.

    Rows go by 128 bits of hash of all their columns to buckets (by default one for BUCKET_ROWS rows, 4096 at least), are
    numbered within them in the order of the hashes, and start where the buckets before end. Nothing depends on partitions or
    on the order of input, so tasks that run again give the same numbers. Rows alike in all columns are counted first and
    written out again after the numbering, so a row that makes up a third of the table is one row in its bucket. Numbers are
    made from hashes and counts alone; whole rows are shuffled once, to meet theirs. A row a bucket is broadcast. Columns must
    be of types that can be grouped (no maps) and may have any names.
    """
    if buckets is None:
        buckets = max(4096, df.count() // BUCKET_ROWS)
    one, two, copies, bucket, size, start, first, k = (free_name(df, f"_{n}") for n in ("one", "two", "copies", "bucket", "size", "start", "first", "k"))
    quoted = [F.col(f"`{c}`") for c in df.columns]
    # a hash passes over nulls, in a column and inside arrays and structs
    whole = [F.to_json(F.struct(c), {"ignoreNullFields": "false"}) if isinstance(f.dataType, (ArrayType, StructType)) else c for c, f in zip(quoted, df.schema, strict=True)]
    hashed = lambda seed: F.xxhash64(F.lit(seed), *[c.isNull() for c in quoted], *whole)
    keyed = df.withColumns({one: hashed(1), two: hashed(2)})
    counts = keyed.groupBy(one, two).agg(F.count(F.lit(1)).alias(copies)).withColumn(bucket, F.pmod(F.col(one), F.lit(buckets)).cast("int"))
    sizes = counts.groupBy(bucket).agg(F.sum(copies).alias(size))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    starts = sizes.select(bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(start), F.sum(size).over(every).alias(total))
    inside = Window.partitionBy(bucket).orderBy(one, two).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn(first, F.coalesce(F.sum(copies).over(inside), F.lit(0))).join(F.broadcast(starts), bucket).select(one, two, copies, (F.col(start) + F.col(first)).alias(start), total)
    once = keyed.groupBy(one, two).agg(*[F.first(c).alias(n) for c, n in zip(quoted, df.columns, strict=True)])
    rows = once.join(placed, [one, two]).select(*quoted, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)).alias(k), start, total)
    return rows.select(*quoted, (F.col(start) + F.col(k)).alias(out), total)


def feistel(x: Column, bits: Column, seed: int) -> Column:
    """A permutation of [0, 2**bits): rounds on two halves whose widths trade places, the round function being XXH64."""
    low = F.floor(bits / 2).cast("int")
    ones = lambda w: F.pow(F.lit(2.0), w).cast("long") - 1
    start = F.struct(
        F.floor(x / F.pow(F.lit(2.0), low)).cast("long").alias("l"),
        x.bitwiseAND(ones(low)).alias("r"),
        (bits - low).alias("lw"),
        low.alias("rw"),
    )

    def step(s: Column, i: Column) -> Column:
        f = F.xxhash64(s["r"], i, F.lit(seed)).bitwiseAND(ones(s["lw"]))
        return F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(f).alias("r"), s["rw"].alias("lw"), s["lw"].alias("rw"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: (s["l"] * F.pow(F.lit(2.0), s["rw"]).cast("long") + s["r"]).cast("long"))


def permuted(row: Column, total: Column, seed: int, walk: int = 256) -> Column:
    """The place of row number row in a permutation of [0, total).

    The domain is the next power of two, so each step of the walk lands inside with odds of at least a half; a walk of over
    `walk` steps (odds under 2**-256 a row) raises an error instead of giving a wrong place.
    """
    bits = F.greatest(F.length(F.bin(total - 1)), F.lit(2)).cast("int")
    first = feistel(row, bits, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(walk)), F.struct(first.alias("x")), lambda s, _: F.when(s["x"] < total, s).otherwise(F.struct(feistel(s["x"], bits, seed).alias("x"))), lambda s: s["x"]
    )
    return F.when(walked < total, walked).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long"))


def shard_rows(df: DataFrame, shards: int = 24, *, seed: int = 2024, buckets: int | None = None) -> DataFrame:
    """df with row_number, n_rows, perm, shard and slot (law `rows`: the counts of shards differ by one at most).

    Every row gets a place, null or not; rows alike in all columns get places of their own. An empty table gives no rows.
    Columns of df that have one of these names are kept, with an underscore before the new column's name.
    """
    names = {k: free_name(df, k) for k in ("row_number", "n_rows", "perm", "shard", "slot")}
    df = row_numbers(df, names["row_number"], names["n_rows"], buckets)
    df = df.withColumn(names["perm"], permuted(F.col(names["row_number"]), F.col(names["n_rows"]), seed))
    p = F.col(names["perm"])
    return df.withColumn(names["shard"], F.pmod(p, F.lit(shards)).cast("int")).withColumn(names["slot"], F.floor(p / shards).cast("long"))
