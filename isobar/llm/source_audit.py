"""Divergence of sources: which terms a source overuses, and how far its terms lie from those of each other source.

Terms are counted once per (language, source, term), already summed in each task. All arithmetic is on whole numbers.
The value of a pair of sources sums over all kept terms, but most terms occur in neither: every term gives the value of two
counts of zero (the baseline), and only terms that occur in one or both correct it. Terms of one are taken by their different
counts, terms of both by blocks of sources, so no row per pair and term is made.

The ranking of terms finds each group's kth value by radix selection: histograms of the values' leading bits tell the
bucket with the kth, the next bits are looked at in that bucket only, and rows with the very kth value are told apart by
their UTF-8 bytes in the same way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written
from .hashed import pieces

#: Bytes of terms stay (A-Z lower-cased), others become blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Different terms that a task keeps before it hands its counts on.
HELD = 400_000
#: Sources that are compared with as many others at once.
BLOCK = 64
#: Bits of a value that one histogram looks at, and bits that values have at most.
DIGIT, BITS = 16, 32
GROUP = ["lang", "source"]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) of docs (lang, source, text; no nulls): occurrences, and rows that hold the term."""

    def rows(held: dict) -> pa.RecordBatch:
        flat = [(lang, source, t, n, df[t]) for (lang, source), (total, df) in held.items() for t, n in total.items()]
        lang, source, term, n, df = zip(*flat, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(source), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(df, pa.int64())], names=["lang", "source", "term", "n", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for b in batches:
            for start, end in pieces(b.column(2)):
                part = b.slice(start, end - start)
                for lang, source, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2), strict=True):
                    if terms := text.as_buffer().to_pybytes().translate(_TERM_BYTES).split():
                        total, df = held.setdefault((lang, source), (Counter(), Counter()))
                        total.update(terms)
                        df.update(set(terms))
                if sum(len(total) for total, _ in held.values()) > HELD:
                    yield rows(held)
                    held = {}
        if held:
            yield rows(held)

    counted = docs.select(*GROUP, "text").mapInArrow(count, "lang string, source string, term string, n bigint, df bigint")
    return counted.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: str, total: str, v: str = "v") -> str:
    """SQL of 1 + floor(10^9 (n + 2) / (total + 2 v)), exact up to 10^18 occurrences; null if no term is kept."""
    return f"1 + (cast(1000000000 as decimal(10,0)) * cast({n} + 2 as decimal(20,0))) div nullif(cast({total} + 2 * {v} as decimal(20,0)), 0)"


def apart(p: str, q: str) -> str:
    """SQL of floor((p - q)^2 / (p + q)) of whole numbers from 1 to 10^9 + 1; at most |p - q|, so that sums over terms fit."""
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def radix_top(rows: DataFrame, group: list[str], value: str, item: str, k: int, bits: int = BITS) -> DataFrame:
    """Of each group the k rows with the largest values, equal ones by ascending UTF-8 bytes of item; rows must be written.

    Values are whole numbers from 0 below 2^bits; a group's items differ. A group of fewer than k rows keeps all. What a
    window sees of a group is a histogram: at most 2^DIGIT buckets for values; for bytes, those that equal values with
    equal bytes before have in two more bytes, then four, eight and so on, as items may share long beginnings.
    """
    by = Window.partitionBy(*group)
    state = None  # (group, _prefix, _left): the kth value's leading bits, and how many rows are to be found among those with them
    for shift in range(bits - DIGIT, -1, -DIGIT):
        digit = (F.shiftrightunsigned(value, shift) % (1 << DIGIT)).alias("_digit")
        if state is None:
            hist = rows.groupBy(*group, digit).agg(F.count(F.lit(1)).alias("_n")).withColumns({"_prefix": F.lit(0).cast("long"), "_left": F.lit(k).cast("long")})
        else:
            near = rows.join(state, group).filter(F.shiftrightunsigned(value, shift + DIGIT) == F.col("_prefix"))
            hist = near.groupBy(*group, "_prefix", "_left", digit).agg(F.count(F.lit(1)).alias("_n"))
        upto = hist.withColumn("_upto", F.sum("_n").over(by.orderBy(F.desc("_digit"))))
        kth = upto.filter("_upto >= _left and _upto - _n < _left")
        state = kth.select(*group, (F.col("_prefix") * (1 << DIGIT) + F.col("_digit")).alias("_prefix"), (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"), F.col("_n").alias("_ties"))
        if shift:
            state = state.drop("_ties")
    state = written(state)
    marked = rows.join(state, group, "left")
    found = marked.filter(f"_prefix is null or {value} > _prefix or ({value} = _prefix and _ties <= _left)").select(*rows.columns)
    open_ = state.filter("_ties > _left").select(*group, "_prefix", "_left")
    # bytes of the items that have the kth value: as long as a bucket holds more rows than are left to be found, look further
    ties = written(rows.join(open_, group).filter(F.col(value) == F.col("_prefix")).select(*rows.columns, "_left", F.encode(item, "UTF-8").alias("_rest")))
    width = 2
    while not ties.isEmpty():
        cut = ties.withColumns({"_digit": F.substring("_rest", 1, width), "_rest": F.expr(f"substring(_rest, {width + 1})")})
        hist = cut.groupBy(*group, "_left", "_digit").agg(F.count(F.lit(1)).alias("_n"))
        upto = hist.withColumn("_upto", F.sum("_n").over(by.orderBy("_digit")))
        kth = upto.filter("_upto >= _left and _upto - _n < _left").select(*group, F.col("_digit").alias("_at"), (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_more"), F.col("_n").alias("_ties"))
        marked = written(cut.join(kth, group).filter("_digit <= _at"))
        found = found.unionByName(marked.filter("_digit < _at or _ties <= _more").select(*rows.columns))
        last, ties = ties, written(marked.filter("_digit = _at and _ties > _more").select(*rows.columns, F.col("_more").alias("_left"), "_rest"))
        discard(last)
        width *= 2
    return found


def _packed(cells: DataFrame) -> DataFrame:
    """(lang, term, block, members): of each term up to BLOCK sources (their place in the block, share, and share of no occurrence)."""
    return cells.groupBy("lang", "term", (F.col("idx") / BLOCK).cast("int").alias("block")).agg(F.collect_list(F.struct((F.col("idx") % BLOCK).cast("int").alias("i"), "p", "p0")).alias("members"))


def _both(packed: DataFrame) -> DataFrame:
    """(lang, a, b, value): for sources a < b by their numbers, the correction of all terms that occur in both."""
    other = packed.select("lang", "term", F.col("block").alias("block_b"), F.col("members").alias("members_b"))
    pairs = packed.join(other, ["lang", "term"]).filter("block <= block_b").select("lang", "block", "block_b", "members", "members_b")

    def dense(members: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        flat = members.flatten()
        at = np.repeat(np.arange(len(members)), np.diff(members.offsets.to_numpy()))
        p, p0 = np.zeros((len(members), BLOCK), np.int64), np.zeros(BLOCK, np.int64)
        i = flat.field("i").to_numpy()
        p[at, i] = flat.field("p").to_numpy()
        p0[i] = flat.field("p0").to_numpy()
        return p, p0

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // np.maximum(p + q, 1)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).sort_by([("lang", "ascending"), ("block", "ascending"), ("block_b", "ascending")]).combine_chunks()
            keys = list(zip(t["lang"].to_pylist(), t["block"].to_pylist(), t["block_b"].to_pylist(), strict=True))
            borders = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
            out: list[tuple] = []
            for start, end in zip(borders[:-1], borders[1:], strict=True):
                part = t.slice(start, end - start).combine_chunks()
                (p, p0), (q, q0) = (dense(part[c].combine_chunks()) for c in ("members", "members_b"))
                lang, one, two = keys[start]
                for i in np.flatnonzero(p.any(0)):
                    x, x0 = p[:, i : i + 1], p0[i]
                    held = (x > 0) & (q > 0)
                    total = np.where(held, f(x, q) - f(x, q0) - f(x0, q) + f(x0, q0), 0).sum(0)
                    a = one * BLOCK + int(i)
                    out += [(lang, a, two * BLOCK + int(j), int(total[j])) for j in np.flatnonzero(total) if a < two * BLOCK + j]
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["lang", "a", "b", "value"])

    return pairs.mapInArrow(sums, "lang string, a int, b int, value bigint").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_audit(docs: DataFrame, least_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value and rank: of each (lang, source) all other sources of the language by divergence
    (part pair), and the `top` terms that it overuses most against its language (part term).

    docs has lang, source and text; nulls count as ''. A term is a run of letters of a-z, A-Z (lower-cased) and characters
    beyond ASCII; a language keeps those that at least least_docs of its rows hold. Rows are documents: repeated rows count
    again. A source without terms takes part with counts of zero; a language that keeps no term gives its pairs the value 0.
    One source of a language gives no pair; an empty table gives no row.
    """
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*GROUP, "text")])
    counts = written(term_counts(docs))
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("df").alias("df")).filter(F.col("df") >= least_docs).drop("df")
    kept = written(kept)
    cells = written(counts.join(kept, ["lang", "term"]).select(*GROUP, "term", "n", "n_lang"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    totals = cells.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    groups = docs.select(*GROUP).distinct().join(totals, GROUP, "left").join(langs, "lang", "left").na.fill(0, ["total", "v", "total_lang"])
    number = (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("idx")  # a row a source
    groups = written(groups.select(*GROUP, number, "total", "v", "total_lang", F.expr(share("0", "total")).alias("p0")))
    cells = written(cells.join(groups, GROUP).select(*GROUP, "idx", "term", "p0", F.expr(share("n", "total")).alias("p"), F.expr(share("n_lang", "total_lang")).alias("q")))

    # pairs: of the sources of a language, block by block
    others = groups.groupBy("lang", (F.col("idx") / BLOCK).cast("int").alias("block")).agg(F.collect_list(F.struct(F.col("source").alias("item"), F.col("p0").alias("q0"))).alias("others"))
    blocks = groups.groupBy("lang").agg(F.max("idx").alias("last"))

    def with_others(rows: DataFrame) -> DataFrame:
        dealt = rows.join(blocks, "lang").select(*rows.columns, F.explode(F.sequence(F.lit(0), (F.col("last") / BLOCK).cast("int"))).alias("block"))
        return dealt.join(others, ["lang", "block"]).select(*rows.columns, F.inline("others")).filter("source <> item")

    base = with_others(groups.select(*GROUP, "v", "p0")).select(*GROUP, "item", F.expr(f"coalesce(v * ({apart('p0', 'q0')}), 0)").alias("value"))
    one = with_others(cells.groupBy(*GROUP, "p0", "p").agg(F.count(F.lit(1)).alias("m")))
    one = one.groupBy(*GROUP, "item").agg(F.sum(F.expr(f"m * ({apart('p', 'q0')} - {apart('p0', 'q0')})")).alias("value"))
    names = groups.select("lang", "idx", "source")
    both = _both(_packed(cells))
    both = both.join(names.withColumnRenamed("idx", "a"), ["lang", "a"]).join(names.select("lang", F.col("idx").alias("b"), F.col("source").alias("item")), ["lang", "b"]).select(*GROUP, "item", "value")
    swapped = lambda df: df.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pairs = base.unionByName(one).unionByName(swapped(one)).unionByName(both).unionByName(swapped(both)).groupBy(*GROUP, "item").agg(F.sum("value").alias("value"))

    terms = written(cells.filter("p > q").select(*GROUP, F.col("term").alias("item"), F.expr(apart("p", "q")).alias("value")))
    best = radix_top(terms, GROUP, "value", "item", top)
    found = pairs.withColumn("part", F.lit("pair")).unionByName(best.withColumn("part", F.lit("term")))
    rank = F.row_number().over(Window.partitionBy(*GROUP, "part").orderBy(F.desc("value"), "item"))
    return found.select(*GROUP, "part", "item", "value", rank.alias("rank"))
