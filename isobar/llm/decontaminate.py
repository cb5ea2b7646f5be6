"""Benchmark decontamination by templates: numbers, units and names become typed placeholders, and windows of the template
are joined by hash, so a question whose parameters were changed is still found; the values in its slots must fit together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import join_counted, written
from .hashed import mix, pieces, window_hashes

WINDOW = 5
#: A window with fewer words of its own says little; it is not looked for.
LITERALS = 2
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs ms hz khz mhz w kw v a k c f pa hpa kpa bar j kj mph kmh km/h m/s usd eur gbp percent degrees meters metres kilometers grams kilograms liters litres seconds minutes hours days weeks months years dollars euros pounds cents".split())
_STRIP = "\"'`.,;:!?()[]{}<>«»“”‘’…*#$%&|-–—"
_NUMBER, _UNIT, _NAME = 1, 2, 3
_PLACE = mix(np.arange(1, 4, dtype=np.uint64))
_VOCABULARY = 500_000


class Vocabulary(dict):
    """A number for each word, and by number what the template needs to know of it."""

    def __init__(self) -> None:
        self.words: list[str] = []
        self.hash: list[int] = []
        self.flags: list[int] = []  # 1 number, 2 unit, 4 capital, 8 ends a sentence, 16 nothing but punctuation

    def __missing__(self, word: str) -> int:
        bare = word.strip(_STRIP)
        flags = (any(c.isdigit() for c in bare) * 1) | ((bare.lower() in UNITS) * 2) | ((bare[:1].isupper() and not bare.isupper()) * 4) | ((word.rstrip("\"'”’)")[-1:] in ".!?:") * 8) | ((not bare) * 16)
        self.words.append(bare.lower())
        self.hash.append(xxhash.xxh64_intdigest(bare.lower().encode(), 7))
        self.flags.append(flags)
        self[word] = n = len(self.words) - 1
        return n


def template(texts: list[str | None], known: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' words with more than punctuation, one after the other: hash in the template, slot kind (0: none), number
    in known; and the borders of the texts."""
    ids: list[int] = []
    starts: list[int] = []
    borders = [0]
    for text in texts:
        for line in (text or "").split("\n"):
            starts.append(len(ids))
            ids += map(known.__getitem__, line.split())
        borders.append(len(ids))
    number = np.array(ids, np.int64)
    flags = np.array(known.flags, np.uint8)[number] if len(ids) else np.zeros(0, np.uint8)
    first = np.zeros(len(ids) + 1, bool)
    first[starts] = True
    first = first[:-1]
    first[1:] |= (flags[:-1] & 8) > 0
    is_number = (flags & 1) > 0
    unit = (flags & 2) > 0
    unit[1:] &= is_number[:-1]
    unit[:1] = False
    kind = np.where(is_number, _NUMBER, np.where(unit, _UNIT, np.where(((flags & 4) > 0) & ~first, _NAME, 0)))
    hashes = np.array(known.hash, np.uint64)[number] if len(ids) else np.zeros(0, np.uint64)
    hashes = np.where(kind > 0, _PLACE[kind - 1], hashes)
    full = (flags & 16) == 0
    kept = np.concatenate([[0], np.cumsum(full)])[borders]
    return hashes[full], kind[full], number[full], kept


def window_rows(docs: DataFrame, key: str, sieve: np.ndarray | None, spark_key: str) -> DataFrame:
    """(spark_key, at, window, slots): template windows of the text column; with a sieve only those whose bit is set."""
    seen = docs.sparkSession.sparkContext.broadcast(sieve) if sieve is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary()
        for b in batches:
            for start, end in pieces(b.column(1)):
                part = b.slice(start, end - start)
                if len(known) > _VOCABULARY:
                    known = Vocabulary()
                hashes, kind, number, borders = template(part.column(1).to_pylist(), known)
                windows = window_hashes(hashes, WINDOW)
                text = np.repeat(np.arange(part.num_rows), np.diff(borders))[: len(windows)]
                literal = np.concatenate([[0], np.cumsum(kind == 0)])
                good = (np.arange(len(windows)) + WINDOW <= borders[text + 1]) & (literal[WINDOW:] - literal[: len(windows)] >= LITERALS) if len(windows) else np.zeros(0, bool)
                if seen is not None and len(windows):
                    cell = windows & np.uint64(8 * len(seen.value) - 1)
                    good &= (seen.value[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1
                hit = np.flatnonzero(good)
                slots = [[known.words[number[i]] for i in range(at, at + WINDOW) if kind[i]] for at in hit.tolist()]
                cols = [part.column(0).take(pa.array(text[hit])), pa.array(hit - borders[text[hit]], pa.int64()), pa.array(windows[hit].view(np.int64)), pa.array(slots, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, names=[spark_key, "at", "window", "slots"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias(spark_key), "text").mapInArrow(run, f"{spark_key} {kind}, at bigint, window bigint, slots array<string>")


def sieve_of(windows: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the cells (window mod bits) of all windows: blocks of it are made in tasks, the driver puts them together."""
    block = max(bits >> 10, 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, np.zeros(block, bool)
        for b in batches:
            for k, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if key is not None and k != key:
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()])], names=["block", "bits"])
                    held = np.zeros(block, bool)
                key = k
                held[cells] = True
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([np.packbits(held, bitorder="little").tobytes()])], names=["block", "bits"])

    cell = F.col("window").bitwiseAND(bits - 1)
    cells = windows.select(F.floor(cell / block).cast("int").alias("block"), (cell % block).cast("int").alias("cell")).distinct()
    lists = cells.groupBy("block").agg(F.collect_list("cell").alias("cells"))  # block cells at most
    out = np.zeros((bits // block, block // 8), np.uint8)
    for row in lists.mapInArrow(fill, "block int, bits binary").toLocalIterator():
        out[row["block"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def agreeing(rows: Column) -> Column:
    """Of an alignment's windows (place, pairs of the item's and the document's slot values) those whose pairs all follow the
    mapping that most pairs give: one value in the item is one value in the document."""
    pairs = F.flatten(F.transform(rows, lambda r: r["pairs"]))

    def best(v: Column, every: Column) -> Column:
        own = F.filter(every, lambda p: p["values"] == v)
        counted = F.transform(F.array_distinct(own), lambda q: F.struct(F.size(F.filter(own, lambda p: p == q)).alias("n"), q["slots"].alias("slots")))
        return F.array_max(counted)["slots"]

    def kept(every: Column) -> Column:
        names = F.array_distinct(F.transform(every, lambda p: p["values"]))
        mapping = F.map_from_entries(F.transform(names, lambda v: F.struct(v, best(v, every))))
        return F.get(F.transform(F.array(mapping), lambda m: F.filter(rows, lambda r: F.forall(r["pairs"], lambda p: F.try_element_at(m, p["values"]) == p["slots"]))), F.lit(0))

    return F.get(F.transform(F.array(pairs), kept), F.lit(0))


def leading(own: DataFrame, sizes: DataFrame, least: float) -> DataFrame:
    """(item_id, window): the n - ceil(least * n) + 1 places of each item's n whose windows are in the fewest items.

    A document that matches least * n places or more matches one of these, so items that share windows (typed placeholders
    make them common) are looked for by what is theirs.
    """
    spread = written(own.groupBy("window").agg(F.count(F.lit(1)).alias("_k")).withColumn("k", F.col("_k")))
    ranked = join_counted(own.select("item_id", "at", "window"), spread, ["window"], "_k", own.count())
    ranked = ranked.withColumn("_r", F.row_number().over(Window.partitionBy("item_id").orderBy("k", "window", "at")))  # an item's places
    needed = F.greatest(F.ceil(F.col("n_windows") * least - 1e-9), F.lit(1))
    return ranked.join(sizes, "item_id").filter(F.col("_r") <= F.col("n_windows") - needed + 1).select("item_id", "window")


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.4, sieve_bits: int = 1 << 23) -> DataFrame:
    """doc_id, item_id, n_matched, n_windows, coverage and verbatim for each document and item that it holds.

    docs has doc_id and text, benchmark has item_id and text; other columns are ignored. n_windows is the number of different
    places of template windows in the item, n_matched those found in the document. In an alignment (windows at one distance)
    the same value in the item must be the same value in the document: most pairs decide which, and windows that hold
    another one don't count. Items are found at a coverage of least or more. verbatim: all matched slots hold the item's own
    values. Null and short texts (under five words, or under two of its own in any window) hold and match nothing; repeated
    rows of one id are one document; rows with a null id match nothing. What is broadcast is a bitmap of sieve_bits, whatever
    the benchmark's size; beyond that size it lets more windows through to the join, which compares all 64 bits. Documents meet
    items by the items' leading windows only, which lose none at the coverage asked for; then all windows of the two are
    compared. A window that very many documents hold is joined where they lie.
    """
    own = written(window_rows(benchmark.filter("item_id is not null"), "item_id", None, "item_id").dropDuplicates(["item_id", "at"]))
    sizes = own.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_windows"))
    hits = written(window_rows(docs.filter("doc_id is not null"), "doc_id", sieve_of(own.select("window"), sieve_bits), "doc_id"))
    total = hits.count()
    lead = leading(own, sizes, least).groupBy("window").agg(F.collect_set("item_id").alias("items"))
    counted = written(hits.groupBy("window").agg(F.count(F.lit(1)).alias("_n")).join(lead, "window"))
    asked = written(join_counted(hits.select("doc_id", "window"), counted, ["window"], "_n", total).select("doc_id", F.explode("items").alias("item_id")).distinct())
    whole = own.groupBy("item_id").agg(F.collect_list(F.struct("window", F.col("at").alias("place"), F.col("slots").alias("values"))).alias("own"))
    whole = written(whole.join(asked.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")), "item_id"))
    sought = join_counted(asked, whole, ["item_id"], "_n", asked.count()).select("doc_id", "item_id", F.inline("own"))
    pairs = hits.join(sought, ["doc_id", "window"]).select("doc_id", "item_id", (F.col("at") - F.col("place")).alias("offset"), F.struct("place", F.arrays_zip("values", "slots").alias("pairs")).alias("r"))
    runs = pairs.groupBy("doc_id", "item_id", "offset").agg(F.collect_set("r").alias("rows"))
    runs = runs.withColumn("rows", agreeing(F.col("rows")))
    same = F.forall("rows", lambda r: F.forall(r["pairs"], lambda s: s["values"] == s["slots"]))
    told = runs.filter(F.size("rows") > 0).withColumns({"places": F.transform("rows", lambda r: r["place"]), "same": same})
    found = told.groupBy("doc_id", "item_id").agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_matched"), F.min("same").alias("verbatim"))
    found = found.join(sizes, "item_id").withColumn("coverage", F.col("n_matched") / F.col("n_windows"))
    return found.filter(F.col("coverage") >= least).select("doc_id", "item_id", "n_matched", "n_windows", "coverage", "verbatim")
