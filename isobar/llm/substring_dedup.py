"""Substring deduplication: words covered by a window of 50 words that also starts in a document with a smaller id go.

A window's anchor is the 10-word run with the least hash inside it, the first of equals; equal windows have equal anchors at
equal places. Neighbouring windows with one anchor make up a segment (about 20 windows), so segments and anchors are far
fewer than windows.

1. Count-min prefilter: each task counts the anchors of its documents (a document counts an anchor once) in a sketch of two
   rows of saturating counters; sketches merge cell by cell, a block of cells in a task. An anchor's estimate is never below
   the number of documents that hold any window it anchors, so windows in two documents are never lost. The sketch has at
   least four cells for an anchor that there may be, up to MOST_BITS cells a row, which is what is broadcast; a corpus
   beyond that lets more through to the exact pass, which takes all of it.
2. Segments whose anchor is estimated to be in two documents are grouped exactly, by 128 bits of hash and their length.
   The first document of each different segment stands for all others. Where an anchor has several different segments, the
   windows of their first documents are grouped one by one, by 128 bits of hash (their own and their anchor's).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, written
from .hashed import mix, pieces, sliding_least, window_hashes, word_hashes

RUN = 10
ROWS = 2
#: Cells of a row of the sketch at least and at most (an eighth as many bytes are broadcast), and blocks it is merged in.
LEAST_BITS, MOST_BITS, BLOCKS = 1 << 20, 1 << 29, 1 << 12
#: Bytes of text for an anchor (about 160 in prose), and cells for an anchor.
BYTES_PER_ANCHOR, CELLS = 160, 4


class Segments:
    """The segments of the texts of one piece: index of the text, first window's word, windows, anchor and content hash."""

    def __init__(self, texts: pa.Array, size: int) -> None:
        words, borders = word_hashes(texts)
        self.size, self.words, self.borders = size, words, borders
        n, run = len(words) - size + 1, min(RUN, size)
        counts = np.diff(borders)
        if n <= 0 or counts.max(initial=0) < size:
            self.text = self.first = self.windows = np.zeros(0, np.int64)
            self.anchor = self.content = np.zeros(0, np.uint64)
            return
        runs = window_hashes(words, run)
        place = np.arange(len(runs), dtype=np.uint64)
        least = sliding_least((runs >> np.uint64(26) << np.uint64(26)) | (place & np.uint64((1 << 26) - 1)), size - run + 1)
        anchor = (least & np.uint64((1 << 26) - 1)).astype(np.int64)  # place within 2**26 words
        text = np.repeat(np.arange(len(counts)), counts)[:n]
        whole = np.arange(n) + size <= borders[text + 1]
        new = np.ones(n, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
        starts = np.flatnonzero(new & whole)
        ends = np.append(np.flatnonzero(new | ~whole), n)  # the first window that is no longer in the segment
        ends = ends[np.searchsorted(ends, starts, side="right")]
        self.text, self.first, self.windows = text[starts], starts, ends - starts
        at = starts + ((anchor[starts] - starts) & ((1 << 26) - 1))
        self.anchor = runs[at]
        # content: the words of the segment by Horner's rule, from sums over prefixes; odd multipliers have inverses
        power = np.cumprod(np.full(len(words), np.uint64(0xA24BAED4963EE407)))
        back = np.cumprod(np.full(len(words), np.uint64(pow(0xA24BAED4963EE407, -1, 1 << 64))))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words + np.uint64(1)) * power)])
        self.content = mix((sums[ends + size - 1] - sums[starts]) * back[starts])

    def window_lists(self, chosen: np.ndarray) -> list[np.ndarray]:
        every = window_hashes(self.words, self.size).view(np.int64)
        return [every[a : a + n] for a, n in zip(self.first[chosen].tolist(), self.windows[chosen].tolist(), strict=True)]


def _cells(anchor: np.ndarray, bits: int) -> list[np.ndarray]:
    """The cell of each anchor in each row of the sketch."""
    low = np.uint64(bits - 1)
    return [mix(anchor + np.uint64(0x51ED270B * (r + 1))) & low for r in range(ROWS)]


def cells_for(n: int) -> int:
    """Cells of a row of a sketch for n numbers: a power of two with CELLS for each, within the least and the most."""
    return min(max(LEAST_BITS, 1 << (CELLS * n - 1).bit_length() if n else LEAST_BITS), MOST_BITS)


def sketch(docs: DataFrame, size: int, bits: int) -> list[np.ndarray]:
    """For each row of the sketch, a bitmap of the cells with a count of two or more (a bit each, bits cells)."""

    def anchors(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        for start, end in pieces(b.column(0)):
            s = Segments(b.column(0).slice(start, end - start), size)
            order = np.lexsort((s.anchor, s.text))
            text, anchor = s.text[order], s.anchor[order]
            single = np.ones(len(order), bool)
            single[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1])
            yield anchor[single]

    return repeated_cells(docs.select("text"), anchors, bits)


def repeated_cells(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int) -> list[np.ndarray]:
    """The bitmaps of sketch for the numbers that hashes gives for the batches of df.

    A task gives, for each row and block, the cells it counted once and those it counted more often; it holds what it counts
    since its last rows, never the whole sketch. Blocks merge by their numbers in their own tasks; the driver gets bits / 8
    bytes a row.
    """
    block = max(bits // BLOCKS, 8)

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        numbers = np.concatenate(held)
        if not len(numbers):
            return
        for r, cell in enumerate(_cells(numbers, bits)):
            cell, n = np.unique(cell, return_counts=True)
            of, first = np.unique(cell // np.uint64(block), return_index=True)
            offset = (cell % np.uint64(block)).astype(np.uint32)
            once, twice = [], []
            for a, z in zip(first.tolist(), [*first[1:].tolist(), len(cell)], strict=True):
                single = n[a:z] == 1
                once.append(offset[a:z][single].tobytes())
                twice.append(offset[a:z][~single].tobytes())
            cols = [pa.array(np.full(len(of), r, np.int32)), pa.array(of.astype(np.int32)), pa.array(once, pa.binary()), pa.array(twice, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "block", "once", "twice"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            held += hashes(b)
            if sum(map(len, held)) > 1 << 22:
                yield from counted(held)
                held = []
        if held:
            yield from counted(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([np.packbits(twice).tobytes()])], names=["row", "block", "twice"])

        key, once, twice = None, np.zeros(block, bool), np.zeros(block, bool)
        for b in batches:
            for r, k, x, y in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if (r, k) != key:
                    if key is not None:
                        yield out()
                    key, once, twice = (r, k), np.zeros(block, bool), np.zeros(block, bool)
                single, several = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                twice[single] |= once[single]
                once[single] = once[several] = twice[several] = True
        if key is not None:
            yield out()

    parts = df.mapInArrow(count, "row int, block int, once binary, twice binary")
    merged = parts.repartition("row", "block").sortWithinPartitions("row", "block").mapInArrow(merge, "row int, block int, twice binary")
    found = [np.zeros((bits // block, block // 8), np.uint8) for _ in range(ROWS)]
    for x in merged.toLocalIterator():
        found[x["row"]][x["block"]] = np.frombuffer(x["twice"], np.uint8)
    return [x.ravel() for x in found]


def repeated(rows: list[np.ndarray], hashes: np.ndarray, bits: int) -> np.ndarray:
    """Whether the bitmaps of a sketch let each number through; all that were counted twice pass."""
    often = np.ones(len(hashes), bool)
    for bitmap, cell in zip(rows, _cells(hashes, bits), strict=True):
        often &= (bitmap[cell >> np.uint64(3)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return often


def repeated_ranges(docs: DataFrame, size: int = 50, bits: int | None = None) -> DataFrame:
    """(doc_id, first, windows): ranges of windows, by first word, that also start in a document with a smaller id.

    docs has doc_id and text; bits is the number of cells in a row of the sketch (bits / 8 bytes are broadcast a row), by
    default for the texts' bytes.
    """
    spark = docs.sparkSession
    if bits is None:
        bits = cells_for((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BYTES_PER_ANCHOR)
    seen = spark.sparkContext.broadcast(sketch(docs, size, bits))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = seen.value
        for b in batches:
            for start, end in pieces(b.column(1)):
                s = Segments(b.column(1).slice(start, end - start), size)
                chosen = np.flatnonzero(repeated(rows, s.anchor, bits))
                lists = s.window_lists(chosen) if len(chosen) else []
                cols = [
                    b.column(0).take(pa.array(s.text[chosen] + start)),
                    pa.array((s.first - s.borders[s.text])[chosen].astype(np.int64)),
                    pa.array(s.windows[chosen].astype(np.int32)),
                    pa.array(s.anchor[chosen].view(np.int64)),
                    pa.array(s.content[chosen].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)), pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "first", "windows", "anchor", "content", "hashes"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = written(docs.select("doc_id", "text").mapInArrow(emit, f"doc_id {kind}, first bigint, windows int, anchor bigint, content bigint, hashes array<bigint>"))
    key = ["anchor", "content", "windows"]
    firsts = rows.groupBy(*key).agg(F.min(F.struct("doc_id", "first")).alias("f"), F.count(F.lit(1)).alias("_n")).select(*key, F.col("f.doc_id").alias("least"), F.col("f.first").alias("at"), "_n")
    firsts = written(firsts)
    total = firsts.agg(F.sum("_n")).first()[0] or 0
    several = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("a"), F.max("least").alias("z")).filter("n > 1 and a < z")
    several = written(several.select("anchor", "n"))
    # one by one: the windows of the first documents of anchors with several segments
    told = join_counted(firsts, several, ["anchor"], "n", firsts.count()).select(*key, "least", "at")
    named = rows.select(*key, F.col("doc_id").alias("least"), F.col("first").alias("at"), "hashes").join(told, [*key, "least", "at"])
    windows = written(named.select(*key, "least", F.posexplode("hashes").alias("k", "hash")))
    earliest = windows.groupBy("anchor", "hash").agg(F.min("least").alias("a"), F.max("least").alias("z"), F.count(F.lit(1)).alias("_m")).filter("a < z")
    earliest = written(earliest.select("anchor", "hash", "a", "_m"))
    inner = join_counted(windows, earliest, ["anchor", "hash"], "_m", windows.count()).filter("a < least").groupBy(*key).agg(F.collect_set("k").alias("ks"))
    judged = written(firsts.join(inner, key, "left").select(*key, "least", "ks", "_n"))
    # a passage that a third of the documents hold is a heavy key: its rows stay where they are
    found = join_counted(rows.select("doc_id", "first", *key), judged, key, "_n", total)
    later = found.filter("least < doc_id").select("doc_id", "first", "windows")
    same = found.filter("least >= doc_id and ks is not null").select("doc_id", F.explode(F.transform("ks", lambda k: F.col("first") + k)).alias("first"), F.lit(1).alias("windows"))
    return later.unionByName(same)


def substring_dedup(docs: DataFrame, size: int = 50, bits: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and removed (array of start and end of word runs) for every row of docs.

    docs has doc_id and text; a null text has no words. Rows with the same doc_id are one document's parts for the question
    which id is smaller: neither loses words to the other; a null doc_id neither takes nor loses words. Texts under size
    words lose nothing. An empty table gives no rows. Other columns are ignored. Text that isn't valid makes no difference:
    words are compared as bytes (by 128 bits of hash).
    """
    own = docs.select("doc_id", "text")
    ranges = repeated_ranges(own.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), size, bits)
    lists = ranges.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("first", "windows"))).alias("cut"))

    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start, end in pieces(whole.column(1)):
                yield cut_piece(whole.slice(start, end - start))

    def cut_piece(b: pa.RecordBatch) -> pa.RecordBatch:
        n, gone, kept, spans = [], [], [], []
        for text, ranges in zip(b.column(1), b.column(2), strict=True):
            words = (text.as_py() or "").encode().split()
            runs: list[list[int]] = []
            for r in ranges.as_py() or ():
                # a range may be of another row with this doc_id
                start, end = r["first"], min(r["first"] + r["windows"] + size - 1, len(words))
                if start >= end:
                    continue
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            left, at = [], 0
            for start, end in runs:
                left += words[at:start]
                at = end
            left += words[at:]
            n.append(len(words))
            gone.append(len(words) - len(left))
            kept.append(b" ".join(left))
            spans.append([{"start": a, "end": z} for a, z in runs])
        cols = [b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, span)]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return own.join(lists, "doc_id", "left").select("doc_id", "text", "cut").mapInArrow(cut, f"doc_id {kind}, n_words bigint, n_removed bigint, kept_text string, removed array<struct<start:bigint,end:bigint>>")
