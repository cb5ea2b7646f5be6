"""Ranked lexical search: postings in doc_id order, scored window by window.

An index holds, of the queries' terms, each document's occurrences. It is dealt by ranges of ascending doc_id; a task goes through its postings in
windows of WINDOW documents. In a window they lie by term; each query adds its terms' contributions to an array of the
window's size, marks the documents in a bitset, reads the marked scores off and keeps its ten best in a heap. Heaps of all
tasks are merged by query, in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .hashed import pieces

#: Bytes of terms stay (A-Z lower-cased), others become blanks.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents of a window: an array of scores takes 256 KB.
WINDOW = 1 << 15
#: Bytes of queries that are searched for together, about: they, their terms and heaps are what the driver sends to tasks.
QUERY_BYTES = 8 << 20


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, terms, tfs) of every row with a term: its number of terms, and those of the vocabulary with their occurrences
    (written)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in batches:
            for start, end in pieces(b.column(1)):
                ids, n, terms, tfs = [], [], [], []
                part = b.slice(start, end - start)
                for doc, value in zip(part.column(0), part.column(1), strict=True):
                    found = terms_of(value.as_buffer().to_pybytes()) if value.is_valid else ()
                    if found:
                        own = [(known[t], c) for t, c in Counter(found).items() if t in known]
                        ids.append(doc)
                        n.append(len(found))
                        terms.append([t for t, _ in own])
                        tfs.append([c for _, c in own])
                kind = b.column(0).type
                yield pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in ids], kind), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))], names=["doc", "n", "terms", "tfs"])

    kind = docs.schema[doc_id].dataType.simpleString()
    found = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).mapInArrow(index, f"doc {kind}, n bigint, terms array<int>, tfs array<bigint>")
    return written(found)


def _contributions(part: pa.Table, weight: dict[int, int], docs: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The postings of a window by term: term, document's place in the window, and what the term adds to its score."""
    lists, tfs = part["terms"].combine_chunks(), part["tfs"].combine_chunks()
    term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
    slot = np.repeat(np.arange(len(part)), np.diff(lists.offsets.to_numpy()))
    lengths, at = np.unique(part["n"].to_numpy(), return_inverse=True)
    m = np.array([100 - 90 + (90 * int(n) * docs) // total for n in lengths], np.int64)[at]
    known = np.zeros(int(term.max()) + 1 if len(term) else 1, np.int64)
    for t, w in weight.items():
        if t < len(known):
            known[t] = w
    add = known[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[slot]))
    order = np.argsort(term, kind="stable")
    return term[order], slot[order], add[order]


class Heap:
    """The k best (score, doc) of a query; equal scores by ascending doc, which come in ascending order."""

    def __init__(self, k: int) -> None:
        self.k, self.rows, self.least = k, [], 0

    def offer(self, scores: np.ndarray, places: np.ndarray, docs: list) -> None:
        better = scores > self.least
        scores, places = scores[better], places[better]
        best = np.lexsort((places, -scores))[: self.k]
        if len(best):
            self.rows = sorted(self.rows + [(int(scores[i]), docs[places[i]]) for i in best], key=lambda r: -r[0])[: self.k]  # stable: earlier documents first
            if len(self.rows) == self.k:
                self.least = self.rows[-1][0]


def _search_block(index: DataFrame, items: list[tuple[int, list[int]]], k: int) -> DataFrame:
    """(query, doc, score): of each query (its number, its terms' numbers) the k best of each task."""
    spark = index.sparkSession
    stats = index.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    df = dict(index.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect())  # a row a term of the queries
    docs, total = stats["docs"], stats["total"] or 1
    sent = spark.sparkContext.broadcast((items, {t: math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for t, n in df.items()}))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = sent.value
        heaps = [Heap(k) for _ in queries]
        scores, kind = np.zeros(WINDOW, np.int64), None

        def window(part: pa.Table) -> None:
            term, slot, add = _contributions(part, weight, docs, total)
            first = np.flatnonzero(np.diff(term, prepend=-1))
            spans = dict(zip(term[first].tolist(), zip(first.tolist(), np.append(first, len(term))[1:].tolist(), strict=True), strict=True))
            bits = {}
            for t, (start, end) in spans.items():  # which documents hold the term
                held = np.zeros(WINDOW, bool)
                held[slot[start:end]] = True
                bits[t] = np.packbits(held)
            names = part["doc"].to_pylist()
            for (_, terms), heap in zip(queries, heaps, strict=True):
                own = [t for t in terms if t in spans]
                if not own:
                    continue
                occupied = np.zeros(WINDOW // 8, np.uint8)
                for t in own:
                    start, end = spans[t]
                    scores[slot[start:end]] += add[start:end]  # a term's documents differ
                    occupied |= bits[t]
                places = np.flatnonzero(np.unpackbits(occupied))
                heap.offer(scores[places], places, names)
                scores[places] = 0

        held, n = [], 0
        for b in batches:
            kind = b.column(0).type
            while n + b.num_rows >= WINDOW:
                window(pa.Table.from_batches([*held, b.slice(0, WINDOW - n)]))
                held, b, n = [], b.slice(WINDOW - n), 0
            held, n = [*held, b], n + b.num_rows
        if n:
            window(pa.Table.from_batches(held))
        out = [(number, doc, score) for (number, _), heap in zip(queries, heaps, strict=True) for score, doc in heap.rows]
        if out:
            number, doc, score = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(doc, kind), pa.array(score, pa.int64())], names=["query", "doc", "score"])

    # in doc_id order; an id with very many rows is dealt by their hash too
    salt = F.pmod(F.xxhash64("n", "terms", "tfs"), F.lit(4096))
    ordered = index.withColumn("_salt", salt).repartitionByRange("doc", "_salt").sortWithinPartitions("doc").drop("_salt")
    kind = index.schema["doc"].dataType.simpleString()
    return ordered.mapInArrow(search, f"query bigint, doc {kind}, score bigint")


def lexical_search(docs: DataFrame, queries: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item, rank, doc_id and score: of each row of queries the k documents with the highest scores above 0.

    Terms are runs of digits, letters (A-Z lower-cased) and characters beyond ASCII of whole texts; nulls have none. Every row
    of docs is a document and every row of queries a query, repeated or null ids too; null doc_ids come first among equal
    scores. Queries are dealt into blocks of about query_bytes, searched one after the other, each with an index of
    its own terms. No queries, no documents or no common term give no rows.
    """
    asked = written(queries.select(F.col(item).alias("item"), F.col(query_text).alias("text"), F.monotonically_increasing_id().alias("query")))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, found = max(1, -(-size // query_bytes)), None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "text").collect()  # about query_bytes of text
        own = [(r["query"], sorted(set(terms_of((r["text"] or "").encode())))) for r in rows]
        vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in own for t in terms}))}
        index = build_index(docs, vocabulary, doc_id, text)
        part = _search_block(index, [(q, [vocabulary[t] for t in terms]) for q, terms in own], k)
        found = part if found is None else found.unionByName(part)
    some = found.withColumn("_part", F.spark_partition_id() % 64)
    some = some.withColumn("_rank", F.row_number().over(Window.partitionBy("query", "_part").orderBy(F.desc("score"), "doc"))).filter(F.col("_rank") <= k)
    ranked = some.select("query", "doc", "score", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "doc")).alias("rank")).filter(F.col("rank") <= k)
    return ranked.join(asked.select("query", "item"), "query").select(F.col("item").alias(item), "rank", F.col("doc").alias(doc_id), "score")
