"""Token ids as files of directly addressable codes.

Documents are dealt by ranges of doc_id and sorted, so file k holds smaller ids than file k + 1, and each task tokenizes and
writes one file of chunks. A chunk holds the ids of whole documents as levels of 8 bits: level 0 has the lowest byte of every
id, level 1 the next byte of those ids that go on, and so on. A bitmap per level marks the ids that go on, and a directory
has the count of marks before each 512 bits, so the place of an id in the next level is a lookup and a count within one
block: any token is read without decoding others.

Body of a chunk (little-endian): b"DAC1", uint32 levels; per level uint64 n, n bytes, then, unless it is the last level,
(n + 7) // 8 bytes of bitmap (lowest bit first) and (n + 511) // 512 + 1 uint64 of directory.
"""

from __future__ import annotations

import re
import sys
import types
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder

MAGIC, BLOCK = b"DAC1", 512
#: Tokens after which a chunk ends with its document, and words a task keeps ids of.
CHUNK_TOKENS, CACHED_WORDS = 1 << 18, 400_000
#: Words that are encoded side by side, with each gap between them, to see that no token crosses white space or is made of it.
GAPS = (" ", "  ", "\n", "\r\n\n", "\t", "\x0b", "\x0c ")
PROBES = ("the", "The", "a", "'s", "12", "3", "it's", "(x)", "...", "été", "你好", "#", "-")
FILE_SCHEMA = "file int, chunk int, first bigint, n_tokens bigint, doc_ids array<bigint>, counts array<bigint>, body binary"


def encode(ids: np.ndarray) -> bytes:
    """The body of a chunk."""
    ids, out = ids.astype(np.uint64), []
    while True:
        level = [np.uint64(len(ids)).tobytes(), (ids & np.uint64(255)).astype(np.uint8).tobytes()]
        more = ids > 255
        out.append(level)
        if not more.any():
            break
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64)
        level += [np.packbits(more, bitorder="little").tobytes(), np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks, dtype=np.uint64)]).tobytes()]
        ids = ids[more] >> np.uint64(8)
    return b"".join([MAGIC, np.uint32(len(out)).tobytes(), *(x for level in out for x in level)])


class Chunk:
    """A body; ids are read one by one (get) or all together (decode)."""

    def __init__(self, body: bytes) -> None:
        if body[:4] != MAGIC:
            raise ValueError("not a chunk of directly addressable codes")
        n, at = int(np.frombuffer(body, np.uint32, 1, 4)[0]), 8
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        for k in range(n):
            size = int(np.frombuffer(body, np.uint64, 1, at)[0])
            low, at = np.frombuffer(body, np.uint8, size, at + 8), at + 8 + size
            marks = ranks = None
            if k + 1 < n:
                marks, at = np.frombuffer(body, np.uint8, (size + 7) // 8, at), at + (size + 7) // 8
                ranks, at = np.frombuffer(body, np.uint64, (size + BLOCK - 1) // BLOCK + 1, at), at + 8 * ((size + BLOCK - 1) // BLOCK + 1)
            self.levels.append((low, marks, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def get(self, i: int) -> int:
        value = shift = 0
        for low, marks, ranks in self.levels:
            value |= int(low[i]) << shift
            if marks is None or not marks[i >> 3] >> (i & 7) & 1:
                return value
            block, shift = i // BLOCK, shift + 8
            inside = marks[block * (BLOCK // 8) : i >> 3]
            i = int(ranks[block]) + int(np.bitwise_count(inside).sum()) + int(marks[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
        raise ValueError("a code goes on after the last level")

    def decode(self) -> np.ndarray:
        out, place = self.levels[0][0].astype(np.uint32), None
        for k, (low, marks, _) in enumerate(self.levels):
            if k:
                out[place] |= low.astype(np.uint32) << np.uint32(8 * k)
            if marks is not None:
                on = np.flatnonzero(np.unpackbits(marks, count=len(low), bitorder="little"))
                place = on if place is None else place[on]
        return out


class WordIds(dict):
    """Ids (as bytes of uint32) of the words that white space parts, by the tokenizers library; no token crosses white space.

    Words of Latin letters with marks before or after go part by part through the tokenizer's model, any other word through
    the whole tokenizer. Beyond CACHED_WORDS words, further ones aren't kept.
    """

    SIMPLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,;:!?*#$%&|()\"=/+-]+")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole, self.parts = Tokenizer.from_file(path), {}
        for gap in GAPS:  # words are encoded one by one
            for a in PROBES:
                for b in PROBES:
                    if self._full(f"{a}{gap}{b}") != self._full(a) + self._full(b):
                        raise ValueError(f"tokens of {path} cross white space, as in {f'{a}{gap}{b}'!r}")
        self.by_part = self._agrees()

    def _agrees(self) -> bool:
        """Does this tokenizer treat letters and marks part by part, in lower case?"""
        for word in ("Ab,", "été!!", "(x)", "naïve.Über", "The*** a&&& ÀÉ|"):
            if self._full(word) != b"".join(self._part(p) for w in word.split() for p in self.SIMPLE.findall(w)):
                return False
        return True

    def _full(self, word: str) -> bytes:
        return np.array(self.whole.encode(word, add_special_tokens=False).ids, np.uint32).tobytes()

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            low = part.lower()
            if not low.isascii():
                low = low.encode().decode("latin-1").translate(self._chars())
            found = array("I", [t.id for t in self.whole.model.tokenize(low)]).tobytes()
            if len(self.parts) < CACHED_WORDS:
                self.parts[part] = found
        return found

    def _chars(self) -> dict[int, str]:
        """The printable characters that stand for bytes in byte-level vocabularies, for bytes that don't stand for themselves."""
        if not hasattr(self, "chars"):
            plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
            self.chars = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - plain))}
        return self.chars

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        parts = self.SIMPLE.findall(text) if self.by_part else ()
        ids = b"".join(map(self._part, parts)) if sum(map(len, parts)) == len(text) else self._full(text)
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


def word_ids(path: str) -> WordIds:
    """One per Python worker: later tasks in it find the words of earlier ones."""
    kept = sys.modules.setdefault("_word_ids_kept", types.ModuleType("_word_ids_kept")).__dict__
    if path not in kept:
        kept[path] = WordIds(path)
    return kept[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes files of chunks (FILE_SCHEMA, as Parquet rows) to path in ascending doc_id order.

    A null text is empty: its ids are the end id alone. Rows with one doc_id, however many, follow each other by the hash of
    their text, then by text; a null doc_id comes first. doc_id is a whole number of 64 bits. An empty table gives files without chunks. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, file = word_ids(tokenizer), np.uint32(end_id).tobytes(), TaskContext.get().partitionId()
        chunk = first = size = 0
        blobs: list[bytes] = []
        names: list[int | None] = []
        counts: list[int] = []

        def flush() -> pa.RecordBatch:
            body = encode(np.frombuffer(b"".join(blobs), np.uint32))
            row = {"file": file, "chunk": chunk, "first": first, "n_tokens": size, "doc_ids": list(names), "counts": list(counts), "body": body}
            return pa.RecordBatch.from_pylist([row], pa.schema([("file", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("body", pa.binary())]))

        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                blob = b"".join(map(ids.__getitem__, (t.as_py() or "").encode().split())) + end
                blobs.append(blob)
                names.append(name)
                counts.append(len(blob) // 4)
                size += counts[-1]
                if size >= CHUNK_TOKENS:
                    yield flush()
                    chunk, first, size = chunk + 1, first + size, 0
                    blobs, names, counts = [], [], []
        if names:
            yield flush()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("hash", F.xxhash64("text"))  # ranges are told by samples of ids and hashes, not of texts
    ordered = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text")
    ordered.select("doc_id", "text").mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, file, chunk and at (place in the chunk) of every document in the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids, counts = Chunk(row["body"]).decode(), row["counts"]
                at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                if at[-1] != len(ids) or at[-1] != row["n_tokens"]:
                    raise ValueError("a chunk's counts and ids differ")
                crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(at[:-1], at[1:], strict=True)]
                n = len(counts)
                cols = [pa.array(row["doc_ids"], pa.int64()), pa.array(np.full(n, row["file"], np.int32)), pa.array(np.full(n, row["chunk"], np.int32)), pa.array(at[:-1]), pa.array(at[:-1] + row["first"]), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "file", "chunk", "at", "in_file", "n_tokens", "ids_crc32"])

    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    sizes = files.groupBy("file").agg(F.sum("n_tokens").alias("size"))  # a row for each file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    docs = files.mapInArrow(run, "doc_id bigint, file int, chunk int, at bigint, in_file bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(F.broadcast(starts), "file").select("doc_id", (F.col("base") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32", "file", "chunk", "at")


def token_output(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Writes docs to path (a new folder in the shared one unless given) and reads the files back, as read_tokens."""
    path = path or f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path)
