"""Tile packs as a data source: `spark.read.format("tilepack")` reads them entry by entry, `df.write.format("tilepack")` writes them.

Reading: partitions are runs of files of about `bytes` (64 MB); of a file a task reads its table, of an entry its header, and
of the channels that are asked for their numbers. Filters on key, channel and hour (a number that ends the key) are pushed
down to where tables and headers are read, if spark.sql.python.filterPushdown.enabled is set (register sets it). Paths are
whatever pyarrow's file systems open (file, hdfs, s3, gs). Writing: a task writes the packs that it has all rows of (packs
must be dealt by name, write_packs does), under a hidden name; they get their own names when all tasks are done.
"""

from __future__ import annotations

import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from .tiles import PACK, TILE, make_pack

SCHEMA = "path string, key string, hour int, channel int, lon0 float, lat0 float, dx float, dy float, width int, height int, scale float, offset float, raw array<int>, bytes_read bigint"
HOUR = re.compile(rb"(\d+)$")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (fs.LocalFileSystem(), path)


def entries(f, size: int) -> tuple[list[tuple[str, int, int]], int]:
    """(key, start, length) of each entry of an open pack, and how many bytes were read for it: the table, in steps of 4 KB."""
    data = f.read(min(4096, size))
    if data[:4] != PACK or len(data) < 7:
        raise ValueError("not a pack")
    (n,), at, out = struct.unpack_from("<H", data, 5), 7, []
    for _ in range(n):
        while len(data) < at + 1 or len(data) < at + 9 + data[at]:
            more = f.read(4096)
            if not more:
                raise ValueError("a pack ends within its table")
            data += more
        length = data[at]
        out.append((data[at + 1 : at + 1 + length].decode(), *struct.unpack_from("<II", data, at + 1 + length)))
        at += 9 + length
    return [(key, at + start, size) for key, start, size in out], len(data)


@dataclass
class Files(InputPartition):
    files: tuple[tuple[str, int], ...]


class PackReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path, self.bytes = options["path"], int(options.get("bytes", 64 << 20))
        self.wanted: dict[str, list] = {"key": [], "hour": [], "channel": []}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        tests = {EqualTo: lambda v: lambda x: x == v, In: lambda v: lambda x: x in v, GreaterThan: lambda v: lambda x: x > v, GreaterThanOrEqual: lambda v: lambda x: x >= v, LessThan: lambda v: lambda x: x < v, LessThanOrEqual: lambda v: lambda x: x <= v}
        for f in filters:
            if type(f) in tests and len(f.attribute) == 1 and f.attribute[0] in self.wanted:
                self.wanted[f.attribute[0]].append(tests[type(f)](f.value))
            else:
                yield f

    def _is(self, name: str, value) -> bool:
        return all(value is not None and test(value) for test in self.wanted[name])

    def partitions(self) -> list[Files]:
        system, base = opened(self.path)
        found = system.get_file_info(fs.FileSelector(base, recursive=True)) if system.get_file_info(base).type == fs.FileType.Directory else [system.get_file_info(base)]
        packs = sorted((i.path, i.size) for i in found if i.path.endswith(".gpack") and not any(p.startswith(("_", ".")) for p in i.path[len(base) :].split("/")))
        out, part, size = [], [], 0
        for path, n in packs:
            part.append((path, n))
            size += n
            if size >= self.bytes:
                out, part, size = [*out, Files(tuple(part))], [], 0
        return [*out, Files(tuple(part))] if part or not out else out

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = opened(self.path)
        for path, size in partition.files:
            with system.open_input_file(path) as f:
                table, cost = entries(f, size)
                for key, start, _ in table:
                    digits = HOUR.search(key.encode())
                    hour = int(digits[1]) if digits and len(digits[1]) < 10 else None
                    if not (self._is("key", key) and self._is("hour", hour)):
                        continue
                    f.seek(start)
                    head = f.read(28)
                    if head[:4] != TILE:
                        raise ValueError(f"not a tile: {key} of {path}")
                    n, (width, height, *geometry) = head[6], struct.unpack_from("<HHffff", head, 8)
                    numbers = f.read(10 * n)
                    cost += 28 + 10 * n
                    for k in range(n):
                        channel, scale, offset = struct.unpack_from("<hff", numbers, 10 * k)
                        if self._is("channel", channel):
                            f.seek(start + 28 + 10 * n + 2 * k * width * height)
                            raw = np.frombuffer(f.read(2 * width * height), "<i2").astype(np.int32)
                            yield (path, key, hour, channel, *geometry, width, height, scale, offset, raw.tolist(), cost + 2 * width * height)
                            cost = 0


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


class PackWriter(DataSourceWriter):
    """Rows are (pack, key, tile)."""

    def __init__(self, options: dict, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = options["path"].rstrip("/"), overwrite, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Written:
        system, base = opened(self.path)
        packs: dict[str, list] = {}
        for pack, key, tile in rows:
            packs.setdefault(pack, []).append((key, bytes(tile)))
        task = f"{base}/_{self.job}/{uuid.uuid4().hex}"
        for pack, tiles in packs.items():
            if "/" in pack or pack.startswith((".", "_")):
                raise ValueError(f"not a pack's name: {pack}")
            system.create_dir(task)
            with system.open_output_stream(f"{task}/{pack}.gpack") as f:
                f.write(make_pack(sorted(tiles)))
        return Written(tuple(f"{task}/{pack}.gpack" for pack in packs))

    def commit(self, messages: list[Written]) -> None:
        system, base = opened(self.path)
        new = {name.rsplit("/", 1)[1]: name for m in messages if m is not None for name in m.names}
        if len(new) < sum(len(m.names) for m in messages if m is not None):
            self.abort(messages)
            raise ValueError("a pack was in several tasks: deal the rows by pack")
        system.create_dir(base)
        old = [i.path for i in system.get_file_info(fs.FileSelector(base)) if i.path.endswith(".gpack")] if self.overwrite else []
        for name, path in new.items():
            system.move(path, f"{base}/{name}")
        for path in old:
            if path.rsplit("/", 1)[1] not in new:
                system.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[Written]) -> None:
        system, base = opened(self.path)
        if system.get_file_info(f"{base}/_{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/_{self.job}")


class PackSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tilepack"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PackReader:
        return PackReader(self.options)

    def writer(self, schema, overwrite: bool) -> PackWriter:
        return PackWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes format `tilepack` known to the session, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PackSource)


def read_packs(spark: SparkSession, path: str) -> DataFrame:
    """A row for each channel of each entry of the packs below path (SCHEMA). bytes_read is what reading took from the file: a
    pack's table and its entries' headers count at the first row after them."""
    register(spark)
    return spark.read.format("tilepack").load(path)


def write_packs(tiles: DataFrame, path: str, pack: str, key: str = "key", tile: str = "tile", overwrite: bool = True) -> None:
    """Packs path/<pack>.gpack of the tiles of each value of pack, by key. A task holds its packs one after the other's end."""
    register(tiles.sparkSession)
    rows = tiles.select(F.col(pack).cast("string").alias("pack"), F.col(key).cast("string").alias("key"), F.col(tile).alias("tile"))
    rows.repartition("pack").write.format("tilepack").mode("overwrite" if overwrite else "append").save(path)
