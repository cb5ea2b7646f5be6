"""Binary tiles and packs, read with binaryFile and decoded in Arrow batches.

Fixed formats, little-endian. Tile: b"GSTY", version 1, encoding 1, number of channels, 0 (bytes), width, height (uint16),
lon0, lat0, dx, dy (float32); per channel number (int16), scale, offset (float32); then per channel int16 values, row by row.
Pack: b"GPAK", version 1 (byte), entries (uint16); per entry length of key (byte), key, offset and length (uint32) from the
end of the table; then the tiles.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE, PACK = b"GSTY", b"GPAK"
CELLS = "lon0 float, lat0 float, dx float, dy float, width int, height int, channel int, scale float, offset float, raw array<int>"


def parse_pack(data: bytes) -> Iterator[tuple[str, bytes]]:
    if data[:4] != PACK:
        raise ValueError("not a pack")
    (n,), at, table = struct.unpack_from("<H", data, 5), 7, []
    for _ in range(n):
        size = data[at]
        key = data[at + 1 : at + 1 + size].decode()
        table.append((key, *struct.unpack_from("<II", data, at + 1 + size)))
        at += 9 + size
    for key, start, length in table:
        yield key, data[at + start : at + start + length]


def parse_tile(data: bytes) -> list[tuple]:
    """(lon0, lat0, dx, dy, width, height, channel, scale, offset, raw) of each channel."""
    if data[:4] != TILE:
        raise ValueError("not a tile")
    n, (width, height, *geometry) = data[6], struct.unpack_from("<HHffff", data, 8)
    at = 28 + 10 * n
    out = []
    for k in range(n):
        channel, scale, offset = struct.unpack_from("<hff", data, 28 + 10 * k)
        out.append((*geometry, width, height, channel, scale, offset, np.frombuffer(data, "<i2", width * height, at + 2 * k * width * height).astype(np.int32)))
    return out


def make_tile(geometry: tuple, width: int, height: int, channels: list[tuple[int, float, float, list[int]]]) -> bytes:
    for number, _, _, raw in channels:
        if len(raw) != width * height:
            raise ValueError(f"channel {number} has {len(raw)} values, not {width * height}")
    head = TILE + struct.pack("<BBBBHHffff", 1, 1, len(channels), 0, width, height, *geometry)
    return head + b"".join(struct.pack("<hff", *c[:3]) for c in channels) + b"".join(np.array(c[3], "<i2").tobytes() for c in channels)


def make_pack(entries: list[tuple[str, bytes]]) -> bytes:
    head, at = PACK + struct.pack("<BH", 1, len(entries)), 0
    for key, tile in entries:
        name = key.encode()
        if len(name) > 255:
            raise ValueError(f"key too long: {key}")
        head, at = head + bytes([len(name)]) + name + struct.pack("<II", at, len(tile)), at + len(tile)
    return head + b"".join(tile for _, tile in entries)


def unpacked(packs: DataFrame, content: str = "content") -> DataFrame:
    """key and tile of every entry of every pack (rows with a binary column, as binaryFile reads them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0).to_pylist():
                keys, tiles = zip(*parse_pack(data), strict=True) if data and data[5:7] != b"\0\0" else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(tiles, pa.binary())], names=["key", "tile"])

    return packs.select(content).mapInArrow(run, "key string, tile binary")


def decoded(tiles: DataFrame, key: str = "key", tile: str = "tile") -> DataFrame:
    """key and CELLS: a row for each channel of each tile; values are raw * scale + offset, -32768 missing (grids.dequantised)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.float32()] * 4 + [pa.int32()] * 3 + [pa.float32()] * 2 + [pa.list_(pa.int32())]
        for b in batches:
            rows = [(k, *c) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for c in parse_tile(t)]
            cols = list(zip(*rows, strict=True)) or [()] * 11
            names = ["key", "lon0", "lat0", "dx", "dy", "width", "height", "channel", "scale", "offset", "raw"]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), *[pa.array(list(c), t) for c, t in zip(cols[1:], kinds, strict=True)]], names=names)

    return tiles.select(F.col(key).alias("key"), F.col(tile).alias("tile")).mapInArrow(run, f"key string, {CELLS}")


def headers(tiles: DataFrame, key: str = "key", tile: str = "tile") -> DataFrame:
    """key and channel of every channel that a tile's header names; of a tile only the header's bytes go to Python."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, struct.unpack_from("<h", t, 28 + 10 * i)[0]) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for i in range(t[6])]
            keys, channels = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(channels, pa.int32())], names=["key", "channel"])

    head = F.substring(tile, 1, 28 + 10 * 255)  # at most so many channels
    return tiles.select(F.col(key).alias("key"), head.alias("tile")).mapInArrow(run, "key string, channel int")


def encoded(channels: DataFrame, by: list[str]) -> DataFrame:
    """by and tile, from rows of by and CELLS (one per channel; a tile has few)."""
    kinds = {f.name: f.dataType.simpleString() for f in channels.schema.fields}

    def tile(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["channel"])
        one = rows[0]
        body = make_tile(tuple(one[c] for c in ("lon0", "lat0", "dx", "dy")), one["width"], one["height"], [(r["channel"], r["scale"], r["offset"], r["raw"]) for r in rows])
        return pa.table({**{c: t.column(c).slice(0, 1) for c in by}, "tile": pa.array([body], pa.binary())})

    wanted = channels.select(*by, "channel", "scale", "offset", "raw", "lon0", "lat0", "dx", "dy", "width", "height")
    return wanted.groupBy(*by).applyInArrow(tile, ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", tile binary")


def packed(tiles: DataFrame, by: list[str], key: str = "key", order: str | None = None) -> DataFrame:
    """by and pack: the tiles of a group in one pack, by key (or by order: the hour, say). A pack's size is that of its tiles,
    which its four-byte offsets bound."""
    kinds = {f.name: f.dataType.simpleString() for f in tiles.schema.fields}
    place = order or key

    def pack(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r[place])
        return pa.table({**{c: t.column(c).slice(0, 1) for c in by}, "pack": pa.array([make_pack([(str(r[key]), r["tile"]) for r in rows])], pa.binary())})

    return tiles.select(*dict.fromkeys([*by, key, place, "tile"])).groupBy(*by).applyInArrow(pack, ", ".join(f"`{c}` {kinds[c]}" for c in by) + ", pack binary")


def quantised_planes(planes: DataFrame, by: list[str]) -> DataFrame:
    """planes (by, channel, geometry and plane) as CELLS with their raw numbers, scale and offset: ready for encoded."""
    values = F.transform("plane", lambda v: F.nanvl(v.cast("double"), F.lit(None).cast("double")))
    known = F.array_compact(values)
    low, high = F.array_min(known), F.array_max(known)
    flat = F.coalesce(high <= low, F.lit(True))
    rows = planes.withColumns({"scale": F.when(flat, 1.0).otherwise((high - low) / 65534), "offset": F.coalesce(F.when(flat, low).otherwise((high + low) / 2), F.lit(0.0)), "_v": values})
    one = lambda v: F.when(v.isNull(), F.lit(-32768)).otherwise(F.greatest(F.least(F.rint((v - F.col("offset")) / F.col("scale")), F.lit(32767.0)), F.lit(-32767.0)).cast("int"))
    kinds = {"lon0": "float", "lat0": "float", "dx": "float", "dy": "float", "scale": "float", "offset": "float"}
    rows = rows.withColumn("raw", F.transform("_v", one))
    return rows.select(*by, F.col("channel").cast("int").alias("channel"), *[F.col(c).cast(k).alias(c) for c, k in kinds.items()], "width", "height", "raw")
