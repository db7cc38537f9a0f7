"""Tile archives: PMTiles v3 directories and vector tiles, decoded into rows."""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def varint(data: bytes, at: int) -> tuple[int, int]:
    """(value, next place)."""
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7


def directory(data: bytes) -> list[tuple[int, int, int, int]]:
    """(tile id, offset, length, run) of each entry; a run of 0 is a leaf directory."""
    n, at = varint(data, 0)
    columns = []
    for _ in range(4):
        column = []
        for _ in range(n):
            v, at = varint(data, at)
            column.append(v)
        columns.append(column)
    out, tile, end = [], 0, 0
    for delta, run, length, offset in zip(*columns, strict=True):
        tile += delta
        start = end if offset == 0 else offset - 1
        out.append((tile, start, length, run))
        end = start + length
    return out


def tile_zxy(tile: int) -> tuple[int, int, int]:
    """Zoom, x and y of a tile's number: zooms in turn, each along its Hilbert curve."""
    z = 0
    while tile >= 4**z:
        tile -= 4**z
        z += 1
    x = y = 0
    s = 1
    while s < 2**z:
        rx = 1 & (tile // 2)
        ry = 1 & (tile ^ rx)
        if ry == 0:
            if rx:
                x, y = s - 1 - x, s - 1 - y
            x, y = y, x
        x, y = x + s * rx, y + s * ry
        tile //= 4
        s *= 2
    return z, x, y


def entries(data: bytes) -> Iterator[tuple[int, int, int, int, int]]:
    """(z, x, y, offset, length) of every tile of an archive, leaves and runs followed."""
    if data[:7] != b"PMTiles" or data[7] != 3:
        raise ValueError("not a PMTiles v3 archive")
    root_at, root_len, _, _, leaf_at, _, tile_at, _ = struct.unpack("<8Q", data[8:72])
    unpack = gzip.decompress if data[97] == 2 else bytes

    def walk(own: bytes) -> Iterator[tuple[int, int, int, int, int]]:
        for tile, offset, length, run in directory(unpack(own)):
            if run == 0:
                yield from walk(data[leaf_at + offset : leaf_at + offset + length])
            for k in range(run):
                yield (*tile_zxy(tile + k), tile_at + offset, length)

    yield from walk(data[root_at : root_at + root_len])


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            n, at = varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind} is not known")
        yield key >> 3, value


def _packed(data: bytes) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = varint(data, at)
        out.append(v)
    return out


def _value(data: bytes):
    zigzag = lambda v: v >> 1 ^ -(v & 1)
    for number, v in fields(data):
        if number == 1:
            return v.decode()
        if number == 2:
            return struct.unpack("<f", v)[0]
        if number == 3:
            return struct.unpack("<d", v)[0]
        if number in (4, 5):
            return v - (1 << 64) if number == 4 and v >> 63 else v
        if number == 6:
            return zigzag(v)
        if number == 7:
            return bool(v)
    return None


def layers(tile: bytes) -> Iterator[tuple[str, int, dict, list[list[tuple[int, int]]]]]:
    """(layer, extent, properties, paths) of each feature of a vector tile."""
    tile = gzip.decompress(tile) if tile[:2] == b"\x1f\x8b" else tile
    for number, data in fields(tile):
        if number != 3:
            continue
        name, extent, keys, values, rows = "", 4096, [], [], []
        for f, v in fields(data):
            if f == 1:
                name = v.decode()
            elif f == 2:
                rows.append(v)
            elif f == 3:
                keys.append(v.decode())
            elif f == 4:
                values.append(_value(v))
            elif f == 5:
                extent = v
        for row in rows:
            own = dict(fields(row))
            tags = _packed(own.get(2, b""))
            yield name, extent, {keys[k]: values[v] for k, v in zip(tags[::2], tags[1::2], strict=True)}, paths(_packed(own.get(4, b"")))


def paths(commands: list[int]) -> list[list[tuple[int, int]]]:
    """The lines of a feature's geometry commands."""
    out, x, y, at = [], 0, 0, 0
    while at < len(commands):
        kind, count = commands[at] & 7, commands[at] >> 3
        at += 1
        for _ in range(count if kind in (1, 2) else 0):
            x, y = x + (commands[at] >> 1 ^ -(commands[at] & 1)), y + (commands[at + 1] >> 1 ^ -(commands[at + 1] & 1))
            at += 2
            if kind == 1:
                out.append([])
            out[-1].append((x, y))
        if kind == 7 and out:
            out[-1].append(out[-1][0])
    return out


def features(spark: SparkSession, path: str) -> DataFrame:
    """(z, x, y, bytes, layer, extent, properties, paths): archives read whole by the executors, one row a feature."""
    raw = spark.read.format("binaryFile").load(path).select("content")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for content in pdf["content"]:
                data = bytes(content)
                out = []
                for z, x, y, at, n in entries(data):
                    for name, extent, props, lines in layers(data[at : at + n]):
                        out.append((z, x, y, n, name, extent, {k: str(v) for k, v in props.items()}, [[{"x": a, "y": b} for a, b in p] for p in lines]))
                    if len(out) > 5000:
                        yield pd.DataFrame(out, columns=["z", "x", "y", "bytes", "layer", "extent", "properties", "paths"])
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=["z", "x", "y", "bytes", "layer", "extent", "properties", "paths"])

    return raw.mapInPandas(run, "z int, x int, y int, bytes int, layer string, extent int, properties map<string,string>, paths array<array<struct<x:int,y:int>>>")


def attributes(features: DataFrame, zoom: int) -> DataFrame:
    """(layer, keys): which attributes a zoom's features carry."""
    rows = features.where(F.col("z") == zoom).select("layer", F.explode(F.map_keys("properties")).alias("key"))
    return rows.groupBy("layer").agg(F.sort_array(F.collect_set("key")).alias("keys"))
