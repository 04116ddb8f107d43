"""GeoTIFF files of one region's maps, written a strip at a time."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable
from xml.sax.saxutils import escape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import band_name
from .sinks import bands

#: Fixed values of the format: how many bytes a value of each field type has, and its letter in ``struct``.
_TYPES = {"ascii": (2, "s"), "short": (3, "H"), "long": (4, "I"), "double": (12, "d"), "long8": (16, "Q")}
#: Lines of a strip: what the driver holds at a time is this many lines of one band.
STRIP = 256
#: Fixed value: what stands for a missing 32-bit float in NetCDF and so in these files.
FILL = 9.96920996838687e36


#: The statistics of a period's bands, in order, and the periods that every file has bands for.
STATISTICS = ("median", "p05", "p95")
PERIODS = {"month": range(1, 13), "doy": range(1, 366)}


def _fields(entries: list[tuple[int, str, bytes | list]], at: int, big: bool) -> bytes:
    """The directory at ``at``, its long values behind it."""
    count, word, head = ("<Q", "Q", 8) if big else ("<H", "I", 2)
    room, size = (8, 20) if big else (4, 12)
    behind, body, tail = at + head + size * len(entries) + room, b"", b""
    for tag, kind, values in sorted(entries):
        code, letter = _TYPES[kind]
        raw = values if kind == "ascii" else struct.pack(f"<{len(values)}{letter}", *values)
        place = raw.ljust(room, b"\0") if len(raw) <= room else struct.pack(f"<{word}", behind + len(tail))
        tail += b"" if len(raw) <= room else raw + b"\0" * (-len(raw) % 8)
        body += struct.pack(f"<HH{word}", tag, code, len(values)) + place
    return struct.pack(count, len(entries)) + body + b"\0" * room + tail


def _strips(rows: Iterable, names: list[str], north: float, west: float, height: int, width: int, step: float, nodata: float) -> Iterable[np.ndarray]:
    """Every strip of every band in order, from rows in that order."""
    per_band = -(-height // STRIP)
    now, block = 0, None
    fresh = lambda k: np.full((min(STRIP, height - k % per_band * STRIP), width), nodata, "<f4")
    for r in rows:
        line, column = round((north - r.y) / step), round((r.x - west) / step)
        k = r["__band"] * per_band + line // STRIP
        while now < k:
            yield fresh(now) if block is None else block
            now, block = now + 1, None
        block = fresh(now) if block is None else block
        if r.value is not None:
            block[line % STRIP, column] = r.value
    while now < per_band * len(names):
        yield fresh(now) if block is None else block
        now, block = now + 1, None


def write_geotiff(df: DataFrame, path: str, names: list[str], epsg: int | None = None, step: float = 30.0, nodata: float = FILL) -> None:
    """``df`` (band, y, x, value; one region) as a file of the driver's machine with one band for each of ``names``.

    32-bit floats in deflated strips, bands one after another, with their names; cells without a value hold
    ``nodata``.  Rows are sorted by the cluster and pulled a partition at a time.  Files that could pass 4 GB
    have 64-bit offsets.  Bands that aren't named are left out; a table without rows fails.
    """
    placed = df.withColumn("__band", F.array_position(F.array(*[F.lit(n) for n in names]), F.col("band")).cast("int") - 1).where("__band >= 0")
    edge = placed.agg(F.min("y"), F.max("y"), F.min("x"), F.max("x")).first()
    if edge[0] is None:
        raise ValueError("no cells to write")
    south, north, west, east = edge
    height, width = round((north - south) / step) + 1, round((east - west) / step) + 1
    big = height * width * 4 * len(names) > 4_000_000_000
    rows = bands(placed.select("__band", "y", "x", "value", (-F.col("y")).alias("__down")), ["__band", "__down", "x"])
    offsets, sizes = [], []
    with open(f"{path}.part", "wb") as out:
        out.write(b"\0" * 16)
        for strip in _strips(rows, names, north, west, height, width, step, nodata):
            packed = zlib.compress(strip.tobytes(), 6)
            offsets.append(out.tell())
            sizes.append(len(packed))
            out.write(packed)
        out.write(b"\0" * (-out.tell() % 8))
        at, n = out.tell(), len(names)
        items = "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{escape(b)}</Item>' for i, b in enumerate(names))
        entries: list[tuple[int, str, bytes | list]] = [
            (256, "long", [width]), (257, "long", [height]), (258, "short", [32] * n), (259, "short", [8]), (262, "short", [1]),
            (273, "long8" if big else "long", offsets), (277, "short", [n]), (278, "long", [STRIP]), (279, "long8" if big else "long", sizes),
            (284, "short", [2]), (339, "short", [3] * n),
            (33550, "double", [step, step, 0.0]), (33922, "double", [0.0, 0.0, 0.0, west - step / 2, north + step / 2, 0.0]),
            (42112, "ascii", f"<GDALMetadata>{items}</GDALMetadata>".encode() + b"\0"), (42113, "ascii", repr(float(nodata)).encode() + b"\0"),
        ]
        if n > 1:
            entries.append((338, "short", [0] * (n - 1)))
        if epsg is not None:
            entries.append((34735, "short", [1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg]))
        out.write(_fields(entries, at, big))
        out.seek(0)
        out.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at))
    os.replace(f"{path}.part", path)


def write_periods(table: DataFrame, kind: str, folder: str) -> None:
    """A file {vi}_{region}_per_{kind}.tif for each index and region of a table of percentiles by ``kind`` of period.

    Files are written one after another on the driver's machine.  Years are those of the region; months and days
    are all of them, without values where there was nothing.  The code of the coordinate system, if known, is the
    table's column epsg.
    """
    os.makedirs(folder, exist_ok=True)
    code = F.first("epsg") if "epsg" in table.columns else F.lit(None).cast("int")
    for part in table.groupBy("vi", "region").agg(F.sort_array(F.collect_set(kind)).alias("periods"), code.alias("epsg")).orderBy("vi", "region").collect():
        one = table.where((F.col("vi") == part.vi) & (F.col("region") == part.region))
        long = one.unpivot(["y", "x", kind], list(STATISTICS), "statistic", "value")
        named = long.select(band_name(kind, F.col(kind), F.col("statistic")).alias("band"), "y", "x", "value")
        form = {"year": "year{}_{}", "month": "month{:02d}_{}", "doy": "doy{:03d}_{}"}[kind]
        names = [form.format(period, s) for period in PERIODS.get(kind, part.periods) for s in STATISTICS]
        write_geotiff(named, os.path.join(folder, f"{part.vi}_{part.region}_per_{kind}.tif"), names, part.epsg)
