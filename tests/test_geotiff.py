import struct
import zlib

import numpy as np
import pytest

from chronogrid.sources import geotiff


def read(path):
    """A plain reader of what the writer may use: tag -> values, and the bands."""
    raw = path.read_bytes()
    big = struct.unpack_from("<H", raw, 2)[0] == 43
    at = struct.unpack_from("<Q", raw, 8)[0] if big else struct.unpack_from("<I", raw, 4)[0]
    n, at = (struct.unpack_from("<Q", raw, at)[0], at + 8) if big else (struct.unpack_from("<H", raw, at)[0], at + 2)
    tags, word, room, size = {}, "Q" if big else "I", 8 if big else 4, 20 if big else 12
    for i in range(n):
        p = at + size * i
        tag, code, count = struct.unpack_from(f"<HH{word}", raw, p)
        letter, width = {2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 12: ("d", 8), 16: ("Q", 8)}[code]
        place = p + size - room if width * count <= room else struct.unpack_from(f"<{word}", raw, p + size - room)[0]
        tags[tag] = struct.unpack_from(f"<{count}{letter}", raw, place)
    assert list(tags) == sorted(tags)
    width, height, rows = tags[256][0], tags[257][0], tags[278][0]
    strips = [np.frombuffer(zlib.decompress(raw[o : o + s]), "<f4").reshape(-1, width) for o, s in zip(tags[273], tags[279])]
    per_band = -(-height // rows)
    return tags, [np.concatenate(strips[i : i + per_band]) for i in range(0, len(strips), per_band)]


@pytest.mark.parametrize("strip", [256, 2])
def test_round_trip(spark, tmp_path, monkeypatch, strip):
    monkeypatch.setattr(geotiff, "STRIP", strip)
    rows = [(b, 30.0 * y + 15, 30.0 * x + 15, float(10 * y + x + 100 * k)) for k, b in enumerate(("peak", "a<b")) for y in range(5) for x in range(3) if (y, x) != (3, 1)]
    df = spark.createDataFrame([*rows, ("other", 15.0, 15.0, 1.0), ("peak", 105.0, 45.0, None)], "band string, y double, x double, value double")
    path = tmp_path / "map.tif"
    geotiff.write_geotiff(df.repartition(3), str(path), ["a<b", "none", "peak"], epsg=32631, nodata=-9999.0)
    tags, (first, none, last) = read(path)
    want = np.array([[10 * y + x for x in range(3)] for y in range(4, -1, -1)], "f4")
    gap = np.zeros_like(want, bool)
    gap[1, 1] = True
    assert (last == np.where(gap, -9999, want)).all() and (first == np.where(gap, -9999, want + 100)).all() and (none == -9999).all()
    assert tags[33550] == (30.0, 30.0, 0.0) and tags[33922] == (0.0, 0.0, 0.0, 0.0, 150.0, 0.0) and tags[34735][-1] == 32631
    assert b"a&lt;b" in tags[42112][0] and tags[42113][0] == b"-9999.0\0" and tags[277] == (3,)
    assert not list(tmp_path.glob("*.part"))


def test_big_directory_and_empty_table(spark, tmp_path):
    body = geotiff._fields([(273, "long8", [1 << 40, 7]), (256, "long", [9])], 16, True)
    assert struct.unpack_from("<Q", body)[0] == 2 and struct.unpack_from("<HHQI", body, 8) == (256, 4, 1, 9)
    place = struct.unpack_from("<Q", body, 8 + 20 + 12)[0]
    assert struct.unpack_from("<QQ", body, place - 16) == (1 << 40, 7)
    with pytest.raises(ValueError):
        geotiff.write_geotiff(spark.createDataFrame([], "band string, y double, x double, value double"), str(tmp_path / "x.tif"), ["a"])
