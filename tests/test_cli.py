import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid import cli
from chronogrid.functions import projection


def test_utm_round_trip_and_known_point(spark):
    df = spark.createDataFrame([(48.8582, 2.2945), (-33.857, 18.5), (0.0, 3.0)], "lat double, lon double")
    x, y = projection.to_utm(F.col("lat"), F.col("lon"), "EPSG:32631")
    got = df.where("lat > 40").select(x.alias("x"), y.alias("y")).first()
    # The northing on the central meridian is the scaled arc of the meridian, integrated here.
    e2, phi = projection.FLATTENING * (2 - projection.FLATTENING), np.linspace(0, np.radians(48.8582), 200_001)
    arc = np.trapezoid(projection.AXIS * (1 - e2) / (1 - e2 * np.sin(phi) ** 2) ** 1.5, phi)
    on = df.where("lat > 40").select(projection.to_utm(F.col("lat"), F.lit(3.0), "EPSG:32631")[1].alias("y")).first()
    assert abs(on.y - projection.SCALE * arc) < 1e-3
    assert abs(got.x - 448251.8) < 0.1 and 0 < got.y - on.y < 1000
    edge = df.where("lat = 0").select(x.alias("x"), y.alias("y")).first()
    assert abs(edge.x - 500000) < 1e-6 and abs(edge.y) < 1e-6
    for crs, where in (("EPSG:32631", "lat > 0"), ("EPSG:32734", "lat < 0")):
        px, py = projection.to_utm(F.col("lat"), F.col("lon"), crs)
        lat, lon = projection.from_utm(F.col("px"), F.col("py"), crs)
        r = df.where(where).select("lat", "lon", px.alias("px"), py.alias("py")).select("lat", "lon", lat.alias("a"), lon.alias("b")).first()
        assert abs(r.a - r.lat) < 1e-8 and abs(r.b - r.lon) < 1e-8
    with pytest.raises(ValueError):
        projection.utm_zone("EPSG:4326")


@pytest.fixture(scope="module")
def tiles(spark, tmp_path_factory):
    from chronogrid.sources.observations import VI_OBS

    folder = tmp_path_factory.mktemp("tiles")
    day = [dt.datetime(2020, 1, 1) + dt.timedelta(days=7 * i) for i in range(60)]
    rows = [(None, None, None, "EPSG:32631", i, d, 30.0 * y, 30.0 * x, 0.2 + 0.01 * (i % 30)) for i, d in enumerate(day) for y in range(3) for x in range(3)]
    spark.createDataFrame(rows, VI_OBS).coalesce(1).write.parquet(str(folder / "raw"))
    part = next((folder / "raw").glob("part-*.parquet"))
    for t in ("T01", "T02"):
        (folder / f"{t}_NDVI.parquet").write_bytes(part.read_bytes())
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [31, 0], [31, 31], [0, 31], [0, 0]]]}
    # In metres of the tiles' zone, as the file says; one that names no system is in degrees.
    crs = {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32631"}}
    (folder / "park.json").write_text(json.dumps({"type": "FeatureCollection", "crs": crs, "features": [{"type": "Feature", "properties": {"n": "a b"}, "geometry": shape}]}))
    return folder


def test_programs(spark, tiles, tmp_path):
    out = str(tmp_path)
    base = ["--tiles", str(tiles), "--output-dir", out]
    cli.run(spark, ["series", *base, "--smooth-method", "whittaker", "--metrics", "--regions", str(tiles / "park.json"), "--region-field", "n"])
    obs = spark.read.option("header", True).csv(f"{out}/observations")
    assert obs.count() == 60 and {r.region for r in obs.select("region").distinct().collect()} == {"a_b"} and obs.first().vi_count == "8"
    assert spark.read.option("header", True).csv(f"{out}/metrics").count() == 2
    combined = spark.read.option("header", True).csv(f"{out}/combined_metrics")
    assert combined.count() == 2 and combined.first().shapefile_stem == "park"
    cli.run(spark, ["cube", *base])
    cube = spark.read.parquet(f"{out}/cubes")
    assert cube.count() == 540 and {r.tile for r in cube.select("tile").distinct().collect()} == {"T02"}
    cli.run(spark, ["pixel", *base])
    assert spark.read.parquet(f"{out}/pixel_metrics/NDVI").count() == 9
    cli.run(spark, ["raster", *base, "--skip-per-doy", "--geotiff-dir", f"{out}/tif"])
    assert {f.name for f in (tmp_path / "tif").iterdir()} == {"NDVI_full_extent_per_year.tif", "NDVI_full_extent_per_month.tif"}
    assert spark.read.parquet(f"{out}/per_month").count() == 108


def test_tiles_of_one_system_apart_and_log(spark, tiles, tmp_path):
    out = str(tmp_path)
    cli.run(spark, ["cube", "--tiles", str(tiles), "--output-dir", out, "--no-merge-same-crs", "--log-dir", f"{out}/logs"])
    apart = spark.read.parquet(f"{out}/tile_cubes")
    assert {(r.tile, r["count"]) for r in apart.groupBy("tile").count().collect()} == {("T01", 540), ("T02", 540)}
    assert not list((tmp_path / "cubes").rglob("*.parquet"))
    (log,) = (tmp_path / "logs").iterdir()
    assert log.name.startswith("cube_") and "per_tile: 1 cubes" in log.read_text() and "done" in log.read_text()


def _place(spark, lat, lon, crs):
    x, y = projection.to_utm(F.lit(lat), F.lit(lon), crs)
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    return r.x, r.y


def test_regions_in_degrees_reach_tiles_in_metres(spark):
    import chronogrid.operators.regions as regions

    zone = "EPSG:32631"
    x0, y0 = _place(spark, 48.0, 2.0, zone)
    cells = spark.createDataFrame([("NDVI", "T1", zone, y0 + 30.0 * i, x0 + 30.0 * j, 0.5) for i in range(-20, 21) for j in range(-20, 21)], "vi string, tile string, crs string, y double, x double, value double")
    d = 0.002
    ring = [[2.0 - d, 48.0 - d], [2.0 + d, 48.0 - d], [2.0 + d, 48.0 + d], [2.0 - d, 48.0 + d], [2.0 - d, 48.0 - d]]
    shapes = spark.createDataFrame([("r", [[ring]], [ring], "f")], "region string, polygons array<array<array<array<double>>>>, rings array<array<array<double>>>, shapefile_stem string")
    got = {(r.y, r.x) for r in regions.clip_to(cells.withColumn("region", F.lit(None).cast("string")), [(shapes, "EPSG:4326")]).collect()}
    # A degree of latitude is some 111.2 km here, one of longitude 74.6 km: the meridians' tilt is under half a metre.
    want = {(y0 + 30.0 * i, x0 + 30.0 * j) for i in range(-20, 21) for j in range(-20, 21) if abs(30 * i) <= d * 111_200 + 15 and abs(30 * j) <= d * 74_600 + 15}
    assert len(got ^ want) <= 0.05 * len(want) and len(want) > 100


def test_minority_system_is_resampled(spark):
    from chronogrid.operators import cube

    west, east = "EPSG:32631", "EPSG:32632"
    # A field linear in degrees about the border of the zones at 6 degrees east, which bilinear resampling keeps.
    field = lambda lat, lon: 0.3 + 10 * (lat - 48.0) + 20 * (lon - 6.0)
    frames = []
    for tile, crs, n in (("T1", west, 30), ("T2", east, 20)):
        x0, y0 = (round(c / 30) * 30.0 for c in _place(spark, 48.0, 6.0, crs))
        at = spark.range(-n, n + 1).select((F.lit(y0) + 30.0 * F.col("id")).alias("y")).crossJoin(spark.range(-n, n + 1).select((F.lit(x0) + 30.0 * F.col("id")).alias("x")))
        lat, lon = projection.from_utm(F.col("x"), F.col("y"), crs)
        frames.append(at.select(F.lit("NDVI").alias("vi"), F.lit("r").alias("region"), F.lit(tile).alias("tile"), F.lit(crs).alias("crs"), "y", "x", F.lit(dt.date(2020, 1, 1)).alias("date"), field(lat, lon).alias("value")))
    df = frames[0].unionByName(frames[1])
    tiles = cube.tile_extents(df)
    plans = cube.merge_plans(tiles)
    plan = plans.first()
    assert (plan.strategy, plan.target, plan.n_tiles, plan.n_crs) == ("reproject", west, 2, 2)
    assert cube.merge_plans(tiles, merge_cross=False).first().strategy == "per_tile"
    assert cube.colliding_lines(df, plans).isEmpty()
    lat, lon = projection.from_utm(F.col("x"), F.col("y"), west)
    merged = cube.merge(df, tiles, plans).withColumns({"want": field(lat, lon), "off": F.abs((F.col("y") - plan.ref_y) / 30 % 1)}).toPandas()
    moved = merged[merged.tile == "T2"]
    # T2 wins where it reaches: 41 x 41 cells, turned by some 4.5 degrees; all places are on the grid and none occurs twice.
    assert abs(len(moved) - 41 * 41) < 60 and len(merged) == 61 * 61 and not merged.duplicated(["y", "x"]).any() and merged.off.max() == 0
    # A cell half outside has only its inner neighbours' values: at most half a cell's slope off.
    error = (moved["value"] - moved["want"]).abs()
    assert error.median() < 1e-5 and error.max() < 0.02
    about = cube.describe(tiles, plans).first()
    assert about.tiles == ["T1", "T2"] and about.resampled == ["T2"] and about.crs == west


def test_lines_that_collide(spark):
    from chronogrid.operators import cube

    rows = [("NDVI", "r", "T1", None, y, 0.0) for y in (0.0, 30.0, 40.0)]
    df = spark.createDataFrame(rows, "vi string, region string, tile string, crs string, y double, x double")
    plans = cube.merge_plans(cube.tile_extents(df))
    assert [(r.axis, r.line) for r in cube.colliding_lines(df, plans).collect()] == [("y", 40.0)]
