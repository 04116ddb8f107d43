"""Regions: GeoJSON reading, labels, bounding boxes, and cells that touch a polygon."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import collisions, sanitize
from ..functions.projection import from_utm, to_utm

#: Most bytes of region geometry that may be broadcast; more are joined by key.
BROADCAST_LIMIT = 32 << 20
#: How GeoJSON files name degrees on WGS 84; a file without a name is in these.
DEGREES = ("EPSG:4326", "CRS84")


def read_geojson(spark: SparkSession, path: str, field: str | None = None, stem: str = "regions") -> DataFrame:
    """region, polygons (arrays of rings of [x, y]), rings (of all of them), shapefile_stem: one row a region.

    Without ``field`` all features are one region named by ``stem``; with it they are split by its
    non-null values, and values whose labels collide fail.
    """
    # Coordinates as text: polygons and multipolygons of one file are nested to different depths.
    shape = "features array<struct<geometry: struct<type: string, coordinates: string>, properties: map<string, string>>>"
    raw = spark.read.schema(shape).option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
    geometry = F.col("f.geometry")
    kind, coordinates = geometry["type"], geometry["coordinates"]
    polygon = F.from_json(coordinates, "array<array<array<double>>>")
    polygons = F.when(kind == "Polygon", F.array(polygon)).otherwise(F.from_json(coordinates, "array<array<array<array<double>>>>"))
    if field is None:
        out = raw.select(sanitize(F.lit(stem)).alias("region"), polygons.alias("polygons"))
    else:
        value = F.col("f.properties")[field]
        named = raw.where(value.isNotNull()).select(value.alias("raw"), polygons.alias("polygons"))
        if clash := [r.label for r in collisions(named, "raw").limit(20).collect()]:
            raise ValueError(f"values of {field} that get the same label: {clash}")
        out = named.select(sanitize("raw").alias("region"), "polygons")
    whole = out.groupBy("region").agg(F.flatten(F.collect_list("polygons")).alias("polygons"))
    return whole.withColumns({"rings": F.flatten("polygons"), "shapefile_stem": F.lit(stem)})


def geojson_crs(spark: SparkSession, path: str) -> str:
    """'EPSG:4326' or the system that the file's member ``crs`` names, as 'EPSG:n'."""
    named = spark.read.schema("crs struct<properties: struct<name: string>>").option("multiLine", "true").json(path).select("crs.properties.name").first()
    name = (named and named[0]) or DEGREES[0]
    code = "EPSG:" + name.rsplit(":", 1)[-1] if "EPSG" in name else name.rsplit(":", 1)[-1]
    return DEGREES[0] if code in DEGREES else code


def to_crs(shapes: DataFrame, source: str, target: str | None) -> DataFrame:
    """Regions with their corners in the target's coordinates; as they are where it is unknown or the same."""
    if not target or source == target:
        return shapes

    def moved(p):
        lat, lon = (p[1], p[0]) if source == DEGREES[0] else from_utm(p[0], p[1], source)
        return F.array(lon, lat) if target == DEGREES[0] else F.array(*to_utm(lat, lon, target))

    polygons = F.transform("polygons", lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, moved)))
    return shapes.withColumn("polygons", polygons).withColumn("rings", F.flatten("polygons"))


def enumerate_regions(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def bounding_boxes(regions: DataFrame) -> DataFrame:
    points = F.flatten("rings")
    along = lambda i: F.transform(points, lambda p: p[i])
    return regions.select("region", F.array_min(along(0)).alias("min_x"), F.array_max(along(0)).alias("max_x"), F.array_min(along(1)).alias("min_y"), F.array_max(along(1)).alias("max_y"))


def overlapping(tiles: DataFrame, boxes: DataFrame) -> DataFrame:
    """Pairs of tile extents and region boxes that overlap; edges count."""
    a, b = tiles.alias("a"), boxes.alias("b")
    cond = (F.col("a.min_x") <= F.col("b.max_x")) & (F.col("a.max_x") >= F.col("b.min_x")) & (F.col("a.min_y") <= F.col("b.max_y")) & (F.col("a.max_y") >= F.col("b.min_y"))
    return a.join(b, cond).select("a.tile", "b.region")


def touches(x: np.ndarray, y: np.ndarray, rings: list[list[list[float]]], size: float) -> np.ndarray:
    """Whether square cells around the centres touch the polygon (even-odd over its rings)."""
    half, hit, inside = size / 2, np.zeros(len(x), bool), np.zeros(len(x), bool)
    for ring in rings:
        pts = np.asarray(ring, float)
        for (x0, y0), (x1, y1) in zip(pts, np.roll(pts, -1, axis=0)):
            if (x0, y0) == (x1, y1):
                continue
            if y0 != y1:
                crosses = (y0 > y) != (y1 > y)
                inside ^= crosses & (x < (x1 - x0) * (y - y0) / (y1 - y0) + x0)
            # The edge meets the cell: clip the segment to the square.
            lo, hi, ok = np.zeros(len(x)), np.ones(len(x)), np.ones(len(x), bool)
            for p, d, c in ((x0, x1 - x0, x), (y0, y1 - y0, y)):
                if d == 0:
                    ok &= np.abs(p - c) <= half
                else:
                    a, b = (c - half - p) / d, (c + half - p) / d
                    lo, hi = np.maximum(lo, np.minimum(a, b)), np.minimum(hi, np.maximum(a, b))
            hit |= ok & (lo <= hi)
    return hit | inside


def region_pixels(cells: DataFrame, regions: DataFrame, size: float = 30.0) -> DataFrame:
    """(region, y, x) of distinct cells that touch a region: any of its polygons, or its rings where it has no such column.

    The bounding box, a range predicate, leaves few cells; the exact test is a vectorised pass over those.
    Polygons travel once a task, and only while they are small.
    """
    spark = cells.sparkSession
    shapes = regions.select("region", (F.col("polygons") if "polygons" in regions.columns else F.array("rings")).alias("polygons"))
    # Measured where it lies, before any of it comes to the driver.
    size_of = F.aggregate(F.flatten("polygons"), F.lit(0).cast("long"), lambda n, ring: n + F.size(ring) * 16)
    if (shapes.agg(F.sum(size_of + 64).alias("n")).first().n or 0) > BROADCAST_LIMIT:
        raise ValueError("region geometry is too large for one pass; split the region table")
    shared = spark.sparkContext.broadcast({r.region: [[[list(p) for p in ring] for ring in polygon] for polygon in r.polygons] for r in shapes.collect()})
    half = size / 2
    near = cells.select("y", "x").distinct().join(F.broadcast(bounding_boxes(regions)), (F.col("x") >= F.col("min_x") - half) & (F.col("x") <= F.col("max_x") + half) & (F.col("y") >= F.col("min_y") - half) & (F.col("y") <= F.col("max_y") + half))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for region, part in batch.groupby("region"):
                x, y = part["x"].to_numpy(), part["y"].to_numpy()
                yield part[np.logical_or.reduce([touches(x, y, rings, size) for rings in shared.value[region]])]

    return near.select("region", "y", "x").mapInPandas(run, "region string, y double, x double")


def clip_to(df: DataFrame, files: list[tuple[DataFrame, str]], size: float = 30.0) -> DataFrame:
    """Observations in the regions of ``files``, pairs of regions and their system, taken to the system of each tile.

    There is a branch for each coordinate system of the observations, of which UTM bounds the number.
    """
    systems = [r.crs for r in df.select("crs").distinct().collect()]
    parts = []
    for crs in sorted(systems, key=lambda c: c or ""):
        here = df if len(systems) == 1 else df.where(F.col("crs").eqNullSafe(F.lit(crs)))
        shapes = enumerate_regions(*[to_crs(s, own, crs) for s, own in files])
        parts.append(clip(here, region_pixels(here, shapes, size)))
    return enumerate_regions(*parts) if parts else df.limit(0)


def clip(df: DataFrame, pixels: DataFrame) -> DataFrame:
    """Observations in regions: an equi-join on the place; a cell of two regions counts in both."""
    return df.drop("region").join(pixels, ["y", "x"])
