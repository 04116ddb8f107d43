"""Merging tiles: same-day duplicates, grid snap, overlap, coordinate systems."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregate import dominant


def same_day_first(df: DataFrame, value: str = "value") -> DataFrame:
    """Of a tile's values at one place and day, the first that isn't null in source order."""
    return df.where(F.col(value).isNotNull()).groupBy("vi", "tile", "y", "x", "date").agg(F.min(F.struct("seq", F.col(value).alias("v"))).alias("__m")).select("vi", "tile", "y", "x", "date", F.col("__m.v").alias(value))


def last_tile_wins(df: DataFrame, value: str = "value", keys: tuple[str, ...] = ("vi", "region")) -> DataFrame:
    """Where tiles overlap, the value of the last tile by name that has one."""
    best = F.max(F.struct("tile", "seq", F.col(value).alias("v"))).alias("__m")
    return df.where(F.col(value).isNotNull()).groupBy(*keys, "y", "x", "date").agg(best).select(*keys, "y", "x", "date", F.col("__m.tile").alias("tile"), F.col("__m.v").alias(value))


def snap(coordinate: str, reference: float | Column, step: float = 30.0) -> Column:
    """The nearest grid line, halves to the even one."""
    ref = F.lit(reference) if isinstance(reference, (int, float)) else reference
    return F.bround((F.col(coordinate) - ref) / step) * step + ref


def axes(df: DataFrame, axis: str, keys: tuple[str, ...] = ("vi", "region")) -> DataFrame:
    """The distinct lines of an axis over all tiles, numbered: y from the north, others ascending."""
    order = F.col(axis).desc() if axis == "y" else F.col(axis)
    return df.select(*keys, axis).distinct().withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)


def gaps(df: DataFrame, axis: str, step: float = 30.0, keys: tuple[str, ...] = ("vi", "region")) -> DataFrame:
    """Axis lines that aren't whole steps from the line before; a sound mosaic has none."""
    lines = df.select(*keys, axis).distinct().withColumn("__d", F.col(axis) - F.lag(axis).over(Window.partitionBy(*keys).orderBy(axis)))
    return lines.where(F.abs(F.col("__d") / step - F.bround(F.col("__d") / step)) > 1e-6).select(*keys, axis)


def crs_key(epsg: str, name: str, wkt: str) -> Column:
    """What groups coordinate systems: the code, else the name, else the whole text."""
    return F.coalesce(F.concat(F.lit("EPSG:"), F.col(epsg).cast("string")), F.nullif(F.col(name), F.lit("")), F.col(wkt))


def dominant_crs(df: DataFrame, group: str = "crs") -> DataFrame:
    return dominant(df, group)


def bilinear(df: DataFrame, targets: DataFrame, step: float = 30.0, value: str = "value", keys: tuple[str, ...] = ()) -> DataFrame:
    """Values at ``targets`` (ty, tx on the source grid, row keys y, x) from the four cells around each.

    Null cells leave their weight to the others.  One equi-join on the four neighbours' places and on
    ``keys``, columns of both tables.
    """
    fy, fx = F.floor(F.col("ty") / step) * step, F.floor(F.col("tx") / step) * step
    wy, wx = (F.col("ty") - fy) / step, (F.col("tx") - fx) / step
    corner = lambda dy, dx, w: F.struct((fy + dy * step).alias("cy"), (fx + dx * step).alias("cx"), w.alias("w"))
    near = targets.withColumn("__c", F.explode(F.array(corner(0, 0, (1 - wy) * (1 - wx)), corner(0, 1, (1 - wy) * wx), corner(1, 0, wy * (1 - wx)), corner(1, 1, wy * wx)))).select(*keys, "y", "x", "__c.*").where("w > 0")
    source = df.select(F.col("y").alias("cy"), F.col("x").alias("cx"), *dict.fromkeys(["vi", *keys]), "date", value)
    return near.join(source, [*keys, "cy", "cx"]).groupBy(*dict.fromkeys(["vi", *keys]), "date", "y", "x").agg((F.sum(F.col("w") * F.col(value)) / F.sum(F.when(F.col(value).isNotNull(), F.col("w")))).alias(value))
