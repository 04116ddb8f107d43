"""Percentile rasters by year, month and day of year, and their geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregate import percentiles
from .filters import KEYS

PLACE = ["y", "x"]


def _spread(df: DataFrame, by: list[str], value: str) -> DataFrame:
    out = df.groupBy(*by).agg(percentiles(value))
    p = F.col("percentiles")
    return out.select(*by, p[0].alias("median"), p[1].alias("p05"), p[2].alias("p95"))


def per_year(df: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    return _spread(df.withColumn("year", F.year("date")), [*keys, *PLACE, "year"], value)


def per_month(df: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Percentiles of each year's month, then their plain mean over the years."""
    first = _spread(df.withColumns({"year": F.year("date"), "month": F.month("date")}), [*keys, *PLACE, "year", "month"], value)
    return first.groupBy(*keys, *PLACE, "month").agg(*[F.avg(c).alias(c) for c in ("median", "p05", "p95")])


def per_doy(df: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Pooled over years; day 366 counts as 365."""
    return _spread(df.withColumn("doy", F.least(F.dayofyear("date"), F.lit(365))), [*keys, *PLACE, "doy"], value)


def dense(bands: DataFrame, period: str, periods: list[int], keys: list[str] = KEYS) -> DataFrame:
    """Every period for every place, nulls where there was nothing; periods are at most 365."""
    places = bands.select(*keys, *PLACE).distinct().withColumn(period, F.explode(F.array(*[F.lit(p) for p in periods])))
    return places.join(bands, [*keys, *PLACE, period], "left")


def geotransform(df: DataFrame, keys: list[str] = KEYS, fallback: float = 30.0) -> DataFrame:
    """North-west corner and cell size: from the first spacing of either axis, half a cell off the first centre."""
    out = None
    for axis, order in (("x", F.col("x").asc()), ("y", F.col("y").desc())):
        from pyspark.sql import Window

        ranked = df.select(*keys, axis).distinct().withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("__r <= 2")
        part = ranked.groupBy(*keys).agg(F.max(F.when(F.col("__r") == 1, F.col(axis))).alias(f"__{axis}0"), F.max(F.when(F.col("__r") == 2, F.col(axis))).alias(f"__{axis}1"))
        out = part if out is None else out.join(part, keys)
    dx = F.coalesce(F.col("__x1") - F.col("__x0"), F.lit(fallback))
    dy = F.coalesce(F.col("__y1") - F.col("__y0"), F.lit(-fallback))
    return out.select(*keys, (F.col("__x0") - dx / 2).alias("west"), (F.col("__y0") - dy / 2).alias("north"), dx.alias("dx"), dy.alias("dy"))
