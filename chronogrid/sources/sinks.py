"""Writing results: partitioned CSV and Parquet, combined tables, band streams."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.filters import KEYS


def observation_rows(series: DataFrame, smoothed: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """Dates with observations, with the smoothed value where there is one."""
    out = series.where(F.col("vi_count") > 0).select(*keys, "date", "vi_raw", "vi_count", "vi_std")
    return out if smoothed is None else out.join(smoothed.select(*keys, "date", "vi_smooth"), [*keys, "date"], "left")


def combined_rows(rows: DataFrame, regions: DataFrame, order: str = "date") -> DataFrame:
    """Rows of the region files that have several regions, with the file's stem, in order."""
    many = regions.groupBy("shapefile_stem").agg(F.countDistinct("region").alias("k")).where("k > 1").select("shapefile_stem")
    return rows.join(regions.select("region", "shapefile_stem").join(many, "shapefile_stem"), "region").orderBy("region", order)


def combined_metrics(metrics: DataFrame, labels: DataFrame) -> DataFrame:
    """Metrics of the labelled regions, in order."""
    return metrics.join(labels.select("region").distinct(), "region", "left_semi").orderBy("region", "year_label")


def write_csv(df: DataFrame, path: str, by: list[str] = KEYS) -> None:
    dated = df.withColumns({f.name: F.date_format(f.name, "yyyy-MM-dd") for f in df.schema.fields if f.dataType.typeName() == "date"})
    dated.write.mode("overwrite").partitionBy(*by).option("header", "true").csv(path)


def write_cube(df: DataFrame, path: str, by: list[str] = KEYS) -> None:
    """Parquet in time order within each index and region, so that date ranges skip row groups.

    Ranges of dates and lines, not regions, are what tasks get: one region may hold most of the rows.
    """
    df.repartitionByRange(*by, "date", "y").sortWithinPartitions(*by, "date", "y", "x").write.mode("overwrite").partitionBy(*by).parquet(path)


def output_folder(base: str, region: str | None, stem: str | None = None, split: bool = False, cube: bool = False) -> str:
    """Where a region's files go: by region for cubes, else by region file and, if split, region."""
    if cube:
        return f"{base}/{region}"
    if stem is None:
        return base
    return f"{base}/{stem}/{region}" if split else f"{base}/{stem}"


def bands(df: DataFrame, order: list[str]) -> Iterator:
    """Rows in band order, a partition at a time: what a raster writer pulls."""
    return df.orderBy(*order).toLocalIterator(prefetchPartitions=True)
