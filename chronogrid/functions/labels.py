"""Labels and names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sanitize(label: str | Column) -> Column:
    """Anything but word characters and hyphens becomes '_'; outer '_' go; nothing left is 'region'."""
    c = F.col(label) if isinstance(label, str) else label
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(c, r"(?U)[^\w\-]", "_"), F.lit("_")), F.lit("")), F.lit("region"))


def collisions(df: DataFrame, raw: str) -> DataFrame:
    """Labels that more than one raw value would get."""
    return df.where(F.col(raw).isNotNull()).withColumn("label", sanitize(raw)).groupBy("label").agg(F.countDistinct(raw).alias("n_values")).where("n_values > 1")


def band_name(kind: str, period: Column, statistic: Column) -> Column:
    """year2001_median, month03_p05, doy007_p95."""
    form = {"year": "year%d_%s", "month": "month%02d_%s", "doy": "doy%03d_%s"}[kind]
    return F.format_string(form, period, statistic)
