"""Choosing pixels: eligibility, a reproducible sample, and the semi-join on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import KEYS


def eligible_pixels(stats: DataFrame, axis_length: DataFrame, min_mean: float | None = None, min_fraction: float = 0.0, keys: list[str] = KEYS) -> DataFrame:
    """Pixels whose mean and share of valid time steps suffice; ``axis_length`` has n_time by key."""
    out = stats.join(axis_length, keys).withColumn("valid_fraction", F.col("n_valid") / F.col("n_time"))
    if min_mean is not None:
        out = out.where(F.col("mean") >= min_mean)
    return out.where(F.col("valid_fraction") >= min_fraction)


def sample_pixels(pixels: DataFrame, n: int, seed: int = 0, keys: list[str] = KEYS) -> DataFrame:
    """``n`` pixels of each key (all, if fewer), in the order of a seeded md5: the same on any cluster."""
    order = F.md5(F.concat_ws("_", F.lit(str(seed)), F.col("y").cast("long").cast("string"), F.col("x").cast("long").cast("string")))
    ranked = pixels.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(order, "y", "x")))
    return ranked.where(F.col("__r") <= n).select(*keys, "y", "x")


def at_pixels(df: DataFrame, pixels: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Observations at the pixels, places rounded as theirs; Spark chooses the join by their size."""
    here = df.withColumns({"__y": F.bround("y", 1), "__x": F.bround("x", 1)})
    there = pixels.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("y").alias("__py"), F.col("x").alias("__px"))
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__y") == F.col("__py"), F.col("__x") == F.col("__px")]
    return here.join(there, on, "left_semi").drop("__y", "__x")
