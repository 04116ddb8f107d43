"""Yearly metrics of a smoothed daily curve.

Everything but the peaks is built from windows and aggregates that share the exchange on the series' keys.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from .aggregate import coefficient_of_variation
from .filters import KEYS

#: Amplitude under which a curve counts as flat.
FLAT = 1e-6


def season_label(date: str = "date", start_doy: int = 1) -> Column:
    """'2022', or '2022-2023' where a year starts after 1 January; the raw day of year decides."""
    if start_doy == 1:
        return F.year(date).cast("string")
    first = F.when(F.dayofyear(date) >= start_doy, F.year(date)).otherwise(F.year(date) - 1)
    return F.concat_ws("-", first.cast("string"), (first + 1).cast("string"))


def seasons(smoothed: DataFrame, start_doy: int = 1) -> DataFrame:
    return smoothed.withColumn("year_label", season_label("date", start_doy))


def curve_points(frame: DataFrame, keys: list[str], threshold: float, value: str) -> DataFrame:
    """Each day with its season's low, high, peak and trough (first of ties), and first and last day over the threshold
    overall and on either side of the peak."""
    w = Window.partitionBy(*keys)
    y, day = F.col(value), F.unix_date("date")
    out = frame.where(y.isNotNull()).withColumns({"__lo": F.min(y).over(w), "__hi": F.max(y).over(w), "__top": F.max(F.struct(y.alias("y"), (-day).alias("d"), "date")).over(w), "__low": F.min(F.struct(y.alias("y"), day.alias("d"), "date")).over(w)})
    amplitude = F.col("__hi") - F.col("__lo")
    above = (amplitude >= FLAT) & (y >= F.col("__lo") + threshold * amplitude)
    out = out.withColumns({"__pos": F.col("__top.date"), "__trough": F.col("__low.date"), "__above": above}).drop("__top", "__low")
    on = F.when(F.col("__above"), F.col("date"))
    return out.withColumns({
        "__sos": F.min(F.when(F.col("date") <= F.col("__pos"), on)).over(w),
        "__eos": F.max(F.when(F.col("date") >= F.col("__pos"), on)).over(w),
        "__n_above": F.count_if("__above").over(w),
        "__before": F.lag(value).over(w.orderBy("date")),
    })


def yearly_metrics(smoothed: DataFrame, threshold: float = 0.20, start_doy: int = 1, min_obs: int = 5, keys: list[str] = KEYS, value: str = "vi_smooth") -> DataFrame:
    """The metrics of every season with ``min_obs`` observations at least, but for the peaks'."""
    by = [*keys, "year_label"]
    points = curve_points(seasons(smoothed, start_doy), by, threshold, value)
    y = F.col(value)
    inside = F.when((F.col("date") > F.col("__sos")) & (F.col("date") <= F.col("__eos")), (y + F.col("__before")) / 2)
    at = lambda d: F.max(F.when(F.col("date") == F.col(d), y))
    fixed = ["__lo", "__hi", "__pos", "__trough", "__sos", "__eos", "__n_above"]
    one = points.groupBy(*by).agg(*[F.first(c).alias(c) for c in fixed], F.sum(inside).alias("__ivi"), at("__sos").alias("__ys"), at("__eos").alias("__ye"), F.count_if(F.col("vi_count") > 0).alias("__n"))
    span = lambda b, a: F.nullif(F.datediff(b, a), F.lit(0))
    return one.where(F.col("__n") >= min_obs).select(
        *by,
        F.col("__sos").alias("sos_date"),
        F.dayofyear("__sos").alias("sos_doy"),
        F.col("__pos").alias("pos_date"),
        F.dayofyear("__pos").alias("pos_doy"),
        F.col("__hi").alias("pos_value"),
        F.col("__eos").alias("eos_date"),
        F.dayofyear("__eos").alias("eos_doy"),
        F.datediff("__eos", "__sos").cast("double").alias("los_days"),
        F.when(F.col("__sos").isNotNull(), F.coalesce("__ivi", F.lit(0.0))).alias("ivi"),
        ((F.col("__hi") - F.col("__ys")) / span("__pos", "__sos")).alias("greening_rate"),
        ((F.col("__ye") - F.col("__hi")) / span("__eos", "__pos")).alias("senescence_rate"),
        F.col("__lo").alias("floor_ndvi"),
        F.col("__hi").alias("ceiling_ndvi"),
        F.when(F.col("__n_above") >= 2, F.datediff("__eos", "__sos").cast("double")).alias("season_length_days"),
        F.when(F.col("__trough") < F.col("__pos"), (F.col("__hi") - F.col("__lo")) / F.datediff("__pos", "__trough")).alias("greenup_rate"),
    )


def region_cv(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    return series.groupBy(*keys).agg(coefficient_of_variation("vi_raw").alias("cv"))


def peak_metrics(smoothed: DataFrame, prominence: float = 0.05, distance: int = 45, start_doy: int = 1, keys: list[str] = KEYS, value: str = "vi_smooth") -> DataFrame:
    """n_peaks, peak_separation_days, relative_peak_amplitude, valley_depth by season; a group is one year's days."""
    by = [*keys, "year_label"]

    def run(season: pd.DataFrame) -> pd.DataFrame:
        season = season.sort_values("date")
        day = pd.to_datetime(season["date"]).to_numpy().astype("datetime64[D]").astype(np.int64)
        found = kernels.bimodality(season["y"].to_numpy(float), day, prominence, distance)
        return pd.DataFrame([[*season[by].iloc[0], *found]], columns=[*by, "n_peaks", "peak_separation_days", "relative_peak_amplitude", "valley_depth"])

    own = seasons(smoothed, start_doy).where(F.col(value).isNotNull()).select(*by, "date", F.col(value).cast("double").alias("y"))
    return own.groupBy(*by).applyInPandas(run, ", ".join(f"{k} string" for k in by) + ", n_peaks long, peak_separation_days double, relative_peak_amplitude double, valley_depth double")


def all_metrics(smoothed: DataFrame, threshold: float = 0.20, start_doy: int = 1, min_obs: int = 5, prominence: float = 0.05, distance: int = 45, keys: list[str] = KEYS) -> DataFrame:
    """The 23 columns of the metrics table."""
    by = [*keys, "year_label"]
    base = yearly_metrics(smoothed, threshold, start_doy, min_obs, keys)
    return base.join(peak_metrics(smoothed, prominence, distance, start_doy, keys), by, "left").join(region_cv(smoothed, keys), keys)
