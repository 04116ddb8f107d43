"""The daily calendar and the smoothers over it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from .filters import KEYS


def daily(series: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One row a day from a series' first to its last date; days without one have vi_count 0."""
    span = series.groupBy(*keys).agg(F.min("date").alias("__a"), F.max("date").alias("__b"))
    days = span.select(*keys, F.explode(F.sequence("__a", "__b")).alias("date"))
    out = days.join(series, [*keys, "date"], "left")
    return out.withColumn("vi_count", F.coalesce("vi_count", F.lit(0))).withColumn("vi_daily", F.col("vi_raw"))


def _around(keys: list[str]) -> tuple:
    # Either frame runs from the start of its order: one that runs to the end is evaluated anew for every row.
    w, back = (Window.partitionBy(*keys).orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in ("date", F.col("date").desc()))
    at = F.when(F.col("vi_daily").isNotNull(), F.struct("date", F.col("vi_daily").alias("v")))
    before = F.last(at, ignorenulls=True).over(w)
    after = F.last(at, ignorenulls=True).over(back)
    return before, after


def linear(frame: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Straight lines in time between observations, by windows alone; with provenance flags."""
    before, after = _around(keys)
    out = frame.withColumns({"__p": before, "__n": after})
    share = F.datediff("date", "__p.date") / F.datediff("__n.date", "__p.date")
    value = F.when(F.col("__p.date") == F.col("__n.date"), F.col("vi_daily")).when(F.col("__p").isNotNull() & F.col("__n").isNotNull(), F.col("__p.v") + (F.col("__n.v") - F.col("__p.v")) * share)
    flag = F.when(F.col("vi_daily").isNotNull(), "observed").when(F.col("__p").isNotNull() & F.col("__n").isNotNull(), "interpolated").otherwise("extrapolated")
    return out.withColumn("vi_smooth", value).withColumn("vi_smooth_flag", flag).drop("__p", "__n")


def flags(frame: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """observed, interpolated (between observations) or extrapolated, by the span of a series' observations."""
    w = Window.partitionBy(*keys)
    seen = F.when(F.col("vi_daily").isNotNull(), F.col("date"))
    inside = F.col("date").between(F.min(seen).over(w), F.max(seen).over(w))
    return frame.withColumn("vi_smooth_flag", F.when(F.col("vi_daily").isNotNull(), "observed").when(inside, "interpolated").otherwise("extrapolated"))


def _kernel(method: str, window: int, order: int, lam: float, harmonics: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return {
        "savgol": lambda d, y: kernels.savgol_daily(d, y, window, order),
        "loess": lambda d, y: kernels.lowess_daily(d, y, window),
        "harmonic": lambda d, y: kernels.harmonic_daily(d, y, harmonics),
        "whittaker": lambda d, y: kernels.whittaker_daily(d, y, lam),
    }[method]


def smooth(frame: DataFrame, method: str = "savgol", window: int = 15, order: int = 3, lam: float = 100.0, harmonics: int = 3, keys: list[str] = KEYS) -> DataFrame:
    """A daily frame with vi_smooth and vi_smooth_flag.

    Linear is native; the others run one series at a time as a vectorised kernel.  A regional series has
    at most a few thousand days, so a group is small however many observations went into it.
    """
    if method == "none":
        return frame
    if method == "linear":
        return linear(frame, keys)
    kernel = _kernel(method, window, order, lam, harmonics)

    def run(series: pd.DataFrame) -> pd.DataFrame:
        series = series.sort_values("date")
        day = pd.to_datetime(series["date"]).to_numpy().astype("datetime64[D]").astype(np.int64)
        seen = series["vi_daily"].notna().to_numpy()
        out = np.full(len(series), np.nan)
        if seen.any():
            own = day[seen]
            value = kernel(own, series["vi_daily"].to_numpy(float)[seen])
            inside = (day >= own[0]) & (day <= own[-1])
            out[inside] = value[day[inside] - own[0]]
        return series.assign(vi_smooth=pd.Series(out, index=series.index).astype(object).where(~np.isnan(out), None).astype(float))

    schema = T.StructType([*frame.schema.fields, T.StructField("vi_smooth", T.DoubleType())])
    out = frame.groupBy(*keys).applyInPandas(run, schema)
    return flags(out.withColumn("vi_smooth", F.when(~F.isnan("vi_smooth"), F.col("vi_smooth"))), keys)


def flag_counts(smoothed: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    one = lambda f: F.count_if(F.col("vi_smooth_flag") == f).alias(f"n_{f}")
    return smoothed.groupBy(*keys).agg(one("observed"), one("interpolated"), one("extrapolated"))
