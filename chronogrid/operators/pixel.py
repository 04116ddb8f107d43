"""Nineteen multi-year metrics of every pixel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from .filters import KEYS

#: The names of the bands, in order.
BANDS = ("peak_ndvi_mean", "peak_ndvi_std", "peak_doy_mean", "peak_doy_std", "integrated_ndvi_mean", "integrated_ndvi_std", "greenup_rate_mean", "greenup_rate_std", "floor_ndvi_mean", "ceiling_ndvi_mean", "season_length_mean", "season_length_std", "cv", "interannual_peak_range", "interannual_peak_std", "n_peaks_mean", "peak_separation_mean", "relative_peak_amplitude_mean", "valley_depth_mean")
#: Shortest year that counts, in days.
SHORTEST = 30


#: The quantities of one year, and the bands that are their means and deviations over years.
QUANTITIES = ("peak", "doy", "integral", "greenup", "floor", "season", "n", "apart", "ratio", "valley")


def year_quantities(y: np.ndarray, doy: np.ndarray, prominence: float, distance: int, threshold: float) -> dict[str, np.ndarray]:
    """The annual quantities of one year's daily values, (pixels, days); nan where one isn't defined."""
    at = np.arange(len(y))
    top, low = y.argmax(axis=1), y.argmin(axis=1)
    high, floor = y[at, top], y[at, low]
    amplitude = high - floor
    above = (y >= (floor + threshold * amplitude)[:, None]) & (amplitude >= 1e-6)[:, None]
    season = (above.shape[1] - 1 - above[:, ::-1].argmax(axis=1) - above.argmax(axis=1)).astype(float)
    rising = low < top
    out = {"peak": high, "doy": doy[top].astype(float), "integral": y.sum(axis=1) - (y[:, 0] + y[:, -1]) / 2, "floor": floor}
    out["greenup"] = np.where(rising, amplitude / np.where(rising, top - low, 1), np.nan)
    out["season"] = np.where(above.sum(axis=1) >= 2, season, np.nan)
    two = np.array([kernels.bimodality(row, doy, prominence, distance) for row in y], float).reshape(len(y), 4)
    return out | dict(zip(("n", "apart", "ratio", "valley"), two.T))


def _over_years(found: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Bands of quantities given as (pixels, years), nan where a year doesn't count or lacks one."""
    n = {k: np.isfinite(v).sum(axis=1) for k, v in found.items()}
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = {k: np.nansum(v, axis=1) / n[k] for k, v in found.items()}
        std = {k: np.sqrt(np.nansum((v - mean[k][:, None]) ** 2, axis=1) / n[k]) for k, v in found.items()}
    band = {}
    for name, k in (("peak_ndvi", "peak"), ("peak_doy", "doy"), ("integrated_ndvi", "integral"), ("greenup_rate", "greenup"), ("season_length", "season")):
        band[f"{name}_mean"], band[f"{name}_std"] = mean[k], std[k]
    for name, k in (("floor_ndvi", "floor"), ("ceiling_ndvi", "peak"), ("n_peaks", "n"), ("peak_separation", "apart"), ("relative_peak_amplitude", "ratio"), ("valley_depth", "valley")):
        band[f"{name}_mean"] = mean[k]
    peak = found["peak"]
    some = n["peak"] > 0
    band["interannual_peak_range"] = np.where(some, np.nanmax(np.where(some[:, None], peak, 0), axis=1, initial=-np.inf) - np.nanmin(np.where(some[:, None], peak, 0), axis=1, initial=np.inf), np.nan)
    band["interannual_peak_std"] = std["peak"]
    return band


def pixel_metrics(df: DataFrame, lam: float = 100.0, min_obs: int = 20, min_year_obs: int = 5, prominence: float = 0.05, distance: int = 45, threshold: float = 0.20, low: float = -0.1, high: float = 1.0, keys: list[str] = KEYS, block: int = 512, value: str = "value") -> DataFrame:
    """One row a pixel with the nineteen bands (null where undefined, all of them for a pixel without valid values).

    Values of a day are averaged, the daily axis is the whole cube's, and a block of pixels goes through
    the smoother and the yearly quantities as one array.  Blocks are dealt by hash; their number follows the
    number of pixels of an index and region.
    """
    own_value = F.when(F.col(value).between(low, high), F.col(value))
    cube = df.groupBy(*keys).agg(F.min("date").alias("first"), F.max("date").alias("last"), F.ceil(F.approx_count_distinct(F.struct("y", "x")) / block).alias("blocks"))
    raw = df.select(*keys, "y", "x", "date", own_value.alias("v")).groupBy(*keys, "y", "x", "date").agg(F.avg("v").alias("v"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.count("v").alias("n"))
    day = F.when(F.col("n") > 0, F.struct("date", "v"))
    series = raw.groupBy(*keys, "y", "x").agg(F.sort_array(F.collect_list(day)).alias("days"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    own = series.join(F.broadcast(cube), keys).select(*keys, "y", "x", "first", "last", F.transform("days", lambda d: F.datediff(d["date"], F.col("first"))).alias("at"), F.transform("days", lambda d: d["v"]).alias("v"), "n", "s", "q", F.pmod(F.xxhash64("y", "x"), F.greatest("blocks", F.lit(1))).alias("block"))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        days = pd.date_range(pd.Timestamp(part["first"].iloc[0]), pd.Timestamp(part["last"].iloc[0]), freq="D")
        y, w = np.zeros((len(part), len(days))), np.zeros((len(part), len(days)))
        for i, (at, v) in enumerate(zip(part["at"], part["v"])):
            y[i, at], w[i, at] = v, 1.0
        out = np.full((len(part), len(BANDS)), np.nan)
        n = part["n"].to_numpy(float)
        enough = np.flatnonzero(n >= min_obs)
        if len(enough):
            smooth = kernels.whittaker(y[enough], w[enough], lam)
            sound = np.isfinite(smooth).all(axis=1)
            enough, smooth, w = enough[sound], np.clip(smooth[sound], low, high), w[enough[sound]]
        if len(enough):
            years, doy = days.year.to_numpy(), days.dayofyear.to_numpy().astype(np.int64)
            found: dict[str, list[np.ndarray]] = {k: [] for k in QUANTITIES}
            for year in np.unique(years):
                inside = np.flatnonzero(years == year)
                counts = np.flatnonzero(w[:, inside].sum(axis=1) >= min_year_obs) if len(inside) >= SHORTEST else np.zeros(0, np.int64)
                own = year_quantities(smooth[np.ix_(counts, inside)], doy[inside], prominence, distance, threshold) if len(counts) else {}
                for k in QUANTITIES:
                    column = np.full(len(smooth), np.nan)
                    if len(counts):
                        column[counts] = own[k]
                    found[k].append(column)
            band = _over_years({k: np.stack(v, axis=1) for k, v in found.items()})
            mean = part["s"].to_numpy(float)[enough] / n[enough]
            spread = np.sqrt(np.maximum(part["q"].to_numpy(float)[enough] / n[enough] - mean * mean, 0))
            band["cv"] = np.where(mean > 0, spread / np.where(mean > 0, mean, 1), np.nan)
            out[enough] = np.stack([band[b] for b in BANDS], axis=1)
        return pd.concat([part[[*keys, "y", "x"]].reset_index(drop=True), pd.DataFrame(out, columns=list(BANDS))], axis=1)

    schema = T.StructType([*[T.StructField(k, T.StringType()) for k in keys], T.StructField("y", T.DoubleType()), T.StructField("x", T.DoubleType()), *[T.StructField(b, T.DoubleType()) for b in BANDS]])
    out = own.groupBy(*keys, "block").applyInPandas(run, schema)
    return out.select(*keys, "y", "x", *[F.when(~F.isnan(b), F.col(b)).alias(b) for b in BANDS])


def pixel_cv(df: DataFrame, keys: list[str] = KEYS, value: str = "value") -> DataFrame:
    """Population deviation over mean of every pixel's values."""
    m = F.avg(value)
    return df.groupBy(*keys, "y", "x").agg(F.when(m > 0, F.stddev_pop(value) / m).alias("cv"))
