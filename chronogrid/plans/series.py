"""The regional program as one lazy plan over every index and region."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import aggregate, filters, metrics, sampling, smooth
from ..params import Params


def regional_series(observations: DataFrame, params: Params, pixels: DataFrame | None = None) -> DataFrame:
    """Filtered, aggregated, daily and smoothed series."""
    dated = filters.with_date(filters.date_range(observations.where(observations["vi"].isin(*params.vis)), params.start_date, params.end_date))
    ok = filters.valid_ranges(dated, {v: params.valid_range(v) for v in params.vis})
    if params.sample_pixels or params.min_value_mean is not None or params.min_quality_frac > 0:
        from pyspark.sql import functions as F

        length = dated.groupBy("vi", "region").agg(F.countDistinct("time").alias("n_time"))
        chosen = sampling.eligible_pixels(aggregate.pixel_stats(ok), length, params.min_value_mean, params.min_quality_frac)
        if params.sample_pixels:
            chosen = sampling.sample_pixels(chosen, params.sample_pixels, params.random_seed or 0)
        ok = sampling.at_pixels(ok, chosen)
    series = aggregate.spatial_median(ok) if params.use_median else aggregate.spatial_mean(ok, None if params.datacubes else aggregate.time_axis(dated))
    enough = filters.min_observations(series, params.min_valid_obs)
    return smooth.smooth(smooth.daily(enough), params.smooth_method, params.smooth_window, params.smooth_polyorder, params.smooth_lambda, params.harmonics)


def regional_metrics(smoothed: DataFrame, params: Params) -> DataFrame:
    return metrics.all_metrics(smoothed, params.sos_threshold, params.year_start_doy, params.min_valid_obs_per_year, params.peak_prominence, params.peak_min_distance_days)
