"""Named queries over the test tables, with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels
from ..operators import aggregate, climatology, cube, filters, metrics, mosaic, pixel, raster, sampling, smooth
from ..sources import sinks
from ..sources.observations import lineitem_observations

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
LOW, HIGH = 0.05, 0.95

_OBS = """
obs AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'NDVI' WHEN 'N' THEN 'EVI2' ELSE 'NIRv' END AS vi, n_name AS region, l_linestatus AS tile,
         l_orderkey * 10 + l_linenumber AS seq, l_shipdate AS time, CAST(l_shipdate AS DATE) AS date,
         l_suppkey * 30.0::DOUBLE AS y, l_linenumber * 30.0::DOUBLE AS x, l_quantity / 50.0::DOUBLE AS value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
), ok AS (SELECT * FROM obs WHERE value BETWEEN 0.05 AND 0.95)"""
_SERIES = (
    _OBS
    + """, series AS (
  SELECT vi, region, date, avg(value) AS vi_raw, count(value) AS vi_count, stddev_samp(value) AS vi_std FROM ok GROUP BY ALL
)"""
)
_DAILY = (
    _SERIES
    + """, span AS (SELECT vi, region, min(date) AS a, max(date) AS b FROM series GROUP BY ALL),
days AS (SELECT vi, region, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
daily AS (
  SELECT d.vi, d.region, d.date, s.vi_raw, coalesce(s.vi_count, 0) AS vi_count, s.vi_std, s.vi_raw AS vi_daily
  FROM days d LEFT JOIN series s USING (vi, region, date)
)"""
)
_LINEAR = (
    _DAILY
    + """, near AS (
  SELECT *, last_value(CASE WHEN vi_daily IS NOT NULL THEN date END IGNORE NULLS) OVER b AS pd, last_value(vi_daily IGNORE NULLS) OVER b AS pv,
         first_value(CASE WHEN vi_daily IS NOT NULL THEN date END IGNORE NULLS) OVER a AS nd, first_value(vi_daily IGNORE NULLS) OVER a AS nv
  FROM daily
  WINDOW b AS (PARTITION BY vi, region ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         a AS (PARTITION BY vi, region ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), curve AS (
  SELECT vi, region, date, vi_raw, vi_count, vi_std, vi_daily,
         CASE WHEN pd = nd THEN vi_daily ELSE pv + (nv - pv) * date_diff('day', pd, date) / date_diff('day', pd, nd) END AS vi_smooth,
         CASE WHEN vi_daily IS NOT NULL THEN 'observed' WHEN pd IS NOT NULL AND nd IS NOT NULL THEN 'interpolated' ELSE 'extrapolated' END AS vi_smooth_flag
  FROM near
)"""
)
_METRICS = (
    _LINEAR
    + """, season AS (SELECT *, CAST(year(date) AS VARCHAR) AS year_label, vi_smooth AS y FROM curve WHERE vi_smooth IS NOT NULL),
low AS (
  SELECT vi, region, year_label, min(y) AS lo, max(y) AS hi, arg_max(date, (y, -epoch(date))) AS pos, arg_min(date, (y, epoch(date))) AS trough,
         count(*) FILTER (vi_count > 0) AS n FROM season GROUP BY ALL
), point AS (
  SELECT s.*, l.lo, l.hi, l.pos, l.trough, l.n, l.hi - l.lo >= 1e-6 AND s.y >= l.lo + 0.2 * (l.hi - l.lo) AS above,
         lag(s.y) OVER (PARTITION BY s.vi, s.region, s.year_label ORDER BY s.date) AS before
  FROM season s JOIN low l USING (vi, region, year_label)
), ends AS (
  SELECT vi, region, year_label, min(date) FILTER (above AND date <= pos) AS sos, max(date) FILTER (above AND date >= pos) AS eos, count(*) FILTER (above) AS n_above
  FROM point GROUP BY ALL
), m AS (
  SELECT p.vi, p.region, p.year_label, any_value(sos) AS sos_date, any_value(pos) AS pos_date, any_value(eos) AS eos_date, any_value(hi) AS hi, any_value(lo) AS lo,
         any_value(trough) AS trough, any_value(n_above) AS n_above, any_value(n) AS n,
         sum((y + before) / 2) FILTER (date > sos AND date <= eos) AS area, max(y) FILTER (date = sos) AS ys, max(y) FILTER (date = eos) AS ye
  FROM point p JOIN ends USING (vi, region, year_label) GROUP BY ALL HAVING any_value(n) >= 5
), metric AS (
  SELECT vi, region, year_label, sos_date, dayofyear(sos_date)::INTEGER AS sos_doy, pos_date, dayofyear(pos_date)::INTEGER AS pos_doy, hi AS pos_value,
         eos_date, dayofyear(eos_date)::INTEGER AS eos_doy, date_diff('day', sos_date, eos_date)::DOUBLE AS los_days,
         CASE WHEN sos_date IS NOT NULL THEN coalesce(area, 0.0) END AS ivi,
         (hi - ys) / nullif(date_diff('day', sos_date, pos_date), 0) AS greening_rate,
         (ye - hi) / nullif(date_diff('day', pos_date, eos_date), 0) AS senescence_rate, lo AS floor_ndvi, hi AS ceiling_ndvi,
         CASE WHEN n_above >= 2 THEN date_diff('day', sos_date, eos_date)::DOUBLE END AS season_length_days,
         CASE WHEN trough < pos_date THEN (hi - lo) / date_diff('day', trough, pos_date) END AS greenup_rate
  FROM m
)"""
)


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of sums doesn't show."""
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"})


def _query(name: str, sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: _rounded(f(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return f

    return put


def _obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.with_date(lineitem_observations(spark, sf_dir))


def _ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.valid_range(_obs(spark, sf_dir), LOW, HIGH)


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.spatial_mean(_ok(spark, sf_dir))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smooth.daily(_series(spark, sf_dir))


def _curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smooth.linear(_daily(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.yearly_metrics(_curve(spark, sf_dir))


@_query("valid_range_filter", f"WITH {_OBS} SELECT vi, region, tile, seq, date, y, x, round(value, 6) AS value FROM ok")
def valid_range_filter(spark, sf_dir):
    return _ok(spark, sf_dir).select("vi", "region", "tile", "seq", "date", "y", "x", "value")


@_query("valid_range_mask", f"WITH {_OBS} SELECT vi, region, count(*) AS n_rows, count(CASE WHEN value BETWEEN 0.3 AND 0.6 THEN value END) AS n_valid, round(avg(CASE WHEN value BETWEEN 0.3 AND 0.6 THEN value END), 6) AS mean FROM obs GROUP BY ALL")
def valid_range_mask(spark, sf_dir):
    return filters.mask_range(_obs(spark, sf_dir), 0.3, 0.6).groupBy("vi", "region").agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_valid"), F.avg("value").alias("mean"))


@_query("date_range_filter", f"WITH {_OBS} SELECT vi, region, seq, date, round(value, 6) AS value FROM obs WHERE date BETWEEN DATE '1996-02-01' AND DATE '1997-01-31'")
def date_range_filter(spark, sf_dir):
    return filters.date_range(_obs(spark, sf_dir), "1996-02-01", "1997-01-31").select("vi", "region", "seq", "date", "value")


@_query("roi_mean_timeseries", f"WITH {_SERIES} SELECT vi, region, date, round(vi_raw, 6) AS vi_raw, vi_count, round(vi_std, 6) AS vi_std FROM series")
def roi_mean_timeseries(spark, sf_dir):
    return _series(spark, sf_dir)


@_query("roi_median_iqr", f"WITH {_OBS} SELECT vi, region, date, round(quantile_cont(value, 0.5), 6) AS vi_raw, count(*) AS vi_count, round(CASE WHEN count(*) > 1 THEN quantile_cont(value, 0.75) - quantile_cont(value, 0.25) END, 6) AS vi_std FROM ok GROUP BY ALL")
def roi_median_iqr(spark, sf_dir):
    return aggregate.spatial_median(_ok(spark, sf_dir))


@_query("tile_stats_pop", f"WITH {_OBS} SELECT vi, region, tile, date, round(avg(value), 6) AS vi_raw, count(*) AS vi_count, round(stddev_pop(value), 6) AS vi_std FROM ok GROUP BY ALL")
def tile_stats_pop(spark, sf_dir):
    return aggregate.tile_stats(_ok(spark, sf_dir), ("vi", "region", "tile", "date"))


@_query("tile_pooled_timeseries", f"WITH {_SERIES}, axis AS (SELECT DISTINCT vi, region, date FROM obs) SELECT a.vi, a.region, a.date, round(vi_raw, 6) AS vi_raw, coalesce(vi_count, 0) AS vi_count, round(vi_std, 6) AS vi_std FROM axis a LEFT JOIN series s USING (vi, region, date)")
def tile_pooled_timeseries(spark, sf_dir):
    obs = _obs(spark, sf_dir)
    return aggregate.spatial_mean(filters.valid_range(obs, LOW, HIGH), aggregate.time_axis(obs))


@_query("tile_run_stats", f"WITH {_OBS} SELECT vi, tile, count(DISTINCT date) AS n_dates, count(DISTINCT CASE WHEN value BETWEEN 0.05 AND 0.95 THEN date END) AS n_valid_dates, count(*) FILTER (value BETWEEN 0.05 AND 0.95) AS total_pixels FROM obs GROUP BY ALL")
def tile_run_stats(spark, sf_dir):
    return aggregate.run_stats(_obs(spark, sf_dir), ["vi", "tile"], LOW, HIGH)


_PIXELS = _OBS + ", pix AS (SELECT vi, region, y, x, sum(value) AS total, count(*) AS n_valid, avg(value) AS mean FROM ok GROUP BY ALL)"


@_query("pixel_temporal_stats", f"WITH {_PIXELS} SELECT vi, region, y, x, round(total, 6) AS total, n_valid, round(mean, 6) AS mean FROM pix")
def pixel_temporal_stats(spark, sf_dir):
    return aggregate.pixel_stats(_ok(spark, sf_dir))


_ELIGIBLE = _PIXELS + ", len AS (SELECT vi, region, count(DISTINCT time) AS n_time FROM obs GROUP BY ALL), el AS (SELECT *, n_valid / n_time::DOUBLE AS valid_fraction FROM pix JOIN len USING (vi, region) WHERE mean >= 0.45 AND n_valid / n_time::DOUBLE >= 0.01)"


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = _obs(spark, sf_dir)
    length = obs.groupBy("vi", "region").agg(F.countDistinct("time").alias("n_time"))
    return sampling.eligible_pixels(aggregate.pixel_stats(filters.valid_range(obs, LOW, HIGH)), length, 0.45, 0.01)


@_query("pixel_eligibility", f"WITH {_ELIGIBLE} SELECT vi, region, y, x, n_valid, n_time, round(mean, 6) AS mean, round(valid_fraction, 6) AS valid_fraction FROM el")
def pixel_eligibility(spark, sf_dir):
    return _eligible(spark, sf_dir).select("vi", "region", "y", "x", "n_valid", "n_time", "mean", "valid_fraction")


_SAMPLE = _ELIGIBLE + ", chosen AS (SELECT vi, region, y, x FROM (SELECT *, row_number() OVER (PARTITION BY vi, region ORDER BY md5('7_' || CAST(CAST(y AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(x AS BIGINT) AS VARCHAR)), y, x) AS r FROM el) WHERE r <= 5)"


@_query("pixel_sample_semi_join", f"WITH {_SAMPLE} SELECT vi, region, date, round(avg(value), 6) AS vi_raw, count(*) AS vi_count FROM ok SEMI JOIN chosen USING (vi, region, y, x) GROUP BY ALL")
def pixel_sample_semi_join(spark, sf_dir):
    chosen = sampling.sample_pixels(_eligible(spark, sf_dir), 5, 7)
    return aggregate.spatial_mean(sampling.at_pixels(_ok(spark, sf_dir), chosen)).drop("vi_std")


@_query("min_observations", f"WITH {_SERIES} SELECT vi, region, count(*) AS n FROM series GROUP BY ALL HAVING count(*) >= 400")
def min_observations(spark, sf_dir):
    return filters.min_observations(_series(spark, sf_dir), 400).groupBy("vi", "region").agg(F.count(F.lit(1)).alias("n"))


@_query("daily_reindex", f"WITH {_DAILY} SELECT vi, region, date, round(vi_daily, 6) AS vi_daily, vi_count FROM daily")
def daily_reindex(spark, sf_dir):
    return _daily(spark, sf_dir).select("vi", "region", "date", "vi_daily", "vi_count")


@_query("smooth_linear", f"WITH {_LINEAR} SELECT vi, region, date, round(vi_smooth, 6) AS vi_smooth, vi_smooth_flag FROM curve")
def smooth_linear(spark, sf_dir):
    return _curve(spark, sf_dir).select("vi", "region", "date", "vi_smooth", "vi_smooth_flag")


@_query("provenance_flags", f"WITH {_LINEAR} SELECT vi, region, count(*) FILTER (vi_smooth_flag = 'observed') AS n_observed, count(*) FILTER (vi_smooth_flag = 'interpolated') AS n_interpolated, count(*) FILTER (vi_smooth_flag = 'extrapolated') AS n_extrapolated FROM curve GROUP BY ALL")
def provenance_flags(spark, sf_dir):
    return smooth.flag_counts(_curve(spark, sf_dir))


@_query("season_year_split", f"WITH {_DAILY} SELECT vi, region, CASE WHEN dayofyear(date) >= 182 THEN year(date) || '-' || (year(date) + 1) ELSE (year(date) - 1) || '-' || year(date) END AS year_label, count(*) AS n_days, min(date) AS first, max(date) AS last FROM daily GROUP BY ALL")
def season_year_split(spark, sf_dir):
    return metrics.seasons(_daily(spark, sf_dir), 182).groupBy("vi", "region", "year_label").agg(F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first"), F.max("date").alias("last"))


_METRIC_COLUMNS = {
    "peak_of_season": ["pos_date", "pos_doy", "pos_value"],
    "sos_eos": ["sos_date", "sos_doy", "eos_date", "eos_doy"],
    "los_ivi": ["los_days", "ivi"],
    "greening_senescence": ["greening_rate", "senescence_rate"],
    "floor_ceiling": ["floor_ndvi", "ceiling_ndvi"],
    "season_length": ["season_length_days"],
    "greenup_rate": ["greenup_rate"],
}
_DOUBLES = {"pos_value", "los_days", "ivi", "greening_rate", "senescence_rate", "floor_ndvi", "ceiling_ndvi", "season_length_days", "greenup_rate", "cv"}
_YEAR = ["vi", "region", "year_label"]


def _listed(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in _DOUBLES else c for c in columns)


for _name, _columns in _METRIC_COLUMNS.items():
    _query(_name, f"WITH {_METRICS} SELECT {_listed(_YEAR + _columns)} FROM metric")(lambda spark, sf_dir, c=tuple(_YEAR + _columns): _metrics(spark, sf_dir).select(*c))
_ALL = [c for own in _METRIC_COLUMNS.values() for c in own]
_CV = ", cv AS (SELECT vi, region, CASE WHEN avg(vi_raw) > 0 THEN stddev_samp(vi_raw) / avg(vi_raw) END AS cv FROM series GROUP BY ALL)"


@_query("cv_region", f"WITH {_SERIES}{_CV} SELECT vi, region, round(cv, 6) AS cv FROM cv")
def cv_region(spark, sf_dir):
    return metrics.region_cv(_series(spark, sf_dir))


@_query("yearly_metrics_full", f"WITH {_METRICS}{_CV} SELECT {_listed(_YEAR + _ALL + ['cv'])} FROM metric JOIN cv USING (vi, region)")
def yearly_metrics_full(spark, sf_dir):
    curve = _curve(spark, sf_dir)
    return metrics.yearly_metrics(curve).join(metrics.region_cv(curve), ["vi", "region"]).select(*_YEAR, *_ALL, "cv")


@_query("cv_pixel", f"WITH {_OBS} SELECT vi, region, y, x, round(CASE WHEN avg(value) > 0 THEN stddev_pop(value) / avg(value) END, 6) AS cv FROM ok GROUP BY ALL")
def cv_pixel(spark, sf_dir):
    return pixel.pixel_cv(_ok(spark, sf_dir))


def _quantiles(alias: str = "") -> str:
    return ", ".join(f"quantile_cont(value, {q}) AS {n}" for q, n in ((0.5, "median"), (0.05, "p05"), (0.95, "p95")))


_ROUND3 = "round(median, 6) AS median, round(p05, 6) AS p05, round(p95, 6) AS p95"


@_query("stats_per_year", f"WITH {_OBS}, s AS (SELECT vi, region, y, x, year(date)::INTEGER AS year, {_quantiles()} FROM ok GROUP BY ALL) SELECT vi, region, y, x, year, {_ROUND3} FROM s")
def stats_per_year(spark, sf_dir):
    return raster.per_year(_ok(spark, sf_dir))


@_query("stats_per_month", f"WITH {_OBS}, s AS (SELECT vi, region, y, x, year(date) AS year, month(date)::INTEGER AS month, {_quantiles()} FROM ok GROUP BY ALL), a AS (SELECT vi, region, y, x, month, avg(median) AS median, avg(p05) AS p05, avg(p95) AS p95 FROM s GROUP BY ALL) SELECT vi, region, y, x, month, {_ROUND3} FROM a")
def stats_per_month(spark, sf_dir):
    return raster.per_month(_ok(spark, sf_dir))


@_query("stats_per_doy", f"WITH {_OBS}, s AS (SELECT vi, region, y, x, least(dayofyear(date), 365)::INTEGER AS doy, {_quantiles()} FROM ok GROUP BY ALL) SELECT vi, region, y, x, doy, {_ROUND3} FROM s")
def stats_per_doy(spark, sf_dir):
    return raster.per_doy(_ok(spark, sf_dir))


@_query("band_names", f"WITH {_OBS} SELECT DISTINCT vi, region, 'year' || year(date) || '_median' AS band FROM ok UNION ALL SELECT DISTINCT vi, region, 'month' || lpad(CAST(month(date) AS VARCHAR), 2, '0') || '_p05' FROM ok UNION ALL SELECT DISTINCT vi, region, 'doy' || lpad(CAST(least(dayofyear(date), 365) AS VARCHAR), 3, '0') || '_p95' FROM ok")
def band_names(spark, sf_dir):
    ok = _ok(spark, sf_dir)
    kinds = (("year", F.year("date"), "median"), ("month", F.month("date"), "p05"), ("doy", F.least(F.dayofyear("date"), F.lit(365)), "p95"))
    a, b, c = (ok.select("vi", "region", labels.band_name(k, p, F.lit(s)).alias("band")).distinct() for k, p, s in kinds)
    return a.unionAll(b).unionAll(c)


@_query("dense_months", f"WITH {_OBS}, p AS (SELECT DISTINCT vi, region, y, x FROM ok), g AS (SELECT p.*, CAST(m.m AS INTEGER) AS month FROM p, generate_series(1, 12) AS m(m)), s AS (SELECT vi, region, y, x, month(date) AS month, count(*) AS n FROM ok GROUP BY ALL) SELECT g.vi, g.region, g.y, g.x, g.month, s.n FROM g LEFT JOIN s USING (vi, region, y, x, month)")
def dense_months(spark, sf_dir):
    ok = _ok(spark, sf_dir)
    return raster.dense(ok.groupBy("vi", "region", "y", "x", F.month("date").alias("month")).agg(F.count(F.lit(1)).alias("n")), "month", list(range(1, 13)))


@_query("geotransform", f"WITH {_OBS}, e AS (SELECT vi, region, list_sort(list(DISTINCT x)) AS xs, list_reverse_sort(list(DISTINCT y)) AS ys FROM obs GROUP BY ALL) SELECT vi, region, round(xs[1] - coalesce(xs[2] - xs[1], 30.0) / 2, 6) AS west, round(ys[1] - coalesce(ys[2] - ys[1], -30.0) / 2, 6) AS north, coalesce(xs[2] - xs[1], 30.0) AS dx, coalesce(ys[2] - ys[1], -30.0) AS dy FROM e")
def geotransform(spark, sf_dir):
    return raster.geotransform(_obs(spark, sf_dir))


@_query("same_day_dedup", f"WITH {_OBS} SELECT vi, tile, y, x, date, round(arg_min(value, (seq, value)), 6) AS value FROM ok GROUP BY ALL")
def same_day_dedup(spark, sf_dir):
    return mosaic.same_day_first(_ok(spark, sf_dir))


@_query("mosaic_last_wins", f"WITH {_OBS} SELECT vi, region, y, x, date, arg_max(tile, (tile, seq, value)) AS tile, round(arg_max(value, (tile, seq, value)), 6) AS value FROM ok GROUP BY vi, region, y, x, date")
def mosaic_last_wins(spark, sf_dir):
    return mosaic.last_tile_wins(_ok(spark, sf_dir))


@_query("grid_snap", f"WITH {_OBS} SELECT DISTINCT y, round_even((y + 7.5 - 5.0) / 30.0, 0) * 30.0 + 5.0 AS snapped FROM obs")
def grid_snap(spark, sf_dir):
    return _obs(spark, sf_dir).select("y", (F.col("y") + 7.5).alias("off")).select("y", mosaic.snap("off", 5.0).alias("snapped")).distinct()


@_query("axis_union", f"WITH {_OBS} SELECT vi, region, y, row_number() OVER (PARTITION BY vi, region ORDER BY y DESC)::INTEGER - 1 AS position FROM (SELECT DISTINCT vi, region, y FROM obs)")
def axis_union(spark, sf_dir):
    return mosaic.axes(_obs(spark, sf_dir), "y")


@_query("axis_gaps", f"WITH {_OBS}, l AS (SELECT vi, region, y, y - lag(y) OVER (PARTITION BY vi, region ORDER BY y) AS d FROM (SELECT DISTINCT vi, region, y FROM obs)) SELECT vi, region, y FROM l WHERE abs(d / 70 - round_even(d / 70, 0)) > 1e-6")
def axis_gaps(spark, sf_dir):
    return mosaic.gaps(_obs(spark, sf_dir), "y", 70.0)


@_query("dominant_group", f"WITH {_OBS} SELECT region, count(*) AS weight FROM obs GROUP BY ALL ORDER BY weight DESC, region LIMIT 1")
def dominant_group(spark, sf_dir):
    return aggregate.dominant(_obs(spark, sf_dir), "region")


@_query("extent", f"WITH {_OBS} SELECT vi, region, min(y) AS min_y, max(y) AS max_y, min(x) AS min_x, max(x) AS max_x FROM obs GROUP BY ALL")
def extent(spark, sf_dir):
    return aggregate.extent(_obs(spark, sf_dir), ["vi", "region"])


@_query("bbox_prefilter", f"WITH {_OBS}, t AS (SELECT region AS tile, min(y) AS min_y, max(y) AS max_y, min(x) AS min_x, max(x) AS max_x FROM obs GROUP BY ALL), r AS (SELECT n_name AS region, n_nationkey * 60.0 AS min_y, n_nationkey * 60.0 + 90.0 AS max_y, 30.0 AS min_x, 60.0 AS max_x FROM nation) SELECT t.tile, r.region FROM t JOIN r ON t.min_x <= r.max_x AND t.max_x >= r.min_x AND t.min_y <= r.max_y AND t.max_y >= r.min_y")
def bbox_prefilter(spark, sf_dir):
    from ..operators.regions import overlapping

    tiles = aggregate.extent(_obs(spark, sf_dir), ["region"]).withColumnRenamed("region", "tile")
    low = F.col("n_nationkey") * 60.0
    boxes = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("region"), low.alias("min_y"), (low + 90.0).alias("max_y"), F.lit(30.0).alias("min_x"), F.lit(60.0).alias("max_x"))
    return overlapping(tiles, boxes)


@_query("roi_polygon_clip", f"WITH {_OBS} SELECT 'box' AS region, vi, date, count(*) AS vi_count, round(avg(value), 6) AS vi_raw FROM ok WHERE y BETWEEN 585 AND 915 AND x BETWEEN 45 AND 135 GROUP BY ALL")
def roi_polygon_clip(spark, sf_dir):
    from ..operators.regions import clip, region_pixels

    # Cells of 30 m touch this rectangle when their centres are within 15 m of it.
    box = spark.createDataFrame([("box", [[[60.0, 600.0], [120.0, 600.0], [120.0, 900.0], [60.0, 900.0], [60.0, 600.0]]])], "region string, rings array<array<array<double>>>")
    ok = _ok(spark, sf_dir)
    return clip(ok, region_pixels(ok, box)).groupBy("region", "vi", "date").agg(F.count("value").alias("vi_count"), F.avg("value").alias("vi_raw"))


# A square of 30 m meets the triangle where their boxes meet and its nearest corner lies under the slope, 4 x + y = 1200.
@_query("roi_polygon_union", f"WITH {_OBS} SELECT 'park' AS region, vi, date, count(*) AS vi_count, round(avg(value), 6) AS vi_raw FROM ok WHERE (y BETWEEN 585 AND 915 AND x BETWEEN 45 AND 135) OR (y BETWEEN 585 AND 1215 AND x BETWEEN -15 AND 165 AND 4 * x + y - 75 <= 1200) GROUP BY ALL")
def roi_polygon_union(spark, sf_dir):
    from ..operators.regions import clip, region_pixels

    box, triangle = [[[60.0, 600.0], [120.0, 600.0], [120.0, 900.0], [60.0, 900.0], [60.0, 600.0]]], [[[0.0, 600.0], [150.0, 600.0], [0.0, 1200.0], [0.0, 600.0]]]
    park = spark.createDataFrame([("park", [box, triangle], box + triangle)], "region string, polygons array<array<array<array<double>>>>, rings array<array<array<double>>>")
    ok = _ok(spark, sf_dir)
    return clip(ok, region_pixels(ok, park)).groupBy("region", "vi", "date").agg(F.count("value").alias("vi_count"), F.round(F.avg("value"), 6).alias("vi_raw"))


_ZONED = f"""{_OBS}, tiles AS (
  SELECT vi, region, tile, CASE tile WHEN 'F' THEN 'EPSG:32631' ELSE 'EPSG:32632' END AS crs, min(x) AS min_x, max(y) AS max_y,
         (round((max(y) - min(y)) / 30) + 1) * (round((max(x) - min(x)) / 30) + 1) AS cells
  FROM obs GROUP BY vi, region, tile
), best AS (SELECT *, row_number() OVER (PARTITION BY vi, region ORDER BY cells DESC, crs) AS place FROM tiles)"""


@_query("cube_strategy", f"WITH {_ZONED} SELECT vi, region, count(*) AS n_tiles, count(DISTINCT crs) AS n_crs, CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT crs) = 1 THEN 'mosaic' ELSE 'reproject' END AS strategy, max(crs) FILTER (place = 1) AS target, max(max_y) FILTER (place = 1) AS ref_y, max(min_x) FILTER (place = 1) AS ref_x FROM best GROUP BY vi, region")
def cube_strategy(spark, sf_dir):
    zoned = _obs(spark, sf_dir).withColumn("crs", F.when(F.col("tile") == "F", "EPSG:32631").otherwise("EPSG:32632"))
    return cube.merge_plans(cube.tile_extents(zoned))


@_query("doy_climatology", f"WITH {_LINEAR} SELECT vi, region, dayofyear(date)::INTEGER AS doy, round(avg(vi_smooth), 6) AS mean FROM curve GROUP BY ALL")
def doy_climatology(spark, sf_dir):
    return climatology.doy_climatology(_curve(spark, sf_dir))


@_query("anomaly", f"WITH {_LINEAR} SELECT vi, region, date, round(vi_smooth - avg(vi_smooth) OVER (PARTITION BY vi, region, dayofyear(date)), 6) + 0.0 AS anomaly FROM curve QUALIFY max(year(date)) OVER (PARTITION BY vi, region) > min(year(date)) OVER (PARTITION BY vi, region)")
def anomaly(spark, sf_dir):
    return climatology.anomaly(_curve(spark, sf_dir)).withColumn("anomaly", F.round("anomaly", 6) + 0.0)


@_query("annual_overlay", f"WITH {_LINEAR} SELECT vi, region, year(date)::INTEGER AS year, dayofyear(date)::INTEGER AS doy, round(vi_smooth, 6) AS value FROM curve")
def annual_overlay(spark, sf_dir):
    return climatology.annual_overlay(_curve(spark, sf_dir))


@_query("deviation_band", f"WITH {_SERIES} SELECT vi, region, date, round(vi_raw, 6) AS vi_raw, round(vi_raw - coalesce(vi_std, 0), 6) AS low, round(vi_raw + coalesce(vi_std, 0), 6) AS high FROM series")
def deviation_band(spark, sf_dir):
    return climatology.deviation_band(_series(spark, sf_dir))


@_query("index_panel", f"WITH {_LINEAR}, k AS (SELECT region FROM curve GROUP BY region HAVING count(DISTINCT vi) > 1) SELECT region, vi, date, round(vi_smooth, 6) AS vi_smooth FROM curve SEMI JOIN k USING (region)")
def index_panel(spark, sf_dir):
    return climatology.index_panel(_curve(spark, sf_dir))


@_query("map_decimation", f"WITH {_OBS}, p AS (SELECT DISTINCT vi, region, y, x FROM obs), q AS (SELECT *, dense_rank() OVER (PARTITION BY vi, region ORDER BY y) - 1 AS i, dense_rank() OVER (PARTITION BY vi, region ORDER BY x) - 1 AS j, greatest(ceil(sqrt(count(*) OVER (PARTITION BY vi, region) / 10.0)), 1) AS k FROM p) SELECT vi, region, y, x FROM q WHERE i % k = 0 AND j % k = 0")
def map_decimation(spark, sf_dir):
    return climatology.every_kth(_obs(spark, sf_dir).select("vi", "region", "y", "x").distinct(), 10)


@_query("observations_output", f"WITH {_LINEAR} SELECT vi, region, date, round(vi_raw, 6) AS vi_raw, vi_count, round(vi_std, 6) AS vi_std, round(vi_smooth, 6) AS vi_smooth FROM curve WHERE vi_count > 0")
def observations_output(spark, sf_dir):
    curve = _curve(spark, sf_dir)
    return sinks.observation_rows(curve, curve)


_REGIONS = ", files AS (SELECT n_name AS region, r_name AS shapefile_stem FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = spark.read.parquet(f"{sf_dir}/nation.parquet"), spark.read.parquet(f"{sf_dir}/region.parquet")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_name").alias("region"), F.col("r_name").alias("shapefile_stem"))


@_query("combined_timeseries", f"WITH {_SERIES}{_REGIONS}, many AS (SELECT shapefile_stem FROM files GROUP BY ALL HAVING count(DISTINCT region) > 1) SELECT region, vi, date, round(vi_raw, 6) AS vi_raw, vi_count, round(vi_std, 6) AS vi_std, shapefile_stem FROM series JOIN files USING (region) SEMI JOIN many USING (shapefile_stem)")
def combined_timeseries(spark, sf_dir):
    return sinks.combined_rows(_series(spark, sf_dir), _regions(spark, sf_dir))


@_query("combined_metrics", f"WITH {_METRICS}{_REGIONS} SELECT region, vi, year_label, round(pos_value, 6) AS pos_value FROM metric WHERE region IN (SELECT region FROM files WHERE shapefile_stem = 'ASIA')")
def combined_metrics(spark, sf_dir):
    asia = _regions(spark, sf_dir).where("shapefile_stem = 'ASIA'")
    return sinks.combined_metrics(_metrics(spark, sf_dir), asia).select("region", "vi", "year_label", "pos_value")


_PIXEL_WIDE = _OBS + ", wide AS (SELECT vi, region, y, x, avg(value) AS mean_value, stddev_pop(value) AS std_value, max(value) AS peak FROM ok GROUP BY ALL), long AS (UNPIVOT wide ON mean_value, std_value, peak INTO NAME metric VALUE v)"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ok(spark, sf_dir).groupBy("vi", "region", "y", "x").agg(F.avg("value").alias("mean_value"), F.stddev_pop("value").alias("std_value"), F.max("value").alias("peak"))


@_query("metric_summary", f"WITH {_PIXEL_WIDE} SELECT vi, region, metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(quantile_cont(v, 0.05), 6) AS p05, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.95), 6) AS p95, count(v) AS n_valid_pixels FROM long GROUP BY ALL")
def metric_summary(spark, sf_dir):
    return aggregate.unpivot_summary(_wide(spark, sf_dir), ["vi", "region"], ["mean_value", "std_value", "peak"])


@_query("display_stretch", f"WITH {_PIXEL_WIDE}, q AS (SELECT vi, region, quantile_cont(mean_value, 0.02) AS low, quantile_cont(mean_value, 0.98) AS high FROM wide GROUP BY ALL) SELECT vi, region, round(low, 6) AS low, round(CASE WHEN high = low THEN high + 1e-6 ELSE high END, 6) AS high FROM q")
def display_stretch(spark, sf_dir):
    return aggregate.display_stretch(_wide(spark, sf_dir), ["vi", "region"], "mean_value")


@_query("sentinel_fill", f"WITH {_OBS} SELECT vi, region, count(*) AS n, count(*) FILTER (value BETWEEN 0.3 AND 0.6) AS n_back FROM obs GROUP BY ALL")
def sentinel_fill(spark, sf_dir):
    fill = 9.96920996838687e36
    back = filters.unfill(filters.fill_missing(filters.mask_range(_obs(spark, sf_dir), 0.3, 0.6), ["value"], fill), ["value"], fill)
    return back.groupBy("vi", "region").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_back"))


@_query("sanitize_label", r"SELECT p_name, coalesce(nullif(trim(regexp_replace(p_name || ' / ' || p_type || '*', '[^\w\-]', '_', 'g'), '_'), ''), 'region') AS label FROM part")
def sanitize_label(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return part.select("p_name", labels.sanitize(F.concat("p_name", F.lit(" / "), "p_type", F.lit("*"))).alias("label"))


@_query("label_collisions", r"WITH n AS (SELECT upper(p_type) AS raw FROM part UNION ALL SELECT upper(p_type) || '*' FROM part), l AS (SELECT raw, coalesce(nullif(trim(regexp_replace(raw, '[^\w\-]', '_', 'g'), '_'), ''), 'region') AS label FROM n) SELECT label, count(DISTINCT raw) AS n_values FROM l GROUP BY ALL HAVING count(DISTINCT raw) > 1")
def label_collisions(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.upper("p_type").alias("raw"))
    return labels.collisions(part.unionAll(part.select(F.concat("raw", F.lit("*")).alias("raw"))), "raw")


def _smoothed(method: str) -> Query:
    return lambda spark, sf_dir: smooth.smooth(_daily(spark, sf_dir), method, window=45).select("vi", "region", "date", "vi_smooth", "vi_smooth_flag")


# Kernels that SQL can't express; the tests hold them against dense NumPy solutions.
for _method in ("whittaker", "savgol", "loess", "harmonic"):
    _query(f"smooth_{_method}")(_smoothed(_method))


@_query("bimodality")
def bimodality(spark, sf_dir):
    return metrics.peak_metrics(smooth.smooth(_daily(spark, sf_dir), "whittaker"))


@_query("pixel_metrics")
def pixel_metrics(spark, sf_dir):
    return pixel.pixel_metrics(_obs(spark, sf_dir))


@_query("pixel_summary")
def pixel_summary(spark, sf_dir):
    return aggregate.unpivot_summary(pixel.pixel_metrics(_obs(spark, sf_dir)), ["vi", "region"], list(pixel.BANDS))


def FLAGSHIP(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly metrics of every index and region."""
    return _rounded(_metrics(spark, sf_dir))
