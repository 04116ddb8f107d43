"""Four programs over Parquet tables: series, cube, pixel and raster."""

from __future__ import annotations

import argparse
import logging
import os
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import aggregate, cube, filters, pixel, raster, regions
from .params import METHODS, RASTER_RANGES, SERIES_RANGES, Params, parse_valid_range
from .plans.series import regional_metrics, regional_series
from .sources import geotiff, observations, sinks


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="chronogrid", description=__doc__)
    programs = top.add_subparsers(dest="program", required=True)
    for name in ("series", "cube", "pixel", "raster"):
        p = programs.add_parser(name)
        where = p.add_mutually_exclusive_group(required=True)
        where.add_argument("--tiles", help="folder of tile files T*_{vi}.parquet")
        where.add_argument("--datacubes", nargs="+", help="folders with {vi}_{region}_datacube.parquet files")
        p.add_argument("--vi", nargs="+", default=["NDVI"])
        p.add_argument("--output-dir", required=True)
        p.add_argument("--log-dir", help="a folder of the driver's machine for a log file of this run")
        p.add_argument("--start-date")
        p.add_argument("--end-date")
        p.add_argument("--valid-range", nargs="*", default=[], help="VI=min,max", metavar="RANGE")
        p.add_argument("--regions", nargs="*", default=[], help="GeoJSON files")
        p.add_argument("--region-field", nargs="*", help="a property for each file; 'none' dissolves")
        p.add_argument("--peak-prominence", type=float, default=0.05)
        p.add_argument("--peak-min-distance", type=int, default=45)
        p.add_argument("--smooth-lambda", type=float, default=100.0)
        p.add_argument("--min-valid-obs", type=int, default=20)
        p.add_argument("--min-valid-obs-per-year", type=int, default=5)
        p.add_argument("--sos-threshold", type=float, default=0.20)
        if name == "series":
            p.add_argument("--smooth-method", choices=METHODS, default="savgol")
            p.add_argument("--smooth-window", type=int, default=15)
            p.add_argument("--smooth-polyorder", type=int, default=3)
            p.add_argument("--metrics", action="store_true")
            p.add_argument("--year-start-doy", type=int, default=1)
            p.add_argument("--sample-pixels", type=int)
            p.add_argument("--random-seed", type=int)
            p.add_argument("--min-value-mean", type=float)
            p.add_argument("--min-quality-frac", type=float, default=0.0)
            p.add_argument("--use-median", action="store_true")
        if name == "cube":
            p.add_argument("--no-merge-same-crs", action="store_true", help="keep tiles of one coordinate system apart")
            p.add_argument("--no-merge-cross-crs", action="store_true", help="keep tiles of several coordinate systems apart")
        if name == "raster":
            for part in ("year", "month", "doy"):
                p.add_argument(f"--skip-per-{part}", action="store_true")
            p.add_argument("--geotiff-dir", help="a folder of the driver's machine for GeoTIFF files too")
    return top


def params_of(a: argparse.Namespace) -> Params:
    ranges = dict(SERIES_RANGES if a.program in ("series", "cube") else RASTER_RANGES)
    for item in a.valid_range:
        vi, _, text = item.partition("=")
        ranges[vi] = parse_valid_range(text, strict=a.program in ("pixel", "raster"))
    common = dict(vis=tuple(a.vi), valid_ranges=ranges, tiles=a.tiles, datacubes=tuple(a.datacubes) if a.datacubes else None, output_dir=a.output_dir, start_date=a.start_date, end_date=a.end_date, region_files=tuple(a.regions), region_fields=tuple(a.region_field) if a.region_field else None, peak_prominence=a.peak_prominence, peak_min_distance_days=a.peak_min_distance, smooth_lambda=a.smooth_lambda, min_valid_obs=a.min_valid_obs, min_valid_obs_per_year=a.min_valid_obs_per_year, sos_threshold=a.sos_threshold)
    if a.program == "series":
        common |= dict(smooth_method=a.smooth_method, smooth_window=a.smooth_window, smooth_polyorder=a.smooth_polyorder, compute_metrics=a.metrics, year_start_doy=a.year_start_doy, sample_pixels=a.sample_pixels, random_seed=a.random_seed, min_value_mean=a.min_value_mean, min_quality_frac=a.min_quality_frac, use_median=a.use_median)
    return Params(**common)


def load(spark: SparkSession, p: Params) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Observations of the wanted indices and dates, clipped to the regions where there are any; all and the split regions."""
    frames = [observations.read_tiles(spark, p.tiles, v) for v in p.vis] if p.tiles else [observations.read_datacubes(spark, f) for f in p.datacubes]
    df = regions.enumerate_regions(*frames).where(F.col("vi").isin(*p.vis))
    df = filters.with_date(filters.date_range(df, p.start_date, p.end_date))
    if not p.region_files:
        return df.withColumn("region", F.coalesce("region", F.lit("full_extent"))), None, None
    fields = p.region_fields or ["none"] * len(p.region_files)
    files = []
    for f, g in zip(p.region_files, fields):
        stem = f.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        files.append((regions.read_geojson(spark, f, None if g == "none" else g, stem), regions.geojson_crs(spark, f)))
    split = [s for (s, _), g in zip(files, fields) if g != "none"]
    names = lambda shapes: regions.enumerate_regions(*[s.select("region", "shapefile_stem") for s in shapes]) if shapes else None
    return regions.clip_to(df, files), names([s for s, _ in files]), names(split)


def log_to(folder: str | None, program: str) -> logging.Logger:
    """This run's log: to standard error, and to a file named by program and start where a folder is given."""
    log = logging.getLogger(f"chronogrid.{program}")
    log.setLevel(logging.INFO)
    if folder:
        os.makedirs(folder, exist_ok=True)
        handler = logging.FileHandler(os.path.join(folder, f"{program}_{time.strftime('%Y%m%d_%H%M%S')}.log"))
        handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
        log.addHandler(handler)
    return log


def write_series(df: DataFrame, shapes: DataFrame | None, split: DataFrame | None, p: Params, out: str) -> None:
    """Observations and metrics of each index and region, and of each region file that has several."""
    curve = regional_series(df, p).persist(StorageLevel.DISK_ONLY)
    rows = sinks.observation_rows(curve, curve if "vi_smooth" in curve.columns else None)
    sinks.write_csv(rows, f"{out}/observations")
    by = ["vi", "shapefile_stem"]
    if shapes is not None:
        sinks.write_csv(sinks.combined_rows(rows, shapes).orderBy(*by, "region", "date"), f"{out}/combined_observations", by)
    if p.compute_metrics:
        yearly = regional_metrics(curve, p)
        sinks.write_csv(yearly, f"{out}/metrics")
        if split is not None:
            combined = sinks.combined_metrics(yearly, split).join(split.distinct(), "region").orderBy(*by, "region", "year_label")
            sinks.write_csv(combined, f"{out}/combined_metrics", by)
    curve.unpersist()


def write_cubes(df: DataFrame, ok: DataFrame, merge_same: bool, merge_cross: bool, out: str, log: logging.Logger) -> None:
    """Merged cubes, cubes of single tiles where tiles stay apart, and what each of them holds."""
    tiles = cube.tile_extents(df).persist(StorageLevel.DISK_ONLY)
    plans = cube.merge_plans(tiles, merge_same, merge_cross)
    if clash := cube.colliding_lines(df, plans.where("strategy <> 'per_tile'")).limit(20).collect():
        raise ValueError(f"lines of one tile that fall on the same grid line: {[tuple(r) for r in clash]}")
    ready = one_a_day(ok)
    sinks.write_cube(cube.merge(ready, tiles, plans), f"{out}/cubes")
    sinks.write_cube(cube.apart(ready, plans), f"{out}/tile_cubes", ["vi", "region", "tile"])
    cube.describe(tiles, plans).write.mode("overwrite").parquet(f"{out}/cube_metadata")
    for r in plans.groupBy("strategy").count().orderBy("strategy").collect():
        log.info("%s: %d cubes", r["strategy"], r["count"])
    tiles.unpersist()


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    p, out, log = params_of(a), a.output_dir, log_to(a.log_dir, a.program)
    log.info("%s of %s to %s", a.program, ", ".join(p.vis), out)
    try:
        write(spark, a, p, out, log)
        log.info("done")
    except Exception:
        log.exception("failed")
        raise
    finally:
        for handler in list(log.handlers):
            log.removeHandler(handler)
            handler.close()


def write(spark: SparkSession, a: argparse.Namespace, p: Params, out: str, log: logging.Logger) -> None:
    """What the program makes of its observations."""
    df, shapes, split = load(spark, p)
    ok = filters.valid_ranges(df, {v: p.valid_range(v) for v in p.vis})
    if a.program == "series":
        write_series(df, shapes, split, p, out)
    elif a.program == "cube":
        write_cubes(df, ok, not a.no_merge_same_crs, not a.no_merge_cross_crs, out, log)
    elif a.program == "pixel":
        for v in p.vis:
            low, high = p.valid_range(v)
            bands = pixel.pixel_metrics(df.where(F.col("vi") == v), p.smooth_lambda, p.min_valid_obs, p.min_valid_obs_per_year, p.peak_prominence, p.peak_min_distance_days, p.sos_threshold, low, high)
            bands.write.mode("overwrite").parquet(f"{out}/pixel_metrics/{v}")
            back = spark.read.parquet(f"{out}/pixel_metrics/{v}")
            sinks.write_csv(aggregate.unpivot_summary(back, ["vi", "region"], list(pixel.BANDS)), f"{out}/pixel_summary/{v}")
    else:
        for part, make in (("year", raster.per_year), ("month", raster.per_month), ("doy", raster.per_doy)):
            if not getattr(a, f"skip_per_{part}"):
                made = make(ok)
                made.write.mode("overwrite").partitionBy("vi", "region").parquet(f"{out}/per_{part}")
                if a.geotiff_dir:
                    geotiff.write_periods(spark.read.schema(made.schema).parquet(f"{out}/per_{part}"), part, a.geotiff_dir)


def one_a_day(df: DataFrame) -> DataFrame:
    """One value for each tile, place and day: the first in source order."""
    keys = ["vi", "region", "tile", "crs", "y", "x", "date"]
    best = F.min(F.struct(F.coalesce("seq", F.lit(0)).alias("seq"), F.col("value").alias("v"))).alias("m")
    return df.where("value IS NOT NULL").groupBy(*keys).agg(best).select(*keys, F.col("m.v").alias("value"))


def main() -> None:
    run(SparkSession.builder.appName("chronogrid").getOrCreate())


if __name__ == "__main__":
    main()
