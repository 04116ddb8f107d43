"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

HEADLINE = ["roi_mean_timeseries", "roi_median_iqr", "tile_pooled_timeseries", "pixel_temporal_stats", "pixel_sample_semi_join", "daily_reindex", "smooth_linear", "yearly_metrics_full", "stats_per_year", "stats_per_month", "stats_per_doy", "mosaic_last_wins", "doy_climatology", "anomaly", "smooth_whittaker", "smooth_savgol", "smooth_harmonic", "pixel_metrics"]


def main() -> None:
    from pyspark.sql import SparkSession

    from chronogrid.plans import registry

    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run = lambda n: registry.QUERIES[n](spark, sf).write.format("noop").mode("overwrite").save()
    run(names[0])
    took = {}
    for n in names:
        t = time.time()
        run(n)
        took[n] = round(time.time() - t, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
