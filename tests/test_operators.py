import datetime as dt

import numpy as np
import pytest

from chronogrid.functions import labels
from chronogrid.operators import aggregate, filters, metrics, mosaic, pixel, raster, regions, sampling, smooth
from chronogrid.params import Params, parse_valid_range
from chronogrid.sources import observations, sinks

D = dt.date


def series(spark, values, start=D(2020, 1, 1), vi="NDVI", region="r"):
    rows = [(vi, region, start + dt.timedelta(days=d), float(v), 1, None) for d, v in values]
    return spark.createDataFrame(rows, "vi string, region string, date date, vi_raw double, vi_count long, vi_std double")


def test_params_report_every_broken_rule():
    with pytest.raises(ValueError) as e:
        Params(vis=(), smooth_window=0, sos_threshold=2, start_date="2020-13-01", peak_prominence=0, min_valid_obs=0)
    assert str(e.value).count("\n") == 8
    assert Params(tiles="x").valid_range("EVI2") == (-1.0, 2.0)
    assert parse_valid_range("0, 1, 2") == (0.0, 1.0)
    with pytest.raises(ValueError):
        parse_valid_range("0,1,2", strict=True)


def test_range_edges_and_nan(spark):
    df = spark.createDataFrame([(v,) for v in (-0.1, -0.10001, 1.0, 1.00001, float("nan"), None)], "value double")
    assert filters.valid_range(df, -0.1, 1.0).count() == 2
    assert observations.nan_to_null(df, "value").where("value IS NULL").count() == 2


def test_date_range_keeps_the_whole_last_day(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-01-31 23:59:59' AS time UNION ALL SELECT timestamp_ntz'2020-02-01 00:00:00'")
    assert filters.date_range(df, "2020-01-01", "2020-01-31").count() == 1


def test_single_value_has_no_spread(spark):
    df = spark.createDataFrame([("NDVI", "r", D(2020, 1, 1), 0.5)], "vi string, region string, date date, value double")
    assert aggregate.spatial_mean(df).first().vi_std is None
    assert aggregate.spatial_median(df).first().vi_std is None


def test_gap_series_is_interpolated_and_flagged(spark):
    frame = smooth.daily(series(spark, [(0, 0.2), (3, 0.5), (10, 0.1)]))
    rows = smooth.linear(frame).orderBy("date").collect()
    assert len(rows) == 11 and abs(rows[1].vi_smooth - 0.3) < 1e-12
    assert [r.vi_smooth_flag for r in rows].count("interpolated") == 8


def test_empty_ends_are_extrapolated(spark):
    frame = smooth.daily(series(spark, [(0, 0.2), (2, 0.4), (5, 0.3)]))
    from pyspark.sql import functions as F

    masked = frame.withColumn("vi_daily", F.when(F.col("date") == D(2020, 1, 3), F.col("vi_daily")))
    for method in ("linear", "whittaker"):
        rows = smooth.smooth(masked, method).orderBy("date").collect()
        assert [r.vi_smooth_flag for r in rows] == ["extrapolated"] * 2 + ["observed"] + ["extrapolated"] * 3
        assert [r.vi_smooth is None for r in rows] == [True] * 2 + [False] + [True] * 3


def test_triangle_year(spark):
    values = [(d, min(d, 200 - d) / 100) for d in range(201)]
    m = metrics.all_metrics(smooth.linear(smooth.daily(series(spark, values)))).first()
    assert (m.pos_doy, m.sos_doy, m.eos_doy, m.los_days) == (101, 21, 181, 160.0)
    assert abs(m.ivi - 96.0) < 1e-9 and abs(m.greening_rate - 0.01) < 1e-12 and abs(m.senescence_rate + 0.01) < 1e-12
    assert m.season_length_days == m.los_days and m.n_peaks == 1 and abs(m.greenup_rate - 0.01) < 1e-12


def test_flat_year_and_ties(spark):
    m = metrics.yearly_metrics(smooth.linear(smooth.daily(series(spark, [(d, 0.4) for d in range(40)])))).first()
    assert m.sos_date is None and m.ivi is None and m.season_length_days is None and m.pos_doy == 1
    t = metrics.yearly_metrics(smooth.linear(smooth.daily(series(spark, [(0, 0.1), (1, 0.9), (2, 0.1), (3, 0.9), (4, 0.1)])))).first()
    assert t.pos_doy == 2


def test_season_labels_cross_the_year(spark):
    df = spark.createDataFrame([(D(2020, 6, 29),), (D(2020, 6, 30),), (D(2021, 6, 30),), (D(2021, 7, 1),)], "date date")
    got = [r.year_label for r in metrics.seasons(df, 182).collect()]
    assert got == ["2019-2020", "2020-2021", "2020-2021", "2021-2022"]


def test_leap_day_folds(spark):
    df = spark.createDataFrame([("v", "r", 0.0, 0.0, D(2020, 12, 31), 0.2), ("v", "r", 0.0, 0.0, D(2021, 12, 31), 0.4)], "vi string, region string, y double, x double, date date, value double")
    row = raster.per_doy(df).collect()
    assert len(row) == 1 and row[0].doy == 365 and abs(row[0].median - 0.3) < 1e-12


def test_months_are_not_weighted_by_observations(spark):
    rows = [("v", "r", 0.0, 0.0, D(2020, 3, 1), 0.8)] + [("v", "r", 0.0, 0.0, D(2021, 3, d), 0.2) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "vi string, region string, y double, x double, date date, value double")
    assert abs(raster.per_month(df).first().median - 0.5) < 1e-12


def test_same_day_and_overlap(spark):
    rows = [("v", "r", "A", 1, 0.0, 0.0, D(2020, 1, 1), None), ("v", "r", "A", 2, 0.0, 0.0, D(2020, 1, 1), 0.3), ("v", "r", "A", 3, 0.0, 0.0, D(2020, 1, 1), 0.4), ("v", "r", "B", 1, 0.0, 0.0, D(2020, 1, 1), 0.9), ("v", "r", "C", 1, 0.0, 0.0, D(2020, 1, 1), None)]
    df = spark.createDataFrame(rows, "vi string, region string, tile string, seq long, y double, x double, date date, value double")
    assert {r.tile: r.value for r in mosaic.same_day_first(df).collect()} == {"A": 0.3, "B": 0.9}
    assert mosaic.last_tile_wins(df).first().value == 0.9


def test_snap_halves_to_even(spark):
    df = spark.createDataFrame([(44.6,), (45.0,), (75.0,), (29.6,)], "y double")
    assert [r[0] for r in df.select(mosaic.snap("y", 0.0)).collect()] == [30.0, 60.0, 60.0, 30.0]


def test_bilinear_middle_and_missing(spark):
    src = spark.createDataFrame([("v", D(2020, 1, 1), y, x, v) for y, x, v in ((0.0, 0.0, 0.0), (0.0, 30.0, 1.0), (30.0, 0.0, 1.0), (30.0, 30.0, None))], "vi string, date date, y double, x double, value double")
    at = spark.createDataFrame([(1.0, 1.0, 15.0, 15.0), (2.0, 2.0, 0.0, 15.0)], "y double, x double, ty double, tx double")
    got = {r.y: r.value for r in mosaic.bilinear(src, at).collect()}
    assert abs(got[1.0] - 2 / 3) < 1e-12 and abs(got[2.0] - 0.5) < 1e-12


def test_labels(spark):
    df = spark.createDataFrame([("My Park",), ("My_Park",), ("***",), ("Été-1",), (None,)], "n string")
    assert [r[0] for r in df.select(labels.sanitize("n")).collect()] == ["My_Park", "My_Park", "region", "Été-1", "region"]
    assert [(r.label, r.n_values) for r in labels.collisions(df, "n").collect()] == [("My_Park", 2)]


def test_cells_that_touch():
    ring = [[[0.0, 0.0], [100.0, 0.0], [100.0, 100.0], [0.0, 100.0], [0.0, 0.0]], [[30.0, 30.0], [70.0, 30.0], [70.0, 70.0], [30.0, 70.0], [30.0, 30.0]]]
    x = np.array([50.0, 110.0, 116.0, 50.0, -14.0])
    y = np.array([50.0, 50.0, 50.0, 10.0, -14.0])
    assert regions.touches(x, y, ring, 30.0).tolist() == [False, True, False, True, True]


def test_geojson_split_and_collision(spark, tmp_path):
    import json

    def write(names):
        shape = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
        p = tmp_path / f"{len(names)}{names[0]}.json"
        p.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": n}, "geometry": shape} for n in names]}))
        return str(p)

    assert {r.region for r in regions.read_geojson(spark, write(["a b", "c", None]), "name").collect()} == {"a_b", "c"}
    assert regions.read_geojson(spark, write(["a"]), stem="my file").first().region == "my_file"
    with pytest.raises(ValueError):
        regions.read_geojson(spark, write(["x y", "x_y"]), "name")


def test_pixel_metrics_of_a_sine(spark):
    day = [D(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 730, 5)]
    rows = [("NDVI", "r", 0.0, 0.0, d, float(0.5 - 0.3 * np.cos(2 * np.pi * d.timetuple().tm_yday / 365))) for d in day]
    rows += [("NDVI", "r", 0.0, 30.0, day[0], 0.5)]
    df = spark.createDataFrame(rows, "vi string, region string, y double, x double, date date, value double")
    got = {r.x: r for r in pixel.pixel_metrics(df, lam=10.0).collect()}
    assert abs(got[0.0].peak_ndvi_mean - 0.8) < 0.01 and abs(got[0.0].peak_doy_mean - 182.5) < 4
    assert got[0.0].interannual_peak_std == got[0.0].peak_ndvi_std and got[0.0].n_peaks_mean == 1.0
    assert got[30.0].peak_ndvi_mean is None and got[30.0].cv is None


def test_sample_is_the_same_again(spark):
    df = spark.createDataFrame([("v", "r", 30.0 * i, 30.0 * j) for i in range(10) for j in range(10)], "vi string, region string, y double, x double")
    a, b = ({(r.y, r.x) for r in sampling.sample_pixels(d, 7, 3).collect()} for d in (df, df.repartition(7)))
    assert a == b and len(a) == 7


def test_file_names_and_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("NDVI_a_b_datacube",), ("other",)], "s string")
    got = [tuple(r) for r in df.select(*[c.alias(k) for k, c in observations.cube_identity(df["s"]).items()]).collect()]
    assert got == [("NDVI", "a_b"), (None, None)]
    rows = series(spark, [(0, 0.2), (5, 0.4)])
    sinks.write_csv(sinks.observation_rows(rows), str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert sorted(r.date for r in back.collect()) == ["2020-01-01", "2020-01-06"]
    assert sinks.output_folder("o", "r", "s", split=True) == "o/s/r"


def test_streaming_mean(spark, tmp_path):
    from chronogrid.streaming.incremental import streaming_mean

    sql = "SELECT 'NDVI' AS vi, 'r' AS region, timestamp_ntz'2020-01-0{d} 10:00:00' AS time, CAST({v} AS DOUBLE) AS value"
    spark.sql(" UNION ALL ".join(sql.format(d=d, v=v) for d, v in ((1, 0.2), (1, 0.4), (2, 9.0), (3, 0.5), (9, 0.5)))).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = streaming_mean(stream, 0.0, 1.0).writeStream.format("memory").queryName("means").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.date: (r.vi_count, round(r.vi_raw, 6)) for r in spark.table("means").collect()}
    assert got[D(2020, 1, 1)] == (2, 0.3) and got[D(2020, 1, 3)] == (1, 0.5) and D(2020, 1, 9) not in got


def test_pixel_bands_against_a_plain_version(spark):
    """All nineteen bands, pixel by pixel and year by year; a pixel without valid values has nulls."""
    import datetime
    import math

    import numpy as np

    from chronogrid.functions import kernels
    from chronogrid.operators import pixel

    first, days = datetime.date(2019, 3, 1), 1100
    rng = np.random.default_rng(3)
    shapes = [lambda d: 0.5 + 0.3 * math.sin(d / 58), lambda d: 0.45 + 0.2 * math.sin(d / 29) + 0.1 * math.sin(d / 58), lambda d: 0.4, lambda d: 5.0, lambda d: 0.3 + 0.0003 * d]
    rows = [("NDVI", "r", float(i), 1.0, first + datetime.timedelta(d), f(d) + (0.01 * float(rng.normal()) if i < 2 else 0)) for i, f in enumerate(shapes) for d in sorted({0, days - 1, *rng.choice(days, 150 if i < 4 else 18, replace=False).tolist()})]
    df = spark.createDataFrame(rows, "vi string, region string, y double, x double, date date, value double")
    got = {r.y: r for r in pixel.pixel_metrics(df, block=2).collect()}
    assert len(got) == len(shapes) and all(got[3.0][b] is None for b in pixel.BANDS)
    axis = [first + datetime.timedelta(d) for d in range(days)]
    for i in (0, 1, 2, 4):
        own = {(r[4] - first).days: r[5] for r in rows if r[2] == i}
        y, w = np.zeros(days), np.zeros(days)
        for d, v in own.items():
            y[d], w[d] = v, 1
        z = np.clip(kernels.whittaker(y, w, 100.0)[0], -0.1, 1.0)
        years = []
        for year in sorted({d.year for d in axis}):
            at = [k for k, d in enumerate(axis) if d.year == year]
            if len(at) < 30 or sum(w[at]) < 5:
                continue
            v, doy = [float(z[k]) for k in at], [axis[k].timetuple().tm_yday for k in at]
            top, low = v.index(max(v)), v.index(min(v))
            above = [k for k, x in enumerate(v) if x >= v[low] + 0.2 * (v[top] - v[low])] if v[top] - v[low] >= 1e-6 else []
            n, apart, ratio, valley = kernels.bimodality(np.array(v), np.array(doy), 0.05, 45)
            years.append(dict(peak=v[top], doy=doy[top], integral=sum((a + b) / 2 for a, b in zip(v, v[1:])), greenup=(v[top] - v[low]) / (top - low) if low < top else None, floor=v[low], season=above[-1] - above[0] if len(above) >= 2 else None, n=n, apart=apart, ratio=ratio, valley=valley))
        of = lambda k: [q[k] for q in years if q[k] is not None]
        mean = lambda k: sum(of(k)) / len(of(k)) if of(k) else None
        std = lambda k: math.sqrt(sum((x - mean(k)) ** 2 for x in of(k)) / len(of(k))) if of(k) else None
        values = list(own.values())
        m = sum(values) / len(values)
        want = [mean("peak"), std("peak"), mean("doy"), std("doy"), mean("integral"), std("integral"), mean("greenup"), std("greenup"), mean("floor"), mean("peak"), mean("season"), std("season"), math.sqrt(sum((x - m) ** 2 for x in values) / len(values)) / m, max(of("peak")) - min(of("peak")), std("peak"), mean("n"), mean("apart"), mean("ratio"), mean("valley")]
        for band, x in zip(pixel.BANDS, want):
            a = got[float(i)][band]
            assert (a is None) == (x is None) and (x is None or math.isclose(a, x, rel_tol=1e-6, abs_tol=1e-6)), (i, band, a, x)


def test_overlapping_features_of_a_region_are_a_union(spark, tmp_path):
    import json

    from chronogrid.operators import regions

    square = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    hole = [square(200.0, 300.0), square(220.0, 280.0)]
    features = [{"type": "Feature", "properties": {"n": "one"}, "geometry": {"type": k, "coordinates": c}} for k, c in (("Polygon", [square(0.0, 100.0)]), ("MultiPolygon", [[square(50.0, 150.0)], hole]))]
    (tmp_path / "r.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    cells = spark.createDataFrame([(v, v) for v in (10.0, 75.0, 140.0, 180.0, 210.0, 250.0)], "y double, x double")
    for field in (None, "n"):
        shapes = regions.read_geojson(spark, str(tmp_path / "r.json"), field)
        assert sorted(r.x for r in regions.region_pixels(cells, shapes, size=2.0).collect()) == [10.0, 75.0, 140.0, 210.0]
        assert shapes.count() == 1
