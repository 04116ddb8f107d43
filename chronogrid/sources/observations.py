"""Reading observations: canonical Parquet, file-name identity, region files, and the test-table adapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: vi, region or tile, time and place of one valid or masked value.
VI_OBS = T.StructType([T.StructField("vi", T.StringType()), T.StructField("region", T.StringType()), T.StructField("tile", T.StringType()), T.StructField("crs", T.StringType()), T.StructField("seq", T.LongType()), T.StructField("time", T.TimestampNTZType()), T.StructField("y", T.DoubleType()), T.StructField("x", T.DoubleType()), T.StructField("value", T.FloatType())])
SERIES_COLUMNS = frozenset({"date", "vi_raw", "vi_count", "vi_std", "vi_daily"})


def nan_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """NaN is how rasters mark a missing value; in tables it is null."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns})


def read_observations(spark: SparkSession, path: str, vi: str | None = None, region: str | None = None) -> DataFrame:
    """Observations partitioned by vi and region; the filters prune partitions."""
    df = nan_to_null(spark.read.parquet(path), "value")
    for column, wanted in (("vi", vi), ("region", region)):
        df = df if wanted is None else df.where(F.col(column) == wanted)
    return df


def read_tiles(spark: SparkSession, folder: str, vi: str) -> DataFrame:
    """Tile files T*_{vi}.parquet; the tile is the stem before the last underscore."""
    df = spark.read.option("pathGlobFilter", f"T*_{vi}.parquet").schema(VI_OBS).parquet(folder)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]+$", 1)
    return nan_to_null(df.withColumn("tile", tile_of(stem)).withColumn("vi", F.lit(vi)), "value")


def read_datacubes(spark: SparkSession, folder: str) -> DataFrame:
    """Files {vi}_{region}_datacube.parquet below a folder, with both read off the name."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*_datacube.parquet").schema(VI_OBS).parquet(folder)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]+$", 1)
    return nan_to_null(df.withColumns(cube_identity(stem)), "value")


def tile_of(stem: Column) -> Column:
    return F.regexp_extract(stem, r"^(.*)_[^_]*$", 1)


def cube_identity(stem: Column, upper: bool = False) -> dict[str, Column]:
    """vi before the first underscore, region between it and '_datacube'; nulls where the name doesn't fit."""
    vi, region = F.regexp_extract(stem, r"^([^_]+)_(.+)_datacube$", 1), F.regexp_extract(stem, r"^([^_]+)_(.+)_datacube$", 2)
    return {"vi": F.nullif(F.upper(vi) if upper else vi, F.lit("")), "region": F.nullif(region, F.lit(""))}


def crs_of(crs_wkt: str = "crs_wkt", spatial_ref: str = "spatial_ref") -> Column:
    """The first that isn't empty; reading a row with neither fails."""
    found = F.coalesce(F.nullif(F.col(crs_wkt), F.lit("")), F.nullif(F.col(spatial_ref), F.lit("")))
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(F.lit("no coordinate system")))


def normalise_axes(df: DataFrame) -> DataFrame:
    """lat / lon as y / x; the one float column that isn't an axis as value."""
    names = {"lat": "y", "latitude": "y", "lon": "x", "longitude": "x"}
    for old, new in names.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    if "value" not in df.columns:
        found = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType)) and f.name not in ("y", "x")]
        df = df.withColumnRenamed(found[0], "value") if found else df
    return df


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("date", F.to_date("date"))


def is_series(df: DataFrame) -> bool:
    return SERIES_COLUMNS <= set(df.columns)


def lineitem_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test tables seen as observations: a quantity at a supplier's place on a ship date."""
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", "s_nationkey")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    joined = line.join(supplier, line["l_suppkey"] == supplier["s_suppkey"]).join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    vi = F.when(F.col("l_returnflag") == "A", "NDVI").when(F.col("l_returnflag") == "N", "EVI2").otherwise("NIRv")
    return joined.select(vi.alias("vi"), F.col("n_name").alias("region"), F.col("l_linestatus").alias("tile"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.col("l_shipdate").alias("time"), (F.col("l_suppkey") * F.lit(30.0)).alias("y"), (F.col("l_linenumber") * F.lit(30.0)).alias("x"), (F.col("l_quantity") / 50.0).alias("value"))
