"""The cube of each index and region: which tiles merge, in which coordinate system and on which grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.projection import reproject
from . import mosaic

KEYS = ["vi", "region"]


def tile_extents(df: DataFrame, step: float = 30.0) -> DataFrame:
    """One row for each tile of an index and region: crs ('' where it is null), outermost lines, and cells between them."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("y", "x") for n, f in (("min", F.min), ("max", F.max))]
    out = df.groupBy(*KEYS, "tile", F.coalesce("crs", F.lit("")).alias("crs")).agg(*ends)
    across = lambda c: F.round((F.col(f"max_{c}") - F.col(f"min_{c}")) / step) + 1
    return out.withColumn("cells", across("y") * across("x"))


def merge_plans(tiles: DataFrame, merge_same: bool = True, merge_cross: bool = True) -> DataFrame:
    """One row for each index and region: n_tiles, n_crs, strategy, target, ref_y, ref_x.

    strategy is single, mosaic, reproject or per_tile.  The target is the system whose tiles have most cells, ties
    to the first by name; its first tile's northern and western lines are the grid's reference.
    """
    systems = tiles.groupBy(*KEYS, "crs").agg(F.sum("cells").alias("cells"), F.count(F.lit(1)).alias("n"), F.min(F.struct("tile", "max_y", "min_x")).alias("first"))
    best = F.min(F.struct((-F.col("cells")).alias("less"), "crs", "first")).alias("m")
    out = systems.groupBy(*KEYS).agg(F.sum("n").alias("n_tiles"), F.count(F.lit(1)).alias("n_crs"), best)
    merged = F.when(F.col("n_crs") == 1, F.lit("mosaic" if merge_same else "per_tile")).otherwise(F.lit("reproject" if merge_cross else "per_tile"))
    strategy = F.when(F.col("n_tiles") == 1, F.lit("single")).otherwise(merged)
    return out.select(*KEYS, "n_tiles", "n_crs", strategy.alias("strategy"), F.col("m.crs").alias("target"), F.col("m.first.max_y").alias("ref_y"), F.col("m.first.min_x").alias("ref_x"))


def colliding_lines(df: DataFrame, plans: DataFrame, step: float = 30.0) -> DataFrame:
    """Grid lines that two lines of one tile fall on: vi, region, tile, axis, line.  A tile of the target's grid has none."""
    placed = df.withColumn("crs", F.coalesce("crs", F.lit(""))).join(plans, KEYS).where("crs = target")
    lines = placed.select(*KEYS, "tile", F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).alias("raw"), mosaic.snap(c, F.col(f"ref_{c}"), step).alias("line")) for c in ("y", "x")])).alias("l")).select(*KEYS, "tile", "l.*")
    return lines.groupBy(*KEYS, "tile", "axis", "line").agg((F.min("raw") < F.max("raw")).alias("two")).where("two").drop("two")


def _moved(rows: DataFrame, tiles: DataFrame, source: str, target: str, step: float) -> DataFrame:
    """Tiles of ``source`` on the target's grid: bilinear from the four cells around, where the centre lies in the tile.

    Places are projected once for all dates.  Cells are numbered from the tile's south-western one, so that
    neighbours meet by whole numbers.
    """
    keys = [*KEYS, "tile"]
    edges = tiles.where(F.col("crs") == source).select(*keys, "min_y", "max_y", "min_x", "max_x")
    x, y = reproject(F.col("x"), F.col("y"), source, target)
    around = F.array(*[F.struct((F.lit(dy) * step).alias("dy"), (F.lit(dx) * step).alias("dx")) for dy in (-1, 0, 1) for dx in (-1, 0, 1)])
    centres = rows.select(*keys, "ref_y", "ref_x", "y", "x").distinct().select(*keys, "ref_y", "ref_x", y.alias("y"), x.alias("x"))
    grid = centres.select(*keys, mosaic.snap("y", F.col("ref_y"), step).alias("y"), mosaic.snap("x", F.col("ref_x"), step).alias("x"), F.explode(around).alias("a"))
    grid = grid.select(*keys, (F.col("y") + F.col("a.dy")).alias("y"), (F.col("x") + F.col("a.dx")).alias("x")).distinct()
    back_x, back_y = reproject(F.col("x"), F.col("y"), target, source)
    half = step / 2
    wanted = grid.select(*keys, "y", "x", back_y.alias("sy"), back_x.alias("sx")).join(edges, keys)
    wanted = wanted.where(F.col("sy").between(F.col("min_y") - half, F.col("max_y") + half) & F.col("sx").between(F.col("min_x") - half, F.col("max_x") + half))
    number = lambda c, low: (F.col(c) - F.col(low)) / step
    wanted = wanted.select(*keys, "y", "x", number("sy", "min_y").alias("ty"), number("sx", "min_x").alias("tx"))
    numbered = rows.select(*keys, "date", "y", "x", "value").join(edges, keys).withColumns({"y": F.bround(number("y", "min_y")), "x": F.bround(number("x", "min_x"))})
    return mosaic.bilinear(numbered, wanted, 1.0, keys=tuple(keys))


def merge(df: DataFrame, tiles: DataFrame, plans: DataFrame, step: float = 30.0) -> DataFrame:
    """vi, region, y, x, date, tile, value of the groups that merge: one value a cell and day, of the last tile by name.

    ``df`` has one value for each tile, place and day.  Tiles of other systems than their group's target are
    resampled; there is a branch of the plan for each pair of systems that meet, of which UTM bounds the number.
    """
    columns = [*KEYS, "tile", "y", "x", "date", "value"]
    placed = df.withColumn("crs", F.coalesce("crs", F.lit(""))).join(plans.where("strategy <> 'per_tile'"), KEYS)
    out = placed.where("crs = target").withColumns({c: mosaic.snap(c, F.col(f"ref_{c}"), step) for c in ("y", "x")}).select(columns)
    pairs = tiles.join(plans.where("strategy = 'reproject'"), KEYS).where("crs <> target").select("crs", "target").distinct().collect()
    for source, target in sorted(map(tuple, pairs)):
        rows = placed.where((F.col("crs") == source) & (F.col("target") == target))
        out = out.unionByName(_moved(rows, tiles, source, target, step).select(columns))
    return mosaic.last_tile_wins(out.withColumn("seq", F.lit(0)))


def apart(df: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows of the groups whose tiles stay apart, where they were."""
    return df.join(plans.where("strategy = 'per_tile'").select(KEYS), KEYS).select(*KEYS, "tile", "crs", "y", "x", "date", "value")


def describe(tiles: DataFrame, plans: DataFrame) -> DataFrame:
    """What a cube's file would say of it: strategy, coordinate system, tiles, which of them were resampled, and edges."""
    moved = F.when((F.col("strategy") == "reproject") & (F.col("crs") != F.col("target")), F.col("tile"))
    own = F.col("crs") == F.col("target")
    ends = [f(F.when(own, F.col(c))).alias(c) for f, c in ((F.min, "min_y"), (F.max, "max_y"), (F.min, "min_x"), (F.max, "max_x"))]
    names = [F.sort_array(F.collect_set(c)).alias(n) for c, n in ((F.col("tile"), "tiles"), (moved, "resampled"))]
    return tiles.join(plans, KEYS).groupBy(*KEYS, "strategy", F.col("target").alias("crs")).agg(*names, *ends)
