"""Imagery, label masks and probability tiles, stored in tile form as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells along each side of a storage block, the unit of partition pruning.
BLOCK = 256


def block_of(key: str):
    return F.floor(F.col(key) / F.lit(BLOCK)).cast("int")


def write_tiles(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Store tiles so that readers of a few cells open few files.

    Range partitioning by block and cell gives files of similar size whatever the share of a
    single scene, and tight min/max statistics for ``col`` and ``row``.
    """
    folders = (["season"] if "season" in df.columns else []) + ["block_col", "block_row"]
    order = [*folders, "col", "row"]
    (
        df.withColumns({"block_col": block_of("col"), "block_row": block_of("row")})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode).partitionBy(*folders).parquet(path)
    )


def read_tiles(spark: SparkSession, path: str, bands: Sequence[str] | None = None) -> DataFrame:
    """Tiles keyed by season, scene and cell. Only the named band columns are read.

    ``block_col`` and ``block_row`` stay in the frame: joins that use them prune folders.
    """
    tiles = spark.read.parquet(path)
    if bands is None:
        return tiles
    keys = [
        c for c in ("season", "scene_id", "col", "row", "block_col", "block_row")
        if c in tiles.columns
    ]
    return tiles.select(*keys, *bands)


def read_masks(spark: SparkSession, path: str, sites: DataFrame, band: str = "mask") -> DataFrame:
    """Label tiles of the listed cells, one row per cell."""
    masks = read_tiles(spark, path, [band])
    wanted = (
        sites.select("col", "row").distinct()
        .withColumns({"block_col": block_of("col"), "block_row": block_of("row")})
    )
    keys = ["block_col", "block_row", "col", "row"]
    return masks.join(wanted, keys, "left_semi").select("col", "row", band)
