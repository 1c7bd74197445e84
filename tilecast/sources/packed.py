"""Stores of packed tiles: mosaics of sub-tiles, and pyramids of all levels of an image."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilecast.functions.columns import validity_mask
from tilecast.operators.packed import kinds_of, pack_tiles, read_windows
from tilecast.operators.tiles import overviews

# Fixed value: side of a stored square of a pyramid, in pixels.
CHUNK = 256

#: Tiles along each side of a folder.
BLOCK = 32


def write_packed(
    packed: DataFrame, path: str, folders: Sequence[str] = (), block: int = BLOCK, mode: str = "errorifexists"
) -> None:
    """Store packed tiles by ``folders`` and block of ``block`` x ``block`` tiles.

    With ``block`` a multiple of a coarse factor, the sub-tiles of a coarse cell lie in one
    folder. Range partitioning splits large folders by cell, so files stay of similar size.
    """
    order = [*folders, "block_col", "block_row", "col", "row"]
    blocked = packed.withColumns(
        {f"block_{c}": F.floor(F.col(c) / F.lit(block)).cast("int") for c in ("col", "row")}
    )
    (
        blocked.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode(mode).partitionBy(*order[:-2]).parquet(path)
    )


def pack_pyramid(
    pixels: DataFrame, bands: Sequence[str], factors: Sequence[int], chunk: int = CHUNK,
    keys: Sequence[str] = (),
) -> tuple[DataFrame, dict[str, str]]:
    """Squares of ``chunk`` pixels of an image (``gx``, ``gy``), its overviews and its mask.

    One pass over the pixels makes all levels; ``factor`` 1 is the image itself. ``mask`` is 255
    where every band has a value, 0 elsewhere and NULL where the image has no pixel. ``keys`` tell
    images apart. Pixels must not repeat within an image. Also returned: the types of the values.
    """
    levels = overviews(
        pixels.select(*keys, "gx", "gy", *bands, validity_mask(bands).alias("mask")), [1, *factors]
    )
    square, side = {"gx": "col", "gy": "row"}, F.lit(chunk)
    places = {square[g]: F.floor(F.col(g) / side).cast("bigint") for g in square}
    places |= {f"_{g}": F.pmod(F.col(g), side).cast("int") for g in square}
    kinds = kinds_of(levels, [*bands, "mask"])
    packed = pack_tiles(
        levels.withColumns(places), [*keys, "factor", "col", "row"], kinds, chunk, chunk, "_gx", "_gy", unique=True
    )
    return packed, kinds


def write_pyramid(packed: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_packed(packed, path, ["factor"], mode=mode)


def pyramid_part(
    spark: SparkSession, path: str, factor: int, x0: int, y0: int, x1: int, y1: int, chunk: int = CHUNK
) -> DataFrame:
    """The stored squares of one level that a rectangle touches; other folders are not opened."""
    (c0, c1), (r0, r1) = (x0 // chunk, (x1 - 1) // chunk), (y0 // chunk, (y1 - 1) // chunk)
    return spark.read.parquet(path).where(
        (F.col("factor") == factor)
        & F.col("block_col").between(c0 // BLOCK, c1 // BLOCK)
        & F.col("block_row").between(r0 // BLOCK, r1 // BLOCK)
        & F.col("col").between(c0, c1) & F.col("row").between(r0, r1)
    )


def pyramid_windows(
    spark: SparkSession, path: str, windows: DataFrame, kinds: dict[str, str], chunk: int = CHUNK,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Windows of any level of a stored pyramid, in pixels of that level (see ``read_windows``)."""
    return read_windows(
        spark.read.parquet(path), windows, [*keys, "factor"], kinds, chunk, chunk, BLOCK
    )
