"""Conversions between tile form and pixel form, and changes of tile size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.layout import Layout

PIXEL = ["column_index", "row_index"]


def explode_tiles(
    tiles: DataFrame, values: Sequence[str], tile_cols: int, keys: Sequence[str] | None = None
) -> DataFrame:
    """One row per pixel; all ``values`` advance together."""
    keys = [c for c in tiles.columns if c not in values] if keys is None else list(keys)
    return tiles.select(*keys, F.posexplode(F.arrays_zip(*values)).alias("_pos", "_px")).select(
        *keys,
        F.pmod("_pos", F.lit(tile_cols)).cast("int").alias("column_index"),
        F.floor(F.col("_pos") / F.lit(tile_cols)).cast("int").alias("row_index"),
        *[F.col("_px")[v].alias(v) for v in values],
    )


def _dense(packed: str, value: str, size: int, kind: str) -> Column:
    """Array of ``size`` values from entries sorted by position; missing positions are NULL."""
    entries = F.col(packed)
    empty = F.lit(None).cast(kind)

    def with_gap_after(entry: Column, i: Column) -> Column:
        following = F.coalesce(F.get(entries, i + 1)["pos"], F.lit(size))
        gap = F.array_repeat(empty, (following - entry["pos"] - 1).cast("int"))
        return F.concat(F.array(entry[value]), gap)

    leading = F.array_repeat(empty, F.get(entries, F.lit(0))["pos"].cast("int"))
    filled = F.flatten(F.concat(F.array(leading), F.transform(entries, with_gap_after)))
    return F.when(F.size(entries) == size, entries[value]).otherwise(filled)


def assemble_tiles(
    pixels: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    layout: Layout,
    unique: bool = False,
) -> DataFrame:
    """Inverse of :func:`explode_tiles`: one row per ``keys`` with dense row-major arrays.

    Absent pixels become NULL. Repeated pixels are first reduced to their largest value, with
    map-side combining, so a tile never gathers more than its fixed number of pixels. A caller
    who knows that no pixel repeats says ``unique`` and saves that shuffle.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pixels.schema.fields}
    position = (F.col("row_index") * layout.tile_cols + F.col("column_index")).cast("int")
    single = pixels.select(*keys, position.alias("pos"), *values)
    if not unique:
        single = single.groupBy(*keys, "pos").agg(*[F.max(v).alias(v) for v in values])
    packed = single.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("pos", *values))).alias("_packed")
    )
    return packed.select(
        *keys, *[_dense("_packed", v, layout.tile_size, kinds[v]).alias(v) for v in values]
    )


def crop(cells: str | Column, tile_cols: int, x0, x1, y0, y1) -> Column:
    """The rectangle of columns ``x0..x1`` and rows ``y0..y1`` (inclusive) of a row-major tile."""
    cells = F.col(cells) if isinstance(cells, str) else cells
    x0, x1, y0, y1 = [v if isinstance(v, Column) else F.lit(v) for v in (x0, x1, y0, y1)]
    return F.flatten(
        F.transform(
            F.sequence(y0.cast("int"), y1.cast("int")),
            lambda y: F.slice(cells, (y * tile_cols + x0 + 1).cast("int"), (x1 - x0 + 1).cast("int")),
        )
    )


def erode_tile(cells: str | Column, tile_cols: int, tile_rows: int, border: int) -> Column:
    """The tile without its outer ``border`` pixels."""
    return crop(cells, tile_cols, border, tile_cols - 1 - border, border, tile_rows - 1 - border)


def retile(tiles: DataFrame, values: Sequence[str], layout: Layout, factor: int) -> DataFrame:
    """Join ``factor`` x ``factor`` cells into one tile of the coarser layout.

    Tiles are unique per cell (a repeated one is an error), so at most ``factor`` squared meet
    in a group. Cells without a tile are NULL.
    """
    width, height, size = layout.tile_cols, layout.tile_rows, layout.tile_size
    kinds = {f.name: f.dataType.elementType.simpleString() for f in tiles.schema.fields if f.name in values}
    keys = [c for c in tiles.columns if c not in values and c not in ("col", "row")]
    col, row = F.col("col"), F.col("row")
    place = (F.pmod(row, F.lit(factor)) * factor + F.pmod(col, F.lit(factor))).cast("int")
    grouped = tiles.groupBy(
        *keys,
        F.floor(col / F.lit(factor)).cast("bigint").alias("_col"),
        F.floor(row / F.lit(factor)).cast("bigint").alias("_row"),
    ).agg(F.collect_list(F.struct(place, F.struct(*values))).alias("_entries"))

    def parts_of(by_place: Column, value: str) -> Column:
        blank = F.array_repeat(F.lit(None).cast(kinds[value]), size)
        return F.transform(
            F.sequence(F.lit(0), F.lit(factor * factor - 1)),
            lambda i: F.coalesce(by_place[i][value], blank),
        )

    def rows_of(parts: Column) -> Column:
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.lit(factor * height - 1)),
                lambda y: F.flatten(
                    F.transform(
                        F.sequence(F.lit(0), F.lit(factor - 1)),
                        lambda c: F.slice(
                            F.get(parts, (F.floor(y / F.lit(height)) * factor + c).cast("int")),
                            (F.pmod(y, F.lit(height)) * width + 1).cast("int"),
                            width,
                        ),
                    )
                ),
            )
        )

    def joined(value: str) -> Column:
        by_place = F.map_from_entries("_entries")
        return _bind(_bind(by_place, lambda m: parts_of(m, value)), rows_of)

    return grouped.select(
        *keys, F.col("_col").alias("col"), F.col("_row").alias("row"),
        *[joined(v).alias(v) for v in values],
    )


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` looks at it.

    Inside a lambda a plain expression would be computed again for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def overview_factors(size: int) -> list[int]:
    """Reduction factors of the overviews of an image that is ``size`` pixels wide."""
    return [2**j for j in range(1, int(size).bit_length() - 1 - 8 + 1)]


def overviews(pixels: DataFrame, factors: Sequence[int], gx: str = "gx", gy: str = "gy") -> DataFrame:
    """Reduced copies of an image: every ``factor``-th pixel along both axes (nearest).

    A single narrow pass over the pixels makes all levels.
    """
    x, y = F.col(gx), F.col(gy)
    kept = F.filter(
        F.array(*[F.lit(f) for f in factors]), lambda f: (F.pmod(x, f) == 0) & (F.pmod(y, f) == 0)
    )
    others = [c for c in pixels.columns if c not in (gx, gy)]
    return pixels.select(gx, gy, *others, F.explode(kept).alias("factor")).select(
        "factor",
        F.floor(x / F.col("factor")).cast("bigint").alias(gx),
        F.floor(y / F.col("factor")).cast("bigint").alias(gy),
        *others,
    )
