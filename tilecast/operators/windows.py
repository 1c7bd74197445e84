"""Buffered windows: each target cell together with the pixels around it, from its own scene.

The only data that moves is tile pieces: a cell's own tile and thin strips of its neighbours
(about 10 % more for 200-pixel cells and a halo of 5). Pieces of all seasons of a target meet
in one group, so reading, resampling, focal statistics and the pairing of seasons need a
single shuffle of imagery.
"""

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from types import MappingProxyType

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.functions import kernels
from tilecast.functions.columns import draws_for, poisson_steps
from tilecast.layout import Layout, SourceGrid
from tilecast.operators.tiles import crop
from tilecast.runtime import MAX_BROADCAST_ROWS, broadcast_if_small, materialize
from tilecast.sources.imagery import BLOCK, block_of


class _Axis:
    """Pixel ranges along x or y. Scale and offset are numbers, or names of columns that hold them."""

    def __init__(self, key: str, tile: int, scale: float | str, offset: float | str, buffer: int):
        self.key, self.tile, self.scale, self.offset, self.buffer = key, tile, scale, offset, buffer

    def at(self, scale: float, offset: float) -> "_Axis":
        """The same axis on one grid."""
        return _Axis(self.key, self.tile, scale, offset, self.buffer)

    @property
    def of_scenes(self) -> bool:
        return isinstance(self.scale, str)

    def _grid(self) -> tuple[Column, Column]:
        return tuple(F.col(v) if isinstance(v, str) else F.lit(v) for v in (self.scale, self.offset))

    def window(self, target: str) -> tuple[Column, Column]:
        """First and last source pixel that a target cell needs."""
        first = F.col(target) * self.tile - self.buffer
        last = first + (self.tile + 2 * self.buffer - 1)
        scale, offset = self._grid()
        return (
            F.floor(first * scale + offset).cast("bigint"),
            F.ceil(last * scale + offset).cast("bigint"),
        )

    def sources(self, target: str) -> Column:
        """Source tiles that hold pixels of a target's window."""
        first, last = self.window(target)
        tile = F.lit(self.tile)
        return F.sequence(
            F.floor(first / tile).cast("bigint"), F.floor(last / tile).cast("bigint")
        )

    def most_sources(self) -> int:
        """Most source tiles that one target's window can touch along this axis."""
        pixels = math.ceil((self.tile + 2 * self.buffer - 1) * self.scale) + 2
        return -(-pixels // self.tile) + 1

    def targets(self, source: str) -> Column:
        """Target cells whose window may reach a source tile."""
        first, last = F.col(source) * self.tile, F.col(source) * self.tile + (self.tile - 1)
        scale, offset = self._grid()
        tile = F.lit(self.tile)
        low = ((first - 1 - offset) / scale - self.buffer - (self.tile - 1)) / tile
        high = ((last + 1 - offset) / scale + self.buffer) / tile
        return F.sequence(F.ceil(low).cast("bigint"), F.floor(high).cast("bigint"))

    def overlap(self, source: str, target: str) -> tuple[Column, Column]:
        """Part of the window inside a source tile, as in-tile positions."""
        first, last = self.window(target)
        start = F.col(source) * self.tile
        return (
            F.greatest(first - start, F.lit(0)).cast("int"),
            F.least(last - start, F.lit(self.tile - 1)).cast("int"),
        )

    def length(self, cell: int) -> int:
        first = cell * self.tile - self.buffer
        last = first + self.tile + 2 * self.buffer - 1
        return math.ceil(last * self.scale + self.offset) - math.floor(first * self.scale + self.offset) + 1

    def positions(self, cell: int) -> np.ndarray:
        """Fractional positions of the target pixels inside the source window."""
        first = cell * self.tile - self.buffer
        target = first + np.arange(self.tile + 2 * self.buffer)
        return target * self.scale + self.offset - math.floor(first * self.scale + self.offset)


#: Columns that hold the grid of a scene.
GRID = ("scale_x", "offset_x", "scale_y", "offset_y")


def _axes(layout: Layout, grid: SourceGrid | None, buffer: int) -> tuple[_Axis, _Axis]:
    """Both axes; without a grid it is read from the columns ``GRID``."""
    if grid is None:
        return (
            _Axis("col", layout.tile_cols, "scale_x", "offset_x", buffer),
            _Axis("row", layout.tile_rows, "scale_y", "offset_y", buffer),
        )
    return (
        _Axis("col", layout.tile_cols, grid.scale_x, grid.offset_x, buffer),
        _Axis("row", layout.tile_rows, grid.scale_y, grid.offset_y, buffer),
    )


def _pieces(joined: DataFrame, keys: list[str], bands: Sequence[str], x: _Axis, y: _Axis) -> DataFrame:
    """Cut the part of each source tile (``s_col``, ``s_row``) that its target needs."""
    x0, x1 = x.overlap("s_col", "col")
    y0, y1 = y.overlap("s_row", "row")
    whole = (F.col("x1") - F.col("x0") == x.tile - 1) & (F.col("y1") - F.col("y0") == y.tile - 1)
    located = joined.withColumns({"x0": x0, "x1": x1, "y0": y0, "y1": y1}).where(
        (F.col("x0") <= F.col("x1")) & (F.col("y0") <= F.col("y1"))
    )
    return located.select(
        *keys,
        "season",
        (F.col("s_col") * x.tile + F.col("x0") - x.window("col")[0]).cast("int").alias("left"),
        (F.col("s_row") * y.tile + F.col("y0") - y.window("row")[0]).cast("int").alias("top"),
        (F.col("x1") - F.col("x0") + 1).cast("int").alias("width"),
        *[
            F.when(whole, F.col(b)).otherwise(
                crop(b, x.tile, F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
            ).alias(b)
            for b in bands
        ],
    )


def _by_season(targets: DataFrame, keys: Sequence[str], seasons: Sequence[str]) -> DataFrame:
    """A row per target and season: ``keys, season, scene_id``, and the scene's grid if targets have it."""
    each = []
    for s in seasons:
        grid = [F.col(_grid_column(s, g)).alias(g) for g in GRID if _grid_column(s, g) in targets.columns]
        each.append(F.struct(F.lit(s).alias("season"), F.col(s).alias("scene_id"), *grid))
    return targets.select(*keys, F.explode(F.array(*each)).alias("_s")).select(*keys, "_s.*")


def _grid_column(season: str, name: str) -> str:
    return f"_{season}_{name}"


def _with_grids(targets: DataFrame, grids: DataFrame, seasons: Sequence[str]) -> DataFrame:
    """Targets with the grid of each season's scene; scenes that are not listed lie on the layout's pixels."""
    plain = dict(zip(GRID, (1.0, 0.0, 1.0, 0.0)))
    known = broadcast_if_small(grids)
    for s in seasons:
        own = known.select(F.col("scene_id").alias("_scene"), *[F.col(g).cast("double").alias(f"_{g}") for g in GRID])
        targets = targets.join(own, F.col(s) == F.col("_scene"), "left").select(
            *targets.columns, *[F.coalesce(f"_{g}", F.lit(plain[g])).alias(_grid_column(s, g)) for g in GRID]
        )
    return targets


def _pull(tiles, targets, keys, seasons, bands, x, y) -> DataFrame:
    """Few targets: broadcast the source keys they need, so other imagery is never read."""
    needs = (
        _by_season(targets, keys, seasons)
        .withColumn("s_col", F.explode(x.sources("col")))
        .withColumn("s_row", F.explode(y.sources("row")))
    )
    on = ["season", "scene_id", "s_col", "s_row"]
    blocks = [c for c in ("block_col", "block_row") if c in tiles.columns]
    if blocks:
        needs = needs.withColumns({"block_col": block_of("s_col"), "block_row": block_of("s_row")})
    source = tiles.withColumnsRenamed({"col": "s_col", "row": "s_row"})
    return _pieces(source.join(F.broadcast(needs), on + blocks), keys, bands, x, y)


#: Bitmaps of wanted cells (4 KB for 32,768 cells) that may be broadcast: 40 MB.
MAX_BITMAPS = 10_000

_BITS = 32_768


def _needed_only(source: DataFrame, targets: DataFrame, seasons, x, y) -> DataFrame:
    """Source tiles that some target needs, in place: a bitmap of cells for each storage block.

    The join is on the block, so folders of other blocks are not read, and other tiles of a block
    go before anything is shuffled. Beyond ``MAX_BITMAPS`` all tiles stay, which is correct too.
    """
    cell = (F.pmod("s_col", F.lit(BLOCK)) * BLOCK + F.pmod("s_row", F.lit(BLOCK))).cast("bigint")
    blocks = {"block_col": block_of("s_col"), "block_row": block_of("s_row"), "_half": (cell / _BITS).cast("int")}
    needed = (
        (_by_season(targets, ["col", "row"], seasons).drop("season", "scene_id") if x.of_scenes else targets.select("col", "row")).distinct()
        .withColumn("s_col", F.explode(x.sources("col"))).withColumn("s_row", F.explode(y.sources("row")))
        .withColumns(blocks)
        .groupBy(*blocks)
        .agg(F.bitmap_construct_agg(F.pmod(cell, F.lit(_BITS))).alias("_cells"))
    )
    needed = materialize(needed, "bitmaps")
    if needed.count() > MAX_BITMAPS:
        return source
    byte = F.conv(F.hex(F.substring("_cells", (F.pmod(cell, F.lit(_BITS)) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    stored = [c for c in ("block_col", "block_row") if c in source.columns]
    located = source.withColumns({name: made for name, made in blocks.items() if name not in stored})
    return (
        # Spark prunes folders at run time only where the other side has a filter of its own.
        located.join(F.broadcast(needed.where(F.bitmap_count("_cells") > 0)), list(blocks))
        .where(F.getbit(byte, (cell % 8).cast("int")) == 1)
        .drop("_cells", "_half")
    )


def _push(tiles, targets, keys, seasons, bands, x, y, grids=None) -> DataFrame:
    """Many targets: send each tile's pieces to the cells around it, in one shuffle.

    The join is on the cell alone. Season and scene are compared as a condition over both
    sides, so the pieces arrive partitioned by cell, which is what the grouping needs too.
    """
    source = _needed_only(tiles.withColumnsRenamed({"col": "s_col", "row": "s_row"}), targets, seasons, x, y)
    if x.of_scenes:  # which targets a tile reaches follows from its scene's grid
        scene = source.select("season", "scene_id", "s_col", "s_row", *bands).withColumnRenamed("scene_id", "own")
        source = _with_grids(scene, grids, ["own"]).withColumnsRenamed({"own": "scene_id", **{_grid_column("own", g): g for g in GRID}})
    carried = GRID if x.of_scenes else ()
    sent = source.select(
        "season", "scene_id", "s_col", "s_row", *bands, *carried, F.explode(x.targets("s_col")).alias("col")
    ).withColumn("row", F.explode(y.targets("s_row")))
    pieces = _pieces(sent, ["col", "row", "scene_id"], bands, x, y).alias("p")
    # Hashing the keys of the targets spares a sort of the imagery.
    wanted = targets.hint("shuffle_hash").alias("t")
    same_scene = reduce(
        lambda otherwise, s: F.when(F.col("p.season") == s, F.col(f"t.{s}")).otherwise(otherwise),
        seasons,
        F.lit(None).cast("string"),
    )
    joined = pieces.join(
        wanted,
        (F.col("p.col") == F.col("t.col"))
        & (F.col("p.row") == F.col("t.row"))
        & (same_scene == F.col("p.scene_id")),
    )
    return joined.select(*[F.col(f"t.{k}") for k in keys], "p.season", "left", "top", "width", *bands)


def _with_layers(pieces, layers, targets, keys, few) -> DataFrame:
    """Append the tiles of the extra layers, each in a column of its own."""
    wanted = F.broadcast(targets) if few else targets.hint("shuffle_hash")
    blocks = [c for c in ("block_col", "block_row")]
    for name, layer in layers.items():
        on = ["col", "row"]
        if set(blocks) <= set(layer.columns):  # stored by block: other folders are not read
            on = [*blocks, *on]
            wanted = wanted.withColumns({"block_col": block_of("col"), "block_row": block_of("row")})
        tiles = layer.select(*on, name).join(wanted, on).select(*keys, name)
        pieces = pieces.unionByName(tiles, allowMissingColumns=True)
    return pieces


@dataclass(frozen=True)
class Layer:
    """A raster on a grid of its own, in tiles of the layout's size: ``col, row`` and an array column."""

    tiles: DataFrame
    grid: SourceGrid
    method: str = "bilinear"


def scene_grids(transforms: DataFrame, layout: Layout) -> DataFrame:
    """``scene_id`` and ``GRID`` from the transform of each scene.

    ``transforms`` has ``scene_id``, the upper-left corner ``xmin, ymax`` of north-up imagery, and
    its ``pixel_width, pixel_height``. The transform is data: nothing of it passes through the driver.
    """
    width, height = F.col("pixel_width"), F.col("pixel_height")
    return transforms.select(
        "scene_id",
        (F.lit(layout.pixel_width) / width).alias("scale_x"),
        ((F.lit(layout.xmin + layout.pixel_width / 2) - F.col("xmin")) / width - 0.5).alias("offset_x"),
        (F.lit(layout.pixel_height) / height).alias("scale_y"),
        ((F.col("ymax") - F.lit(layout.ymax) + F.lit(layout.pixel_height / 2)) / height - 0.5).alias("offset_y"),
    )


def window_map(
    tiles: DataFrame,
    targets: DataFrame,
    seasons: Sequence[str],
    bands: Sequence[str],
    layout: Layout,
    compute: Callable[[str, np.ndarray], dict[str, np.ndarray]],
    outputs: Sequence[str],
    buffer: int = 0,
    grid: SourceGrid = SourceGrid(),
    method: str = "bilinear",
    layers: Mapping[str, DataFrame | Layer] = MappingProxyType({}),
    grids: DataFrame | None = None,
    carry: Sequence[str] = (),
    sample: tuple[float, int] | None = None,
    max_broadcast: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Apply ``compute`` to the buffered window of every target cell.

    Args:
        tiles: imagery in tile form: ``season, scene_id, col, row`` and one array per band,
            unique in its key (as :func:`assemble_tiles` and the tile table provide).
        targets: ``col, row`` and one column per season naming the scene to read from.
        compute: gets the season and a ``[bands, height, width]`` array on the target grid,
            NaN for nodata, and returns named two-dimensional arrays.
        outputs: names of all arrays that ``compute`` returns over the seasons.
        grid, method: where the imagery's pixels lie, and how to resample them.
        layers: further rasters: ``col, row`` and an array column of the given name, unique per
            cell. They join the same groups. A table lies on the layout's own pixels, such as
            label masks; a :class:`Layer` has its own grid and is resampled in the group.
        grids: ``scene_id`` and the columns ``GRID``, a row per scene whose pixels are not the
            layout's; in place of ``grid``. See :func:`scene_grids`. Every target has a row then.
        carry: columns of ``targets`` to keep in the result.
        sample: rate (at most ``MAX_RATE_PER_DRAW``) and seed of a Poisson sample of each target's
            pixels, drawn before the group returns; the draws are those of ``poisson_sample``.

    Returns:
        The target keys, the carried columns, and one dense array column per output and
        layer, NULL for nodata. The array of a layer without a tile is NULL. With ``sample`` the
        arrays hold drawn pixels only; ``_place`` and ``drawn`` say where each lies and how often
        it was drawn, and a target without a draw has empty arrays.
    """
    if sample and draws_for(sample[0]) > 1:
        raise ValueError(f"a rate of {sample[0]} takes several draws a pixel")
    steps = poisson_steps(sample[0]) if sample else []
    draws = ["_place", "drawn"] if sample else []
    x, y = _axes(layout, grid if grids is None else None, buffer)
    identity = ["col", "row", *seasons, *carry]
    asked = targets.select(*identity).distinct()
    if grids is not None:
        grids = materialize(grids.select("scene_id", *GRID), "grids")
        asked = _with_grids(asked, grids, seasons)
    # Only keys, written once: counted here and read again by the join.
    wanted = materialize(asked, "targets")
    keys = wanted.columns  # a scene's grid goes with its target
    total = wanted.count()

    def few(x: _Axis, y: _Axis, sources: int) -> bool:
        return total * sources * x.most_sources() * y.most_sources() <= max_broadcast

    if grids is None:
        pull = few(x, y, len(seasons))
    else:
        scales = grids.agg(*[F.greatest(F.max(c), F.lit(1.0)) for c in ("scale_x", "scale_y")]).first()
        pull = few(x.at(scales[0] or 1.0, 0.0), y.at(scales[1] or 1.0, 0.0), len(seasons))
    pieces = _pull(tiles, wanted, keys, seasons, bands, x, y) if pull else _push(tiles, wanted, keys, seasons, bands, x, y, grids)
    if grids is not None:
        # A grid may leave a target without any stored pixel: it is nodata then, not left out.
        pieces = pieces.unionByName(wanted, allowMissingColumns=True)
    plain = {name: layer for name, layer in layers.items() if not isinstance(layer, Layer)}
    pieces = _with_layers(pieces, plain, wanted, keys, pull)
    resampled = {}
    for name, layer in layers.items():
        if isinstance(layer, Layer):
            lx, ly = _axes(layout, layer.grid, 0)
            resampled[name] = (lx, ly, layer.method)
            # Its tiles come like those of a season with a single scene and band.
            own = f"_{name}"
            source = layer.tiles.select(F.lit(own).alias("season"), F.lit(name).alias("scene_id"), "col", "row", name)
            asking = wanted.withColumn(own, F.lit(name))
            found = (_pull if few(lx, ly, 1) else _push)(source, asking, keys, [own], [name], lx, ly)
            pieces = pieces.unionByName(found, allowMissingColumns=True)
    of_scenes = grids is not None
    aligned, count, extra = not of_scenes and grid.aligned, len(bands), list(layers)
    names = [*identity, *outputs, *extra, *draws]
    schema = T.StructType(
        [wanted.schema[k] for k in identity]
        + [T.StructField(o, T.ArrayType(T.DoubleType())) for o in (*outputs, *extra)]
        + [T.StructField(d, T.ArrayType(T.IntegerType())) for d in draws]
    )

    def split(lists):
        """The values of a list column, one array per row; empty for NULL."""
        values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
        lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return np.split(values, np.cumsum(lengths)[:-1])

    def build(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        col, row = key[0].as_py(), key[1].as_py()
        axes = dict.fromkeys(seasons, (x, y))
        if of_scenes:
            values = dict(zip(keys, (k.as_py() for k in key)))
            for s in seasons:
                sx, ox, sy, oy = (values[_grid_column(s, g)] for g in GRID)
                axes[s] = (x.at(sx, ox), y.at(sy, oy))
        canvas = {
            s: np.full((count, ay.length(row), ax.length(col)), np.nan) for s, (ax, ay) in axes.items()
        }
        results = dict.fromkeys(extra)
        sheets = {name: np.full((1, ly.length(row), lx.length(col)), np.nan) for name, (lx, ly, _) in resampled.items()}
        seen = set()
        for batch in batches:
            place = list(zip(*[batch.column(c).to_pylist() for c in ("season", "left", "top", "width")]))
            for band, name in enumerate(bands):
                for (season, left, top, width), part in zip(place, split(batch.column(name))):
                    if part.size:
                        part = part.reshape(-1, width)
                        canvas[season][band, top : top + part.shape[0], left : left + width] = part
            for name in extra:
                for (_, left, top, width), part in zip(place, split(batch.column(name))):
                    if part.size and name in sheets:
                        part = part.reshape(-1, width)
                        sheets[name][0, top : top + part.shape[0], left : left + width] = part
                        seen.add(name)
                    elif part.size:
                        results[name] = part

        def on_target(pixels, ax, ay, kernel):
            return kernels.resample(
                pixels,
                kernels.axis_weights(ay.positions(row), pixels.shape[1], kernel),
                kernels.axis_weights(ax.positions(col), pixels.shape[2], kernel),
            )

        for season, pixels in canvas.items():
            results.update(compute(season, pixels if aligned else on_target(pixels, *axes[season], method)))
        for name in seen:
            results[name] = on_target(sheets[name], *resampled[name])[0]

        def listed(values):
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        def column(a):
            if a is None:
                return pa.nulls(1, pa.list_(pa.float64()))
            a = np.ascontiguousarray(a, dtype=float).ravel()
            return listed(pa.array(a if sample is None else a[spots], from_pandas=True))

        if sample:
            spots, drawn = kernels.drawn_pixels(
                f"{sample[1]}_{col}_{row}", layout.tile_cols, layout.tile_rows, steps
            )
        own = [pa.array([k.as_py()], k.type) for k in key[: len(identity)]]
        yield pa.RecordBatch.from_arrays(
            own + [column(results[o]) for o in (*outputs, *extra)]
            + ([listed(pa.array(spots)), listed(pa.array(drawn))] if sample else []),
            names=names,
        )

    return pieces.groupBy(*keys).applyInArrow(build, schema)
