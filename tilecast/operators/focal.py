"""Neighbourhood statistics and the per-cell feature frame."""

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions import kernels
from tilecast.functions.columns import BANDS, SEASONS, band_columns, draws_for, feature_names
from tilecast.layout import Layout, SourceGrid
from tilecast.operators.sampling import poisson_sample
from tilecast.operators.tiles import PIXEL, explode_tiles
from tilecast.operators.windows import window_map

# Halo read around each cell, and the window sizes of the two statistics.
HALO = 5
MEAN_WINDOW = 11
STDDEV_WINDOW = 5


def _statistic(
    tiles: DataFrame,
    targets: DataFrame,
    layout: Layout,
    kind: str,
    buffer: int,
    kernel: Callable[[np.ndarray], np.ndarray],
    seasons: Sequence[str],
    bands: Sequence[int],
    **reading,
) -> DataFrame:
    """One array per season and band, named ``<season>_<kind>_<band>``, for each target."""

    def compute(season, a):
        return {f"{season}_{kind}_{b}": v for b, v in zip(bands, kernel(a))}

    outputs = [f"{s}_{kind}_{b}" for s in seasons for b in bands]
    return window_map(
        tiles, targets, list(seasons), band_columns(bands), layout, compute, outputs,
        buffer=buffer, **reading,
    )


def buffered_windows(
    tiles, targets, layout, buffer=HALO, seasons=SEASONS, bands=BANDS, **reading
) -> DataFrame:
    """Each target cell with ``buffer`` more pixels on every side, in tile form."""
    return _statistic(tiles, targets, layout, "raw", buffer, lambda a: a, seasons, bands, **reading)


def focal_means(
    tiles, targets, layout, size=MEAN_WINDOW, seasons=SEASONS, bands=BANDS, **reading
) -> DataFrame:
    """Mean over ``size`` x ``size`` pixels around each pixel of the target cells."""

    def kernel(a):
        return kernels.focal_mean(a, size)

    return _statistic(tiles, targets, layout, "avg", size // 2, kernel, seasons, bands, **reading)


def focal_stddevs(
    tiles, targets, layout, size=STDDEV_WINDOW, seasons=SEASONS, bands=BANDS, **reading
) -> DataFrame:
    """Population standard deviation over ``size`` x ``size`` pixels around each pixel."""

    def kernel(a):
        return kernels.focal_stddev(a, size)

    return _statistic(tiles, targets, layout, "std", size // 2, kernel, seasons, bands, **reading)


def focal_slopes(
    tiles, targets, layout, pixel_width=1.0, pixel_height=1.0, seasons=SEASONS, bands=BANDS, **reading
) -> DataFrame:
    """Slope in degrees of each band taken as a surface; needs all eight neighbours."""

    def kernel(a):
        return kernels.slope(a, pixel_width, pixel_height)

    return _statistic(tiles, targets, layout, "slope", 1, kernel, seasons, bands, **reading)


def features(
    tiles: DataFrame,
    targets: DataFrame,
    layout: Layout,
    seasons: Sequence[str] = SEASONS,
    bands: Sequence[int] = BANDS,
    grid: SourceGrid = SourceGrid(),
    method: str = "bilinear",
    **reading,
) -> DataFrame:
    """Raw values, means and standard deviations of every band and season, in tile form.

    One season gives that season's feature frame; several give the joined frame, without a
    join: all imagery of a target is in its group already.
    """
    bands = tuple(bands)

    def compute(s, a):
        kinds = {
            "raw": kernels.erode(a, HALO),
            "avg": kernels.focal_mean(a, MEAN_WINDOW),
            "std": kernels.erode(kernels.focal_stddev(a, STDDEV_WINDOW), HALO - STDDEV_WINDOW // 2),
        }
        return {f"{s}_{kind}_{b}": v[i] for kind, v in kinds.items() for i, b in enumerate(bands)}

    return window_map(
        tiles, targets, list(seasons), band_columns(bands), layout, compute,
        feature_names(seasons, bands), buffer=HALO, grid=grid, method=method, **reading,
    )


def gather(
    tiles: DataFrame,
    pairs: DataFrame,
    sites: DataFrame,
    layout: Layout,
    masks: DataFrame | None = None,
    seasons: Sequence[str] = SEASONS,
    bands: Sequence[int] = BANDS,
    dedupe: bool = False,
    sample: tuple[float, int] | None = None,
    **reading,
) -> DataFrame:
    """Feature pixels of the listed sites, with label, usage and ``copies`` if ``masks`` are given.

    Features are computed once per cell and pair of scenes. ``copies`` says how many rows the
    site list has for the cell and usage (or the sum of its own ``copies``) (1 with ``dedupe``); samples and counts of labelled
    pixels multiply by it, so a site listed very often costs no more pixels than any other.

    ``sample``, a rate and a seed, returns the pixels that ``poisson_sample`` with the four pixel
    keys would keep, with their count ``drawn``. They are drawn inside the group, so that
    others never leave it; only for sites without ``masks``.
    """
    if sample and masks is not None:
        raise ValueError("labelled pixels are balanced, not sampled")
    names = feature_names(seasons, bands)
    if masks is None:
        wanted = pairs.join(sites.select("col", "row").distinct(), ["col", "row"], "left_semi")
        keys = ["col", "row"]
        if sample and draws_for(sample[0]) > 1:
            pixels = gather(tiles, pairs, sites, layout, None, seasons, bands, **reading)
            return poisson_sample(pixels, *sample, [*keys, *PIXEL])
        frame = features(tiles, wanted, layout, seasons, bands, sample=sample, **reading)
        if not sample:
            return explode_tiles(frame, names, layout.tile_cols, keys)
        place, width = F.col("_px._place"), F.lit(layout.tile_cols)
        return frame.select(*keys, F.explode(F.arrays_zip("_place", "drawn", *names)).alias("_px")).select(
            *keys, F.pmod(place, width).cast("int").alias("column_index"),
            F.floor(place / width).cast("int").alias("row_index"),
            *[F.col(f"_px.{v}") for v in (*names, "drawn")],
        )
    rows = F.sum("copies") if "copies" in sites.columns else F.count("*")
    copies = F.max(F.lit(1).cast("bigint")) if dedupe else rows
    listed = sites.groupBy("col", "row", "usage").agg(copies.alias("copies"))
    site_columns = ["usage", "copies"]
    frame = features(
        tiles, pairs.join(listed, ["col", "row"]), layout, seasons, bands,
        layers={"mask": masks}, carry=site_columns, **reading,
    ).where("mask is not null")
    pixels = explode_tiles(frame, ["mask", *names], layout.tile_cols, ["col", "row", *site_columns])
    return pixels.withColumn("mask", F.col("mask").cast("int"))
