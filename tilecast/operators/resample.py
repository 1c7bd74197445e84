"""Bringing imagery onto the layout's pixels."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tilecast.functions.columns import BANDS, SEASONS
from tilecast.layout import Layout, SourceGrid
from tilecast.operators.focal import buffered_windows


def resample(
    tiles: DataFrame,
    targets: DataFrame,
    layout: Layout,
    grid: SourceGrid,
    method: str = "bilinear",
    seasons: Sequence[str] = SEASONS,
    bands: Sequence[int] = BANDS,
    **reading,
) -> DataFrame:
    """Target cells read through ``grid`` with the ``bilinear`` or ``nearest`` kernel.

    Source pixels without data are left out and the remaining weights rescaled.
    """
    return buffered_windows(
        tiles, targets, layout, 0, seasons, bands, grid=grid, method=method, **reading
    )


def resample_scenes(
    tiles: DataFrame,
    targets: DataFrame,
    layout: Layout,
    grids: DataFrame,
    method: str = "bilinear",
    seasons: Sequence[str] = SEASONS,
    bands: Sequence[int] = BANDS,
    **reading,
) -> DataFrame:
    """The same for scenes that each have a grid of their own.

    ``grids`` has ``scene_id`` and its grid's ``scale_x, offset_x, scale_y, offset_y``, a row per scene
    (:func:`tilecast.operators.windows.scene_grids` makes it from transforms). Which source tiles a
    target reads, and with which weights, follows from its scene's row. Scenes without a row lie on
    the layout's own pixels.
    """
    return buffered_windows(tiles, targets, layout, 0, seasons, bands, grids=grids, method=method, **reading)
