"""Result sinks: probability tiles, report files, and database tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions.columns import output_path, scale_to_int8
from tilecast.layout import Layout
from tilecast.operators.packed import kinds_of, pack_tiles

# Fixed value: cells along each side of a published tile.
COARSE_FACTOR = 10

# Fixed value: columns of the metrics table, in the order of its rows.
METRICS_TABLE = [
    "run", "iteration", "tss", "accuracy", "aoi", "iteration_time",
    "precision", "recall", "fpr", "tpr", "auc",
]
NAMES_TABLE = ["name", "run", "iteration", "processed", "usage"]


class NoNewNames(RuntimeError):
    """The selection came out empty: new imagery is needed before the next iteration."""


def probability_tiles(
    scored: DataFrame,
    layout: Layout,
    value: str = "p_field",
    factor: int = COARSE_FACTOR,
    unique: bool = False,
) -> DataFrame:
    """Coarse tiles of the probability in percent, as signed bytes, NULL where not scored.

    Pixels are packed straight into their coarse tile, so there is one shuffle, of some two
    bytes a pixel. ``unique`` says that no pixel is scored more than once.
    """
    coarse = layout.with_tile(layout.tile_cols * factor, layout.tile_rows * factor)
    percent = (
        scored.select(
            scale_to_int8(value).alias("value"),
            *[place.alias(name) for name, place in layout.global_pixel().items()],
        )
        .withColumns(coarse.cell_of())
    )
    return pack_tiles(
        percent, ["col", "row"], kinds_of(percent, ["value"]), coarse.tile_cols, coarse.tile_rows,
        unique=unique, arrays=True,
    )


def publish(
    tiles: DataFrame, folder: str, pattern: str, aoi: str, run: int | str, iteration: int,
    mode: str = "overwrite",
) -> None:
    """Write tiles below ``folder``, with the location that ``pattern`` gives each of them.

    By default they replace those of the same area, run and iteration, and leave all others.
    """
    labelled = tiles.withColumns(
        {"aoi": F.lit(aoi), "run": F.lit(run), "iteration": F.lit(iteration)}
    )
    path = output_path(pattern, "col", "row", "aoi", "run", "iteration")
    (
        labelled.withColumn("path", path)
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("aoi", "run", "iteration").parquet(folder)
    )


def metrics_rows(metrics: DataFrame, run: int, iteration: int) -> DataFrame:
    """The first report of the run and iteration, in table layout; absent columns are NULL."""
    renamed = metrics.withColumnRenamed("AUC", "auc")
    found = {c.lower(): c for c in renamed.columns}
    ordered = renamed.where((F.col("run") == run) & (F.col("iteration") == iteration)).select(
        *[F.col(found[c]).alias(c) if c in found else F.lit(None).alias(c) for c in METRICS_TABLE]
    )
    return ordered.orderBy(*METRICS_TABLE).limit(1)


def names_rows(names: DataFrame, run: int, iteration: int) -> DataFrame:
    """The names selected in the run and iteration, in table layout."""
    return names.where((F.col("run") == run) & (F.col("iteration") == iteration)).select(*NAMES_TABLE)


def jdbc_writer(url: str, properties: dict[str, str]) -> Callable[[DataFrame, str], None]:
    def write(df: DataFrame, table: str) -> None:
        df.write.jdbc(url, table, mode="append", properties=properties)

    return write
