"""Which cells should be labelled next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.layout import Layout
from tilecast.operators.ranking import smallest
from tilecast.operators.sampling import take_sample
from tilecast.runtime import broadcast_if_small, materialize

# Fixed value: share of all scored cells that counts as most uncertain.
WORST_SHARE = 0.05


def cell_certainty(scored: DataFrame, p_no_field: str, weight: str | None = None) -> DataFrame:
    """Mean squared distance of the class probability from one half, per cell.

    Pixels are summed up map-side, so one row per cell and task is shuffled.
    """
    distance = F.pow(F.col(p_no_field) - F.lit(0.5), F.lit(2.0))
    w = F.col(weight) if weight else F.lit(1)
    return scored.groupBy("col", "row").agg(
        (F.sum(distance * w) / F.sum(w)).alias("certainty")
    )


def with_cell_index(cells: DataFrame, layout: Layout) -> DataFrame:
    return cells.withColumn("cell_index", F.col("row") * layout.cols + F.col("col"))


def worst_cells(certainty: DataFrame, layout: Layout, share: float = WORST_SHARE) -> DataFrame:
    """The least certain ``share`` of all cells (rounded half to even; ties by cell)."""
    cells = materialize(certainty, "certainty")
    n = round(share * cells.count())
    return smallest(with_cell_index(cells, layout), n, "certainty", "cell_index").select(*certainty.columns)


def outgoing_names(
    cells: DataFrame, pool: DataFrame, run: int | str, iteration: int
) -> DataFrame:
    """Pool sites on the selected cells, in the layout of the names file."""
    return pool.join(cells.select("col", "row"), ["col", "row"], "left_semi").select(
        "name",
        F.lit(run).alias("run"),
        F.lit(iteration).cast("int").alias("iteration"),
        F.lit(False).alias("processed"),
        F.lit("train").alias("usage"),
    )


def select_names(
    certainty: DataFrame,
    pool: DataFrame,
    layout: Layout,
    number: int,
    run: int | str,
    iteration: int,
    seed: int,
    share: float = WORST_SHARE,
) -> DataFrame:
    """A random ``number`` of the least certain cells, by name."""
    worst = with_cell_index(worst_cells(certainty, layout, share), layout)
    chosen = take_sample(worst, number, seed, ["col", "row"], "cell_index")
    return outgoing_names(chosen, pool, run, iteration)


def restrict(scored: DataFrame, cells: DataFrame) -> DataFrame:
    """Scored pixels on the given cells."""
    return scored.join(
        broadcast_if_small(cells.select("col", "row").distinct()), ["col", "row"], "left_semi"
    )
