"""Load the results of an iteration into the database of the labelling service."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tilecast.operators.sites import current_iteration
from tilecast.sources.publish import NoNewNames, metrics_rows, names_rows


# The tables of the labelling service.
METRICS_TABLE_NAME = "iteration_metrics"
NAMES_TABLE_NAME = "incoming_names"


def load_results(
    metrics: DataFrame,
    names: DataFrame,
    incoming: DataFrame,
    run: int,
    write: Callable[[DataFrame, str], None],
    metrics_table: str = METRICS_TABLE_NAME,
    names_table: str = NAMES_TABLE_NAME,
) -> None:
    """Append the metrics first, as the names refer to them, then the selected names.

    ``write`` appends a frame to a table, for example ``jdbc_writer(url, properties)``.
    """
    iteration = current_iteration(incoming, run).first()[0]
    if iteration is None:
        raise ValueError(f"run {run} has no incoming names")
    write(metrics_rows(metrics, run, iteration), metrics_table)
    if names.isEmpty():
        raise NoNewNames(f"no cell was selected in run {run}, iteration {iteration}; add imagery first")
    write(names_rows(names, run, iteration), names_table)
