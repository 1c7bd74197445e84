"""Reports of runs that work at the same time, kept by run, iteration and writer."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.sources.tables import METRICS

#: Columns that the folders hold.
PLACE = ["run", "iteration", "writer"]

_WRITER = re.compile(r"[A-Za-z0-9][A-Za-z0-9.-]*")


class ReportConflict(RuntimeError):
    """Several writers have reported on one iteration of a run; all reports are kept."""

    def __init__(self, run: int | str, iteration: int, writers: list[str]):
        super().__init__(f"run {run}, iteration {iteration} has reports by {', '.join(writers)}")
        self.run, self.iteration, self.writers = run, iteration, writers


def _layout(schema: T.StructType, run_type: T.DataType) -> T.StructType:
    own = [f for f in schema.fields if f.name not in PLACE]
    kinds = (run_type, T.IntegerType(), T.StringType())
    return T.StructType([*own, *[T.StructField(name, kind) for name, kind in zip(PLACE, kinds)]])


def write_report(
    report: DataFrame, folder: str, run: int | str, iteration: int, writer: str, single_file: bool = True
) -> None:
    """Store a report (or the selected names) of one iteration as CSV, in a folder of its writer.

    ``writer`` names the cluster or job; it must be the same when that job runs again, which
    replaces its own report alone. No writer ever opens another one's folder for writing. Each looks
    at the others after its own report is complete, so of writers that overlap at least the last
    one to finish raises :class:`ReportConflict`; the reports of all of them stay. Rows of another
    run or iteration are an error.
    """
    for name in (writer, str(run)):
        if not _WRITER.fullmatch(name):
            raise ValueError(f"{name!r} cannot be the name of a folder")
    for name, value in (("run", run), ("iteration", iteration)):
        if name in report.columns:
            wrong = F.raise_error(F.lit(f"a row is not of {name} {value}")).cast("boolean")
            report = report.where(F.when(F.col(name).eqNullSafe(F.lit(value)), F.lit(True)).otherwise(wrong))
    rows = report.drop(*PLACE)
    place = f"{folder.rstrip('/')}/run={run}/iteration={iteration}"
    (rows.coalesce(1) if single_file else rows).write.mode("overwrite").option("header", True).csv(
        f"{place}/writer={writer}"
    )
    kept = read_reports(report.sparkSession, folder, report.schema, place=place, run_type=T.StringType())
    writers = sorted(r[0] for r in kept.select("writer").distinct().collect())
    if len(writers) > 1:
        raise ReportConflict(run, iteration, writers)


def read_reports(
    spark: SparkSession, folder: str, schema: T.StructType = METRICS, place: str | None = None,
    run_type: T.DataType | None = None,
) -> DataFrame:
    """All reports below ``folder`` with their run, iteration and writer.

    Conditions on these three open the folders they need. ``place`` is a folder further down. Runs
    have the type that ``schema`` gives them, whole numbers if it has none.
    """
    if run_type is None:
        run_type = schema["run"].dataType if "run" in schema.names else T.IntegerType()
    return (
        spark.read.schema(_layout(schema, run_type)).option("header", True).option("enforceSchema", False)
        .option("basePath", folder).csv(place or folder)
    )


def conflicts(reports: DataFrame) -> DataFrame:
    """Iterations with reports by more than one writer, with the sorted names of all."""
    return (
        reports.groupBy("run", "iteration").agg(F.sort_array(F.collect_set("writer")).alias("writers"))
        .where(F.size("writers") > 1)
    )
