"""Validation metrics of a binary classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.functions.columns import TIME_FORMAT
from tilecast.operators.ranking import running_totals
from tilecast.runtime import materialize
from tilecast.sources.tables import METRICS


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, copies: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Counts ``tn, fp, fn, tp`` (actual class by row, predicted class by column)."""
    weight = F.col(copies) if copies else F.lit(1)

    def cell(actual: int, predicted: int) -> Column:
        hit = (F.col(label) == actual) & (F.col(prediction) == predicted)
        return F.coalesce(F.sum(F.when(hit, weight)), F.lit(0)).cast("bigint")

    return df.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def rates(matrix: DataFrame) -> DataFrame:
    """Add accuracy, TSS, and precision, recall, FPR and TPR of the positive class.

    A ratio over an empty class is NULL.
    """
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))
    tpr, fpr = F.try_divide(tp, tp + fn), F.try_divide(fp, fp + tn)
    return matrix.select(
        "*",
        (tpr + F.try_divide(tn, tn + fp) - 1).alias("tss"),
        F.try_divide(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        tpr.alias("recall"),
        fpr.alias("fpr"),
        tpr.alias("tpr"),
    )


def binary_metrics(df: DataFrame, label: str, prediction: str, **options) -> DataFrame:
    return rates(confusion_matrix(df, label, prediction, **options))


def area_under_roc(df: DataFrame, label: str, score: str, copies: str | None = None) -> DataFrame:
    """One row: the chance that a positive row scores above a negative one, ties counted half.

    Rows are first reduced to one per distinct score, so many equal scores are no skew.
    """
    weight = F.col(copies) if copies else F.lit(1)
    scores = materialize(
        df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
            F.sum(F.when(F.col(label) == 1, weight).otherwise(0)).alias("pos"),
            F.sum(F.when(F.col(label) == 0, weight).otherwise(0)).alias("neg"),
        ),
        "scores",
    )
    ranked = running_totals(scores, "score", ["neg"])
    below = F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / F.lit(2.0))
    return ranked.agg(
        F.sum(below).alias("below"),
        F.sum("pos").cast("double").alias("p"),
        F.sum("neg").cast("double").alias("n"),
    ).select(F.try_divide("below", F.col("p") * F.col("n")).alias("auc"))


def format_time(moment: Column) -> Column:
    """A moment as the metrics file has it: in UTC, to the microsecond."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), TIME_FORMAT)


def metrics_report(
    df: DataFrame,
    label: str,
    prediction: str,
    score: str,
    run: int | str,
    iteration: int,
    aoi: str,
    copies: str | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One row in the layout of the metrics file; ``now`` is the moment it is made, if not this one."""
    counted = binary_metrics(df, label, prediction, copies=copies)
    run_type = "int" if isinstance(run, int) else "string"
    columns = {
        "run": F.lit(run).cast(run_type),
        "iteration": F.lit(iteration).cast("int"),
        "AUC": area_under_roc(df, label, score, copies=copies).scalar(),
        "aoi": F.lit(aoi),
        "iteration_time": format_time(F.current_timestamp() if now is None else now),
    }
    return counted.select(*[columns[c].alias(c) if c in columns else c for c in METRICS.names])
