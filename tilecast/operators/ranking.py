"""Exact ranks and cut-offs over a whole table, without sorting it in one place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.runtime import materialize

#: Rows summed up in one task, and the most slices that the value range is cut into.
SLICE_ROWS = 1_000_000
MAX_SLICES = 10_000

#: Up to this many rows, sort-and-limit is used: every task sends that many rows to a last one.
MAX_LIMIT_ROWS = 1_000


def is_missing(column: str) -> Column:
    """NULL or NaN: no value to rank. Such rows come after all others, whatever the path taken."""
    return F.col(column).isNull() | F.isnan(F.col(column).cast("double"))


def running_totals(
    df: DataFrame, order: str, values: Sequence[str], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Add ``before_<v>``: the sum of ``v`` over all rows with a smaller ``order`` value.

    ``df`` has one row per ``order`` value (aggregate first, which also removes skew). The
    range is cut at approximate quantiles into slices of similar size; totals of the slices
    (at most ``MAX_SLICES`` rows) are summed up first, then rows inside each slice. Any cut
    gives exact results, so the quantiles need not be. NaN follows all numbers and NULL follows
    NaN; both lie in the last slice.
    """
    slices = min(MAX_SLICES, -(-df.count() // slice_rows))
    sliced = df.withColumn("_slice", F.lit(0.0))
    if slices > 1:
        probabilities = [i / slices for i in range(1, slices)]
        cuts = sorted(set(df.approxQuantile(order, probabilities, 0.25 / slices)))
        splits = [float("-inf"), *cuts, float("inf")]
        cut = Bucketizer(splits=splits, inputCol="_order", outputCol="_slice")
        ranked = df.withColumn("_order", F.when(~is_missing(order), F.col(order).cast("double")).otherwise(F.lit(float("inf"))))
        sliced = cut.transform(ranked).drop("_order")
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        sliced.groupBy("_slice").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        .select("_slice", *[F.coalesce(F.sum(f"_{v}").over(earlier), F.lit(0)).alias(f"_base_{v}") for v in values])
    )
    inside = Window.partitionBy("_slice").orderBy(F.col(order).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.select(
            "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values]
        )
        # At most MAX_SLICES rows, so the broadcast has a fixed bound.
        .join(F.broadcast(totals), "_slice")
        .select(
            *df.columns,
            *[(F.col(f"_base_{v}") + F.col(f"_in_{v}")).alias(f"before_{v}") for v in values],
        )
    )


def _cut(df: DataFrame, by: str, n: int) -> tuple[object, int]:
    """Value of ``by`` that the n-th smallest row has, and how many rows lie below it."""
    counts = materialize(df.groupBy(by).agg(F.count("*").alias("n")), "counts")
    row = (
        running_totals(counts, by, ["n"])
        .where((F.col("before_n") < n) & (F.col("before_n") + F.col("n") >= n))
        .first()
    )
    return row[by], row["before_n"]


def smallest(df: DataFrame, n: int, by: str, tie: str, max_limit: int = MAX_LIMIT_ROWS) -> DataFrame:
    """The ``n`` rows with the smallest ``(by, tie)``; ``tie`` is a unique number.

    Rows without a value (NULL or NaN) come last. A small ``n`` is an ordinary sort-and-limit. A
    large one is turned into a cut-off value, found from counts, so the selected rows never pass
    through one task. Both select the same rows.
    """
    missing = is_missing(by)
    if n <= max_limit:
        key = F.when(~missing, F.col(by))
        return df.orderBy(key.asc_nulls_last(), tie).limit(max(n, 0))
    if n >= df.count():
        return df
    ranked = df.where(~missing)
    known = ranked.count()
    if n <= known:
        return _head(ranked, n, by, tie)
    last, _ = _cut(df.where(missing), tie, n - known)
    return df.where(~missing | (F.col(tie) <= F.lit(last)))


def _head(df: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    if n <= 0:
        return df.limit(0)
    value, below = _cut(df, by, n)
    last, _ = _cut(df.where(F.col(by) == F.lit(value)), tie, n - below)
    return df.where(
        (F.col(by) < F.lit(value)) | ((F.col(by) == F.lit(value)) & (F.col(tie) <= F.lit(last)))
    )
