"""Random samples that depend on row keys and a seed, not on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions.columns import (
    draws_for,
    poisson_count,
    poisson_draw,
    steps_passed,
    uniform,
    uniforms,
)
from tilecast.operators.ranking import smallest


def poisson_sample(df: DataFrame, rate: float, seed: int, keys: Sequence[str]) -> DataFrame:
    """Sample with replacement: rows drawn at least once, with their count ``drawn``."""
    # The numbers get a projection of their own, so that they are hashed once per row.
    if draws_for(rate) == 1:
        drawn = df.withColumn("_u", uniform(seed, *keys)).withColumn("drawn", steps_passed(F.col("_u"), rate))
    else:
        numbers = uniforms(F.lit(draws_for(rate)), seed, *keys)
        drawn = df.withColumn("_u", numbers).withColumn("drawn", poisson_count("_u", rate))
    return drawn.drop("_u").where("drawn > 0")


def bernoulli_sample(df: DataFrame, fraction: float, seed: int, keys: Sequence[str]) -> DataFrame:
    """Sample without replacement: each row with probability ``fraction``."""
    return df if fraction >= 1 else df.where(uniform(seed, *keys) < fraction)


def take_sample(df: DataFrame, n: int, seed: int, keys: Sequence[str], tie: str) -> DataFrame:
    """Exactly ``n`` random rows, or all if there are fewer; ``tie`` is a unique number."""
    drawn = smallest(df.withColumn("_u", uniform(seed, *keys)), n, "_u", tie)
    return drawn.select(*df.columns)


def class_counts(df: DataFrame, label: str, copies: str | None = None) -> DataFrame:
    """Rows per class, and their total over all classes."""
    rows = F.sum(copies) if copies else F.count("*")
    counts = df.groupBy(label).agg(rows.alias("n"))
    return counts.select("*", counts.agg(F.sum("n")).scalar().alias("n_total"))


def balance_rates(
    df: DataFrame, label: str, copies: str | None = None, keep_unlabelled: bool = False
) -> dict[int, float]:
    """Sampling rate of the classes 0 and 1 that gives each half of all rows.

    ``keep_unlabelled`` counts rows without a label into the total.
    """
    source = df if keep_unlabelled else df.where(F.col(label).isNotNull())
    known = F.when(F.col(label).isin(0, 1), F.col(label).cast("int"))
    rows = F.sum(copies) if copies else F.count("*")
    found = source.groupBy(known.alias("label")).agg(rows.alias("n")).collect()  # three rows at most
    counts = {row["label"]: row["n"] for row in found}
    for label_value in (0, 1):
        if not counts.get(label_value):
            raise ValueError(f"cannot balance: no rows of class {label_value}")
    return {c: sum(counts.values()) / (2.0 * counts[c]) for c in (0, 1)}


def balance_weights(
    df: DataFrame,
    label: str,
    seed: int,
    keys: Sequence[str],
    copies: str | None = None,
    keep_unlabelled: bool = False,
) -> DataFrame:
    """Class-balanced sample with replacement: rows drawn at least once, with count ``drawn``.

    This is the balanced data set without writing repeated rows; train on it with ``drawn``
    as the weight.
    """
    rates = balance_rates(df, label, copies, keep_unlabelled)
    value = F.col(label)
    if copies:
        # Counts of independent copies add up: one draw at the summed rate.
        rate = F.when(value == 1, rates[1]).otherwise(rates[0])
        means = df.where(value.isin(0, 1)).withColumn("_mean", rate * F.col(copies).cast("double"))
        return means.withColumn("drawn", poisson_draw(F.col("_mean"), seed, *keys).cast("int")).drop("_mean").where("drawn > 0")
    drawn = F.when(value == 1, poisson_count("_u", rates[1])).when(value == 0, poisson_count("_u", rates[0]))
    draws = F.when(value == 1, F.lit(draws_for(rates[1]))).otherwise(F.lit(draws_for(rates[0])))
    known = df.where(value.isin(0, 1)).withColumn("_u", uniforms(draws, seed, *keys))
    return known.withColumn("drawn", drawn).drop("_u").where("drawn > 0")


def repeat_rows(df: DataFrame, count: str = "drawn") -> DataFrame:
    """Write each row ``count`` times."""
    others = [c for c in df.columns if c != count]
    return df.select(*others, F.explode(F.array_repeat(F.lit(0), F.col(count)))).select(*others)


def balance_samples(df: DataFrame, label: str, seed: int, keys: Sequence[str], **options) -> DataFrame:
    """Class-balanced sample with replacement, as repeated rows."""
    return repeat_rows(balance_weights(df, label, seed, keys, **options))
