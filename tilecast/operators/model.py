"""Random-forest training and per-pixel classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hyperparameters of the forest.
TREES = 60
MAX_DEPTH = 15
SUBSAMPLING = 0.1

#: Rows of training data in one partition, about, up to ``MAX_PARTITIONS``. In every pass each
#: partition sends the statistics of all open nodes, so with many rows their number must not grow.
PARTITION_ROWS = 5_000
MAX_PARTITIONS = 24

#: Beyond this many rows a partition, about, there are more partitions again: memory stays bounded.
FULL_PARTITION_ROWS = 500_000


def drop_nodata(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in each of ``columns`` that the frame has."""
    return df.na.drop(subset=[c for c in columns if c in df.columns])


def pipeline(
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    seed: int = 0,
    trees: int = TREES,
    max_depth: int = MAX_DEPTH,
    subsampling: float = SUBSAMPLING,
    max_memory_mb: int = 512,
) -> Pipeline:
    """Nodata filter and vector assembly in one stage, then the forest.

    ``max_memory_mb`` bounds the statistics of one pass; more means fewer passes per level. Rows
    keep the node that they have reached, so no pass sends the trees out or walks them from the root.
    """
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="skip"
    )
    forest = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        numTrees=trees,
        maxDepth=max_depth,
        subsamplingRate=subsampling,
        maxMemoryInMB=max_memory_mb,
        cacheNodeIds=True,
        seed=seed,
    )
    if weight:
        forest = forest.setWeightCol(weight)
    return Pipeline(stages=[assembler, forest])


def training_partitions(rows: int) -> int:
    """Partitions for ``rows`` of training data; follows from the rows alone."""
    some = min(-(-rows // PARTITION_ROWS), MAX_PARTITIONS)
    return max(1, some, -(-rows // FULL_PARTITION_ROWS))


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    spread_by: Sequence[str] = (),
    partitions: int | None = None,
    **options,
) -> PipelineModel:
    """Fit the forest on the rows that have all features and a label.

    ``spread_by`` names row keys by which rows are spread evenly over ``partitions`` before the
    many passes of training. Their number follows from the rows alone, and rows are sorted by
    the keys within partitions, so the same rows and seed give the same forest on any cluster.
    """
    rows = drop_nodata(df, [*features, label]).withColumn(label, F.col(label).cast("double"))
    weight = options.get("weight")
    rows = rows.select(*spread_by, *features, label, *([weight] if weight else []))
    if spread_by:
        n = partitions or training_partitions(rows.count())
        rows = rows.repartition(n, *spread_by).sortWithinPartitions(*spread_by)
    return pipeline(features, label, **options).fit(rows)


def classify(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The ``keep`` columns with ``prediction`` and both class probabilities."""
    probability = vector_to_array("probability")
    return model.transform(df).select(
        *keep,
        "prediction",
        probability[0].alias("p_no_field"),
        probability[1].alias("p_field"),
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
