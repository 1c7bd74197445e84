import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tilecast.operators import metrics as M


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        label = int(rng.random() < 0.4)
        # Coarse scores, a third of them equal.
        score = 0.5 if i % 3 == 0 else min(1.0, max(0.0, round(rng.gauss(0.4 + 0.2 * label, 0.2), 2)))
        rows.append((label, int(score > 0.5), score))
    return spark.createDataFrame(rows, "label int, prediction int, score double").repartition(5).cache()


def test_identities_and_spark_evaluators(scored):
    m = M.binary_metrics(scored, "label", "prediction").first()
    assert m.tpr == m.recall and m.tss == pytest.approx(m.tpr - m.fpr)
    doubles = scored.select(*[F.col(c).cast("double").alias(c) for c in scored.columns])
    names = {
        "accuracy": "accuracy", "precision": "precisionByLabel", "recall": "recallByLabel",
        "fpr": "falsePositiveRateByLabel", "tpr": "truePositiveRateByLabel",
    }
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=theirs, metricLabel=1.0)
        assert m[ours] == pytest.approx(evaluator.evaluate(doubles))


def brute_auc(rows):
    pos = [s for label, _, s in rows if label]
    neg = [s for label, _, s in rows if not label]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("slice_rows", [10**6, 5])
def test_auc(scored, slice_rows, monkeypatch):
    monkeypatch.setattr(M.running_totals, "__defaults__", (slice_rows,))
    auc = M.area_under_roc(scored, "label", "score").first()[0]
    assert auc == pytest.approx(brute_auc([tuple(r) for r in scored.collect()]))
    flipped = M.area_under_roc(scored.withColumn("score", -F.col("score")), "label", "score").first()[0]
    assert flipped == pytest.approx(1 - auc)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert auc == pytest.approx(evaluator.evaluate(scored.withColumn("label", F.col("label").cast("double"))))


def test_copies_weigh_like_repeated_rows(scored):
    weighted = scored.withColumn("copies", F.when(F.col("score") > 0.6, 3).otherwise(1))
    repeated = weighted.select("label", "prediction", "score", F.explode(F.array_repeat(F.lit(0), F.col("copies"))))
    one = M.metrics_report(weighted, "label", "prediction", "score", 1, 2, "here", "copies").drop("iteration_time").first()
    two = M.metrics_report(repeated, "label", "prediction", "score", 1, 2, "here").drop("iteration_time").first()
    assert [*one] == pytest.approx([*two])


def test_empty_class_gives_null(scored):
    m = M.binary_metrics(scored.where("label = 0"), "label", "prediction").first()
    assert m.recall is None and m.tss is None and m.fpr is not None
    assert M.area_under_roc(scored.where("label = 0"), "label", "score").first()[0] is None
