"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is the presence of an n-gram of bytes, hashed to ``BITS`` bits. Spark counts, over all
training texts, how many texts of each label have it; the log ratio of the smoothed shares scales
the feature, and features whose ratio could be chance are left out, so that a long text is not
judged by the many n-grams that it has by accident. A logistic regression over the scaled
features is fitted on a bounded sample of the training rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.llm.common import distinct, map_text, ngram_buckets, slices, stretches_of
from tilecast.runtime import broadcast_if_small, materialize

SIZES = (4, 5, 6)
BITS = 20

#: Features that the classifier may use; bounds what the driver and every task hold.
FEATURES = 20_000

#: Rows that the logistic regression is fitted on, about; counts and ratios use all rows.
FIT_ROWS = 50_000

#: Text handled at once. Every byte of it becomes a few n-grams of eight bytes.
CHUNK = 1_000_000

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


@dataclass
class Model:
    """Weight of each bucket (log-count ratio times coefficient), and the intercept."""

    weights: np.ndarray
    intercept: float


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: CRC-32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def presence(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(text, bucket)`` pairs, sorted."""
    # Pairs are sorted as small numbers where they fit.
    kind = np.uint32 if len(texts) <= 1 << (32 - bits) else np.uint64
    keys = np.empty(0, kind)
    for data, of, _ in stretches_of([t.translate(_LOWER) for t in texts], CHUNK, max(SIZES) - 1):
        shifted = of.astype(kind) << kind(bits)
        pairs = [keys]
        for n, bucket in ngram_buckets(data, SIZES, bits):
            inside = of[: len(bucket)] == of[n - 1 :]
            pairs.append((shifted[: len(bucket)] | bucket)[inside])
        keys = distinct(np.concatenate(pairs))
    return (keys >> kind(bits)).astype(np.int64), (keys & kind((1 << bits) - 1)).astype(np.int64)


def ratios(rows: DataFrame, smooth: float = 1.0) -> DataFrame:
    """``bucket, n0, n1, ratio, z`` over training ``rows`` (``text, label``).

    ``ratio`` is the log of the share of texts with label 1 that have the feature over that of
    label 0; ``z`` is the ratio in units of its standard error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                labels = np.array(part.column("label").to_pylist(), np.int64)
                text, bucket = presence(texts)
                for label in (0, 1):
                    counts[label] += np.bincount(bucket[labels[text] == label], minlength=1 << BITS)
        seen = np.flatnonzero(counts.any(axis=0))
        for a in range(0, len(seen), 100_000):
            s = seen[a : a + 100_000]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, (s, counts[0, s], counts[1, s]))), names=["bucket", "n0", "n1"])

    totals = rows.agg(*[F.coalesce(F.sum((F.col("label") == i).cast("bigint")), F.lit(0)).alias(f"t{i}") for i in (0, 1)]).first()
    share = [(F.col(f"n{i}") + smooth) / F.lit(totals[f"t{i}"] + 2.0 * smooth) for i in (0, 1)]
    error = F.sqrt(1 / (F.col("n0") + smooth) + 1 / (F.col("n1") + smooth))
    counted = rows.mapInArrow(run, "bucket bigint, n0 bigint, n1 bigint").groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    return counted.withColumn("ratio", F.log(share[1] / share[0])).withColumn("z", F.col("ratio") / error)


def fit(docs: DataFrame, labels: DataFrame, features: int = FEATURES, fit_rows: int = FIT_ROWS, least_z: float = 4.0) -> Model:
    """Learn from ``labels`` (``doc_id, label`` 0 or 1) of rows that are not held out.

    Rows with another or no label, and labels without a document, teach nothing. A document
    listed with both labels counts for both. With one label only, or without any feature that
    tells the labels apart, the model is the share of label 1 (0 without any row).
    """
    known = labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("_id"), F.col("label").cast("int").alias("label")
    ).distinct()
    rows = docs.select("doc_id", "text").join(broadcast_if_small(materialize(known, "toxic-labels")), F.col("doc_id") == F.col("_id"))
    rows = materialize(rows.select("doc_id", "text", "label"), "toxic-rows")
    total, ones = rows.agg(F.count("*"), F.sum("label")).first()
    if not total or ones in (0, total):
        share = (ones or 0) / total if total else 0.0
        return Model(np.zeros(1 << BITS, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    ranked = ratios(rows).where((F.abs("z") >= least_z) & (F.col("n0") + F.col("n1") >= 3))
    chosen = ranked.orderBy(F.desc(F.abs("z")), "bucket").limit(features).toArrow()
    if not chosen.num_rows:
        share = ones / total
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    buckets, ratio = chosen["bucket"].to_numpy(), chosen["ratio"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast({"buckets": buckets, "ratio": ratio})

    def make():
        place = np.full(1 << BITS, -1, np.int32)
        place[shared.value["buckets"]] = np.arange(len(shared.value["buckets"]))

        def compute(texts, _):
            text, bucket = presence(texts)
            at = place[bucket]
            text, at = text[at >= 0], at[at >= 0]
            cuts = np.searchsorted(text, np.arange(1, len(texts)))
            return [pa.array([np.sort(x) for x in np.split(at, cuts)], pa.list_(pa.int32()))]

        return compute

    per_million = min(1_000_000, int(1e6 * fit_rows / total))
    sample = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < per_million)
    held = map_text(sample, ["label"], "text", "at array<int>", make, CHUNK)
    n = len(buckets)

    @F.udf(VectorUDT())
    def vector(at):
        return SparseVector(n, at, shared.value["ratio"][at] if at else [])

    data = materialize(held.select("label", "at"), "toxic-features").select(F.col("label").cast("double"), vector("at").alias("features"))
    fitted = LogisticRegression(maxIter=60, regParam=1e-3, standardization=False).fit(data)
    weights = np.zeros(1 << BITS, np.float32)
    weights[buckets] = ratio * fitted.coefficients.toArray()
    return Model(weights, float(fitted.intercept))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text; null and empty texts get the intercept's."""
    shared = docs.sparkSession.sparkContext.broadcast({"weights": model.weights, "intercept": model.intercept})

    def make():
        weights, intercept = shared.value["weights"], shared.value["intercept"]

        def compute(texts, _):
            found = [np.empty(0, np.int64)]
            for data, of, _ in stretches_of([t.translate(_LOWER) for t in texts], CHUNK, max(SIZES) - 1):
                for n, bucket in ngram_buckets(data, SIZES, BITS):
                    at = np.flatnonzero(weights[bucket])  # few n-grams have a weight
                    at = at[of[at] == of[at + n - 1]]
                    found.append(of[at] << BITS | bucket[at])
            keys = distinct(np.concatenate(found))
            total = np.bincount(keys >> BITS, weights[keys & ((1 << BITS) - 1)], minlength=len(texts))
            return [pa.array(1 / (1 + np.exp(-np.clip(total + intercept, -500, 500))))]

        return compute

    return map_text(docs, ["doc_id"], "text", "score double", make, CHUNK)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per document.

    ``labels`` has ``doc_id, label``. Only the text is an input of a score. See :func:`fit` for
    what missing labels mean and :func:`score` for empty texts; a null ``doc_id`` is not held out.
    Repeated rows teach and are returned each; long texts are read whole, in stretches. An empty
    table gives no rows; other columns do not matter.
    """
    scored = score(docs, fit(docs, labels, **options))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
