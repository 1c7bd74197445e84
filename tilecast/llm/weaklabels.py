"""Quality from weak labels: heuristic labellers, their accuracies by EM, and a hashed linear scorer.

Labellers vote good, bad or nothing on a text. Documents are only counted by their pattern of
votes (at most ``3 ** len(LABELLERS)`` patterns), so expectation-maximisation over the whole
corpus runs on a table of fixed size. It estimates how often each labeller is right about good
and about bad documents; the posterior of a pattern is the label of its documents. These labels
train a linear scorer over hashed byte n-grams, which also tells apart what no labeller looks at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.common import map_text, ngram_buckets, stretches_of
from tilecast.runtime import materialize

SIZES, BITS = (1, 2, 3), 12

#: Documents that the linear scorer is fitted on, about; votes and accuracies use all.
FIT_ROWS = 20_000

#: Text handled at once, and documents, as each of them has a row of all features.
CHUNK, ROWS = 1_000_000, 256

#: Words from which on windows are counted as numbers, not as tuples.
MANY = 20_000

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _share(part: float, whole: float, good: float, bad: float) -> int:
    """Good up to one share, bad from another on, nothing between; nothing for nothing."""
    return 0 if not whole else 1 if part <= good * whole else -1 if part >= bad * whole else 0


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def symbols(text: bytes, words: list[bytes]) -> int:
    return _share(_count(text, b"#*$%&|<>"), len(words), 0.02, 0.15)


def capitals(text: bytes, words: list[bytes]) -> int:
    upper = _count(text, _CAPITALS)
    return _share(upper, upper + _count(text, _CAPITALS.lower()), 0.15, 0.4)


def exclamation(text: bytes, words: list[bytes]) -> int:
    return _share(_count(text, b"!?"), len(words), 0.02, 0.3)


def plain(text: bytes, words: list[bytes]) -> int:
    """Words of anything but letters and one closing mark."""
    return _share(len(words) - sum(1 for _ in _PLAIN.finditer(text)), len(words), 0.1, 0.35)


_PLAIN = re.compile(rb"(?<!\S)[A-Za-z\x80-\xff'-]+[.,;:]?(?!\S)")


def variety(text: bytes, words: list[bytes]) -> int:
    return 0 if len(words) < 20 else _share(len(words) - len(set(words)), len(words), 0.7, 0.85)


def repetition(text: bytes, words: list[bytes]) -> int:
    n = max(len(words) - 4, 0)
    return _share(n - _distinct_windows(words, n), n, 0.01, 0.15)


def _distinct_windows(words: list[bytes], n: int) -> int:
    """How many of the ``n`` runs of five words differ."""
    if n < MANY:
        return len(set(zip(words, words[1:], words[2:], words[3:], words[4:])))
    number: dict[bytes, int] = {}
    of = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    window = of
    for i in range(1, 5):  # runs of i + 1 words, numbered by the run of i words and the next word
        kinds, window = np.unique(window[: len(of) - i] * len(number) + of[i:], return_inverse=True)
    return len(kinds)


def neighbours(text: bytes, words: list[bytes]) -> int:
    """Words that equal the one before."""
    return _share(sum(map(bytes.__eq__, words, words[1:])), len(words), 0.05, 0.25)


def sentences(text: bytes, words: list[bytes]) -> int:
    ends = sum(1 for _ in _ENDS.finditer(text))
    return 0 if len(words) < 30 else 1 if 0.01 <= ends / len(words) <= 0.5 else -1 if ends == 0 else 0


_ENDS = re.compile(rb"[.!?](?=\s|$)")

LABELLERS = (symbols, capitals, exclamation, plain, variety, repetition, neighbours, sentences)


def votes(text: bytes) -> list[int]:
    words = text.split()
    return [vote(text, words) for vote in LABELLERS]


#: What a labeller is assumed to vote (bad, nothing, good) on bad and on good documents before any
#: is seen, and how many documents, as a share of all, this assumption counts for.
ASSUMED = np.array([[0.5, 0.2, 0.3], [0.01, 0.29, 0.7]])
ASSUMED_SHARE = 0.1


@dataclass
class LabelModel:
    """``prior`` of good, and ``chance[labeller, quality, vote + 1]``."""

    prior: float
    chance: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of good, for rows of votes -1, 0, 1."""
        logs = np.log(self.chance)
        each = np.arange(patterns.shape[1])
        bad, good = (logs[each, quality, patterns + 1].sum(axis=1) for quality in (0, 1))
        odds = bad - good + np.log(1 - self.prior) - np.log(self.prior)
        return 1 / (1 + np.exp(np.clip(odds, -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Per labeller, how often its votes are right on (bad, good) documents."""
        return np.stack((self.chance[:, 0, 0] / (1 - self.chance[:, 0, 1]), self.chance[:, 1, 2] / (1 - self.chance[:, 1, 1])), axis=1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, prior: float = 0.85) -> LabelModel:
    """Expectation-maximisation over distinct patterns of votes and how often each occurs.

    The assumption keeps the two classes from changing places and every chance above 0.
    """
    k = patterns.shape[1]
    model = LabelModel(prior, np.tile(ASSUMED, (k, 1, 1)))
    weight = ASSUMED_SHARE * counts.sum() + 1
    hits = [(patterns == v).astype(float) for v in (-1, 0, 1)]
    for _ in range(rounds):
        good = model.posterior(patterns) * counts
        seen = np.stack([np.stack([w @ h for h in hits], axis=1) for w in (counts - good, good)], axis=1)
        share = np.array([1 - prior, prior])[:, None] * weight
        chance = (seen + share * ASSUMED) / (seen.sum(axis=2, keepdims=True) + share)
        fresh = LabelModel((good.sum() + weight * prior) / (counts.sum() + weight), chance)
        done = np.abs(fresh.chance - model.chance).max(initial=0) < 1e-9
        model = fresh
        if done:
            break
    return model


def features(texts: list[bytes]) -> np.ndarray:
    """Counts of hashed n-grams as rows of unit length; zero for an empty text."""
    x = np.zeros((len(texts), 1 << BITS), np.float32)
    for data, of, own in stretches_of(texts, CHUNK, max(SIZES) - 1):
        for n, bucket in ngram_buckets(data, SIZES, BITS):
            inside = (of[: len(bucket)] == of[n - 1 :])[:own]
            x += np.bincount((of[: len(bucket)] << BITS | bucket)[:own][inside], minlength=x.size).reshape(x.shape)
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
    return x / np.maximum(norm, 1).astype(np.float32)


def label_model(voted: DataFrame) -> LabelModel:
    counted = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()  # 3 ** 8 rows at most
    patterns = np.array([r["votes"] for r in counted], np.int64).reshape(-1, len(LABELLERS))
    return estimate(patterns, np.array([r["n"] for r in counted], np.float64))


def judge(docs: DataFrame, fit_rows: int = FIT_ROWS, threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, kept``, one row per document.

    ``score`` is the linear scorer's chance of good quality, and ``kept`` is ``score >= threshold``. A
    null text counts as empty; no labeller votes on it. Repeated rows count and are returned each.
    Long texts are read whole, in stretches. If all posteriors agree, scores are the posterior's mean.
    An empty table gives no rows; columns other than ``doc_id`` and ``text`` do not matter.
    """

    def make_votes():
        return lambda texts, _: [pa.array([votes(t) for t in texts], pa.list_(pa.int32()))]

    voted = materialize(map_text(docs, ["doc_id"], "text", "votes array<int>", make_votes), "weak-votes")
    model = label_model(voted)
    prior, chance = model.prior, model.chance.tolist()
    total = voted.count()

    def make_rows():
        own = LabelModel(prior, np.array(chance))

        def compute(texts, _):
            p = own.posterior(np.array([votes(t) for t in texts]))
            return [pa.array(p), pa.array(list(features(texts)), pa.list_(pa.float32()))]

        return compute

    per_million = min(1_000_000, int(1e6 * fit_rows / max(total, 1)))
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) < per_million)
    rows = materialize(map_text(sample, [], "text", "posterior double, x array<float>", make_rows, CHUNK, ROWS), "weak-rows")
    span = rows.agg(F.min("posterior"), F.max("posterior"), F.avg("posterior")).first()
    weights, intercept = np.zeros(1 << BITS), 0.0
    if span[0] is not None and span[0] < 0.5 <= span[1]:
        # A soft label is a row of either label, weighted by its chance.
        both = rows.select(
            F.col("x"), F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("w")),
                                          F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("w")))).alias("l")
        ).where("l.w > 0.001").select("l.label", "l.w", array_to_vector("x").alias("features"))
        fitted = LogisticRegression(maxIter=40, regParam=1e-5, weightCol="w", standardization=False).fit(both)
        weights, intercept = fitted.coefficients.toArray(), float(fitted.intercept)
    elif span[2] is not None:
        mean = min(max(span[2], 1e-6), 1 - 1e-6)
        intercept = float(np.log(mean / (1 - mean)))
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def make():
        def compute(texts, _):
            total = (features(texts) @ shared.value).astype(np.float64) + intercept
            return [pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))]

        return compute

    scored = map_text(docs, ["doc_id"], "text", "score double", make, CHUNK, ROWS)
    return scored.withColumn("kept", F.col("score") >= threshold)
