"""Importance resampling: draw documents that look like a target text collection.

A feature is a run of consecutive words, hashed to a bucket by CRC-32. Spark counts the buckets of
the corpus and of the target; a bucket's gain is the floored log ratio of the two smoothed shares,
a document's weight the floored mean of its features' gains. Gumbel noise from the document's id is
added, and the documents with the highest sums are a draw without replacement in proportion to the
weights.

Inside a task, texts are handled by concatenation: the texts of a batch are joined with a separator
that no word has, one pass of a regular expression finds all words, and the texts' offsets, looked
up by binary search, mask runs that would reach into the next text before buckets are counted.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.llm.common import slices
from tilecast.runtime import materialize

BUCKETS = 10_000

#: Bytes of text that are joined at once. A longer text is cut between words.
CHUNK = 1_000_000

# Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] in UTF-8, after A-Z became lower case.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SEPARATOR = b"\0"


def cut(text: bytes, limit: int, overlap: int) -> Iterator[tuple[bytes, int]]:
    """Parts of about ``limit`` bytes that end between words, and how many leading words repeat.

    A part begins with the last ``overlap`` words of the one before, so that no run of
    ``overlap + 1`` words is lost. A word is never cut, however long.
    """
    start = lead = 0
    while True:
        gap = _GAP.search(text, start + limit) if len(text) - start > limit else None
        if gap is None:
            yield text[start:], lead
            return
        end = gap.start()
        yield text[start:end], lead
        back, lead = end, 0
        if overlap:
            reach = 64 * overlap
            while True:
                low = max(start, end - reach)
                # A word that the window's edge may cut does not count.
                begins = [m.start() + low for m in _WORD.finditer(text[low:end].translate(_LOWER)) if m.start() or low == start]
                if len(begins) >= overlap or low == start:
                    break
                reach *= 2
            own = begins[-overlap:]
            back, lead = (own[0], len(own)) if own else (end, 0)
        start, limit = back, max(limit, 2 * (end - back))


def bucket_runs(parts: Sequence[bytes], leads: np.ndarray, size: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all runs of 1 to ``size`` words, the part each belongs to, and words per part.

    The first ``leads`` words of a part were seen before: runs that end in them do not count.
    """
    joined = _SEPARATOR.join(parts).translate(_LOWER)
    found = list(_WORD.finditer(joined))
    words = [m.group() for m in found]
    begins = np.fromiter((m.start() for m in found), np.int64, len(found))
    offsets = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))[: len(parts)]
    of = np.searchsorted(offsets, begins, side="right") - 1
    first = np.searchsorted(begins, offsets)
    fresh = np.arange(len(words)) - first[of] >= leads[of] if len(words) else np.empty(0, bool)
    hashes: list[int] = [0] * len(words)
    out, owners = [], []
    for n in range(1, size + 1):
        if len(words) < n:
            break
        last = words[n - 1 :]
        hashes = list(map(zlib.crc32, last)) if n == 1 else [
            zlib.crc32(w, zlib.crc32(b" ", h)) for w, h in zip(last, hashes)
        ]
        run_of = of[: len(last)]
        inside = (run_of == of[n - 1 :]) & fresh[n - 1 :]
        out.append((np.array(hashes, np.int64) % buckets)[inside])
        owners.append(run_of[inside])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *out]), np.concatenate([none, *owners]), np.bincount(of[fresh], minlength=len(parts))


def _chunks(texts: Sequence[bytes], limit: int, overlap: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Parts of texts, their repeated leading words and rows, in groups of about ``limit`` bytes."""
    held: list[tuple[bytes, int, int]] = []
    total = 0

    def out():
        return [h[0] for h in held], np.array([h[1] for h in held], np.int64), np.array([h[2] for h in held], np.int64)

    for row, text in enumerate(texts):
        for part, lead in cut(text, limit, overlap):
            if held and total + len(part) > limit:
                yield out()
                held, total = [], 0
            held.append((part, lead, row))
            total += len(part)
    if held:
        yield out()


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def count_buckets(texts: DataFrame, size: int, buckets: int, chunk: int = CHUNK) -> DataFrame:
    """``bucket, n`` over the features of all whole texts, summed up inside tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for rows in slices(batch, "text", chunk):
                for parts, leads, _ in _chunks(_texts(rows, "text"), chunk, size - 1):
                    counts += np.bincount(bucket_runs(parts, leads, size, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Floored thousandfold log ratio of the smoothed shares of every bucket.

    ``corpus`` and ``target`` have ``bucket, n``, at most ``buckets`` rows each, which the driver reads.
    """
    counts = np.zeros((2, buckets))
    for row, table in enumerate((corpus, target)):
        read = table.toArrow()
        counts[row, read["bucket"].to_numpy()] = read["n"].to_numpy()
    s, t = counts
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Floored thousandfold Gumbel noise from 32 bits of a SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    u = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def score(docs: DataFrame, gain: np.ndarray, keep: Sequence[str], size: int = 1, seed: int = 2024, chunk: int = CHUNK) -> DataFrame:
    """The columns ``keep`` with ``n_words, n_features, weight, score``, in place and without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    kept = docs.select(*keep, F.col("text").alias("_text"), noise(F.col("doc_id"), seed).alias("_noise"))
    new = ("n_words", "n_features", "weight", "score")
    fields = [*(f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in keep), *(f"{c} bigint" for c in new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for rows in slices(batch, "_text", chunk):
                n = rows.num_rows
                words, features, total = np.zeros((3, n), np.int64)
                for parts, leads, row in _chunks(_texts(rows, "_text"), chunk, size - 1):
                    found, of, seen = bucket_runs(parts, leads, size, len(own))
                    np.add.at(words, row, seen)
                    features += np.bincount(row[of], minlength=n)
                    # Sums of integers below 2**53: exact in doubles.
                    total += np.bincount(row[of], weights=own[found], minlength=n).astype(np.int64)
                weight = total // np.maximum(features, 1)
                values = (words, features, weight, weight + rows.column("_noise").to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in keep), *map(pa.array, values)], names=[*keep, *new]
                )

    return kept.mapInArrow(run, ", ".join(fields))


def rank(scored: DataFrame, share: int = 10, least_words: int = 20) -> DataFrame:
    """Adds ``rank``: 1, 2, 3... by score, then id, of the drawn ``share`` per cent; else null.

    Only documents of ``least_words`` words or more take part. Scores are counted by value first:
    they are whole numbers within some 100,000 of each other (thousandfold logarithms), so that table
    has a fixed bound. Only drawn rows are then sorted, each score's apart.
    """
    fit = F.col("n_words") >= least_words
    counts = materialize(scored.where(fit).groupBy("score").agg(F.count("*").alias("n")), "importance-scores")
    drawn = (counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * share) // 100
    above = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    heads = counts.withColumn("above", above).where(F.col("above") < drawn).select("score", "above")
    head = F.broadcast(heads.select(F.col("score").alias("_score"), "above"))
    joined = scored.join(head, fit & (F.col("score") == F.col("_score")), "left").drop("_score")
    inside = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last())
    place = F.col("above") + F.row_number().over(inside)
    ranked = joined.where("above is not null").withColumn("rank", F.when(place <= drawn, place).cast("bigint"))
    rest = joined.where("above is null").withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).drop("above")


def importance(
    docs: DataFrame,
    target: DataFrame,
    share: int = 10,
    size: int = 1,
    buckets: int = BUCKETS,
    least_words: int = 20,
    seed: int = 2024,
    keep: Sequence[str] = ("doc_id",),
    chunk: int = CHUNK,
) -> DataFrame:
    """``keep`` with ``n_words, n_features, weight, score, rank`` (bigint), one row per document.

    Args:
        docs: has ``doc_id, text``; other columns do not matter.
        target: has ``text``. Its texts and all of ``docs`` are counted whole.
        share: per cent of the documents with ``least_words`` words that are drawn, rounded down.
        size: features are runs of 1 to ``size`` words.
        seed: the noise depends on it and on the id alone, so reruns agree.

    Null and empty texts have no words, no features and the weight 0. A null id has the noise of the
    word ``null`` and comes last among equal scores. Rows that repeat an id and text have equal scores
    and successive ranks. An empty ``docs`` gives no rows; with an empty ``target`` words that are
    rare in the corpus weigh more.
    """
    gain = gains(count_buckets(docs, size, buckets, chunk), count_buckets(target, size, buckets, chunk), buckets)
    scored = materialize(score(docs, gain, list(keep), size, seed, chunk), "importance")
    return rank(scored, share, least_words)


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, whole and with the same columns, whatever these are called."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text")
    return importance(packed, target, keep=("_row", "doc_id"), **options).where("rank is not null").select("_row.*")
