"""Working memory of task functions: bounded by what they hold, not by a multiple of it."""

import tracemalloc

import numpy as np

import public_tokenizers
from tilecast.llm import bpe, perplexity, repeats


def peak_mb(call) -> float:
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def prose(n: int, seed: int = 0) -> bytes:
    return np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8).tobytes()


def test_contexts_are_gathered_in_bounded_pieces():
    scan = repeats.Scan([prose(2_000_000)])
    every = np.arange(len(scan.first))
    size = len(scan.bytes_of(every)) / 1e6
    assert size > 8  # contexts overlap
    assert peak_mb(lambda: scan.bytes_of(every)) < 2 * size + 30  # an array of 8-byte indices was 8 times as large


def test_gathered_bytes_are_those_of_the_stretches(monkeypatch):
    monkeypatch.setattr(repeats, "GATHERED", 100)
    data = np.frombuffer(prose(5_000), np.uint8)
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50):
        starts, lengths = rng.integers(0, 4_000, n), rng.integers(1, 300, n)
        expected = b"".join(data[a : a + k].tobytes() for a, k in zip(starts, lengths))
        assert repeats.gather(data, starts, lengths).tobytes() == expected


def test_anchors_spread_evenly_over_buckets():
    scan = repeats.Scan([prose(3_000_000)])
    n = np.bincount((scan.ids() >> np.uint64(32 + repeats.BUCKET_BITS - 6)).astype(np.int64), minlength=64)
    assert n.max() < 1.3 * n.mean()  # smallest hashes as they are: the first held 27 times the mean, less what is further up


def test_ngrams_are_looked_up_in_bounded_blocks(monkeypatch):
    packed, counts = perplexity.grams([prose(300_000, seed) for seed in (2, 3)])
    langs = ["en", "de"]
    keys = np.unique(np.concatenate([perplexity.slot(packed[::7] & perplexity._MASKS[k], perplexity.salt("en", k)) for k in range(1, 6)]))
    arrays = perplexity.HashArrays(keys, -np.arange(1, len(keys) + 1, dtype=np.float32) / len(keys))
    found = perplexity.log_probabilities(packed, langs, counts, arrays)
    assert peak_mb(lambda: perplexity.log_probabilities(packed, langs, counts, arrays)) < 30 * len(packed) / 1e6 + 5
    monkeypatch.setattr(perplexity, "LOOKED_UP", len(packed))
    assert (perplexity.log_probabilities(packed, langs, counts, arrays) == found).all()


def test_texts_are_encoded_a_little_at_a_time(spark, monkeypatch):
    texts = [None, "", " and so on", "one two  three\n" * 40, prose(900).decode(), "\u00e9t\u00e9 2024, it's"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert bpe.TEXT_BYTES <= 1_000_000
    whole = sorted(map(tuple, bpe.encode(docs, path, public_tokenizers.PATTERN).collect()))
    monkeypatch.setattr(bpe, "TEXT_BYTES", 300)
    monkeypatch.setattr(bpe, "CACHE", 5)
    assert sorted(map(tuple, bpe.encode(docs, path, public_tokenizers.PATTERN).collect())) == whole
