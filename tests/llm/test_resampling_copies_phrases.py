"""Importance resampling, MinHash near-duplicates and phrases against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast.llm import importance, minhash, phrases

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, weight string, score string, rank string, "
    "n string, node string, mark string, key string, a string, words string, _row string, _text string, _name string"
)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["Alpha", "beta", "gamma,", "delta", "Éa", "日本", "don't", "12a4", "|", "A!!", "the", "the", "of"]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 150))) for _ in range(70)]
    near = [base[3] + " tail", base[3].replace("beta", "Beta"), base[4], base[6].replace("the", "a", 1), "x " + base[7]]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [*base, *near, None, "", " ", "\n\n\t x", "é" * 60, "b" * 5000, "one two", "ONE  two", "a " * 40_000, "of the " * 300, long, long + " end"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, [None, "en", "und"][i % 3], "s", None, *["clash"] * 12) for i, t in enumerate(texts)]
    rows += rows[5:8]  # repeated rows
    rows += [(None, texts[0], "en", "s", None, *["clash"] * 12), (8, "another text with the id of one before it and words of its own", "en", "s", None, *["clash"] * 12)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def key(rows):
    return sorted(map(tuple, rows), key=str)


# -- importance resampling ---------------------------------------------------------------------------


def slow_runs(text, size):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, size + 1) for i in range(len(words) - n + 1)]


def slow_importance(rows, target, size, buckets, share, least):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    s, t = (Counter(bucket(x) for text in group for x in slow_runs(text, size)[1]) for group in ([r[1] for r in rows], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        n, runs = slow_runs(text, size)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in map(bucket, runs)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: share * len(fit) // 100], 1):
        row[5] = place
    return out


@pytest.mark.parametrize("size, buckets, share, chunk", [(1, 10_000, 10, 1_000_000), (3, 97, 60, 700), (2, 10_000, 100, 300)])
def test_importance_against_brute_force(spark, docs, size, buckets, share, chunk):
    target = ["Beta of the alpha", None, "", "the the the unseen words, 12a4"]
    table = spark.createDataFrame([(t, "clash") for t in target], "text string, n string")
    got = importance.importance(docs, table, share, size, buckets, chunk=chunk)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert key(got.collect()) == key(slow_importance(rows, target, size, buckets, share, 20))


def test_importance_draws_whole_rows(spark, docs):
    target = docs.where("doc_id < 9").select("text")
    drawn = importance.resample(docs, target, share=50)
    ranked = importance.importance(docs, target, share=50)
    assert drawn.columns == docs.columns
    assert key(drawn.select("doc_id").collect()) == key(ranked.where("rank is not null").select("doc_id").collect())
    assert drawn.join(docs, docs.columns, "left_anti").where("lang is not null and n_chars is not null").count() == 0
    assert importance.resample(docs, target, share=0).count() == 0


def test_importance_of_empty_tables(docs, empty):
    assert importance.importance(empty, docs).count() == 0
    assert importance.importance(docs, empty).count() == docs.count()
    assert importance.importance(empty, empty).count() == 0


def test_importance_prefers_what_looks_like_the_target(spark):
    rng = random.Random(1)
    kinds = [[f"{k}{i}" for i in range(30)] for k in "xy"]
    rows = [(i, " ".join(rng.choices(kinds[i % 10 == 0], k=60))) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    target = spark.createDataFrame([(" ".join(rng.choices(kinds[1], k=60)),) for _ in range(50)], "text string")
    drawn = [r.doc_id for r in importance.resample(df, target, share=10).collect()]
    # Gains differ by some 3 units of noise between the kinds: a third of the draw without them.
    assert sum(i % 10 == 0 for i in drawn) >= 75


def test_cut_texts_lose_no_run():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab,  é") for _ in range(rng.randrange(0, 80))).encode()
        for size in (1, 2, 4):
            whole = importance.bucket_runs([text], np.zeros(1, np.int64), size, 1 << 30)
            pieces = list(importance.cut(text, rng.randrange(1, 20), size - 1))
            parts = importance.bucket_runs([p for p, _ in pieces], np.array([n for _, n in pieces]), size, 1 << 30)
            assert sorted(whole[0]) == sorted(parts[0]) and whole[2].sum() == parts[2].sum()


# -- near-duplicates -----------------------------------------------------------------------------------


def slow_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set()


def slow_copies(rows, percent):
    sets = [slow_sets(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    names = [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))]
    return [(d, len(s), c, d is not None and d == c) for (d, _), s, c in zip(rows, sets, names)]


def test_minhash_against_all_pairs(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert key(minhash.near_duplicates(docs).collect()) == key(slow_copies(rows, 85))
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.near_duplicates(empty).columns == ["doc_id", "n_shingles", "component_id", "kept"]


@pytest.fixture(scope="module")
def crowd():
    """Families of near copies: neighbours in a family link, its ends do not; families share a passage."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for family in range(12):
        words = passage + [f"f{family}w{i}" for i in range(90)]
        for _ in range(15):
            rows.append((len(rows), " ".join(words)))
            words = list(words)
            words[rng.randrange(60, 150)] = f"new{rng.random()}"
            words[rng.randrange(60, 150)] = f"new{rng.random()}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("percent, unit", [(85, 1024), (85, 8), (60, 16)])
def test_minhash_of_crowded_keys(spark, crowd, percent, unit):
    df = spark.createDataFrame(crowd, "doc_id bigint, text string")
    want = slow_copies(crowd, percent)
    assert len({r[2] for r in want}) < len(crowd) / 2
    # At 60 per cent the keys of the default miss some links; rows of one minhash do not.
    got = minhash.near_duplicates(df, percent, unit=unit, **({} if percent == 85 else {"rows": 1, "keys": 10}))
    assert key(got.collect()) == key(want)


def test_minhash_keeps_one_row_of_each_component(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = minhash.deduplicate(docs)
    assert got.columns == docs.columns
    wordless = sum(not slow_sets(t) for _, t in rows)
    judged = [(i, t) for i, t in enumerate(t for d, t in rows if slow_sets(t))]
    groups = len({r[2] for r in slow_copies(judged, 85)})
    kept = got.collect()
    # The row without an id stays besides its copy.
    assert len(kept) == wordless + groups + 1
    assert {r.text for r in kept if r.doc_id == 8} == {t for d, t in rows if d == 8}
    df = spark.createDataFrame([(3, "a b c d"), (5, "a b c d"), (5, "quite another text")], "doc_id bigint, text string")
    assert key(minhash.deduplicate(df).collect()) == key([(3, "a b c d"), (5, "quite another text")])


def test_possible_pairs_are_a_superset():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**64, 400, np.uint64))
    sets = [np.unique(np.concatenate((rng.permutation(base)[: 400 - d], rng.integers(0, 2**64, d, np.uint64)))) for d in range(0, 200, 5)]
    n = np.array([len(s) for s in sets])
    ranges = np.stack([minhash.counts_in_ranges(s) for s in sets])
    left, right = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    ok = minhash.possible(n, ranges, left, right, 85)
    for i, j, fine in zip(left, right, ok):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 85 * (n[i] + n[j] - both):
            assert fine
    assert not ok.all()


# -- phrases -------------------------------------------------------------------------------------------


def slow_phrases(rows, least, longest, most, covered):
    f, n = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                f.update((lang or "und", *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    hidden = set()
    for (lang, *words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = (lang, *words[i : i + size])
                if 100 * a >= covered * f[inner]:
                    hidden.add(inner)
    found = {}
    for p, a in candidates.items():
        if p not in hidden:
            lang, words = p[0], p[1:]
            cuts = [(1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    out = []
    for lang, rows_ in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize(
    "least, longest, most, covered, chunk, bits",
    [(100, 5, 2000, 100, 500_000, 64), (3, 5, 50, 100, 300, 64), (2, 3, 10**6, 60, 900, 10), (5, 2, 7, 100, 2000, 12)],
)
def test_phrases_against_brute_force(docs, least, longest, most, covered, chunk, bits):
    rows = [(r.lang, r.text) for r in docs.collect()]
    want = slow_phrases(rows, least, longest, most, covered)
    assert want
    got = phrases.collocations(docs, least, longest, most, covered, chunk=chunk, bits=bits)
    assert key(got.collect()) == key(want)


def test_phrases_in_odd_pieces(spark):
    rng = random.Random(4)
    rows = [("xx", "".join(rng.choice("ab ab \t.,\n\x0b\x1c\x85é") for _ in range(200))) for _ in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert key(phrases.collocations(df, 4, chunk=30).collect()) == key(slow_phrases(rows, 4, 5, 2000, 100))


def test_phrases_of_nothing(empty, docs):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_phrase_scores_beyond_64_bits(spark, monkeypatch):
    """Counts of a corpus of 10**13 words: the products have 30 digits."""
    big = 10**13
    counts = spark.createDataFrame(
        [("en", 1, "a", big // 7), ("en", 1, "b", big // 9 + 1), ("en", 2, "a b", big // 11 + 3)], "lang string, size int, phrase string, n bigint"
    )
    totals = spark.createDataFrame([("en", 3 * big + 1)], "lang string, words bigint")
    monkeypatch.setattr(phrases, "frequent", lambda *_, **__: (counts, totals))
    row = phrases.collocations(None).first()
    assert row.score == 1000 * row.a * row.n // (row.l * row.r) and (row.l, row.r, row.n) == (big // 7, big // 9 + 1, 3 * big + 1)
