"""Bounded pieces, crowded keys, evidence for terms, and classifiers against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast.llm import privacy, simhash, toxicity, weaklabels


def slow_buckets(text: bytes, sizes, bits):
    out = []
    for n in sizes:
        for i in range(len(text) - n + 1):
            h = 0
            for c in text[i : i + n]:
                h = (h * 0x01000193 + c + 1) % 2**32
            out.append((((h ^ h >> 15) * 0x9E3779B1) % 2**32) >> (32 - bits))
    return out


TEXTS = [b"", b"a", b"ab", "Ünder the Sea, under the sea!".encode(), b"xyz " * 300, bytes(range(32, 127)) * 8]


@pytest.mark.parametrize("chunk", [1_000_000, 64, 7])
def test_features_against_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(weaklabels, "CHUNK", chunk)
    monkeypatch.setattr(toxicity, "CHUNK", chunk)
    for group in [TEXTS, *([t] for t in TEXTS)]:
        got, has = weaklabels.features(group), toxicity.presence(group)
        want = set()
        for i, t in enumerate(group):
            counts = Counter(slow_buckets(t, weaklabels.SIZES, weaklabels.BITS))
            norm = max(sum(c * c for c in counts.values()) ** 0.5, 1)
            row = np.zeros(1 << weaklabels.BITS)
            for b, c in counts.items():
                row[b] = c / norm
            assert got[i] == pytest.approx(row, abs=1e-6)
            want |= {(i, b) for b in slow_buckets(t.translate(toxicity._LOWER), toxicity.SIZES, toxicity.BITS)}
        assert set(zip(*(x.tolist() for x in has))) == want and len(has[0]) == len(want)


def test_windows_are_counted_alike(monkeypatch):
    rng = random.Random(4)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(3000)]
    for n in (0, 4, 5, 6, 100, 3000):
        of = words[:n]
        monkeypatch.setattr(weaklabels, "MANY", 10**9)
        want = weaklabels._distinct_windows(of, max(n - 4, 0))
        monkeypatch.setattr(weaklabels, "MANY", 1)
        assert weaklabels._distinct_windows(of, max(n - 4, 0)) == want


def test_em_against_documents_one_by_one():
    """The estimate from counted patterns is that of plain EM over every document."""
    rng = random.Random(6)
    k = len(weaklabels.LABELLERS)
    docs = [[rng.choice((-1, 0, 1, 1)) if rng.random() < 0.8 else -1 for _ in range(k)] for _ in range(120)] * 2
    patterns, counts = np.unique(np.array(docs), axis=0, return_counts=True)
    got = weaklabels.estimate(patterns, counts.astype(float), rounds=7)
    prior, assumed, weight = 0.85, weaklabels.ASSUMED, weaklabels.ASSUMED_SHARE * len(docs) + 1
    chance = [[list(assumed[q]) for q in (0, 1)] for _ in range(k)]
    p = prior
    for _ in range(7):
        seen = [[[0.0] * 3 for _ in (0, 1)] for _ in range(k)]
        total = 0.0
        for d in docs:
            like = [1 - p, p]
            for j, v in enumerate(d):
                for q in (0, 1):
                    like[q] *= chance[j][q][v + 1]
            good = like[1] / sum(like)
            total += good
            for j, v in enumerate(d):
                seen[j][0][v + 1] += 1 - good
                seen[j][1][v + 1] += good
        for j in range(k):
            for q in (0, 1):
                share = weight * (prior if q else 1 - prior)
                chance[j][q] = [(seen[j][q][v] + share * assumed[q][v]) / (sum(seen[j][q]) + share) for v in range(3)]
        p = (total + weight * prior) / (len(docs) + weight)
    assert got.prior == pytest.approx(p) and got.chance == pytest.approx(np.array(chance))


def test_weak_labels_take_any_rows(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns: a row each, equal texts alike."""
    texts = [None, "", "word", "tree house. " * 200_000, "%$# " * 40, *["the tree stands near the water."] * 9]
    rows = [(i, t, "a", 1, True) for i, t in enumerate(texts)]
    rows += [*rows[2:6], (None, "the tree stands near the water.", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, votes string, score int, kept boolean")
    got = weaklabels.judge(df).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    by = {}
    for r in got:
        assert 0 <= r.score <= 1 and r.kept == (r.score >= 0.5)
        by.setdefault(texts[r.doc_id] if r.doc_id is not None else texts[-1], set()).add(round(r.score, 5))
    assert all(len(s) == 1 for s in by.values()) and by[None] == by[""]


def test_ratios_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["sun", "rain", "Snow", "é"]) for _ in range(rng.randrange(6))) or None, i % 2) for i in range(40)]
    rows += rows[:5]  # repeated rows teach as often as they come
    got = toxicity.ratios(spark.createDataFrame(rows, "doc_id bigint, text string, label int"))
    want = {}
    for _, t, label in rows:
        for b in set(slow_buckets((t or "").encode().translate(toxicity._LOWER), toxicity.SIZES, toxicity.BITS)):
            want.setdefault(b, [0, 0])[label] += 1
    totals = [sum(r[2] == label for r in rows) for label in (0, 1)]
    found = {r.bucket: r for r in got.collect()}
    assert {b: [r.n0, r.n1] for b, r in found.items()} == want
    for b, (n0, n1) in want.items():
        assert found[b].ratio == pytest.approx(np.log((n1 + 1) / (totals[1] + 2)) - np.log((n0 + 1) / (totals[0] + 2)))


# -- crowded keys ---------------------------------------------------------------------------------


def test_crowded_keys_do_not_meet_all_pairs(spark):
    """All fingerprints agree in the first two blocks of five: one key holds every one of them."""
    rng = np.random.default_rng(8)
    rows = {}
    for n in (4000, 8000):
        values = np.unique(rng.integers(0, 2**38, n))
        df = spark.createDataFrame([(int(v),) for v in values], "fp bigint")
        rows[n] = simhash.units(df, 4, 5, 64).count()
    assert rows[8000] < 2.6 * rows[4000]  # chunks of 64 alone would make it fourfold
    assert rows[8000] < 8000 * 125


@pytest.mark.parametrize("distance", [1, 3, 4])
def test_close_pairs_meet_under_finer_keys(spark, distance):
    rng = np.random.default_rng(distance)
    values = rng.integers(0, 2**36, 300).tolist()
    values += [v ^ sum(1 << int(b) for b in rng.choice(63, distance, replace=False)) for v in values[:150]]
    values = sorted(set(values))
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = simhash.components(simhash.links(df, distance, distance + 1, 4)).collect()
    roots = {r.node: r.root for r in found}
    label = {v: v for v in values}
    for _ in values:
        before = dict(label)
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= distance:
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    assert {v: roots.get(v, v) for v in values} == label


# -- terms ------------------------------------------------------------------------------------------


def slow_terms(texts, evidence=0.2, generalise=0.6, remove=0.8):
    """``{term: action}`` from dictionaries; e-mail addresses only."""
    texts = sorted({t for t in texts if t is not None})
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    near, having = {}, Counter()
    for i, t in enumerate(texts):
        having.update(set(re.findall(r"[^\W_]+", t.lower())))
        for m in email.finditer(t):
            around = t[: m.start()].lower().split()[-5:] + t[m.end() :].lower().split()[:5]
            for w in around:
                if not re.search("[0-9@]", w):
                    for term in re.findall(r"[^\W_]+", w):
                        if len(term) >= 3:
                            near.setdefault(m.group().lower(), {}).setdefault(term, set()).add(i)
    out, n = {}, len(texts)
    for e, terms in near.items():
        share = len(set().union(*terms.values())) / n
        for term, where in terms.items():
            both, whole = len(where), max(having[term], len(where))
            p, z = both / whole, 1 / whole
            sure = (p + z / 2 - (p * (1 - p) / whole + z / whole / 4) ** 0.5) / (1 + z)
            if share < 1 and sure >= evidence:
                out[term] = max(out.get(term, -9.0), 1 - np.log((both + share) / (whole + 1)) / np.log(share))
    return {t: "removed" if v >= remove else "generalised" for t, v in out.items() if v >= generalise}


def marked(texts, docs, **options):
    """Words that get a span, by what becomes of them."""
    found = {}
    for r in docs.collect():
        for span in r.spans.split(",") if r.spans else []:
            kind, a, b = span.split(":")
            if kind in ("removed", "generalised"):
                found[texts[r.doc_id][int(a) : int(b)].lower()] = kind
    return found


def test_terms_against_dictionaries(spark):
    rng = random.Random(14)
    common = ["".join(rng.choice("aeioulnrst") for _ in range(6)) for _ in range(30)]
    rare = ["".join(rng.choice("bcdfgh") for _ in range(9)) for _ in range(60)]
    texts = []
    for i in range(400):
        words = [rng.choice(common) for _ in range(15)]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(15)] = rng.choice(rare)
        if i % 10 == 0:
            words[rng.randrange(15)] = f"u{i % 70}@mail.example"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (3, texts[3]), (900, None), (901, "")], "doc_id bigint, text string")
    got = marked([*texts, *[""] * 600], privacy.report(docs, everywhere=True))
    assert got == slow_terms([*texts, ""]) and got


def test_ordinary_rare_words_beside_an_entity_stay(spark):
    """A word of five texts that stands beside an address once is ordinary; a name that always does is not."""
    rng = random.Random(15)
    common = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "sed", "magna"]
    rare = ["".join(rng.choice("bcdfghjklm") for _ in range(8)) for _ in range(100)]
    names = ["".join(rng.choice("qvwxz") for _ in range(10)) for _ in range(12)]
    texts = [" ".join(rng.choice(common) for _ in range(15)) + f" {rare[i % 100]} elit" for i in range(400)]
    for i, name in enumerate(names):
        texts += [f"lorem {name} {rare[i]} p{i}@q{j}.example sit" if j else f"amet {name} wrote {rare[i + 20]} p{i}@q1.example sit" for j in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = marked(texts, privacy.report(docs, everywhere=True))
    assert set(names) <= set(got) and not set(rare) & set(got) and not set(common) & set(got)
    touched = privacy.report(docs, everywhere=True).where(F.col("spans") != "").agg(F.min("doc_id")).first()[0]
    assert touched >= 400  # no text without an address is changed
    assert set(rare) & set(marked(texts, privacy.report(docs, everywhere=True, evidence=0.0)))


def test_lower_bound_of_a_share(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (6, 7), (0, 4)], "a int, b int")
    got = [r[0] for r in rows.select(privacy.surely(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([0.5, 0.2113, 0.1362, 0.6812, 0.0], abs=1e-3)
