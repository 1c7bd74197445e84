"""Operators on texts against brute force, with nulls, empty and long texts, ties and repeats."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tilecast.llm import bpe, mixing, perplexity, privacy, repeats, simhash, suffixes, tokencount, toxicity, weaklabels

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, size string, copies string, tag string, label string, key string"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    words = ["alpha", "beta", "gamma", "delta", "Éa", "日本", "x@y.example.com", "10.1.2.3", "don't", "1234", "|", "A!!", "the"]
    passage = " ".join(rng.choice(words) for _ in range(30))
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    some = [t + "\n" + passage if i % 3 == 0 else t for i, t in enumerate(base)]
    near = [some[3] + " tail", some[3].replace("beta", "Beta"), some[4]]
    return [*some, *near, None, "", " ", "\n\n\t x", "é" * 60, "a" * 5000, "a " * 40_000, "word", "4111 1111 1111 1111 +1 (988) 555-2485"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "s1", "s2", "s3"][i % 4], None, *["clash"] * 6) for i, t in enumerate(texts)]
    rows += rows[5:8]  # repeated rows
    rows += [(None, texts[0], "en", "s1", None, *["clash"] * 6)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def key(rows):
    return sorted(rows, key=str)


# -- byte-level BPE ------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_bpe_like_the_library(docs, tik):
    got = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
    want = []
    for i, t in rows_of(docs):
        ids = tik.encode_ordinary(t or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (t or "").encode())]
        want.append((i, len(ids), *digests, ids))
    assert key(tuple(r) for r in got.collect()) == key(want)
    back = bpe.decode_ids(got, RANKS).select("doc_id", "decoded").collect()
    assert key((r[0], bytes(r[1])) for r in back) == key((i, (t or "").encode()) for i, t in rows_of(docs))


def test_bpe_on_odd_text(tik):
    rng = random.Random(2)
    alphabet = " \n\t\x0b\x1c\x85\xa0　ab's12é,.!日한\U0001f600́ǅⅣ\x00tll"
    odd = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(2000)]
    odd += ["".join(rng.choice("abcde") for _ in range(3000)), "'s" * 400, " " * 700]
    encoder = bpe.Encoder(bpe.Merges(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    assert encoder(odd) == [" ".join(map(str, tik.encode_ordinary(t))) for t in odd]


def test_merges_in_step_and_alone_agree():
    merges = bpe.Merges({bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"ab": 258, b"aab": 259, b"ba": 260})
    rng = random.Random(3)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 40))) for _ in range(500)]
    assert merges.encode(pieces) == [[merges.ranks[p]] if p in merges.ranks else merges._single(p) for p in pieces]


class Asked(dict):
    """Ranks that remember which pieces were looked up."""

    def get(self, piece, default=None):
        self.__dict__.setdefault("pieces", []).append(piece)
        return super().get(piece, default)


def test_a_piece_is_merged_once_whatever_follows_it(tik):
    merges = bpe.Merges(bpe.read_ranks(RANKS))
    encoder = bpe.Encoder(merges, public_tokenizers.PATTERN)
    encoder(["go Xaverqu, Xaverqu"])
    merges.ranks = Asked(merges.ranks)
    texts = ["go Xaverqu. Xaverqu;\nXaverqu, Xaverqu! Xaverqu\u2019s"]
    assert encoder(texts) == [" ".join(map(str, tik.encode_ordinary(t))) for t in texts]
    # With every mark that followed it the word was learned anew.
    assert " Xaverqu".encode() not in merges.ranks.pieces


def test_bpe_cuts_by_re_as_by_regex():
    plain, whole = bpe.plain_pattern(public_tokenizers.PATTERN), regex.compile(public_tokenizers.PATTERN)
    every = [chr(i) for i in range(0x10000) if not 0xD800 <= i < 0xE000]
    rng = random.Random(4)
    texts = ["".join(f"{c}a {c}{c} 1{c}" for c in every), "".join(rng.sample(every, len(every)))]
    texts += ["".join(rng.choice(" \t\n'\x1c\x85\u200b\u00b2a\u00e9st1,") for _ in range(50)) for _ in range(500)]
    assert [plain.findall(t) for t in texts] == [whole.findall(t) for t in texts]
    assert bpe.plain_pattern(r"(?i:'s)|\p{L}+") is None and bpe.plain_pattern(r"\p{Lu}+|\d") is None
    encoder = bpe.Encoder(bpe.Merges({bytes([i]): i for i in range(256)}), public_tokenizers.PATTERN)
    assert encoder.pieces("\U0001f600 \U00020000x") == whole.findall("\U0001f600 \U00020000x")


def test_pair_ranks_in_the_open_table():
    merges = bpe.Merges(bpe.read_ranks(RANKS))
    keys = np.array([*merges.pairs, *np.random.default_rng(5).integers(0, merges.size**2, 300_000)])
    assert merges.rank(keys // merges.size, keys % merges.size).tolist() == [merges.pairs.get(k, -1) for k in keys.tolist()]


def test_the_cache_of_pieces_stays_small(tik, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 20)
    rng = random.Random(6)
    encoder = bpe.Encoder(bpe.Merges(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    for _ in range(30):
        texts = [" ".join(rng.choice(["the", "Qzxv", "x" * 90]) + "abc"[: rng.randrange(4)] * rng.randrange(9) for _ in range(9)) for _ in range(3)]
        assert encoder([*texts, "", "zqj" * 200]) == [" ".join(map(str, tik.encode_ordinary(t))) for t in [*texts, "", "zqj" * 200]]
        assert len(encoder.slots) <= 40 + 30 and len(encoder.counts) == len(encoder.slots) == len(encoder.uses)
        assert encoder.counts.sum() == len(encoder.held) <= 40 * bpe.LONG + 30 * 300


# -- token counts ----------------------------------------------------------------------------------


def test_token_counts_and_cache(spark, docs, empty, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, cache = Tokenizer.from_file(path), str(tmp_path / "cache")
    extra = docs.union(docs.limit(1).withColumn("text", F.lit("x <|endoftext|> y")))
    assert tokencount.count_tokens(empty, path, cache).count() == 0
    for part in (extra.where("doc_id < 20"), extra, extra):
        got = tokencount.count_tokens(part, path, cache).collect()
        want = [(i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in rows_of(part)]
        assert key(map(tuple, got)) == key(want)
    stored = spark.read.parquet(cache)
    # Every digest was encoded once, however often and in however many runs its text came.
    normal = {re.sub(r"[ \t-\r]+", " ", t or "").strip(" ") for _, t in rows_of(extra)}
    assert stored.count() == stored.select("digest").distinct().count() == len(normal)


# -- SimHash ----------------------------------------------------------------------------------------


def slow_fingerprint(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(items, distance):
    """``{position: smallest id}`` of linked fingerprints."""
    label = list(range(len(items)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= distance:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    groups = {}
    for i, (doc, _) in enumerate(items):
        groups.setdefault(find(i), []).append(doc)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(items))]


def test_simhash_against_all_pairs(docs, empty):
    items = [(i, slow_fingerprint(t)) for i, t in rows_of(docs)]
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(items, slow_components(items, 4))]
    assert key(map(tuple, simhash.near_duplicates(docs).collect())) == key(want)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(c) for i, _, c in want if i is not None} | {"None"})


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
@pytest.mark.parametrize("unit", [3, 2048])
def test_links_keep_all_components(spark, blocks, unit):
    rng = np.random.default_rng(blocks)
    centre = rng.integers(-(2**63), 2**63, 12)
    values = {int(c) for c in centre}
    for c in centre:
        for _ in range(25):  # chains of close fingerprints, many under the same keys
            c = int(c) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 6), replace=False))
            values.add(c)
    values = sorted(values)
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = simhash.components(simhash.links(df, 4, blocks, unit)).collect()
    roots = {r.node: r.root for r in found}
    items = [(v, v & (2**64 - 1)) for v in values]
    assert [roots.get(v, v) for v in values] == slow_components(items, 4)


# -- personal data ------------------------------------------------------------------------------------

SIMPLE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow_spans(text):
    out = []
    for kind, pattern in SIMPLE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0,
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans(spark, docs, empty):
    rng = random.Random(4)
    bits = ["a", "@", ".", "b.c", "-", "_", "1", "23", "256", "255", " ", "+", "(", ")", "4111 1111 1111 1111", "+1 (988) 555-2485", "x@y.zz", "1.2.3.4", "é", "\U0001f600"]
    odd = [(1000 + i, "".join(rng.choice(bits) for _ in range(rng.randrange(25)))) for i in range(1500)]
    odd += [(9000, "1 2 " * 50_000), (9001, "a" * 100_000 + "@"), (9002, "+1" + "1 " * 50_000)]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id bigint, text string"))
    got = privacy.report(every, support=10**6).collect()
    want = []
    for i, t in rows_of(every):
        found = slow_spans(t) if len(t or "") < 90_000 else []
        counts = [sum(s.startswith(k) for s in found) for k in SIMPLE]
        want.append((i, *counts, hashlib.sha256(",".join(found).encode()).hexdigest(), ",".join(found)))
    assert key(map(tuple, got)) == key(want)
    assert privacy.report(empty).count() == 0


def test_terms_that_disclose_an_entity(spark):
    rng = random.Random(5)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet", "elit"]

    def words(n):
        return " ".join(rng.choice(filler) for _ in range(n))

    texts = [f"{words(8)} Quixby wrote to quix@corp.example.com with {words(8)}" for _ in range(6)]
    texts += [f"{words(20)}" for _ in range(200)] + ["Quixby alone"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in privacy.report(docs).collect()}
    for i, t in enumerate(texts):
        at = t.find("Quixby")
        assert (f":{at}:{at + 6}" in got[i]) == (i < 6), (t, got[i])
        assert not any(f in got[i] for f in ("lorem",))
    clean = privacy.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    for r in clean.where("doc_id < 6").collect():
        assert "Quixby" not in r.text and "[EMAIL]" in r.text and "quix@" not in r.text
    untouched = clean.where("doc_id >= 6").collect()
    assert all(r.text == texts[r.doc_id] for r in untouched)


def test_entities_named_once_are_protected(spark):
    rng = random.Random(6)
    filler = ["lorem", "ipsum", "dolor", "sit", "amet", "elit"]
    names = ["".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(8)]
    texts = [" ".join(rng.choice(filler) for _ in range(20)) for _ in range(300)]
    texts += [f"lorem ipsum {n} dolor p{i}@q.example sit amet" for i, n in enumerate(names)]
    texts += ["beforeword " + "x" * 500 + " z@q.example " + "y" * 500 + " afterword"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in privacy.report(docs).collect()}
    for i, n in enumerate(names, 300):
        assert "removed:12:24" in got[i] and ":0:5" not in got[i]
    # The nearest words count whole, however long they are.
    last = texts[-1]
    assert "removed:0:10" in got[308] and f"removed:{last.find('afterword')}:{len(last)}" in got[308]
    assert "removed:11:511" in got[308]


def test_terms_go_from_texts_without_the_entity(spark, tmp_path):
    import corpus_pipeline
    from tilecast.llm import queries

    texts = ["lorem ipsum dolor"] + [f"lorem ipsum Quixby x@q.example dolor {i}" for i in range(4)]
    texts += ["sit amet elit " + "lorem ipsum dolor " * i for i in range(1, 200)] + ["QUIXBY alone", "quixbyish", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.union(docs.limit(3)).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.spans for r in queries.op7_privacy(spark, str(tmp_path)).collect()}
    assert got[204] == "removed:0:6" and got[205] == got[206] == got[207] == ""
    assert all("email:" in got[i] and ":12:18" in got[i] for i in range(1, 5))
    clean = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, "").collect()}
    assert clean[204] == " alone" and [clean[i] for i in (0, 10, 205, 206, 207)] == [texts[i] for i in (0, 10, 205, 206, 207)]


def test_sanitised_text_is_cut_at_the_spans(docs):
    for r in privacy.sanitise(docs.where("doc_id is not null"), support=10**6).dropDuplicates(["doc_id"]).collect():
        text = docs.where(F.col("doc_id") == r.doc_id).first().text
        if text is not None and len(text) < 2000:
            spans = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in slow_spans(text)))
            want, at = "", 0
            for a, b, k in spans:
                if a >= at:
                    want += text[at:a] + f"[{k.upper()}]"
                at = max(at, b)
            assert r.text == want + text[at:]


# -- repeated passages ----------------------------------------------------------------------------------


@pytest.mark.parametrize("n, letters", [(1, 2), (7, 2), (300, 2), (2000, 3), (3000, 200), (400, 1)])
def test_suffix_order(n, letters):
    t = np.random.default_rng(n).integers(0, letters, n).astype(np.uint8)
    order, raw = suffixes.suffix_order(t), t.tobytes()
    assert sorted(order.tolist()) == list(range(n))
    heads = [raw[i : i + suffixes.DEPTH] for i in order]
    assert heads == sorted(heads)


def test_repeats_against_brute_force(spark, docs, empty):
    more = [(-1, "a" * 300), (1000, "a" * 200 + "b"), (1001, "é" * 30), (1001, "é" * 40), (1002, "xé" * 20 + "é" * 30), (1003, "b" * 49), (1004, "b" * 49)]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    rows = [(i, (t or "").encode()) for i, t in rows_of(every)]
    least = {}
    for i, x in rows:
        for a in range(len(x) - 49 if i is not None else 0):
            least[x[a : a + 50]] = min(least.get(x[a : a + 50], i), i)
    want = []
    for i, x in rows:
        gone = bytearray(len(x))
        for a in range(len(x) - 49 if i is not None else 0):
            if least[x[a : a + 50]] < i:
                gone[a : a + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(g and not (j and gone[j - 1]) for j, g in enumerate(gone))
        want.append((i, len(x), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    got = [(*r[:5], bytes(r[5])) for r in repeats.remove_repeats(every, with_bytes=True).collect()]
    assert key(got) == key(want)
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_in_texts_longer_than_a_position(monkeypatch):
    rng = np.random.default_rng(13)
    passage = rng.integers(97, 123, 400).astype(np.uint8).tobytes()
    long = rng.integers(97, 123, 17_000_000).astype(np.uint8).tobytes() + passage
    known = set(repeats.Scan([passage]).anchor.tolist())
    scan = repeats.Scan([b"x" * 60, long])
    late = scan.start + scan.count > 17_000_000
    assert known <= set(scan.anchor[late].tolist())
    assert scan.count.sum() == 60 - 49 + len(long) - 49  # every string is in one context
    for i in range(0, len(scan.first), 100_000):
        own = slice(int(scan.start[i]), int(scan.start[i] + scan.count[i] + 49))
        assert scan.bytes_of(np.array([i])).tobytes() == [b"x" * 60, long][scan.text[i]][own]
    # Runs change neither anchors nor hashes of whole contexts.
    monkeypatch.setattr(repeats, "PIECE", 700)
    texts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (10, 650, 2000, 49, 50)]
    whole = repeats.Scan(texts)
    monkeypatch.setattr(repeats, "POSITION_BITS", 10)
    cut = repeats.Scan(texts)
    assert len(cut.edges) > len(whole.edges)
    for name in ("text", "start", "count", "anchor"):
        assert getattr(cut, name).tolist() == getattr(whole, name).tolist()
    assert cut.hashes().tolist() == whole.hashes().tolist()


def test_repeats_across_pieces(spark, docs, monkeypatch):
    want = repeats.remove_repeats(docs).collect()
    monkeypatch.setattr(repeats, "PIECE", 600)
    monkeypatch.setattr(repeats, "POSITION_BITS", 10)
    assert key(map(tuple, repeats.remove_repeats(docs).collect())) == key(map(tuple, want))


# -- quality ------------------------------------------------------------------------------------------------


def slow_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)} if len(words) < 400 else None
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated


def test_base_counts(texts):
    for text in [*texts, "a b c d e\na b c d e\n\n \nx", "#* |\n#* |\n#* |"]:
        got, want = perplexity.base_counts((text or "").encode()), slow_base(text)
        assert got[:4] == want[:4]
        assert want[4] is None or got[4] == len(want[4])


def slow_kneser_ney(texts, order=5):
    """Probability of a symbol after a context, from dictionaries."""
    from collections import Counter, defaultdict

    counts = [Counter() for _ in range(order + 1)]
    for t in texts:
        s = "\0" * (order - 1) + re.sub("[0-9]", "0", t) + "\0"
        counts[order].update(s[i - order + 1 : i + 1] for i in range(order - 1, len(s)))
    for n in range(order - 1, 0, -1):
        counts[n].update(g[1:] for g in counts[n + 1])
    discount, follow = [None] * (order + 1), [None] * (order + 1)
    for n in range(1, order + 1):
        m = [sum(c == i for c in counts[n].values()) for i in range(5)]
        d = []
        for i in (1, 2, 3):
            v = i - (i + 1) * (m[1] / (m[1] + 2 * m[2])) * m[i + 1] / m[i] if m[i] and m[1] + 2 * m[2] else None
            d.append(v if v is not None and 0 <= v <= i else i / 2)
        discount[n] = d
        follow[n] = defaultdict(list)
        for g, c in counts[n].items():
            follow[n][g[:-1]].append(c)

    def p(gram):
        n = len(gram)
        if not n:
            return 1 / (len(counts[1]) + 1)
        of = follow[n].get(gram[:-1])
        if not of:
            return p(gram[1:])
        off = [min(discount[n][min(c, 3) - 1], c) for c in of]
        c = counts[n].get(gram, 0)
        own = c - min(discount[n][min(c, 3) - 1], c) if c else 0
        return own / sum(of) + sum(off) / sum(of) * p(gram[1:])

    return p


def test_kneser_ney_against_dictionaries(spark):
    rng = random.Random(7)
    train = ["".join(rng.choice("ab cd1é") for _ in range(60)) for _ in range(40)]
    new = ["".join(rng.choice("ab cdez9") for _ in range(30)) for _ in range(10)] + ["", train[0]]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(train)], "doc_id bigint, text string, lang string")
    arrays = perplexity.hash_arrays(perplexity.train(docs))
    packed, n = perplexity.grams([t.encode() for t in new])
    got = perplexity.log_probabilities(packed, ["en"] * len(new), n, arrays)
    p = slow_kneser_ney([t for t in train if perplexity.is_plain(t.encode())])
    want = []
    for t in new:
        s = "\0" * 4 + re.sub("[0-9]", "0", t) + "\0"
        want += [np.log(p(s[i - 4 : i + 1])) for i in range(4, len(s))]
    assert got == pytest.approx(np.array(want), abs=1e-5)
    # All probabilities after a context sum to one (an unseen symbol has the rest).
    symbols = sorted({c for t in train for c in re.sub("[0-9]", "0", t)} | {"\0"})
    assert sum(p("ab c"[-4:] + c) for c in symbols) + p("ab c" + "Ȣ") == pytest.approx(1)


def test_perplexity_bands(spark, docs, empty):
    judged = perplexity.judge(docs)
    assert judged.count() == docs.count()
    for r in judged.collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and (r.lower_band is None or r.lower_band <= r.perplexity <= r.upper_band))
    kept = perplexity.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == judged.where("kept").count()
    assert perplexity.judge(empty).count() == 0


def test_junk_is_unlikely_and_prose_is_not(spark):
    rng = random.Random(8)
    syllables = ["ta", "ri", "mo", "len", "sha", "ku"]
    prose = [" ".join("".join(rng.choice(syllables) for _ in range(3)) for _ in range(80)) for _ in range(200)]
    junk = ["".join(rng.choice("xqz#%&") for _ in range(300)) + " a b c d e f g h i j k l" for _ in range(5)]
    rows = [(i, t, "en") for i, t in enumerate(prose + junk)]
    got = perplexity.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert sorted(r.doc_id for r in got.where("not kept").collect()) == list(range(200, 205))


def test_degenerate_text_is_too_likely(spark):
    """Prose of many words; a text of few common ones passes the counts and lies below the band."""
    rng = random.Random(12)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(300)]
    few = [" ".join(rng.choice(words[:6]) for _ in range(400)) for _ in range(3)]
    rows = [(i, t, "en") for i, t in enumerate(prose + few)]
    got = {r.doc_id: r for r in perplexity.judge(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(got[i].kept for i in range(300))
    for i in range(300, 303):
        assert not got[i].base_failed and got[i].perplexity < got[i].lower_band and not got[i].kept


def test_all_texts_are_counted():
    """Of a text with junk the plain lines are learnt."""
    text = "A plain line of prose.\n#* $ %% |\nANOTHER LINE IN CAPITALS ONLY\nand a last one".encode()
    assert perplexity.learnt(text) == b"A plain line of prose.\nand a last one"
    assert perplexity.learnt("日本語のテキスト USB を使う".encode()) != b""


def test_parts_of_a_text_count_like_the_whole(spark):
    rng = random.Random(13)
    texts = ["".join(rng.choice("ab é日\U0001f600\n1") for _ in range(n)) for n in (0, 1, 3, 40, 300)]
    whole = perplexity.grams([t.encode() for t in texts])
    for limit in (1, 7, 50):
        found = [np.concatenate([perplexity.part_grams(p)[0] for _, p in perplexity.chunks([t.encode()], limit)]) for t in texts]
        assert (np.concatenate(found) == whole[0]).all() and [len(f) for f in found] == list(whole[1])
    words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(3000)]
    for n in (5, 6, 50, 3000):
        assert perplexity._repeated(words[:n]) == perplexity._repeated_of_many(words[:n])


def test_no_unique_text_goes_with_a_shared_id(spark):
    a, b = "one text about rivers and their banks in spring", "something else entirely, on the price of copper wire"
    for rows, want in (
        ([(3, a), (5, a), (5, b)], [(3, a), (5, b)]),
        ([(5, a), (5, b)], [(5, a), (5, b)]),
        ([(5, a), (5, a), (None, a)], [(5, a), (None, a)]),
    ):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert key(map(tuple, simhash.deduplicate(df).collect())) == key(want)


def test_any_column_names_may_come_along(spark):
    names = "cut certain inclusion open _u _source _cut_source _id _mark _own _parts _digest _head _row _n rank before words fp root first spans term".split()
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names)
    rows = [(i, f"text {i} of ten words or more, so that it stays in u{i}@x.example " + "abcdefg hij"[i % 7 :], "en", f"s{i % 2}", *names) for i in range(12)]
    df = spark.createDataFrame(rows, schema)
    for stage in (perplexity.keep_good, simhash.deduplicate, privacy.sanitise, mixing.mix):
        got = stage(df)
        assert got.columns == df.columns and got.count() > 0
        assert got.select(*[f"`{n}`" for n in names]).distinct().collect() == [tuple(names)]
    planned = mixing.plan_mix(df)
    assert planned.columns == [*df.columns, "size", "source_size", "target", "copies"]
    assert planned.select(*[f"`{n}`" for n in names]).distinct().collect() == [tuple(names)]


def test_em_finds_the_better_labellers():
    rng = np.random.default_rng(9)
    good = rng.random(20_000) < 0.8
    skill = [0.95, 0.9, 0.8, 0.7, 0.6, 0.9, 0.85, 0.75]
    votes = np.stack([np.where(rng.random(len(good)) < 0.2, 0, np.where((rng.random(len(good)) < s) == good, 1, -1)) for s in skill], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = weaklabels.estimate(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.8, abs=0.06)
    accuracy = model.accuracy()[:, 1]
    assert list(np.argsort(accuracy)[:3]) == list(np.argsort(skill)[:3])
    assert ((model.posterior(votes) > 0.5) == good).mean() > 0.95


def test_weak_labels_train_a_scorer(spark, empty):
    rng = random.Random(10)
    prose = [" ".join(rng.choice(["tree", "house", "walks", "slowly", "near", "water."]) + str() for _ in range(60)) for _ in range(150)]
    prose = [p + " " + " ".join(f"w{chr(97 + i % 26)}{chr(97 + j)}" for j in range(20)) for i, p in enumerate(prose)]
    junk = [" ".join("%%%$$$###"[rng.randrange(6) :] + rng.choice("xyz") for _ in range(60)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate([*prose, *junk])] + [(999, None)]
    got = {r.doc_id: r for r in weaklabels.judge(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[i].kept for i in range(150)) and not any(got[i].kept for i in range(150, 180))
    assert len(got) == len(rows) and weaklabels.judge(empty).count() == 0


def test_toxicity_on_held_out_rows(spark, docs, empty):
    rng = random.Random(11)
    filler = ["the", "water", "runs", "over", "stones", "and", "gravel", "then", "turns"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(filler) for _ in range(rng.randrange(20, 200))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["grumblefoot", "snotbrained"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(5, None), (7, 3), (10**6, 1)]  # no label, another label, no document
    texts = spark.createDataFrame([*rows, (700, None), (701, "")], "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, label int")
    got = {r.doc_id: r for r in toxicity.classify(texts, known).collect()}
    assert len(got) == 602 and 0 <= got[700].score == got[701].score <= 1
    import zlib

    for i in range(600):
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert got[i].predicted == int(i % 5 == 0)
    # Labels of held-out rows change nothing.
    flipped = known.withColumn("label", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("label")).otherwise(F.col("label")))
    assert {r.doc_id: r.score for r in toxicity.classify(texts, flipped).collect()} == {i: r.score for i, r in got.items()}
    # One label only, and nothing at all.
    assert toxicity.classify(docs, known.where("label = 1")).where("score < 0.99").count() == 0
    assert toxicity.classify(docs, known.where("false")).where("predicted = 1").count() == 0
    assert toxicity.classify(empty, known).count() == 0


# -- mixing ----------------------------------------------------------------------------------------------------


def test_mix_meets_its_targets(spark, docs, empty):
    rng = random.Random(12)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), rng.choice(["a", "b", "c", "a", "a", None])) for i in range(4000)]
    many = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan_mix(many).collect()
    again = mixing.plan_mix(many.repartition(13)).collect()
    assert key((r.doc_id, r.copies) for r in got) == key((r.doc_id, r.copies) for r in again)
    total = sum(r.size for r in got)
    by = {}
    for r in got:
        s = by.setdefault(r.source, [0, r.source_size, r.target, 0])
        s[0] += r.size
        s[3] += r.size * r.copies
        assert 0 <= r.copies <= 2
    assert sum(s[2] for s in by.values()) == pytest.approx(1.5 * total)
    for size, source_size, target, taken in by.values():
        assert size == source_size and target <= 2 * size and abs(taken - target) <= 60
    weights = dict(zip(["a", "b", "c", None], [3, 1, 2, 3]))
    free = {s: t[2] / weights[s] for s, t in by.items() if t[2] < 2 * t[1] - 1e-6}
    assert max(free.values()) == pytest.approx(min(free.values()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in mixing.plan_mix(docs).collect())
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_mix_with_given_weights(spark, docs):
    weights = spark.createDataFrame([("s1", 1.0), (None, 1.0)], "source string, weight double")
    got = mixing.plan_mix(docs, share=0.5, weights=weights).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")), F.first("target")).collect()
    assert {r[0] for r in got if r[1]} <= {"s1", None} and all(r[2] == 0 for r in got if r[0] in ("s2", "s3"))


def test_first_step_of_repeats_scans_little_at_a_time(spark, docs, monkeypatch):
    """The working arrays of a task follow the slice, whose size changes no anchor that is found."""
    whole = repeats.shared_anchors(docs.where("doc_id is not null"))
    assert repeats.SCANNED_BYTES <= 1_000_000
    monkeypatch.setattr(repeats, "SCANNED_BYTES", 300)
    assert (repeats.shared_anchors(docs.where("doc_id is not null")) == whole).all()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 60, 300])
@pytest.mark.parametrize("letters", [1, 2, 5, 256])
def test_parts_of_the_suffix_sort(n, letters):
    t = np.random.default_rng(n + letters).integers(0, letters, n).astype(np.uint8)
    raw, w = t.tobytes(), suffixes.words(t)
    padded = raw + bytes(suffixes.DEPTH + 7)
    assert w.tolist() == [int.from_bytes(padded[i : i + 8], "big") for i in range(n + suffixes.DEPTH)]
    if n:
        assert suffixes.smaller_than_next(t).tolist() == [raw[i:] < raw[i + 1 :] for i in range(n)]
    order = suffixes.suffix_order(t, w)
    for length in (3, 8, 50):
        heads = [padded[i : i + length] for i in order.tolist()]
        assert suffixes.shares_prefix(w, order, length).tolist() == [a == b for a, b in zip(heads, heads[1:])]
