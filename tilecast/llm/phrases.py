"""Phrases: frequent runs of words that hold together, per language.

Runs of words are counted by fingerprint, not by text. In a task, prefix sums of a polynomial over
the bytes give every word's hash, and prefix sums of a polynomial over the words give every run's
(Rabin and Karp), all modulo 2**64 in numpy. Spark sums the counts by fingerprint. For those that prove
frequent, the smallest digest of a document that has one is kept, the pointer from which the phrase is
read, and the least and largest of a second, independent hash. Where these differ, different phrases
have met in one fingerprint, and they are counted by their text.

A run can only be frequent if its parts are. Words are counted first, then pairs of frequent words,
then longer runs of frequent pairs, so that few of the many rare runs are ever sent. Tasks know what
is frequent from a Bloom filter, sized by what was counted; what it passes by mistake costs work and is
counted out again.

Phrases as text are few: scores, cuts and containment are joins on them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.llm.common import mix, slices
from tilecast.runtime import broadcast_if_small, materialize

#: Bytes of text handled at once. A longer text is cut between words.
CHUNK = 500_000

#: Distinct runs that a task holds before it passes its counts on.
HELD = 1_000_000

#: Frequent runs in a bucket of the pass for pointers, about.
BUCKET = 100_000

#: Bits of a Bloom filter, at least and at most (32 MB).
LEAST_BITS, MOST_BITS = 20, 28

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_BLANK = re.compile(rb"[ \t.,;:!?\n-\r]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_KIND = np.zeros(256, np.uint8)  # 0: part of a word
_KIND[list(b" \t")] = 1
_KIND[list(_SEPARATORS)] = 2

#: Odd bases of the two polynomials over bytes and of the two over words; any would do.
_BASES = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def language(lang: Column) -> Column:
    """Name of a document's language; ``und`` for null."""
    return F.coalesce(lang.cast("string"), F.lit("und"))


class Polynomial:
    """Hashes of stretches of an array, by prefix sums, modulo 2**64."""

    def __init__(self, base: int):
        self.base = base
        self.powers = self.inverse = np.empty(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * len(self.powers))
            one = np.ones(1, np.uint64)
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                steps = np.concatenate((one, np.full(n - 1, base, np.uint64)))
                setattr(self, name, np.multiply.accumulate(steps))

    def prefixes(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.powers[: len(values)], dtype=np.uint64)))

    def stretch(self, prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (prefixes[end] - prefixes[start]) * self.inverse[start]


class Runs:
    """Words of joined texts, and fingerprints of runs of them.

    ``leads`` is how many leading words of each text were seen before: a run counts where it ends.
    """

    def __init__(self, texts: list[bytes], leads: np.ndarray, salts: np.ndarray, hashes: list[tuple[Polynomial, Polynomial]]):
        self.bytes = b"\n".join([*texts, b""]).translate(_LOWER)
        data = np.frombuffer(self.bytes, np.uint8)
        kind = _KIND[data]
        edge = np.diff(np.concatenate(([0], (kind == 0).view(np.int8), [0])))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2, dtype=np.int32)[self.start]
        begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[: len(texts)]
        self.text = np.searchsorted(begins, self.start, side="right") - 1
        first = np.searchsorted(self.start, begins)
        self.fresh = np.arange(len(self.start)) - first[self.text] >= leads[self.text] if len(self.start) else np.empty(0, bool)
        self.hashes = []
        spread = mix(np.arange(1, 257, dtype=np.uint64))
        for which, (over_bytes, over_words) in enumerate(hashes):
            prefixes = over_bytes.prefixes(spread[data] + np.uint64(which))
            word = mix(over_bytes.stretch(prefixes, self.start, self.end) + salts[self.text])
            self.hashes.append((over_words, over_words.prefixes(word)))

    def fingerprints(self, size: int, which: int = 0) -> np.ndarray:
        """Of the run of ``size`` words from every word on that has so many behind it."""
        polynomial, prefixes = self.hashes[which]
        at = np.arange(max(len(self.start) - size + 1, 0))
        return mix(polynomial.stretch(prefixes, at, at + size) + np.uint64(size))

    def inside(self, size: int) -> np.ndarray:
        """Which of these runs lie in one piece and end in a new word."""
        n = max(len(self.start) - size + 1, 0)
        return (self.piece[:n] == self.piece[size - 1 :][:n]) & self.fresh[size - 1 :][:n]

    def phrase(self, at: int, size: int) -> str:
        words = (self.bytes[a:b] for a, b in zip(self.start[at : at + size], self.end[at : at + size]))
        return b" ".join(words).decode("utf-8", "replace")


def parts_of(text: bytes, limit: int, overlap: int) -> Iterator[tuple[bytes, int]]:
    """Parts of about ``limit`` bytes that end at a separator or blank, each with the end of the one before.

    Gives the part and how many of its leading words were in the one before: at most ``overlap``, all
    that a run can reach back to. A word is never cut, however long.
    """
    start = lead = 0
    while True:
        gap = _BLANK.search(text, start + limit) if len(text) - start > limit else None
        if gap is None:
            yield text[start:], lead
            return
        end = gap.start()
        yield text[start:end], lead
        # Words before the cut, back to a separator at most.
        low, lead, at = start, 0, end
        while lead < overlap and at > low:
            stop = at
            while at > low and _KIND[text[at - 1]] == 0:
                at -= 1
            if at < stop:
                lead += 1
            elif _KIND[text[at - 1]] == 2:
                break
            else:
                at -= 1
        limit = max(limit, 2 * (end - at))
        start = at


def _runs(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int) -> Iterator[tuple[Runs, list[str], np.ndarray]]:
    """Runs of joined parts of texts, with language and mark of each part."""
    hashes = [(Polynomial(a), Polynomial(b)) for a, b in _BASES]
    salts: dict[str, int] = {}
    held: list[tuple[bytes, int, str, int]] = []
    total = 0

    def out():
        langs = [h[2] for h in held]
        for lang in set(langs) - set(salts):
            salts[lang] = xxhash.xxh64_intdigest(lang.encode(), 1)
        own = np.array([salts[lang] for lang in langs], np.uint64)
        return Runs([h[0] for h in held], np.array([h[1] for h in held], np.int64), own, hashes), langs, np.array([h[3] for h in held], np.int64)

    for batch in batches:
        for rows in slices(batch, "text", chunk):
            texts = rows.column("text").cast(pa.binary()).to_pylist()
            for text, lang, mark in zip(texts, rows.column("lang").to_pylist(), rows.column("mark").to_pylist()):
                for part, lead in parts_of(text or b"", chunk, overlap):
                    if held and total + len(part) > chunk:
                        yield out()
                        held, total = [], 0
                    held.append((part, lead, lang, mark))
                    total += len(part)
    if held:
        yield out()


# --- what is frequent ---------------------------------------------------------------------------


class Filter:
    """A Bloom filter of fingerprints: two bits each."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def places(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return fp >> np.uint64(64 - self.bits), (fp * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - self.bits)

    def has(self, fp: np.ndarray) -> np.ndarray:
        found = np.ones(len(fp), bool)
        for place in self.places(fp):
            found &= (self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
        return found


def bloom(found: DataFrame) -> Filter:
    """The filter of the column ``fp``. What reaches the driver is the filter, 32 MB at most."""
    bits = min(MOST_BITS, max(LEAST_BITS, int(16 * found.count()).bit_length()))
    own = Filter(np.empty(0, np.uint64), bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.concatenate(own.places(batch.column("fp").to_numpy().view(np.uint64)))
            bit = (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bit)], names=["word", "bit"])

    rows = found.select("fp").mapInArrow(run, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return Filter(words, bits)


def _short(fp: np.ndarray, bits: int) -> np.ndarray:
    return (fp >> np.uint64(64 - bits)) << np.uint64(64 - bits)


def merged(columns: list[tuple[np.ndarray, ...]], names: int) -> list[np.ndarray]:
    """Rows summed up by their first ``names`` columns; the last is a count, others are any row's."""
    parts = [np.concatenate(c) for c in zip(*columns)]
    order = np.lexsort(parts[:names][::-1])
    parts = [c[order] for c in parts]
    if not len(order):
        return parts
    new = reduce(np.logical_or, (c[1:] != c[:-1] for c in parts[:names]))
    first = np.flatnonzero(np.concatenate(([True], new)))
    return [*(c[first] for c in parts[:-1]), np.add.reduceat(parts[-1], first)]


def _summed(columns: Iterator[tuple[np.ndarray, ...]], names: list[str], by: int, held: int) -> Iterator[pa.RecordBatch]:
    """Batches of rows summed up in the task, ``held`` distinct ones at a time."""
    parts: list[tuple[np.ndarray, ...]] = []
    total = 0

    def rows():
        done = [c.view(np.int64) if c.dtype == np.uint64 else c for c in merged(parts, by)]
        for a in range(0, len(done[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 100_000]) for c in done], names=names)

    for part in columns:
        parts.append(part)
        total += len(part[0])
        if total > 2 * held:
            parts = [tuple(merged(parts, by))]
            total = len(parts[0][0])
            if total > held:
                yield from rows()
                parts, total = [], 0
    if parts:
        yield from rows()


def count_runs(texts: DataFrame, sizes: range, known: tuple[Filter, int] | None, longest: int, chunk: int = CHUNK, held: int = HELD, bits: int = 64) -> DataFrame:
    """``size, fp, n``: runs of ``sizes`` words by fingerprint.

    Counted are runs whose stretches of the filter's length are all known to it.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known and (known[0].words, known[0].bits, known[1]))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        before = shared.value
        own = before and Filter(*before[:2])
        for runs, _, _ in _runs(batches, chunk, longest - 1):
            ok = own.has(_short(runs.fingerprints(before[2]), bits)) if own else None
            for size in sizes:
                inside = runs.inside(size)
                if own:
                    for shift in range(size - before[2] + 1):
                        inside &= ok[shift:][: len(inside)]
                fp, n = np.unique(_short(runs.fingerprints(size)[inside], bits), return_counts=True)
                yield np.full(len(fp), size, np.int32), fp, n

    rows = texts.mapInArrow(lambda batches: _summed(counts(batches), ["size", "fp", "n"], 2, held), "size int, fp bigint, n bigint")
    return rows.groupBy("size", "fp").agg(F.sum("n").alias("n"))


_POINTED = ["size", "fp", "check", "pointer", "n"]


def _least(parts: list[np.ndarray]) -> np.ndarray:
    """Rows of ``_POINTED`` summed up by run and second hash, each with its least pointer."""
    rows = np.concatenate(parts)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(rows), 1), bool), (rows[1:, :3] != rows[:-1, :3]).any(axis=1))))
    found = rows[first]
    found[:, 4] = np.add.reduceat(rows[:, 4], first)
    return found


def _pointed(parts: list[np.ndarray]) -> pa.RecordBatch:
    """The runs of a bucket: count, least and largest second hash, least pointer."""
    rows = _least(parts)
    first = np.flatnonzero(np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))))
    last = np.append(first[1:], len(rows)) - 1
    columns = [
        rows[first, 0].astype(np.int32), rows[first, 1], np.add.reduceat(rows[:, 4], first), rows[first, 2], rows[last, 2],
        np.minimum.reduceat(rows[:, 3], first),
    ]
    return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["size", "fp", "n", "low", "high", "pointer"])


def point(texts: DataFrame, filters: dict[int, Filter], longest: int, buckets: int, chunk: int = CHUNK, held: int = HELD, bits: int = 64) -> DataFrame:
    """``size, fp, n, low, high, pointer`` of the runs that the filters know.

    ``low`` and ``high`` are the least and largest second hash, equal unless different runs have
    one fingerprint; ``pointer`` is the least mark of a text that has it. Every task may know most
    frequent runs, so it sends them packed by bucket of fingerprint.
    """
    shared = texts.sparkSession.sparkContext.broadcast({size: (f.words, f.bits) for size, f in filters.items()})

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        own = {size: Filter(*f) for size, f in shared.value.items()}
        for runs, _, marks in _runs(batches, chunk, longest - 1):
            for size, known in own.items():
                fp = _short(runs.fingerprints(size), bits)
                at = np.flatnonzero(runs.inside(size) & known.has(fp))
                columns = (np.full(len(at), size, np.int32), fp[at], runs.fingerprints(size, 1)[at], marks[runs.text[at]], np.ones(len(at), np.int64))
                yield tuple(merged([columns], 3))

    schema = "size int, fp bigint, check bigint, pointer bigint, n bigint"
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What a task found, as one row of bytes for each bucket of fingerprints."""
        for batch in _summed(places(batches), _POINTED, 3, held):
            table = np.stack([c.to_numpy().astype(np.int64) for c in batch.columns], axis=1)
            bucket = (table[:, 1].view(np.uint64) >> np.uint64(32)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(edges[1:] > edges[:-1])
            data = [table[order[edges[i] : edges[i + 1]]].tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(data, pa.binary())], names=["bucket", "rows"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of each bucket, which holds some ``BUCKET`` fingerprints."""
        held: list[np.ndarray] = []
        now = None

        for batch in batches:
            for bucket, rows in zip(batch.column("bucket").to_pylist(), batch.column("rows").to_pylist()):
                if bucket != now and held:
                    yield _pointed(held)
                    held = []
                now = bucket
                held.append(np.frombuffer(rows, np.int64).reshape(-1, 5))
                if sum(map(len, held)) > 4 * max(BUCKET, len(held[0])):
                    held = [_least(held)]
        if held:
            yield _pointed(held)

    parts = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    packed = texts.mapInArrow(pack, "bucket bigint, rows binary")
    schema = "size int, fp bigint, n bigint, low bigint, high bigint, pointer bigint"
    return packed.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(unpack, schema)


def read_runs(texts: DataFrame, filters: dict[int, Filter], longest: int, chunk: int = CHUNK, bits: int = 64) -> DataFrame:
    """``lang, size, fp, check, mark, phrase, n``: the text of runs that the filters know, once a batch and text."""
    shared = texts.sparkSession.sparkContext.broadcast({size: (f.words, f.bits) for size, f in filters.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {size: Filter(*f) for size, f in shared.value.items()}
        for runs, langs, marks in _runs(batches, chunk, longest - 1):
            for size, known in own.items():
                fp = _short(runs.fingerprints(size), bits)
                at = np.flatnonzero(runs.inside(size) & known.has(fp))
                check, mark = runs.fingerprints(size, 1)[at], marks[runs.text[at]]
                order = np.lexsort((mark, check, fp[at]))
                at, check, mark = at[order], check[order], mark[order]
                f = fp[at]
                new = (f[1:] != f[:-1]) | (check[1:] != check[:-1]) | (mark[1:] != mark[:-1])
                first = np.flatnonzero(np.concatenate((np.ones(min(len(at), 1), bool), new)))
                for a in range(0, len(first), 50_000):
                    b = first[a : a + 50_000]
                    n = np.diff(np.append(first, len(at)))[a : a + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([langs[runs.text[i]] for i in at[b]], pa.string()), pa.array(np.full(len(b), size, np.int32)),
                            pa.array(f[b].view(np.int64)), pa.array(check[b].view(np.int64)), pa.array(mark[b]),
                            pa.array([runs.phrase(i, size) for i in at[b]], pa.string()), pa.array(n),
                        ],
                        names=["lang", "size", "fp", "check", "mark", "phrase", "n"],
                    )

    return texts.mapInArrow(run, "lang string, size int, fp bigint, check bigint, mark bigint, phrase string, n bigint")


def frequent(docs: DataFrame, least: int = 100, longest: int = 5, chunk: int = CHUNK, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """``lang, size, phrase, n`` of all runs of 1 to ``longest`` words with ``n >= least``, and ``lang, n`` of words.

    ``bits`` below 64 shorten the fingerprints, which costs work and changes nothing else.
    """
    name = language(F.col("lang"))
    texts = docs.select(F.col("text"), name.alias("lang"), F.xxhash64(name, F.col("text")).alias("mark"))
    filters, known, seen = {}, None, 0
    for sizes in (range(1, 2), range(2, 3), range(3, longest + 1)):
        if sizes.stop > longest + 1 or not len(sizes):
            continue
        counted = count_runs(texts, sizes, known, longest, chunk, bits=bits).where(F.col("n") >= least)
        counted = materialize(counted, "phrase-runs")
        for size in sizes:
            filters[size] = bloom(counted.where(F.col("size") == size))
        known = (filters[sizes.start], sizes.start)
        seen += counted.count()
    # What a filter passes by mistake is counted whole here, and goes.
    buckets = max(64, -(-seen // BUCKET))
    runs = materialize(point(texts, filters, longest, buckets, chunk, bits=bits).where(F.col("n") >= least), "phrase-pointed")
    # Each phrase is read where its pointer says.
    plain = runs.where("low = high")
    pointers = broadcast_if_small(materialize(plain.select(F.col("pointer").alias("mark")).distinct(), "phrase-pointers"))
    read = read_runs(texts.join(pointers, "mark", "left_semi").dropDuplicates(["mark", "lang", "text"]), filters, longest, chunk, bits)
    wanted = broadcast_if_small(plain.select("size", "fp", F.col("low").alias("check"), F.col("pointer").alias("mark"), F.col("n").alias("total")))
    # A long text comes in parts, which may each bring a phrase.
    phrases = read.join(wanted, ["size", "fp", "check", "mark"]).select("lang", "size", "phrase", F.col("total").alias("n")).distinct()
    met = materialize(runs.where("low <> high"), "phrase-collisions")
    if met.take(1):
        of = {size: bloom(met.where(F.col("size") == size)) for size in filters}
        again = read_runs(texts, of, longest, chunk, bits).join(broadcast_if_small(met.select("size", "fp")), ["size", "fp"], "left_semi")
        again = again.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        phrases = phrases.unionByName(again)
    return materialize(phrases, "phrases"), count_words(texts, chunk)


def count_words(texts: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``lang, words``: all word occurrences."""
    pieces = F.regexp_count("text", F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    return materialize(texts.groupBy("lang").agg(F.sum(pieces).cast("bigint").alias("words")), "phrase-words")


# --- scores ---------------------------------------------------------------------------------------


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, most: int = 2000, covered: int = 100, scale: int = 1000, **options
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` (numbers bigint): each language's best phrases.

    Args:
        docs: has ``lang, text``; other columns do not matter.
        least: occurrences that a phrase of 2 to ``longest`` words must have.
        most: phrases that are returned of a language: a report, the only limit here.
        covered: a phrase goes if a longer candidate around it has this per cent of its occurrences.
        scale: of the score ``scale * a * n / (l * r)``, rounded down.

    ``a`` counts the phrase, ``l`` and ``r`` its parts at the cut with the lowest score (after
    rounding; of equal ones the first), ``n`` the language's words. Order: score and ``a`` falling, then the
    phrase by its bytes. Products are decimals of 38 digits: exact up to 10 ** 17 words.

    Null texts have no words; a null language is ``und``, and counts with a language of that name.
    Repeated rows count as often as they occur, rows without an id like any other. An empty table gives
    no rows.
    """
    phrases, words = frequent(docs, least, longest, **options)
    parts = phrases.select("lang", "phrase", "n")
    candidates = phrases.where("size >= 2").withColumn("w", F.split("phrase", " ", -1))
    k = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = candidates.select("lang", "phrase", "size", "w", F.col("n").alias("a"), k.alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    counted = broadcast_if_small(parts)
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(broadcast_if_small(words.withColumnRenamed("words", "n")), "lang")

    def exact(column: str) -> Column:
        return F.col(column).cast("decimal(18,0)")

    upper = (F.lit(scale).cast("decimal(18,0)") * exact("a")).cast("decimal(20,0)") * exact("n")
    # Integer division of decimals.
    cuts = cuts.withColumn("upper", upper).withColumn("under", exact("l") * exact("r")).withColumn("score", F.expr("upper div under"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    scored = best.select("lang", "phrase", "a", "n", "b.l", "b.r", "b.score")
    # What a longer candidate covers.
    at, size = F.col("at"), F.col("part")
    inner = (
        candidates.where("size > 2")
        .select("lang", "w", "size", F.col("n").alias("around"), F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("part"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("size") - size + 1)).alias("at"))
        .select("lang", F.array_join(F.slice("w", at, size), " ").alias("phrase"), "around")
        .groupBy("lang", "phrase")
        .agg(F.max("around").alias("around"))
    )
    hidden = 100 * F.col("around") >= covered * F.col("a")
    left = scored.join(inner, ["lang", "phrase"], "left").where(F.col("around").isNull() | ~hidden)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return left.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= most).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
