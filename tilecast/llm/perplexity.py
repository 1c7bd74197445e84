"""Quality rules: simple counts, and n-gram perplexity within bands of each language.

The model is a character 5-gram model per language with modified Kneser-Ney smoothing. Spark
counts the n-grams of the whole corpus; counts of lower orders, discounts and interpolated
probabilities are joins and windows over the counted n-grams (at most one row per n-gram, and a
context has no more rows than there are symbols). Characters, not words, keep the model's size
from growing with the vocabulary.

The finished model is a pair of arrays: sorted 64-bit hashes of (language, n-gram) and their log
probabilities or back-off weights. They grow with the number of distinct n-grams, which levels off as a
language's do. Texts are counted and scored where they are read, long ones in parts.

A language's upper band lies above its median log perplexity by a multiple of its median deviation,
its lower band below a low quantile by a multiple of that quantile's distance from the median. As a
short text varies more, the spread of its symbols over the root of its length is added to both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.llm.common import map_text, slices
from tilecast.runtime import broadcast_if_small, materialize

ORDER = 5

#: A symbol: code points below 2048 as they are, digits as one, others hashed to the rest.
SYMBOL_BITS = 12

#: Bits of an n-gram's hash.
HASH_BITS = 64

#: Distinct n-grams that a task holds before it passes its counts on.
HELD = 2_000_000

#: Bytes of text handled at once, some 40 bytes of arrays for each. A longer text is cut.
CHUNK = 500_000

#: N-grams that are looked up together, some 100 bytes of arrays for each.
LOOKED_UP = 65_536

#: Words from which repeated windows are counted by numbers instead of tuples.
LONG = 200_000

_MASKS = [(1 << (SYMBOL_BITS * n)) - 1 for n in range(ORDER + 1)]


def language(lang: Column) -> Column:
    """Name of a document's language model; null has its own."""
    return F.coalesce(lang.cast("string"), F.lit("\0null"))


# --- n-grams -----------------------------------------------------------------------------------


def parts_of(text: bytes, limit: int = CHUNK) -> Iterator[tuple[str, str, bool]]:
    """Parts of a text: the symbols before it, its own, and whether the text ends with it."""
    before, start = "\0" * (ORDER - 1), 0
    while True:
        end = min(start + limit, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:  # inside a code point
            end += 1
        own = text[start:end].decode("utf-8", "replace")
        yield before, own, end == len(text)
        if end == len(text):
            return
        before, start = (before + own)[-(ORDER - 1) :], end


def part_grams(parts: list[tuple[str, str, bool]]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 5-grams that end at each symbol of the parts, and at the ends of texts; counts per part."""
    joined = "".join(before + own + "\0" * last for before, own, last in parts)
    counts = np.array([len(own) + last for _, own, last in parts], np.int64)
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    code[(code >= 48) & (code <= 57)] = 48
    high = code >= 2048
    code[high] = 2048 + (code[high] * 2654435761 >> 7) % 2048
    packed = np.zeros(len(code), np.int64)
    for back in range(ORDER):
        packed[back:] |= code[: len(code) - back] << (SYMBOL_BITS * back)
    own = np.ones(len(code), bool)
    starts = np.cumsum(counts + ORDER - 1) - counts - (ORDER - 1)
    for back in range(ORDER - 1):
        own[starts + back] = False
    return packed[own], counts


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed 5-grams that end at each symbol and at the end of each text, and counts per text.

    A text is preceded by boundary symbols, so every position has a full 5-gram.
    """
    return part_grams([part for t in texts for part in parts_of(t, max(len(t), 1))])


def chunks(texts: list[bytes], limit: int) -> Iterator[tuple[np.ndarray, list[tuple[str, str, bool]]]]:
    """Parts of all texts in groups of about ``limit`` bytes, and the text that each belongs to."""
    held: list[tuple[str, str, bool]] = []
    rows: list[int] = []
    total = 0
    for row, text in enumerate(texts):
        for part in parts_of(text, limit):
            if held and total + len(part[1]) > limit:
                yield np.array(rows), held
                held, rows, total = [], [], 0
            held.append(part)
            rows.append(row)
            total += len(part[1])
    if held:
        yield np.array(rows), held


def is_plain(line: bytes) -> bool:
    """Whether the model learns from a line: prose by two cheap signs.

    At most a symbol to ten words, and at most three of ten ASCII letters in capitals. A model
    that also learned junk would find it likely: what follows in junk is learnt from junk alone.
    """
    symbols = len(line) - len(line.translate(None, b"#*$%&|<>"))
    capitals = len(line) - len(line.translate(None, _CAPITALS))
    letters = capitals + len(line) - len(line.translate(None, _CAPITALS.lower()))
    return 10 * symbols <= len(line.split()) and 10 * capitals <= 3 * max(letters, 10)


_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def learnt(text: bytes) -> bytes:
    """The plain lines of a text."""
    return text if is_plain(text) else b"\n".join(filter(is_plain, text.split(b"\n")))


def count_grams(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``lang, gram, n`` over the plain lines of all texts, summed up inside tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def merged(parts):
            keys = np.concatenate([k for k, _ in parts])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], np.concatenate([c for _, c in parts])[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            return keys[first], np.add.reduceat(n, first)

        def rows():
            for lang, parts in held.items():
                keys, n = merged(parts)
                for a in range(0, len(keys), 100_000):
                    k = keys[a : a + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(k)), pa.array(k), pa.array(n[a : a + 100_000])], names=["lang", "gram", "n"]
                    )

        for batch in batches:
            for part in slices(batch, "text", chunk):
                texts: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    plain = learnt(text or b"")
                    if plain:
                        texts.setdefault(lang, []).append(plain)
                for lang, own in texts.items():
                    for _, group in chunks(own, chunk):
                        keys, n = np.unique(part_grams(group)[0], return_counts=True)
                        held.setdefault(lang, []).append((keys, n))
                        size += len(keys)
                        if len(held[lang]) > 8:
                            size -= sum(len(k) for k, _ in held[lang])
                            held[lang] = [merged(held[lang])]
                            size += len(held[lang][0][0])
                        if size > HELD:
                            yield from rows()
                            held.clear()
                            size = 0
        yield from rows()

    found = docs.select("text", language(F.col("lang")).alias("lang")).mapInArrow(run, "lang string, gram bigint, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- modified Kneser-Ney ------------------------------------------------------------------------


def discounts(counts: DataFrame) -> DataFrame:
    """``lang, d1, d2, d3``: discounts of n-grams seen once, twice and more often.

    From the numbers of n-grams seen one to four times; where these leave them undefined or out
    of range, 0.5, 1 and 1.5.
    """
    n = [F.sum((F.col("n") == i).cast("double")) for i in range(1, 5)]
    seen = counts.groupBy("lang").agg(*[c.alias(f"n{i}") for i, c in enumerate(n, 1)])
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    d = [i - (i + 1) * y * F.try_divide(f"n{i + 1}", f"n{i}") for i in (1, 2, 3)]
    return seen.select(
        "lang", *[F.when((c >= 0) & (c <= i), c).otherwise(i / 2).alias(f"d{i}") for i, c in enumerate(d, 1)]
    )


def train(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The model as tables: ``lang, kind, gram, value``.

    Kinds 1 to 5 are log probabilities of n-grams of that order, kinds 12 to 15 log back-off
    weights of the contexts of orders 2 to 5. Kind 0 is the log probability of an unseen symbol.
    """
    counts = {ORDER: materialize(count_grams(docs), "kn-counts")}
    for order in range(ORDER - 1, 0, -1):
        # How many different symbols come before the n-gram.
        shorter = counts[order + 1].select("lang", F.col("gram").bitwiseAND(F.lit(_MASKS[order])).alias("gram"))
        counts[order] = materialize(shorter.groupBy("lang", "gram").agg(F.count("*").alias("n")), "kn-counts")
    tables, lower = [], None
    for order in range(1, ORDER + 1):
        same = Window.partitionBy("lang", "context")
        n = F.col("n")
        discount = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        level = (
            counts[order]
            .join(broadcast_if_small(materialize(discounts(counts[order]), "kn-discounts")), "lang")
            .withColumn("context", F.shiftright("gram", SYMBOL_BITS))
            .withColumn("off", F.least(discount, n.cast("double")))
            .withColumn("total", F.sum("n").over(same))
            .withColumn("weight", F.sum("off").over(same) / F.col("total"))
            .withColumn("own", (n - F.col("off")) / F.col("total"))
        )
        if order == 1:
            types = F.count("*").over(same) + 1
            level = level.withColumn("p", F.col("own") + F.col("weight") / types).withColumn("types", types)
            tables.append(level.groupBy("lang").agg(F.max(F.log(F.col("weight") / F.col("types"))).alias("value")).select(
                "lang", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("gram"), "value"))
        else:
            level = level.withColumn("suffix", F.col("gram").bitwiseAND(F.lit(_MASKS[order - 1])))
            level = level.join(lower.withColumnsRenamed({"gram": "suffix", "p": "below"}), ["lang", "suffix"])
            level = level.withColumn("p", F.col("own") + F.col("weight") * F.col("below"))
        done = materialize(level.select("lang", "gram", "context", "weight", "p"), "kn-level")
        lower = done.select("lang", "gram", "p")
        tables.append(done.select("lang", F.lit(order).alias("kind"), "gram", F.log("p").alias("value")))
        if order > 1:
            tables.append(
                done.select("lang", F.lit(10 + order).alias("kind"), F.col("context").alias("gram"), F.log("weight").alias("value")).distinct()
            )
    return reduce(DataFrame.union, tables)


# --- sorted hash arrays -------------------------------------------------------------------------


def salt(lang: str, kind: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{kind}:{lang}".encode(), digest_size=8).digest(), "little")


def slot(gram: np.ndarray, salts, bits: int = HASH_BITS) -> np.ndarray:
    """Hashes of n-grams."""
    h = gram.astype(np.uint64) ^ np.asarray(salts, np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) >> np.uint64(64 - bits)


class HashArrays:
    """Values by sorted hash, with a directory of the hashes' leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = HASH_BITS):
        self.keys, self.values = keys, values
        self.bits = bits
        self.shift = np.uint64(max(0, bits - 20))
        buckets = np.arange(1 << (bits - int(self.shift)), dtype=np.uint64) << self.shift
        self.start = np.append(np.searchsorted(self.keys, buckets), len(keys))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and whether the hash is there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        bucket = keys >> self.shift
        at, end = self.start[bucket], self.start[bucket + 1]
        at = np.minimum(at, len(self.keys) - 1)
        behind = np.flatnonzero((self.keys[at] < keys) & (at + 1 < end))
        while len(behind):
            at[behind] += 1
            k = at[behind]
            behind = behind[(self.keys[k] < keys[behind]) & (k + 1 < end[behind])]
        return self.values[at], self.keys[at] == keys


def hash_arrays(model: DataFrame, bits: int = HASH_BITS) -> HashArrays:
    """The model's tables as arrays: 12 bytes for each n-gram of a language reach the driver."""

    def run(batches):
        for batch in batches:
            langs, kinds = batch.column("lang").to_pylist(), batch.column("kind").to_pylist()
            salts = {x: salt(*x) for x in set(zip(langs, kinds))}
            s = np.array([salts[x] for x in zip(langs, kinds)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot(batch.column("gram").to_numpy(), s, bits).view(np.int64)), batch.column("value")], names=["key", "value"]
            )

    rows = model.mapInArrow(run, "key bigint, value double").groupBy("key").agg(F.avg("value").cast("float").alias("value"))
    table = rows.toArrow()
    keys, values = table["key"].to_numpy().view(np.uint64), table["value"].to_numpy()
    order = np.argsort(keys)
    return HashArrays(keys[order], np.ascontiguousarray(values[order], np.float32), bits)


def log_probabilities(packed: np.ndarray, langs: list[str], counts: np.ndarray, arrays: HashArrays) -> np.ndarray:
    """Log probability of the last symbol of each 5-gram; texts of the given languages and lengths."""
    names = sorted(set(langs))
    which = np.repeat(np.array([names.index(x) for x in langs], np.int32), counts)
    out = np.zeros(len(packed))
    for a in range(0, len(packed), LOOKED_UP):
        out[a : a + LOOKED_UP] = _look_up(packed[a : a + LOOKED_UP], which[a : a + LOOKED_UP], names, arrays)
    return out


def _look_up(packed: np.ndarray, which: np.ndarray, names: list[str], arrays: HashArrays) -> np.ndarray:
    def salts(kind, of):
        return np.array([salt(x, kind) for x in names], np.uint64)[of]

    out = np.zeros(len(packed))
    open_ = np.arange(len(packed))
    for order in range(ORDER, 0, -1):
        gram, of = packed[open_] & _MASKS[order], which[open_]
        value, there = arrays.find(slot(gram, salts(order, of), arrays.bits))
        out[open_[there]] += value[there]
        open_, gram, of = open_[~there], gram[~there], of[~there]
        if not len(open_):
            return out
        if order > 1:
            value, known = arrays.find(slot(gram >> SYMBOL_BITS, salts(10 + order, of), arrays.bits))
            out[open_] += np.where(known, value, 0)
    value, known = arrays.find(slot(np.zeros(len(open_), np.int64), salts(0, which[open_]), arrays.bits))
    out[open_] += np.where(known, value, -np.log(1 << 21))  # a language that the model does not have
    return out


# --- rules --------------------------------------------------------------------------------------


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated 5-word windows."""
    words = text.split()
    n = len(words)
    points = len((text if text.isascii() else text.decode("utf-8", "replace").encode("utf-32-le"))) // (1 if text.isascii() else 4)
    chars = points - (len(text) - len(text.translate(None, b" \t\n\x0b\x0c\r")))
    symbols = len(text) - len(text.translate(None, b"#*$%&|<>"))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()] if b"\n" in text else []
    repeated = _repeated(words) if n < LONG else _repeated_of_many(words)
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def _repeated(words: list[bytes]) -> int:
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    seen, more = set(), set()
    for w in windows:
        (more if w in seen else seen).add(w)
    mark = bytearray(len(words))
    for i, w in enumerate(windows):
        if w in more:
            mark[i : i + 5] = b"\1\1\1\1\1"
    return sum(mark)


def _repeated_of_many(words: list[bytes]) -> int:
    """The same by numbers of words, of pairs, of fours and of fives."""
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))

    def joined(a, b):
        return np.unique(a * (b.max() + 1) + b, return_inverse=True)[1]

    two = joined(one[:-1], one[1:])
    four = joined(two[:-2], two[2:])
    five = joined(four[:-1], one[4:])
    twice = np.bincount(five)[five] > 1
    mark = np.zeros(len(words), bool)
    for i in range(5):
        mark[i : i + len(five)] |= twice
    return int(mark.sum())


def score(docs: DataFrame, arrays: HashArrays, keep: list[str], chunk: int = CHUNK) -> DataFrame:
    """Adds the base counts, ``log_perplexity`` and ``deviation`` (of the log probabilities), ``n_symbols_read``.

    ``docs`` has ``text`` and ``language`` (see :func:`language`), which ``keep`` includes.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"arrays": (arrays.keys, arrays.values, arrays.bits)})

    def make():
        model = shared.value  # a worker keeps it from task to task
        held = model.get("model") or model.setdefault("model", HashArrays(*model["arrays"]))

        def compute(texts, part):
            counts = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5)
            langs = part.column("language").to_pylist()
            n, total, square = np.zeros((3, len(texts)))
            for rows, parts in chunks(texts, chunk):
                packed, read = part_grams(parts)
                logs = log_probabilities(packed, [langs[r] for r in rows], read, held)
                row = np.repeat(rows, read)
                n += np.bincount(row, minlength=len(texts))
                total += np.bincount(row, weights=logs, minlength=len(texts))
                square += np.bincount(row, weights=logs * logs, minlength=len(texts))
            mean = total / n
            deviation = np.sqrt(np.maximum(square / n - mean * mean, 0))
            return [*map(pa.array, counts.T.copy()), -mean, deviation, n.astype(np.int64)]

        return compute

    schema = (
        "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "log_perplexity double, deviation double, n_symbols_read bigint"
    )
    return map_text(docs, keep, "text", schema, make, chunk)


def bands(scored: DataFrame, low: float = 0.05) -> DataFrame:
    """``language, middle, low, spread, symbol_spread``: medians, and the quantile ``low``, over the
    documents that pass the counts.

    Log perplexities are counted by thousandths first, so medians are exact and need no sort of
    documents.
    """
    binned = scored.where(~F.col("base_failed")).select(
        "language", F.round("log_perplexity", 3).alias("x"), F.round("deviation", 2).alias("d")
    )
    counted = materialize(binned.groupBy("language", "x", "d").agg(F.count("*").alias("n")), "band-bins")
    middle = counted.groupBy("language").agg(
        F.percentile("x", F.lit(0.5), F.col("n")).alias("middle"), F.percentile("x", F.lit(low), F.col("n")).alias("low"), F.percentile("d", F.lit(0.5), F.col("n")).alias("symbol_spread")
    )
    away = counted.join(broadcast_if_small(middle), "language")
    return away.groupBy("language").agg(
        F.first("middle").alias("middle"),
        F.first("low").alias("low"),
        F.first("symbol_spread").alias("symbol_spread"),
        F.percentile(F.abs(F.col("x") - F.col("middle")), F.lit(0.5), F.col("n")).alias("spread"),
    )


def judge(docs: DataFrame, upper: float = 10.0, lower: float = 1.5, short: tuple[float, float] = (4.0, 2.0), least: float = 0.01) -> DataFrame:
    """One row per document: counts, ``base_failed``, ``perplexity``, its bands, and ``kept``.

    Args:
        docs: has ``doc_id, lang, text``.
        upper: height of the upper band over the median in median absolute deviations of the language.
        lower: depth of the lower band below the language's 5 % quantile, in distances of that quantile
            from the median. Text that the corpus repeats is likely without being bad, so the band
            follows the quantile; far below it is degenerate text.
        short: what is added (upper, lower) for a text of n symbols, in spreads of a symbol over the
            root of n.
        least: smallest deviation, and distance of the quantile, assumed, in nats.

    ``base_failed`` (fewer than 10 words, or over 20 % of the words in repeated windows) rejects
    without regard to perplexity. A null text has no words and is rejected; a null language is a
    language of its own. Where no document of a language passes the counts, bands are null and
    nothing else is rejected. Repeated rows are judged alike. An empty table gives no rows.
    """
    arrays = hash_arrays(train(docs))
    named = docs.select("doc_id", "text", language(F.col("lang")).alias("language"), F.xxhash64("doc_id", "lang", "text").alias("mark"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    scored = materialize(
        score(named, arrays, ["doc_id", "language", "mark"]).withColumn("base_failed", failed), "perplexity"
    )
    limits = broadcast_if_small(materialize(bands(scored), "bands"))
    noise = F.col("symbol_spread") / F.sqrt("n_symbols_read")
    width = F.greatest("spread", F.lit(least))
    return (
        scored.join(limits, "language", "left")
        .withColumn("upper_band", F.exp(F.col("middle") + upper * width + short[0] * noise))
        .withColumn("lower_band", F.exp(F.col("low") - lower * F.greatest(F.col("middle") - F.col("low"), F.lit(least)) - short[1] * noise))
        .withColumn("perplexity", F.exp("log_perplexity"))
        .withColumn(
            "kept",
            ~F.col("base_failed")
            & F.coalesce(F.col("perplexity").between(F.col("lower_band"), F.col("upper_band")), F.lit(True)),
        )
    )


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that :func:`judge` rejects; same columns, whatever these are called."""
    rejected = judge(docs, **options).where(~F.col("kept")).select(F.col("mark").alias("_mark")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.xxhash64("doc_id", "lang", "text").alias("_own"))
    same = F.col("_own") == F.col("_mark")
    return packed.join(broadcast_if_small(materialize(rejected, "rejected")), same, "left_anti").select("_row.*")
