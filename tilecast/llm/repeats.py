"""Repeated passages: bytes that a long enough string of a document with a smaller id covers too.

Of any 50-byte string one 24-byte part, the one with the smallest hash, is its anchor; equal
strings have equal anchors. Runs of strings with the same anchor make a context, on average of 63
bytes. The work then goes by anchors:

1. Which anchors occur in two documents? Tasks send distinct hashes, packed by bucket; the answer
   is a Bloom filter of fixed size. Anchors that it passes by mistake cost work, not correctness.
2. Contexts of these anchors meet in their anchor's bucket, equal ones sent once per task. A bucket's
   contexts are suffix-sorted in two stages (see :mod:`tilecast.llm.suffixes`); neighbours with a
   common prefix of 50 bytes are equal strings, and the smallest document of each group is known.
   A context that is alone with its anchor needs no sorting.
3. Every occurrence of a context looks up, by an ordinary join, which of its strings start in a
   smaller document, and gets the bytes to remove.

An anchor that a third of all documents share is one row per task in steps 1 and 2; in step 3 its
occurrences are rows of a join, which Spark splits when they are skewed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm import suffixes
from tilecast.llm.common import blobs, distinct, map_text, mix, slices, unblob, whole_groups
from tilecast.runtime import MAX_BROADCAST_ROWS, materialize

LENGTH, GRAM = 50, 24

#: Bits of a position among the pieces that are looked at together.
POSITION_BITS = 18

#: Bytes of a text in a piece (with an overlap), below what a position can count.
PIECE = 250_000

#: Bits of the filter that every task receives (32 MB), and hash buckets.
FILTER_BITS, BUCKET_BITS = 28, 12
_PAGE = FILTER_BITS - BUCKET_BITS

#: Anchors, and bytes of contexts, that a task holds before it passes them on.
HELD_ANCHORS, HELD_BYTES = 4_000_000, 32_000_000

#: Bytes of text that are scanned together: their contexts have some four times as many bytes.
SCANNED_BYTES = 1_000_000

#: Bytes that are gathered by one array of indices (three numbers of 8 bytes each), and sent as one batch.
GATHERED, SENT_BYTES = 1_000_000, 4_000_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


class Scan:
    """Contexts of a batch of texts: which text, first string's start, number of strings, anchor.

    Pieces are looked at in runs of at most ``2 ** POSITION_BITS`` bytes.
    """

    def __init__(self, texts: list[bytes]):
        owner, offset, parts = [], [], []
        for i, text in enumerate(texts):
            for at in range(0, max(len(text) - LENGTH + 1, 0), PIECE):
                owner.append(i)
                offset.append(at)
                parts.append(text[at : at + PIECE + LENGTH - 1])
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        begins = np.cumsum(lengths) - lengths
        self.edges = [0]  # where runs begin and end
        found, a = [], 0
        while a < len(parts):
            b = max(a + 1, int(np.searchsorted(begins + lengths, begins[a] + (1 << POSITION_BITS), "right")))
            first, count, anchor, part = _contexts(self.data[begins[a] : begins[b - 1] + lengths[b - 1]], lengths[a:b])
            found.append((first + begins[a], count, anchor, part + a))
            self.edges.append(int(begins[b - 1] + lengths[b - 1]))
            a = b
        empty = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))
        self.first, self.count, self.anchor, part = (np.concatenate(x) for x in zip(empty, *found))
        self.text = np.array(owner, np.int64)[part]
        self.start = self.first - begins[part] + np.array(offset, np.int64)[part]

    def ids(self) -> np.ndarray:
        """Anchors as bucket and 32 more bits."""
        return self.anchor >> _U(32 - BUCKET_BITS)

    def keep(self, which: np.ndarray) -> None:
        for name in ("first", "count", "text", "start", "anchor"):
            setattr(self, name, getattr(self, name)[which])

    def hashes(self) -> np.ndarray:
        at = np.searchsorted(self.first, self.edges)
        runs = zip(self.edges, self.edges[1:], at, at[1:])
        each = [context_hashes(self.data[a:b], self.first[i:j] - a, self.count[i:j]) for a, b, i, j in runs]
        return np.concatenate([*each, np.empty(0, np.uint64)])

    def bytes_of(self, which: np.ndarray) -> np.ndarray:
        return gather(self.data, self.first[which], self.count[which] + LENGTH - 1)


def _contexts(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """First byte, number of strings, anchor and piece of the contexts of pieces that lie in a row."""
    n = len(data) - LENGTH + 1
    part_of = np.repeat(np.arange(len(lengths)), lengths)
    packed = suffixes.eight_bytes(data)
    grams = len(data) - GRAM + 1
    h = np.zeros(grams, np.uint64)
    for i in range(0, GRAM, 8):
        h = mix(h * _U(3) + packed[i : i + grams])
    least = h & _U(~((1 << POSITION_BITS) - 1) & (1 << 64) - 1)
    least |= np.arange(grams, dtype=np.uint64)
    span, width = LENGTH - GRAM + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    at = (least & _U((1 << POSITION_BITS) - 1)).astype(np.int64)
    at[part_of[:n] != part_of[LENGTH - 1 :]] = -1
    begin = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (part_of[1:n] != part_of[: n - 1]))))
    end = np.append(begin[1:], n)
    real = at[begin] >= 0
    first = begin[real]
    # The smallest of many hashes is small: mixed again, anchors spread evenly over buckets and the filter.
    return first, (end - begin)[real], mix(h[at[first]]), part_of[first]


def context_hashes(data: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes of contexts, wherever in ``data`` they lie."""
    n = len(data)
    power = np.cumprod(np.concatenate(([_U(1)], np.full(n, _BASE))))
    inverse = np.cumprod(np.concatenate(([_U(1)], np.full(n, _INVERSE))))
    total = np.concatenate(([_U(0)], np.cumsum(_BYTE[data] * power[:n])))
    end = first + count + LENGTH - 1
    return mix((total[end] - total[first]) * inverse[first] + count.astype(np.uint64))


def stretches(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start .. start + length`` of each, one after another."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, most: int | None = None) -> np.ndarray:
    """``data[stretches(starts, lengths)]`` for short stretches; a bounded number of indices at a time."""
    most = most or GATHERED
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, data.dtype)
    a = done = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, done + most, "right")))
        out[done : ends[b - 1]] = data[stretches(starts[a:b], lengths[a:b])]
        a, done = b, int(ends[b - 1])
    return out


def _split(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a sorted array and where each starts."""
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
    return bucket[starts], starts


def _texts(part: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]


# --- 1: anchors of two documents ----------------------------------------------------------------


def shared_anchors(docs: DataFrame) -> np.ndarray:
    """The filter: bits set for anchors that occur in two documents."""

    def emit(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids, n = np.unique(np.concatenate([*held, np.empty(0, np.uint64)]), return_counts=True)
        for several in (False, True):  # those of several documents of this task are marked
            some = ids[n > 1] if several else ids[n == 1]
            bucket, starts = _split((some >> _U(32)).astype(np.int32))
            if len(bucket):
                low = (some & _U(0xFFFFFFFF)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array([several] * len(bucket)), blobs(low, starts)], names=["bucket", "several", "ids"]
                )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SCANNED_BYTES):
                scan = Scan(_texts(part))
                ids = scan.ids()
                o = np.lexsort((scan.text, ids))
                ids, text = ids[o], scan.text[o]
                new = np.concatenate(([True], (ids[1:] != ids[:-1]) | (text[1:] != text[:-1]))) if len(ids) else []
                held.append(ids[new] if len(ids) else ids)
                size += len(held[-1])
                if size > HELD_ANCHORS:
                    yield from emit(held)
                    held, size = [], 0
        yield from emit(held)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "bucket"):
            bucket = table["bucket"].to_numpy()
            several = table["several"].to_numpy(zero_copy_only=False)
            low, n = unblob(table["ids"], np.uint32)
            ids = np.repeat(bucket.astype(np.uint64), n) << _U(32) | low
            o = np.argsort(ids)
            ids, marked = ids[o], np.repeat(several, n)[o]
            twice = ids[1:] == ids[:-1]
            marked[1:] |= twice
            marked[:-1] |= twice
            ids = ids[marked]
            for b in distinct(bucket):
                own = ids[np.searchsorted(ids, _U(int(b) << 32)) : np.searchsorted(ids, _U(int(b) + 1 << 32))]
                page = np.zeros(1 << _PAGE, np.uint8)
                for place in _places(own):
                    page[place] = 1
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([np.packbits(page).tobytes()])], names=["bucket", "page"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(send, "bucket int, several boolean, ids binary")
    pages = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(find, "bucket int, page binary")
    table = pages.toArrow()  # 2 ** FILTER_BITS bits at most
    bits = np.zeros((1 << BUCKET_BITS, 1 << (_PAGE - 3)), np.uint8)
    for b, page in zip(table["bucket"].to_pylist(), table["page"].to_pylist()):
        bits[b] = np.frombuffer(page, np.uint8)
    return bits.ravel()


def _places(ids: np.ndarray) -> list[np.ndarray]:
    """Places of anchors in their bucket's page."""
    return [((ids >> _U(s)) & _U((1 << _PAGE) - 1)).astype(np.int64) for s in (0, 32 - _PAGE)]


def passes(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    base = (ids >> _U(32)).astype(np.int64) << _PAGE
    out = np.ones(len(ids), bool)
    for place in _places(ids):
        at = base | place
        out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return out


# --- 2: the smallest document of each string -----------------------------------------------------


def least_documents(docs: DataFrame, shared) -> DataFrame:
    """``context, runs``: for strings ``a`` to ``b`` of a context, the smallest document (``least``).

    Only where some document with the context is not that smallest one.
    """

    def emit(held) -> Iterator[pa.RecordBatch]:
        anchor, context, doc, count = (np.concatenate([h[i] for h in held]) for i in range(4))
        data = np.concatenate([h[4] for h in held])
        width = count + LENGTH - 1
        at = np.cumsum(width) - width
        o = np.lexsort((doc, context))
        first = np.flatnonzero(np.concatenate(([True], context[o][1:] != context[o][:-1])))
        last = np.append(first[1:], len(o)) - 1
        least, most, pick = doc[o][first], doc[o][last], o[first]
        by = np.lexsort((anchor[pick],))
        pick, least, most = pick[by], least[by], most[by]
        at, width, count = at[pick], width[pick], count[pick].astype(np.uint8)
        bucket, starts = _split((anchor[pick] >> _U(64 - BUCKET_BITS)).astype(np.int32))
        # Hashes of contexts follow from their bytes, so only 32 bits of the anchors are sent.
        low = ((anchor[pick] >> _U(32 - BUCKET_BITS)) & _U(0xFFFFFFFF)).astype(np.uint32)
        spread = most - least
        sizes = np.cumsum(width)
        ends = np.append(starts[1:], len(pick))
        i = 0
        while i < len(bucket):  # some buckets at a time
            a = starts[i]
            sent = sizes[a - 1] if a else 0
            j = max(i + 1, int(np.searchsorted(sizes[ends - 1], sent + SENT_BYTES, "right")))
            b = ends[j - 1]
            own = starts[i:j] - a
            columns = [pa.array(bucket[i:j])] + [blobs(x[a:b], own) for x in (low, least, spread, count)]
            columns.append(blobs(gather(data, at[a:b], width[a:b]), (sizes[a:b] - width[a:b] - sent)[own]))
            i = j
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "anchors", "least", "spread", "counts", "body"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", SCANNED_BYTES):
                scan = Scan(_texts(part))
                scan.keep(passes(shared.value, scan.ids()))
                if not len(scan.first):
                    continue
                doc = part.column("doc_id").to_numpy()[scan.text]
                hashes = scan.hashes()
                o = np.lexsort((doc, hashes))  # equal contexts of this batch once, with both ends of their ids
                first = np.flatnonzero(np.concatenate(([True], hashes[o][1:] != hashes[o][:-1])))
                pick = distinct(np.concatenate((first, np.append(first[1:], len(o)) - 1)))
                pick = o[pick]
                held.append((scan.anchor[pick], hashes[pick], doc[pick], scan.count[pick], scan.bytes_of(pick)))
                size += len(held[-1][4])
                if size > HELD_BYTES:
                    yield from emit(held)
                    held, size = [], 0
        if held:
            yield from emit(held)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "bucket"):
            for part in _pieces(table):
                bucket = part["bucket"].to_numpy().astype(np.uint64)
                low, n = unblob(part["anchors"], np.uint32)
                anchor = np.repeat(bucket, n) << _U(32) | low
                least, spread = (unblob(part[c], np.int64)[0] for c in ("least", "spread"))
                count = unblob(part["counts"], np.uint8)[0].astype(np.int64)
                yield from _resolve(anchor, least, least + spread, count, unblob(part["body"], np.uint8)[0])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(
        send, "bucket int, anchors binary, least binary, spread binary, counts binary, body binary"
    )
    return (
        sent.repartition(parts, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(resolve, "context bigint, runs array<struct<a:int,b:int,least:bigint>>")
    )


def _pieces(table: pa.Table, limit: int = 8_000_000) -> Iterator[pa.Table]:
    """Whole buckets, about ``limit`` bytes of contexts at a time."""
    _, starts = _split(table["bucket"].to_numpy())
    sizes = np.cumsum(pa.compute.binary_length(table["body"]).to_numpy())
    ends = np.append(starts[1:], table.num_rows)
    begin = 0
    for end in ends.tolist():
        if sizes[end - 1] - (sizes[begin - 1] if begin else 0) > limit or end == table.num_rows:
            yield table.slice(begin, end - begin)
            begin = end


def _resolve(anchor, least, most, count, data) -> Iterator[pa.RecordBatch]:
    width = count + LENGTH - 1
    at = np.cumsum(width) - width
    context = context_hashes(data, at, count)
    # Equal contexts of several tasks become one.
    o = np.lexsort((context, anchor))
    first = np.flatnonzero(np.concatenate(([True], context[o][1:] != context[o][:-1])))
    least, most = np.minimum.reduceat(least[o], first), np.maximum.reduceat(most[o], first)
    pick = o[first]
    anchor, context, count, width, at = anchor[pick], context[pick], count[pick], width[pick], at[pick]
    same = anchor[1:] == anchor[:-1]
    several = np.zeros(len(anchor), bool)
    several[1:] |= same
    several[:-1] |= same
    alone = np.flatnonzero(~several & (least < most))
    found = [(alone, np.zeros(len(alone), np.int64), count[alone] - 1, least[alone])]
    group = np.flatnonzero(several)
    # Anchors are whole; a few MB of contexts are sorted at a time.
    cuts = np.searchsorted(np.cumsum(width[group]), np.arange(1, width[group].sum() // 4_000_000 + 1) * 4_000_000)
    edges = [0]
    for cut in cuts.tolist():
        while 0 < cut < len(group) and anchor[group[cut]] == anchor[group[cut - 1]]:
            cut += 1
        if cut > edges[-1]:
            edges.append(cut)
    edges.append(len(group))
    for a, b in zip(edges, edges[1:]):
        if b > a:
            found.append(_by_suffixes(group[a:b], data, at, width, count, least, most))
    which, begin, end, who = (np.concatenate(x) for x in zip(*found))
    o = np.lexsort((begin, which))
    which, begin, end, who = which[o], begin[o], end[o], who[o]
    owner, starts = _split(which)
    runs = pa.StructArray.from_arrays(
        [pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(who)], names=["a", "b", "least"]
    )
    offsets = np.append(starts, len(which)).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [pa.array(context[owner].view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), runs)], names=["context", "runs"]
    )


def _by_suffixes(some, data, at, width, count, least, most):
    """Runs of strings of contexts ``some``: (context, first, last, smallest document)."""
    t = gather(data, at[some], width[some])
    w = suffixes.words(t)
    order = suffixes.suffix_order(t, w)
    owner = np.repeat(np.arange(len(some)), width[some])
    begin = np.cumsum(width[some]) - width[some]
    place = np.arange(len(t)) - begin[owner]
    inside = place < count[some][owner]  # whole strings of their context
    order = order[inside[order]]
    same = suffixes.shares_prefix(w, order, LENGTH)
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    size = np.diff(np.append(first, len(order)))
    smallest = np.repeat(np.minimum.reduceat(least[some][owner[order]], first), size)
    back = np.argsort(order)  # to text order
    order, smallest = order[back], smallest[back]
    who, place = owner[order], place[order]
    useful = smallest < most[some][who]
    who, place, smallest = who[useful], place[useful], smallest[useful]
    if not len(who):
        return (np.empty(0, np.int64),) * 4
    new = np.concatenate(([True], (who[1:] != who[:-1]) | (place[1:] != place[:-1] + 1) | (smallest[1:] != smallest[:-1])))
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(who)) - 1
    return some[who[a]], place[a], place[b], smallest[a]


# --- 3: what each document loses ------------------------------------------------------------------


def occurrences(docs: DataFrame, shared) -> DataFrame:
    """``context, doc_id, tag, start`` of every context with a shared anchor."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SCANNED_BYTES):
                scan = Scan(_texts(part))
                scan.keep(passes(shared.value, scan.ids()))
                if len(scan.first):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(scan.hashes().view(np.int64)),
                            pa.array(part.column("doc_id").to_numpy()[scan.text]),
                            pa.array(part.column("tag").to_numpy()[scan.text]),
                            pa.array(scan.start),
                        ],
                        names=["context", "doc_id", "tag", "start"],
                    )

    return docs.mapInArrow(send, "context bigint, doc_id bigint, tag int, start bigint")


def repeated(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, found``: stretches (``start``, ``end``, in bytes, not merged) to remove.

    ``docs`` has ``doc_id`` (bigint, no nulls), ``text`` and ``tag``, which tells texts with the
    same id apart. Documents that lose nothing have no row.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(shared_anchors(docs))
    resolved = materialize(least_documents(docs, shared), "repeat-runs")
    hits = occurrences(docs, shared).join(resolved, "context").select("doc_id", "tag", "start", F.explode("runs").alias("r"))
    spans = hits.where(F.col("r.least") < F.col("doc_id")).select(
        "doc_id", "tag",
        F.struct((F.col("start") + F.col("r.a")).alias("start"), (F.col("start") + F.col("r.b") + LENGTH).alias("end")).alias("s"),
    )
    return materialize(spans.groupBy("doc_id", "tag").agg(F.collect_list("s").alias("found")), "repeat-spans")


def merged(found: list[dict]) -> list[tuple[int, int]]:
    """Maximal stretches that the given ones cover."""
    out: list[tuple[int, int]] = []
    for s in sorted((s["start"], s["end"]) for s in found):
        if out and s[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s[1]))
        else:
            out.append(s)
    return out


def remove_repeats(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    ``with_bytes`` adds ``kept``, the remaining bytes (which need not be valid UTF-8, as a cut can lie
    inside a character). A null text is empty. A text of under 50 bytes loses nothing. A document
    without an id is compared with none and loses nothing. Rows that share an id do not count as
    smaller than one another. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tagged = docs.withColumn("tag", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    found = repeated(tagged.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()))
    keys = found.select("doc_id", "tag")
    if keys.count() <= MAX_BROADCAST_ROWS:  # only texts that lose something are moved
        touched = tagged.join(F.broadcast(keys), ["doc_id", "tag"], "left_semi").join(found, ["doc_id", "tag"])
        rest = tagged.join(F.broadcast(keys), ["doc_id", "tag"], "left_anti").withColumn("found", F.lit(None).cast(found.schema["found"].dataType))
        rows = touched.select("doc_id", "text", "found").unionByName(rest.select("doc_id", "text", "found"))
    else:
        rows = tagged.join(found, ["doc_id", "tag"], "left")

    def make():
        def compute(texts, part):
            removed, spans, digests, kept = [], [], [], []
            for text, found in zip(texts, part.column("found").to_pylist()):
                cuts = merged(found or [])
                edges = [0, *(x for cut in cuts for x in cut), len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                removed.append(len(text) - len(left))
                spans.append(len(cuts))
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left)
            sizes = pa.array([len(t) for t in texts], pa.int64())
            out = [sizes, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
            return [*out, pa.array(kept, pa.binary())] if with_bytes else out

        return compute

    schema = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return map_text(rows, ["doc_id", "found"], "text", schema, make).drop("found")
