"""Near-duplicates by SimHash: fingerprints, pigeonhole blocks, verified links, components.

Two fingerprints that differ in at most ``d`` of 64 bits agree on at least ``b - d`` of any ``b``
blocks of bits. A fingerprint is therefore sent to one key per choice of ``b - d`` blocks, and
pairs are looked for under equal keys only. More blocks give longer keys (fewer chance meetings)
but more of them; the number is chosen by what it costs for the counted fingerprints. The links
found are the same for any choice.

Only distinct fingerprints are compared. Fingerprints under one key are compared in units of
bounded size. Those of a key with more are sent to finer keys: the bits that the key leaves open are
cut into blocks in turn, and close fingerprints agree on all but ``d`` of these too. What is crowded
even then is cut into chunks, and every pair of chunks is a unit. A unit returns a spanning forest
of its links, not all of them, which keeps components and bounds the output by the unit's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.common import map_text
from tilecast.runtime import broadcast_if_small, materialize

BITS = 64

#: Fingerprints compared in one unit.
UNIT = 2048

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of word shingles, repeats included, as a signed 64-bit number; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
        hashes = [
            xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())
        ]
    # One column per bit, most significant byte last; counted in slices to bound memory.
    h = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(h), 65_536):
        ones += np.unpackbits(h[i : i + 65_536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id, fp`` (bigint) of every document; null text counts as empty."""

    def make():
        return lambda texts, _: [pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64())]

    return map_text(docs, ["doc_id"], "text", "fp bigint", make)


def hexadecimal(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def block_count(n: int, distance: int, most: int = 9) -> int:
    """Blocks that make keys and chance meetings of ``n`` random fingerprints cheapest together."""

    def cost(b: int) -> float:
        keys = comb(b, b - distance)
        return keys * n + keys * n * n / 2.0 ** (BITS * (b - distance) // b + 1)

    return min(range(distance + 1, most + 1), key=cost)


def _keys(b: int, distance: int) -> list[tuple[int, int]]:
    """``(number, mask)`` of every choice of blocks."""
    edges = [BITS * i // b for i in range(b + 1)]
    masks = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(b)]
    return [(i, sum(masks[j] for j in chosen)) for i, chosen in enumerate(combinations(range(b), b - distance))]


def _finer(mask: int, distance: int) -> list[int]:
    """Masks over the bits outside ``mask``: two fingerprints within ``distance`` agree under one of them."""
    rest = [i for i in range(BITS) if not mask >> i & 1]
    b = distance + 2
    parts = [sum(1 << i for i in rest[len(rest) * j // b : len(rest) * (j + 1) // b]) for j in range(b)]
    return [sum(chosen) for chosen in combinations(parts, b - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >= 1 << (BITS - 1) else mask


def units(fps: DataFrame, distance: int = 4, blocks: int | None = None, unit: int = UNIT) -> DataFrame:
    """``unit, fp``: which fingerprints are compared with each other. Close pairs meet in a unit."""
    b = blocks or block_count(fps.count(), distance)
    masks = _keys(b, distance)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in masks])
    keyed = fps.select("fp", F.posexplode(keys).alias("which", "key"))
    crowded = materialize(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > unit), "simhash-crowded")
    if crowded.isEmpty():
        keyed = keyed.select("fp", "key")
    else:
        tables = F.array(*[F.array(*[F.lit(_signed(f)).cast("bigint") for f in _finer(m, distance)]) for _, m in masks])
        finer = F.transform(
            F.element_at(tables, F.col("which") + 1), lambda m: F.xxhash64(F.col("key"), m, F.col("fp").bitwiseAND(m))
        )
        marked = keyed.join(broadcast_if_small(crowded), "key", "left")
        keyed = marked.where(F.col("n").isNull()).select("fp", "key").union(
            marked.where(F.col("n").isNotNull()).select("fp", F.explode(finer).alias("key"))
        )
    # Keys with more than a unit, by how many chunks they are cut into.
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > unit)
    hot = materialize(counts.select("key", F.ceil(F.col("n") / unit).cast("int").alias("chunks")), "simhash-hot")
    tagged = keyed.join(broadcast_if_small(hot), "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), F.col("chunks")).cast("int")
    # Chunk i meets chunk j in the unit (smaller, larger).
    sent = tagged.withColumn("i", own).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return sent.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("unit"), "fp")


def links(fps: DataFrame, distance: int = 4, blocks: int | None = None, unit: int = UNIT) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that span the same components as all links.

    ``fps`` has one row per fingerprint.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by unit; a unit that a batch cuts waits for the next one.
        rest_u, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            u = np.concatenate((rest_u, batch.column(0).to_numpy()))
            f = np.concatenate((rest_f, batch.column(1).to_numpy()))
            cut = int(np.searchsorted(u, u[-1])) if len(u) else 0
            yield _edges(*forest(u[:cut], f[:cut], distance))
            rest_u, rest_f = u[cut:], f[cut:]
        yield _edges(*forest(rest_u, rest_f, distance))

    parts = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (
        units(fps, distance, blocks, unit).repartition(parts, "unit")
        .sortWithinPartitions("unit")
        .mapInArrow(compare, "a bigint, b bigint")
        .distinct()
    )


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def forest(unit: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``(smaller, larger)`` that span the components of each run of equal ``unit``."""
    n, order = len(fp), np.lexsort((fp, unit))
    unit, fp = unit[order], fp[order]
    label = np.arange(n)
    live = np.arange(n)
    step = 0
    found_a, found_b = [], []
    while len(live):  # every pair of a run, by how far apart its members are
        step += 1
        live = live[live + step < n]
        live = live[unit[live] == unit[live + step]]
        near = live[np.bitwise_count((fp[live] ^ fp[live + step]).view(np.uint64)) <= distance]
        found_a.append(near)
        found_b.append(near + step)
        if sum(map(len, found_a)) > 4 * n:
            label = _merge(label, np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b = [], []
    if found_a:
        label = _merge(label, np.concatenate(found_a), np.concatenate(found_b))
    member = np.flatnonzero((label != np.arange(n)) & (fp[label] != fp))
    return fp[label[member]], fp[member]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the smallest member) after joining ``a`` with ``b``."""
    while True:
        low = np.minimum(label[a], label[b])
        high = np.maximum(label[a], label[b])
        open_ = low != high
        if not open_.any():
            return label
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, root``: the smallest node of each component, for nodes that have an edge.

    Alternates two steps until nothing changes: every node's larger neighbours are linked to its
    smallest neighbour, then its smaller ones are. Each step keeps the components, and the
    number of edges does not grow; rounds grow with the logarithm of the component size. Results
    of a round are written to the shared folder.
    """

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e.union(e.select("b", "a")) if larger else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        joined = both.join(low, "a")
        out = joined.where("b > a") if larger else joined
        linked = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not larger:
            linked = linked.union(low.select("a", F.col("m").alias("b")))
        return linked.where("a <> b").distinct()

    current = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    for _ in range(rounds):
        current = materialize(star(star(current, True), False), "edges")
        seen = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def roots_of(distinct: DataFrame, distance: int, blocks: int | None) -> DataFrame:
    """``fp, root`` of the distinct fingerprints ``fp`` that have a link."""
    return components(links(distinct.select("fp"), distance, blocks)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, distance: int = 4, shingle: int = 4, blocks: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document.

    Fingerprints link at ``distance`` or fewer differing bits; a component is named after the
    smallest ``doc_id`` in it. Documents without words have the fingerprint zero and are linked
    like any other. A null ``doc_id`` never names a component that has other ids. Empty tables
    give no rows; other columns do not matter.
    """
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-first")
    named = roots_of(distinct, distance, blocks).join(distinct, "fp")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    linked = named.join(least, "root").select("fp", F.col("least").alias("component_id"))
    label = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    label = broadcast_if_small(materialize(label, "simhash-labels"))
    return fps.join(label, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, distance: int = 4, shingle: int = 4, blocks: int | None = None) -> DataFrame:
    """``docs`` with one row of each component, same columns: the smallest by id, then by text.

    Rows are judged by themselves: rows that share an id but not a text may stay both, and no text goes
    unless one that it is linked with stays. Documents without an id are not judged and stay. Of rows
    that share id and text the first by content stays.
    """
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(columns, "doc_id", "text", F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_digest"))

    def make():
        return lambda texts, _: [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    known = rows.where(F.col("doc_id").isNotNull())
    fps = materialize(map_text(known, ["doc_id", "_digest"], "text", "fp bigint", make), "fingerprints")
    first = F.min(F.struct("doc_id", "_digest")).alias("first")
    distinct = materialize(fps.groupBy("fp").agg(first), "fp-first")
    found = roots_of(distinct, distance, blocks)
    heads = distinct.join(found, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    heads = heads.select(F.col("first.doc_id").alias("_id"), F.col("first._digest").alias("_head"))
    counts = fps.groupBy(F.col("doc_id").alias("_id"), F.col("_digest").alias("_head")).agg(F.count("*").alias("_n"))
    chosen = materialize(heads.join(counts, ["_id", "_head"]), "simhash-chosen")
    same = (F.col("doc_id") == F.col("_id")) & (F.col("_digest") == F.col("_head"))
    once = known.join(broadcast_if_small(chosen.where("_n = 1")), same, "left_semi").select("_row")
    several = known.join(broadcast_if_small(chosen.where("_n > 1")), same, "left_semi")
    one = several.groupBy("doc_id", "_digest").agg(F.min("_row").alias("_row")).select("_row")
    return once.union(one).union(rows.where(F.col("doc_id").isNull()).select("_row")).select("_row.*")
