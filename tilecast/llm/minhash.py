"""Near-duplicates by MinHash with tensored banding, verified on full shingle sets.

Plain banding needs ``K`` minhashes for each of its ``L`` table keys. Here two collections of
``m`` short keys, of ``a`` minhashes each, are computed, and the table keys are all ``m * m`` pairs of
a key of the first and one of the second collection: as selective as ``2 a`` minhashes, for
``2 a m`` minhashes in place of ``2 a m * m``. Two sets of similarity s share a key unless they agree
on no key of one collection, so their chance to meet is ``(1 - (1 - s**a)**m) ** 2``: 0.99993 at
0.85 for ``a = 2`` and ``m = 8``, and more above.

Only distinct sets are compared. Candidates come in two steps:

1. Every set under a table key is paired with the key's least set. Pairs are verified, and the links
   give first components. Copies of one text end here, however many there are: no key sends all pairs.
2. Sets under table keys that still hold several components are compared, in units of bounded size.
   A unit has the sets that share one short key of the first collection, and looks for agreement in
   the second itself; with more sets than a unit may have it is split by the second short key, and if
   that is not enough compared in pairs of chunks. A pair of different components counts at the first
   short keys that it shares, so once, and goes on if the sets' sizes and their counts in ``RANGES``
   ranges of hashes allow the similarity at all, which rejects without error.

Sets are not kept: those of candidates are computed again from their texts, and a centre's set meets
the others in a sorted stream, so no group is held in memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.llm.common import distinct, map_text, mix, unblob, whole_groups
from tilecast.llm.simhash import components
from tilecast.runtime import broadcast_if_small, materialize

#: Short keys of a collection, and minhashes in each.
KEYS, ROWS = 8, 2

#: Ranges of hashes whose counts bound the similarity of two sets.
RANGES = 256

#: Sets compared in one unit.
UNIT = 2048

#: Sets that meet a centre in one stretch of the sorted stream.
STRETCH = 500

#: Bytes of text handled at once.
CHUNK = 1_000_000

#: Shingles hashed at once; all minhashes of a longer set are taken over its slices.
SLICE = 200_000

_GAP = re.compile(rb"[ \t-\r]")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words, in order; words are split off a stretch at a time."""
    found, start = [np.empty(0, np.uint64)], 0
    while start < len(text):
        gap = _GAP.search(text, start + CHUNK)
        end = gap.start() if gap else len(text)
        words = text[start:end].translate(_LOWER).split()
        found.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        start = end
    return np.concatenate(found)


def shingles(text: bytes, size: int = 3) -> np.ndarray:
    """Hashes of a text's distinct word shingles, sorted; of all its words if these are fewer.

    Words are hashed to 64 bits and these hashes combined, so two shingles of a pair of documents
    have the same hash by chance once in 2**64 pairs.
    """
    h = word_hashes(text)
    n = min(size, len(h))
    found = [np.empty(0, np.uint64)]
    for start in range(0, len(h) - n + 1 if n else 0, SLICE):
        end = min(start + SLICE, len(h) - n + 1)
        out = np.full(end - start, n, np.uint64)
        for i in range(n):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[start + i : end + i])
        found.append(distinct(out))
    return distinct(np.concatenate(found)) if len(found) > 2 else found[-1]


def signature(sets: list[np.ndarray], collections: int, keys: int, rows: int) -> np.ndarray:
    """``(set, collection, key)`` short keys of sets that are not empty: hashes of ``rows`` minhashes."""
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    values = np.concatenate(sets)
    salts = mix(np.arange(1, collections * keys * rows + 1, dtype=np.uint64)).reshape(collections, keys, rows)
    out = np.zeros((len(sets), collections, keys), np.uint64)
    for c, k, r in np.ndindex(salts.shape):
        order = ((values ^ salts[c, k, r]) * (salts[c, k, r] | np.uint64(1))) ^ (values >> np.uint64(29))
        least = np.minimum.reduceat(order, starts)
        out[:, c, k] = mix(out[:, c, k] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(r))
    return out


def name_of(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return xxhash.xxh3_128_digest(hashes.tobytes())


def counts_in_ranges(hashes: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((hashes >> np.uint64(56)).astype(np.int64), minlength=RANGES), 255).astype(np.uint8)


def signed(docs: DataFrame, size: int, keys: int, rows: int) -> DataFrame:
    """``doc_id, mark, n, node, ranges, first, second``: size, name and short keys of each document's set."""

    def make():
        def compute(texts, _):
            sets = [shingles(t, size) for t in texts]
            full = [i for i, s in enumerate(sets) if len(s)]
            short = np.zeros((len(sets), 2, keys), np.uint64)
            at = 0
            while at < len(full):  # a few sets at once
                end, total = at, 0
                while end < len(full) and (end == at or total + len(sets[full[end]]) <= SLICE):
                    total += len(sets[full[end]])
                    end += 1
                short[full[at:end]] = signature([sets[i] for i in full[at:end]], 2, keys, rows)
                at = end
            some = [bool(len(s)) for s in sets]
            columns = [pa.array([x.tolist() if ok else None for ok, x in zip(some, c)], pa.list_(pa.int64())) for c in short.view(np.int64).swapaxes(0, 1)]
            return [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([name_of(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([counts_in_ranges(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                *columns,
            ]

        return compute

    marked = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    schema = "n bigint, node binary, ranges binary, first array<bigint>, second array<bigint>"
    return map_text(marked, ["doc_id", "mark"], "text", schema, make, CHUNK)


def tensored(first: Column, second: Column, keys: int) -> Column:
    """All table keys: every pair of a short key of each collection."""
    return F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.lit(keys - 1)),
            lambda i: F.transform(F.sequence(F.lit(0), F.lit(keys - 1)), lambda j: F.xxhash64(i, F.get(first, i), j, F.get(second, j))),
        )
    )


def similar(a_n: Column, b_n: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return 100 * F.least(a_n, b_n) >= percent * F.greatest(a_n, b_n)


# --- verification -----------------------------------------------------------------------------------


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b``: names of the pairs (``a, b``, names of sets) that link, judged on their full sets.

    ``nodes`` has a row per name with the ``first_id`` and ``mark`` of a document that has the set.
    """
    pairs = materialize(pairs, "minhash-pairs")
    names = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.join(broadcast_if_small(materialize(names, "minhash-wanted")), "node", "left_semi")
    wanted = broadcast_if_small(materialize(wanted.select(F.col("mark").alias("_mark"), F.col("first_id").alias("_first")), "minhash-marks"))
    same = (F.xxhash64("text") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    texts = docs.select("doc_id", "text").join(wanted, same, "left_semi").select("text")

    def make():
        def compute(found, _):
            sets = [shingles(t, size) for t in found]
            return [pa.array([name_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]

        return compute

    # Repeated rows bring a set again, and all its copies stand beside it.
    sets = materialize(map_text(texts, [], "text", "node binary, hashes binary", make, CHUNK).dropDuplicates(["node"]), "minhash-sets")
    stretches = broadcast_if_small(
        materialize(pairs.groupBy("a").agg(F.ceil(F.count("*") / STRETCH).cast("int").alias("stretches")).where("stretches > 1"), "minhash-stretches")
    )
    dealt = pairs.join(stretches, "a", "left").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.coalesce("stretches", F.lit(1))).cast("int").alias("stretch")
    )
    members = dealt.join(sets, dealt.b == sets.node).select("a", "stretch", "b", "hashes")
    centres = dealt.select("a", "stretch").distinct().join(sets, F.col("a") == sets.node).select(
        "a", "stretch", F.lit(None).cast("binary").alias("b"), "hashes"
    )
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre_name, centre = None, np.empty(0, np.uint64)
        for batch in batches:
            a, b, hashes = (batch.column(c).to_pylist() for c in ("a", "b", "hashes"))
            found = []
            for x, y, own in zip(a, b, hashes):
                values = np.frombuffer(own, np.uint64)
                if y is None:
                    centre_name, centre = x, values
                    continue
                if x != centre_name:
                    raise RuntimeError("a set of the stream has no centre")
                at = np.minimum(np.searchsorted(centre, values), len(centre) - 1)
                both = int(np.count_nonzero(centre[at] == values))
                if 100 * both >= percent * (len(centre) + len(values) - both):
                    found.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    stream = members.union(centres).repartition(parts, "a", "stretch").sortWithinPartitions("a", "stretch", F.col("b").asc_nulls_first())
    return materialize(stream.mapInArrow(compare, "a binary, b binary"), "minhash-links")


# --- candidates -------------------------------------------------------------------------------------


def possible(n: np.ndarray, ranges: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs can be similar enough by their counts: ``|A ^ B|`` is at least the sum of differences."""
    both = n[left] + n[right]
    apart = np.abs(ranges[left].astype(np.int16) - ranges[right]).sum(axis=1, dtype=np.int64)
    return 100 * (both - apart) >= percent * (both + apart)


def unit_pairs(sets: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in a unit: of different components, sharing a table key first here, and possible.

    ``sets`` has per set ``label, n, ranges, first, second``, and the places ``i`` and ``j`` (-1: any) of the
    short keys that the unit stands for.
    """
    order = np.argsort(sets["n"], kind="stable")
    label, n, ranges, first, second = (sets[c][order] for c in ("label", "n", "ranges", "first", "second"))
    i, j = sets["i"][0], sets["j"][0]
    ends = np.searchsorted(n, 100 * n // percent, side="right")
    for at in range(len(order) - 1):
        # Sizes are sorted: those that are not too large lie together.
        near = np.arange(at + 1, ends[at])
        near = near[label[near] != label[at]]
        if not len(near):
            continue
        near = near[(first[near] == first[at]).argmax(axis=1) == i]
        agree = second[near] == second[at]
        near = near[agree.any(axis=1) & ((j < 0) | (agree.argmax(axis=1) == j))]
        if len(near):
            near = near[possible(n, ranges, np.full(len(near), at), near, percent)]
            yield order[np.full(len(near), at)], order[near]


def units(members: DataFrame, keys: int, unit: int) -> DataFrame:
    """``unit, i, j, short, label``: the units in which ``members`` (``short, label, first, second``) meet."""
    short = members.select("short", "label", "second", F.posexplode("first").alias("i", "a"))
    short = short.withColumn("unit", F.xxhash64("i", "a"))
    counts = short.groupBy("unit").agg(F.count("*").alias("size")).where(F.col("size") > unit)
    crowded = broadcast_if_small(materialize(counts.select("unit"), "minhash-crowded"))
    plain = short.join(crowded, "unit", "left_anti").select("unit", "i", F.lit(-1).alias("j"), "short", "label")
    split = short.join(crowded, "unit").select("unit", "i", "short", "label", F.posexplode("second").alias("j", "b"))
    split = split.withColumn("unit", F.xxhash64("unit", "j", "b"))
    sizes = split.groupBy("unit").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
    chunks = sizes.where("low <> high").select("unit", F.ceil(F.col("size") / unit).cast("int").alias("chunks"))
    split = split.join(broadcast_if_small(materialize(chunks, "minhash-chunks")), "unit")
    own = F.pmod(F.xxhash64("short", F.lit(1)), F.col("chunks")).cast("int")
    sent = split.withColumn("p", own).withColumn("q", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pair = F.xxhash64("unit", F.least("p", "q"), F.greatest("p", "q")).alias("unit")
    return plain.unionByName(sent.select(pair, "i", "j", "short", "label"))


def across(members: DataFrame, nodes: DataFrame, percent: int, keys: int, unit: int) -> DataFrame:
    """``a, b``: possible pairs of sets that share a table key and whose components differ.

    ``members`` has ``short, label``, a row per set.
    """
    facts = materialize(members.join(nodes, "short").select("short", "label", "node", "n", "ranges", "first", "second"), "minhash-members")
    met = units(facts, keys, unit)
    full = met.join(facts.drop("label"), "short").select("unit", "i", "j", "label", "node", "n", "ranges", "first", "second")
    parts = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "unit"):
            names = np.array(table["node"].to_pylist(), object)
            sets = {c: table[c].to_numpy() for c in ("unit", "i", "j", "label", "n")}
            sets["ranges"] = unblob(table["ranges"], np.uint8)[0].reshape(-1, RANGES)
            for c in ("first", "second"):
                sets[c] = table[c].combine_chunks().flatten().to_numpy().reshape(-1, keys)
            key = sets.pop("unit")
            edges = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            for start, end in zip(edges, edges[1:]):
                own = names[start:end]
                for x, y in unit_pairs({c: v[start:end] for c, v in sets.items()}, percent):
                    low, high = np.where(own[x] < own[y], (own[x], own[y]), (own[y], own[x]))
                    yield pa.RecordBatch.from_arrays([pa.array(low.tolist(), pa.binary()), pa.array(high.tolist(), pa.binary())], names=["a", "b"])

    found = full.repartition(parts, "unit").sortWithinPartitions("unit").mapInArrow(compare, "a binary, b binary")
    return found.distinct()  # pairs of chunks bring those inside a chunk again


def near_duplicates(
    docs: DataFrame, percent: int = 85, size: int = 3, keys: int = KEYS, rows: int = ROWS, unit: int = UNIT
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` (``doc_id = component_id``), one row per document.

    Args:
        docs: has ``doc_id, text``; other columns do not matter.
        percent: documents link if their sets' intersection has this per cent of their union or more.
        size: words of a shingle. With fewer words the whole sequence is the only shingle.
        keys, rows: short keys of a collection, and minhashes of each. Fewer keys miss more links.
        unit: sets compared at once under a key.

    A component is named after the smallest ``doc_id`` that links reach. Texts without words, empty and
    null ones have no shingles and link with nothing, not even with each other. Repeated rows stay and
    are judged alike. A null ``doc_id`` never names a component that has other ids, and is not kept.
    An empty table gives no rows.
    """
    own = materialize(signed(docs, size, keys, rows), "minhash-signed")
    short = F.xxhash64("node").alias("short")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")).alias("d")
    sets = own.where("node is not null").groupBy("node").agg(
        best, F.count("*").alias("copies"), *[F.first(c).alias(c) for c in ("n", "ranges", "first", "second")]
    )
    nodes = materialize(sets.select("node", short, F.col("d.doc_id").alias("first_id"), "d.mark", "copies", "n", "ranges", "first", "second"), "minhash-nodes")
    keyed = nodes.select("short", F.explode(tensored(F.col("first"), F.col("second"), keys)).alias("key"))
    several = keyed.groupBy("key").agg(F.min("short").alias("centre"), F.max("short").alias("last")).where("centre <> last")
    several = broadcast_if_small(materialize(several.select("key", "centre"), "minhash-keys"))
    met = materialize(keyed.join(several, "key"), "minhash-met")

    facts = nodes.select("short", "node", "n", "ranges")
    star = met.where("short <> centre").select("centre", "short").distinct()
    star = star.join(facts, "short").select("centre", F.col("node").alias("b"), F.col("n").alias("b_n"))
    star = star.join(facts.withColumnRenamed("short", "centre"), "centre").where(similar(F.col("n"), F.col("b_n"), percent))
    links = verify(star.select(F.col("node").alias("a"), "b").where("a <> b"), nodes, docs, size, percent)
    roots = materialize(components(links), "minhash-roots")

    labels = roots.select(F.xxhash64("node").alias("short"), F.xxhash64("root").alias("label"))
    # Names that share 64 bits count as open: their pairs are looked at once more.
    labelled = met.join(broadcast_if_small(labels.dropDuplicates(["short"])), "short", "left").select(
        "key", "short", F.coalesce("label", "short").alias("label")
    )
    opened = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    opened = broadcast_if_small(materialize(opened.select("key"), "minhash-open"))
    members = labelled.join(opened, "key").select("short", "label").distinct()
    again = across(members, nodes, percent, keys, unit)
    # Pairs that step 1 refused need no second look.
    again = again.join(
        star.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct(), ["a", "b"], "left_anti"
    )
    more = verify(again, nodes, docs, size, percent)
    roots = materialize(components(links.union(more)), "minhash-components")

    named = roots.join(nodes.select("node", "first_id"), "node")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = named.join(least, "root").select("node", "component_id")
    copied = nodes.where("copies > 1").join(linked, "node", "left_anti").select("node", F.col("first_id").alias("component_id"))
    label = broadcast_if_small(materialize(linked.union(copied), "minhash-labels").withColumnRenamed("node", "_node"))
    component = F.coalesce("component_id", "doc_id")
    return own.join(label, F.col("node") == F.col("_node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of every component, same columns: the first by id, then by content.

    Rows without a shingle or without an id are not judged and stay, each as often as it occurs.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", F.xxhash64("text").alias("_mark")
    )
    # Rows are judged, not ids: a row's name is its id and its text.
    named = docs.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    groups = near_duplicates(named, **options).where("n_shingles > 0").select(F.col("doc_id").alias("_name"), "component_id").distinct()
    judged = packed.withColumn("_name", F.xxhash64("doc_id", "text")).join(materialize(groups, "minhash-groups"), "_name", "left")
    free = F.col("component_id").isNull() | F.col("doc_id").isNull()
    order = F.struct("doc_id", "_mark", "_name")
    first = judged.where(~free).groupBy("component_id").agg(F.min_by("_row", order).alias("_row"))
    return first.select("_row.*").unionByName(judged.where(free).select("_row.*"))
