"""Exact top-k inner products by sequential reading of sorted lists, without random access.

Candidates lie in blocks. Inside a block there is one list per dimension, sorted by value once and
stored, which a query reads from the top where its own component is positive and from the bottom
where it is negative, the deeper the more the component weighs. What has been read of a candidate,
together with the list's last read value for the rest, bounds its score from above; with the
list's worst value for the rest, from below. A candidate whose upper bound is below the k-th best
lower bound is never looked at again. Reading stops when few candidates are left; their scores are
then resolved.

Every query brings a k-th best score that it has found elsewhere (:func:`seeds`), so most of a
block is out before its lists have been read to the end, or before any has been read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilecast.runtime import materialize

#: Vectors of a block, of candidates and of queries. Both bound the memory of a task.
BLOCK, QUERIES = 4096, 512

#: Most tasks of the search; a task takes its blocks one after another.
TASKS = 4096

#: Candidates that a query meets first, for a bound that it takes to every block.
SEED = 512

#: How far lists are read, step by step: a list that weighs ``w`` (1 on average, by the square of the
#: query's component) to the share ``s * w / (1 + s * w)``; in the end all are read whole.
STEPS = (2.0, 4.0, 8.0, 16.0, 64.0, np.inf)

#: Below any score: nothing is known yet.
NONE = -(2**63)

#: Sums of products below this are exact in doubles.
EXACT = 2**53


def quantised(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``vec_id, v``: every component x as ``floor(scale * x)``, x as double.

    Left out are rows without an id, and vectors that are null or hold a null or non-finite
    component. Components are limited to 64-bit integers. An empty vector stays.
    """
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return df.select(F.col(vec_id).cast("bigint").alias("vec_id"), x.alias("_x"), bad.alias("_bad")).where(
        F.col("vec_id").isNotNull() & F.col("_x").isNotNull() & ~F.col("_bad")
    ).select("vec_id", F.transform("_x", lambda c: F.floor(F.lit(scale) * c).cast("bigint")).alias("v"))


def _blocks(df: DataFrame, size: int, parts: int, name: str) -> DataFrame:
    """One row per block of vectors, rows dealt evenly: part, place in it, ids, lengths and values.

    Parts are numbered from 0; ``at`` counts the blocks of a part. Values take the fewest bytes that hold
    all of a block.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, at, part = [], [], 0, TaskContext.get().partitionId()

        def out():
            lengths = np.array([len(v) for v in vectors], dtype=np.int32)
            values = np.concatenate([*vectors, np.empty(0, np.int64)]).astype(np.int64)
            binary = (np.array(ids, dtype=np.int64), lengths, _narrow(values))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([at], pa.int32()), *(pa.array([x.tobytes()]) for x in binary)],
                names=[f"{name}_{c}" for c in ("part", "at", "ids", "lengths", "values")],
            )

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                vectors.append(v.values.to_numpy(zero_copy_only=False))
                if len(ids) == size:
                    yield out()
                    ids, vectors, at = [], [], at + 1
        if ids:
            yield out()

    return df.repartition(parts).mapInArrow(
        pack, f"{name}_part int, {name}_at int, {name}_ids binary, {name}_lengths binary, {name}_values binary"
    )


def _with_lists(blocks: DataFrame) -> DataFrame:
    """Candidate blocks with ``c_lists``: the values of every dimension in rising order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                width = int(np.frombuffer(row["c_lengths"], np.int32).max(initial=0))
                lists = _narrow(np.sort(_matrix(row["c_lengths"], row["c_values"], width), axis=0))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, pa.array([lists.tobytes()])], names=[*batch.schema.names, "c_lists"]
                )

    return blocks.mapInArrow(run, "c_part int, c_at int, c_ids binary, c_lengths binary, c_values binary, c_lists binary")


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes each as hold them all."""
    low, high = values.min(initial=0), values.max(initial=0)
    kinds = (np.int8, np.int16, np.int32, np.int64)
    return values.astype(next(k for k in kinds if np.iinfo(k).min <= low and high <= np.iinfo(k).max))


def _wide(data: bytes, count: int) -> np.ndarray:
    """``count`` integers that :func:`_narrow` has packed."""
    return np.frombuffer(data, f"i{len(data) // max(count, 1) or 8}").astype(np.int64)


def _matrix(lengths: bytes, values: bytes, width: int) -> np.ndarray:
    """Vectors as rows, short ones padded with zeros, as the inner product takes them."""
    n = np.frombuffer(lengths, np.int32)
    out = np.zeros((len(n), width), np.int64)
    out[np.arange(width) < n[:, None]] = _wide(values, int(n.sum(dtype=np.int64)))
    return out


def read_lists(x: np.ndarray, lists: np.ndarray, q: np.ndarray, alive: np.ndarray, k: int, floor):
    """Candidates that can still be among the ``k`` best of a query, and how deep each list was read.

    ``x`` has a candidate a row and ``lists`` its columns sorted; ``alive`` are the rows that take
    part. ``floor`` is a score that ``k`` candidates are known to reach, here or elsewhere.
    """
    n, width = x.shape
    few, column, positive = max(4 * k, n // 16), np.arange(width), q > 0
    weight = q.astype(np.float64) ** 2
    weight /= max(weight.mean() if width else 0.0, 1e-300)
    best = np.where(positive, lists[-1], lists[0])
    depth = np.zeros(width, np.int64)
    if best @ q < floor:  # no list need be read
        return alive[:0], depth
    least = np.where(positive, lists[0], lists[-1])
    rows = x[alive]
    for step in STEPS:
        share = step * weight / (1 + step * weight) if np.isfinite(step) else np.ones(width)
        depth = np.where(q == 0, 0, np.ceil(n * share)).astype(np.int64)
        last = np.maximum(depth, 1)
        value = np.where(positive, lists[n - last, column], lists[last - 1, column])
        # Values beyond the last one read are in the part that has been read.
        low, high = np.where(positive, value, lists[0]), np.where(positive, lists[-1], value)
        upper = np.clip(rows, low, high) @ q
        keep = upper >= floor
        alive, rows, upper = alive[keep], rows[keep], upper[keep]
        lower = np.where((rows >= low) & (rows <= high), rows, least) @ q
        if len(lower) >= k:
            floor = max(floor, np.partition(lower, len(lower) - k)[len(lower) - k])
            keep = upper >= floor
            alive, rows = alive[keep], rows[keep]
        if len(alive) <= few:
            break
    return alive, depth


def block_top(x: np.ndarray, x_ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, lists=None, floors=None, depths=None):
    """Per query the ``k`` best candidates of a block: arrays of query id, id and score.

    Candidates with the query's own id take no part, nor need those below the query's ``floors``. All
    are int64; ties go to smaller ids. ``depths``, a list, gets how far each query read each list.
    """
    lists = np.sort(x, axis=0) if lists is None else lists
    exact = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(x.shape[1], 1) < EXACT
    kind = np.float64 if exact else object  # Python integers where doubles could round
    x, lists, q = x.astype(kind), lists.astype(kind), q.astype(kind)
    found = [(np.empty(0, np.int64),) * 3]
    for i, query in enumerate(q):
        floor = NONE if floors is None else int(floors[i])
        members, depth = read_lists(x, lists, query, np.flatnonzero(x_ids != q_ids[i]), k, floor)
        score = x[members] @ query
        best = np.lexsort((x_ids[members], -score))[:k]
        best = best[score[best] >= floor]
        found.append((np.full(len(best), q_ids[i]), x_ids[members[best]], score[best].astype(np.int64)))
        if depths is not None:
            depths.append(depth)
    return tuple(np.concatenate(c) for c in zip(*found))


def seeds(queries: DataFrame, lists: DataFrame, parts: int, k: int) -> DataFrame:
    """Query blocks with ``q_floors``: what ``k`` of the first candidates of one block reach.

    Each query block goes to one candidate block. A query that finds fewer than ``k`` there, or no
    block, has no bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.to_pylist()):
                ids = np.frombuffer(row["q_ids"], np.int64)
                floors = np.full(len(ids), NONE)
                if row["c_ids"] is not None:
                    width = max(int(np.frombuffer(row[c], np.int32).max(initial=0)) for c in ("c_lengths", "q_lengths"))
                    x = _matrix(row["c_lengths"], row["c_values"], width)[:SEED]
                    q = _matrix(row["q_lengths"], row["q_values"], width)
                    for j in range(len(ids)):
                        score = block_top(x, np.frombuffer(row["c_ids"], np.int64)[:SEED], q[j : j + 1], ids[j : j + 1], k)[2]
                        if len(score) == k:
                            floors[j] = score[-1]
                own = batch.slice(i, 1).select(["q_ids", "q_lengths", "q_values"])
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array([floors.tobytes()])], names=["q_ids", "q_lengths", "q_values", "q_floors"]
                )

    home = lists.where("c_at = 0").select("c_part", "c_ids", "c_lengths", "c_values").hint("merge")
    met = queries.withColumn("c_part", F.pmod(F.xxhash64("q_ids"), F.lit(parts)).cast("int")).join(home, "c_part", "left")
    return met.mapInArrow(run, "q_ids binary, q_lengths binary, q_values binary, q_floors binary")


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 5, block: int = BLOCK, query_block: int = QUERIES
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best of all candidates but itself.

    Both inputs have ``vec_id, v`` (see :func:`quantised`). Candidate blocks are sorted into lists and
    written once; query blocks, which are smaller, are sent to them. Every query block meets every
    candidate block once, with the bounds of its seeds; only their k best per query go on. Vectors of
    unequal length are padded with zeros. Rows that repeat an id are candidates each; a repeated query
    row asks once, and an id with several vectors asks for the best of all of them. Empty inputs give
    no rows. A score must fit in 64 bits.

    The driver gets counts only. The copies of the query blocks, one for each candidate block, go
    through a shuffle to where the block is: no join, which Spark could turn into a broadcast of them all.
    """
    queries = queries.dropDuplicates(["vec_id", "v"])
    n, m = candidates.count(), queries.count()
    # A little more room than rows, so that hardly a part needs a second block.
    asked_parts = max(1, -(-(n + n // 32) // block))
    lists = materialize(_with_lists(_blocks(candidates, block, asked_parts, "c")), "topk-lists")
    last_part, last_at = lists.agg(F.coalesce(F.max("c_part"), F.lit(0)), F.coalesce(F.max("c_at"), F.lit(0))).first()
    parts, blocks = last_part + 1, (last_part + 1) * (last_at + 1)
    asked = _blocks(queries, query_block, max(1, -(-m // query_block)), "q")
    started = materialize(seeds(asked, lists, parts, k), "topk-queries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if not row["asks"]:
                    held = row
                if not row["asks"] or held is None or held["block"] != row["block"]:
                    continue  # a block, or a number that no block has
                x_n, q_n = (np.frombuffer(r["lengths"], np.int32) for r in (held, row))
                own, width = int(x_n.max(initial=0)), int(max(x_n.max(initial=0), q_n.max(initial=0)))
                sorted_ = _wide(held["more"], len(x_n) * own).reshape(len(x_n), own)
                out = block_top(
                    _matrix(held["lengths"], held["values"], width), np.frombuffer(held["ids"], np.int64),
                    _matrix(row["lengths"], row["values"], width), np.frombuffer(row["ids"], np.int64), k,
                    np.pad(sorted_, ((0, 0), (0, width - own))), np.frombuffer(row["more"], np.int64),
                )
                yield pa.RecordBatch.from_arrays(list(map(pa.array, out)), names=["query_id", "vec_id", "score"])

    def rows(df: DataFrame, number, asks: bool, names: str) -> DataFrame:
        binary = (F.col(c).alias(a) for c, a in zip(names.split(), ("ids", "lengths", "values", "more")))
        return df.select(number.alias("block"), F.lit(asks).alias("asks"), *binary)

    # A block and, after it, all query blocks.
    own = rows(lists, F.col("c_at") * parts + F.col("c_part"), False, "c_ids c_lengths c_values c_lists")
    copies = rows(started, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))), True, "q_ids q_lengths q_values q_floors")
    dealt = own.unionAll(copies).repartitionById(min(blocks, TASKS), "block").sortWithinPartitions("block", "asks")
    local = dealt.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        local.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
