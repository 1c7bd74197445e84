"""What the operators of this package share: words, byte batches, shared tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at once inside a task; bounds the working arrays, not what is processed.
CHUNK_BYTES = 4_000_000


def word_count(text: str | Column) -> Column:
    """Words of a text as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def slices(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of at most ``rows`` rows and about ``limit`` bytes of text (at least a row each)."""
    sizes = [n or 0 for n in pa.compute.binary_length(batch.column(text)).to_pylist()]
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > limit or i - start == rows):
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_text(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    schema: str,
    make: Callable[[], Callable[[list[bytes], pa.RecordBatch], list]],
    limit: int = CHUNK_BYTES,
    rows: int | None = None,
) -> DataFrame:
    """Compute columns from a text column, in place and without a shuffle.

    ``make`` is called once per task; what it returns gets a list of UTF-8 texts (null: empty)
    and the batch with the kept columns, and returns the new columns in the order of ``schema``.
    """
    kept = df.select(*keep)
    fields = [f.split()[0] for f in schema.split(",")]
    full = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for batch in batches:
            for part in slices(batch, "_text", limit, rows):
                compute = compute or make()
                texts = [t or b"" for t in part.column("_text").cast(pa.binary()).to_pylist()]
                columns = compute(texts, part)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *map(pa.array, columns)],
                    names=[*keep, *fields],
                )

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, full)


def joined_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in one array, and the text that each byte belongs to."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))


def stretches_of(texts: list[bytes], limit: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, the text of each, and how many of them begin an n-gram that counts here.

    All texts at once; only a single text of more than ``limit`` bytes comes in several stretches,
    each with ``overlap`` bytes of the next one, so that every n-gram begins in exactly one.
    """
    if len(texts) == 1 and len(texts[0]) > limit:
        for a in range(0, len(texts[0]), limit):
            yield *joined_bytes([texts[0][a : a + limit + overlap]]), limit
    else:
        data, of = joined_bytes(texts)
        yield data, of, len(data)


def ngram_buckets(data: np.ndarray, sizes: Sequence[int], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(n, bucket of the n bytes from each position on)``, by rolling 32-bit hashes.

    Runs that reach into the next text are the caller's to leave out.
    """
    h = np.zeros(len(data), np.uint32)
    for n in range(1, max(sizes) + 1):
        if len(data) < n:
            return
        h = h[: len(data) - n + 1] * np.uint32(0x01000193) + data[n - 1 :] + np.uint32(1)
        if n in sizes:
            yield n, ((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values, sorted; for numbers much faster than hashing them."""
    ordered = np.sort(values)
    return ordered[np.concatenate((np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]))]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    h = h ^ (h >> np.uint64(30))  # a new array, which the next steps change in place
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of complete groups from batches sorted by an integer key that has no nulls."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        keys = table[key].to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def blobs(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Binary values: consecutive parts of an array, each from one start to the next."""
    ends = np.append(starts[1:], len(values))
    offsets = np.append(starts, ends[-1] if len(ends) else 0).astype(np.int64) * values.itemsize
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), data])


def unblob(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of binary rows, one after another, and how many each row has."""
    parts = [np.frombuffer(x, kind) for x in column.to_pylist()]
    return np.concatenate([*parts, np.empty(0, kind)]), np.array([len(x) for x in parts], np.int64)
