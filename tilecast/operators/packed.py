"""Tiles as packed numbers: pixels are written to their byte offsets, no rows are gathered.

A packed tile has two binary columns a value: ``v`` holds one little-endian number for every
pixel, row-major, and ``v_ok`` one bit for every pixel, set where the value is not NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilecast.runtime import broadcast_if_small

#: Types that can be packed.
KINDS = {
    "tinyint": "<i1", "smallint": "<i2", "int": "<i4", "bigint": "<i8", "float": "<f4", "double": "<f8",
}

#: Pixels that a task holds before it sends the parts of tiles that they make.
ROWS_AT_ONCE = 1 << 18

#: Pixels that a task cuts, lays or unpacks in one step, over as many tiles as that takes (one at least).
PIXELS_AT_ONCE = 1 << 18


def kinds_of(df: DataFrame, values: Sequence[str]) -> dict[str, str]:
    """The Spark type of each value, as :func:`unpack` and :func:`read_windows` need it."""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    unfit = [v for v in values if found[v] not in KINDS]
    if unfit:
        raise TypeError(f"only numbers can be packed, not {unfit}")
    return {v: found[v] for v in values}


def _binary(values: Iterable[str]) -> list[T.StructField]:
    return [T.StructField(name, T.BinaryType()) for v in values for name in (v, f"{v}_ok")]


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[name] for name in names]


def _bits(ok: np.ndarray) -> bytes:
    return np.packbits(ok, bitorder="little").tobytes()


def _spans(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ``counts`` elements laid end to end: the row of each element, and its place in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def _portions(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut consecutive rows where their sizes add up to ``PIXELS_AT_ONCE``; each portion has a row."""
    ends, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + PIXELS_AT_ONCE, side="right")))
        yield lo, hi
        lo = hi


def _flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows of a binary column, and where each row starts (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    starts = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[starts[0] : starts[-1]], starts.astype(np.int64) - starts[0]


def _binary_of(numbers: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows hold the next ``counts`` numbers each."""
    starts = np.concatenate([[0], np.cumsum(counts * numbers.itemsize)]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(numbers))]
    )


def _bits_of(ok: np.ndarray, counts: np.ndarray, row: np.ndarray, place: np.ndarray) -> pa.Array:
    """A binary column whose rows hold the next ``counts`` bits each, every row from a byte of its own."""
    width = (counts + 7) // 8
    spread = np.zeros(8 * int(width.sum()), bool)
    spread[8 * (np.cumsum(width) - width)[row] + place] = ok
    return _binary_of(np.packbits(spread, bitorder="little"), width)


def _numbers(column: pa.Array, kind: str, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The numbers at ``place`` of the given rows."""
    data, starts = _flat(column)
    numbers = data.view(KINDS[kind])
    return numbers[starts[row] // numbers.itemsize + place]


def _present(column: pa.Array, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The bits at ``place`` of the given rows."""
    data, starts = _flat(column)
    return (data[starts[row] + place // 8] >> (place % 8).astype(np.uint8) & 1).astype(bool)


def _counts(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """How many numbers each row holds."""
    return np.diff(_flat(column)[1]) // np.dtype(KINDS[kind]).itemsize


def pack_tiles(
    pixels: DataFrame, keys: Sequence[str], kinds: dict[str, str], width: int, height: int,
    x: str = "column_index", y: str = "row_index", unique: bool = False, arrays: bool = False,
) -> DataFrame:
    """One row per ``keys`` with the values of its ``width`` x ``height`` pixels, packed.

    Tasks first pack what they hold of each tile; the parts are shuffled, a few bytes a pixel
    (a run of neighbours needs one position), and laid into the tile. Absent pixels are NULL,
    rows without a position are left out, and a position outside the tile is an error. Repeated
    pixels are reduced to their largest value before, in a shuffle of their own; a caller who
    knows that none repeats says ``unique``. ``arrays`` returns plain arrays instead of bytes.
    An empty frame gives no tiles. Each task lays many tiles in one step, so small ones cost no
    call each.
    """
    keys, values = list(keys), list(kinds)
    inside = F.col(x).between(0, width - 1) & F.col(y).between(0, height - 1)
    position = F.when(inside, F.col(y) * width + F.col(x)).when(
        F.col(x).isNotNull() & F.col(y).isNotNull(),
        F.raise_error(F.lit(f"a pixel lies outside its tile of {width} x {height}")).cast("int"),
    )
    single = pixels.select(*keys, position.cast("int").alias("_pos"), *values).where("_pos is not null")
    if not unique:
        single = single.groupBy(*keys, "_pos").agg(*[F.max(v).alias(v) for v in values])
    part = T.StructType([*_fields(single, keys), T.StructField("_pos", T.BinaryType()), *_binary(values)])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS_AT_ONCE:
                yield from _pack_rows(pa.Table.from_batches(held), keys, values)
                held, rows = [], 0
        if rows:
            yield from _pack_rows(pa.Table.from_batches(held), keys, values)

    if arrays:
        out = [T.StructField(v, T.ArrayType(single.schema[v].dataType)) for v in values]
    else:
        out = _binary(values)
    return _in_runs(single.mapInArrow(parts, part), keys).mapInArrow(
        lambda batches: _merge_runs(batches, keys, kinds, width * height, arrays),
        T.StructType([*_fields(single, keys), *out]),
    )


def _in_runs(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of a key in one partition, one after the other."""
    return parts.repartition(*keys).sortWithinPartitions(*keys)


def _pack_rows(table: pa.Table, keys: list[str], values: list[str]) -> Iterator[pa.RecordBatch]:
    """One part per tile among the rows, with its pixels in the order of their positions."""
    code = np.zeros(table.num_rows, np.int64)
    for key in keys:
        column = table[key].combine_chunks().dictionary_encode(null_encoding="encode")
        code = code * len(column.dictionary) + column.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    position = table["_pos"].to_numpy().astype("<i4")
    order = np.lexsort((position, code))
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    cuts = list(zip(starts, [*starts[1:], len(order)]))
    position = position[order]

    def compact(lo: int, hi: int) -> bytes:
        run = position[lo:hi]
        return run[: 1 if (np.diff(run) == 1).all() else None].tobytes()

    out = table.select(keys).take(pa.array(order[starts]))
    out = out.append_column("_pos", pa.array([compact(lo, hi) for lo, hi in cuts], pa.binary()))
    for v in values:
        ok = table[v].is_valid().to_numpy()[order]
        data = table[v].fill_null(0).to_numpy()[order]
        out = out.append_column(v, pa.array([data[lo:hi].tobytes() for lo, hi in cuts], pa.binary()))
        out = out.append_column(f"{v}_ok", pa.array([_bits(ok[lo:hi]) for lo, hi in cuts], pa.binary()))
    yield from out.to_batches()


def _run_starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """The rows whose key differs from that of the row before."""
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        codes = table[key].combine_chunks().dictionary_encode(null_encoding="encode").indices
        new[1:] |= np.diff(codes.to_numpy(zero_copy_only=False)) != 0
    return np.flatnonzero(new)


def _merge_runs(
    batches: Iterator[pa.RecordBatch], keys: list[str], kinds: dict[str, str], size: int | str, arrays: bool
) -> Iterator[pa.RecordBatch]:
    """Lay the parts of each tile into it; parts of a tile follow each other, also from batch to batch.

    ``size`` is the number of pixels of every tile, or the name of a column that holds it.
    """
    held: list[pa.RecordBatch] = []

    def laid(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        if isinstance(size, str):
            sizes = table[size].to_numpy()[starts].astype(np.int64)
        else:
            sizes = np.full(len(starts), size, np.int64)
        bounds = [*starts, table.num_rows]
        for lo, hi in _portions(sizes):
            part = table.slice(bounds[lo], bounds[hi] - bounds[lo]).combine_chunks()
            yield _merge(part, starts[lo:hi] - bounds[lo], sizes[lo:hi], keys, kinds, arrays)

    for batch in batches:
        if not batch.num_rows:
            continue
        # A tile whose parts fill many batches is looked at once, when the next tile begins.
        if held and not _run_ends(held[-1], batch, keys):
            held.append(batch)
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = _run_starts(table, keys)
        last = int(starts[-1])
        if last:
            yield from laid(table.slice(0, last), starts[:-1])
        held = table.slice(last).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield from laid(table, _run_starts(table, keys))


def _run_ends(before: pa.RecordBatch, batch: pa.RecordBatch, keys: Sequence[str]) -> bool:
    """Whether another key than that of the rows before is among those of a batch."""
    rows = [before.select(keys).slice(before.num_rows - 1), batch.select(keys).slice(batch.num_rows - 1)]
    return len(_run_starts(pa.Table.from_batches(rows), keys)) > 1


def _merge(
    table: pa.Table, starts: np.ndarray, sizes: np.ndarray, keys: list[str], kinds: dict[str, str], arrays: bool
) -> pa.RecordBatch:
    """Lay the parts of several tiles, whose first parts are at ``starts``, into them."""
    first_kind = next(iter(kinds))
    counts = _counts(table[first_kind], kinds[first_kind])
    row, place = _spans(counts)
    tile = np.repeat(np.arange(len(starts)), np.diff([*starts, table.num_rows]))
    base = np.cumsum(sizes) - sizes
    data, at = _flat(table["_pos"])
    positions, at = data.view("<i4").astype(np.int64), at // 4
    listed = (np.diff(at) == counts)[row]  # else the part is a run of neighbours, known by its first
    inside = positions[at[row] + np.where(listed, place, 0)] + np.where(listed, 0, place)
    target = base[tile][row] + inside
    in_tile = _spans(sizes)
    columns = [table[key].combine_chunks().take(pa.array(starts)) for key in keys]
    names = list(keys)
    for v, kind in kinds.items():
        numbers, present = np.zeros(int(sizes.sum()), KINDS[kind]), np.zeros(int(sizes.sum()), bool)
        numbers[target] = _flat(table[v])[0].view(KINDS[kind])
        present[target] = _present(table[f"{v}_ok"], row, place)
        names.append(v)
        if arrays:
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers, mask=~present)))
        else:
            columns += [_binary_of(numbers, sizes), _bits_of(present, sizes, *in_tile)]
            names.append(f"{v}_ok")
    return pa.RecordBatch.from_arrays(columns, names=names)


def unpack(
    packed: DataFrame, keys: Sequence[str], kinds: dict[str, str], width: int | str,
    x: str = "column_index", y: str = "row_index",
) -> DataFrame:
    """One row per pixel of packed tiles, also of absent ones, whose values are all NULL.

    ``width`` is a number of pixels, or the name of a column that holds it for each tile.
    """
    keys = list(keys)
    extra = [width] if isinstance(width, str) and width not in keys else []
    names = [*keys, *extra, *[f.name for f in _binary(kinds)]]
    out = T.StructType([
        *_fields(packed, keys), T.StructField(x, T.IntegerType()), T.StructField(y, T.IntegerType()),
        *[T.StructField(v, T._parse_datatype_string(kind)) for v, kind in kinds.items()],
    ])

    first = next(iter(kinds))

    def pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _portions(_counts(batch[first], kinds[first])):
                part = batch.slice(lo, hi - lo)
                row, place = _spans(_counts(part[first], kinds[first]))
                across = part[width].to_numpy()[row] if isinstance(width, str) else width
                columns = [part[key].take(pa.array(row)) for key in keys]
                columns += [pa.array((place % across).astype(np.int32)), pa.array((place // across).astype(np.int32))]
                columns += [
                    pa.array(_flat(part[v])[0].view(KINDS[kind]), mask=~_present(part[f"{v}_ok"], row, place))
                    for v, kind in kinds.items()
                ]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return packed.select(*names).mapInArrow(pixels, out)


def read_windows(
    packed: DataFrame, windows: DataFrame, on: Sequence[str], kinds: dict[str, str],
    width: int, height: int, block: int | None = None,
) -> DataFrame:
    """Any rectangles of a mosaic of packed tiles, put together from the tiles that they touch.

    ``windows`` has a ``window_id`` that is unique together with ``on``, columns that tiles and
    windows must agree in, and global pixels ``x0, y0`` (first) and ``x1, y1`` (one past the
    last). A window's tiles are cropped where they lie and only the crops are shuffled. The
    result has ``window_id``, ``on``, ``x0``, ``y0``, ``window_width`` and the packed window; what
    no tile covers is NULL, and a window without any tile, or an empty one, gives no row.
    With ``block`` (see ``sources.packed``) the join also prunes folders.
    """
    on, values = list(on), list(kinds)
    tile_keys = [*on, "col", "row"] + (["block_col", "block_row"] if block else [])
    head = ["window_id", *on, "x0", "y0"]
    x1, y1 = F.col("x1"), F.col("y1")
    cells = (
        windows.where("x1 > x0 and y1 > y0")
        .select(*head, "x1", "y1", F.explode(F.sequence(
            F.floor(F.col("x0") / F.lit(width)), F.floor((x1 - 1) / F.lit(width)))).alias("col"))
        .select("*", F.explode(F.sequence(
            F.floor(F.col("y0") / F.lit(height)), F.floor((y1 - 1) / F.lit(height)))).alias("row"))
    )
    if block:
        cells = cells.withColumns({
            f"block_{c}": F.floor(F.col(c) / F.lit(block)).cast("int") for c in ("col", "row")
        })
    data = [f.name for f in _binary(values)]
    joined = packed.select(*tile_keys, *data).join(broadcast_if_small(cells), tile_keys)
    width_of, size_of = (x1 - F.col("x0")).cast("int"), ((x1 - F.col("x0")) * (y1 - F.col("y0"))).cast("int")
    joined = joined.select(
        *head, width_of.alias("window_width"), size_of.alias("_size"), "x1", "y1", "col", "row", *data
    )
    head.append("window_width")
    crop = T.StructType([
        *_fields(joined, [*head, "_size"]), T.StructField("_pos", T.BinaryType()), *_binary(values)
    ])

    def crops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {c: batch[c].to_numpy().astype(np.int64) for c in ("x0", "y0", "x1", "y1", "col", "row")}
            left, top = at["col"] * width, at["row"] * height
            gx, gy = np.maximum(left, at["x0"]), np.maximum(top, at["y0"])
            wide = np.minimum(left + width, at["x1"]) - gx
            sizes = wide * (np.minimum(top + height, at["y1"]) - gy)
            inner, outer = (gy - top) * width + gx - left, (gy - at["y0"]) * (at["x1"] - at["x0"]) + gx - at["x0"]
            for lo, hi in _portions(sizes):
                part, counts = batch.slice(lo, hi - lo), sizes[lo:hi]
                row, place = _spans(counts)
                y, x = np.divmod(place, wide[lo:hi][row])
                inside = inner[lo:hi][row] + y * width + x
                position = outer[lo:hi][row] + y * (at["x1"] - at["x0"])[lo:hi][row] + x
                columns = [part[c] for c in [*head, "_size"]] + [_binary_of(position.astype("<i4"), counts)]
                for v, kind in kinds.items():
                    columns.append(_binary_of(_numbers(part[v], kind, row, inside), counts))
                    columns.append(_bits_of(_present(part[f"{v}_ok"], row, inside), counts, row, place))
                yield pa.RecordBatch.from_arrays(columns, names=crop.names)

    return _in_runs(joined.mapInArrow(crops, crop), head).mapInArrow(
        lambda batches: _merge_runs(batches, head, kinds, "_size", False),
        T.StructType([*_fields(joined, head), *_binary(values)]),
    )
