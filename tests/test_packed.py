"""Packed tiles, mosaics and pyramids against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast import MASTER
from tilecast.operators import packed as P
from tilecast.operators import tiles as T
from tilecast.sources import packed as stores

LAYOUT = MASTER.with_tile(3, 2)
KEYS = ["season", "col", "row"]


def pixels_of(spark, n=400, seed=1):
    """Pixels of four 5 x 4 tiles in no order, with gaps, NULL keys and NULL, NaN and extreme values."""
    rng = np.random.default_rng(seed)
    rows, seen = [], set()
    for _ in range(n):
        place = (
            [None, "GS", "OS"][rng.integers(3)], int(rng.integers(-1, 1)), int(rng.integers(2)),
            int(rng.integers(5)), int(rng.integers(4)),
        )
        if place in seen:
            continue
        seen.add(place)
        rows.append((
            *place,
            [None, -128, 0, 127][rng.integers(4)],
            [None, -(2**63), 2**63 - 1, 5][rng.integers(4)],
            [None, float("nan"), 0.1, float("-inf")][rng.integers(4)],
        ))
    return spark.createDataFrame(
        rows, "season string, col bigint, row bigint, column_index int, row_index int, "
        "a tinyint, b bigint, c double",
    )


def bag(df, columns):
    return sorted(map(repr, df.select(*columns).collect()))


@pytest.mark.parametrize("at_once", [1, 37, 1 << 18])
def test_pack_and_unpack_is_a_round_trip(spark, monkeypatch, at_once):
    monkeypatch.setattr(P, "ROWS_AT_ONCE", at_once)
    pixels = pixels_of(spark)
    kinds = P.kinds_of(pixels, ["a", "b", "c"])
    tiles = P.pack_tiles(pixels.repartition(5), KEYS, kinds, 5, 4, unique=True)
    assert tiles.count() == pixels.select(*KEYS).distinct().count()
    back = P.unpack(tiles, KEYS, kinds, 5)
    assert back.count() == tiles.count() * 20
    some = "not (a is null and b is null and c is null)"
    assert bag(back.where(some), pixels.columns) == bag(pixels.where(some), pixels.columns)


def test_packed_arrays_equal_the_assembled_tiles(spark):
    pixels = pixels_of(spark)
    twice = pixels.union(pixels.withColumn("b", F.lit(4).cast("bigint")))
    kinds = P.kinds_of(pixels, ["a", "b", "c"])
    layout = MASTER.with_tile(5, 4)
    expected = T.assemble_tiles(twice, KEYS, list(kinds), layout)
    got = P.pack_tiles(twice, KEYS, kinds, 5, 4, arrays=True)
    assert bag(got, expected.columns) == bag(expected, expected.columns)
    assert got.schema[3].dataType.elementType == expected.schema[3].dataType.elementType


def test_empty_frames_and_rows_without_position(spark):
    pixels = pixels_of(spark)
    kinds = P.kinds_of(pixels, ["a"])
    assert P.pack_tiles(pixels.limit(0), KEYS, kinds, 5, 4).count() == 0
    nowhere = pixels.withColumn("row_index", F.lit(None).cast("int"))
    assert P.pack_tiles(nowhere, KEYS, kinds, 5, 4, unique=True).count() == 0


def test_a_pixel_outside_its_tile_is_an_error(spark):
    pixels = pixels_of(spark)
    with pytest.raises(Exception, match="outside its tile"):
        P.pack_tiles(pixels, KEYS, P.kinds_of(pixels, ["a"]), 4, 4, unique=True).collect()
    with pytest.raises(TypeError):
        P.kinds_of(pixels, ["season"])


def test_parts_take_few_bytes_a_pixel():
    """Dense int8 tiles are shuffled at some 1.2 bytes a pixel, scattered ones at some 6."""
    import pyarrow as pa

    def size(positions):
        n = len(positions)
        table = pa.table({"col": np.arange(n) // 40000, "_pos": positions, "v": pa.array(np.ones(n, np.int8))})
        parts = pa.Table.from_batches(P._pack_rows(table, ["col"], ["v"]))
        return sum(len(x) for c in ("_pos", "v", "v_ok") for x in parts[c].to_pylist()) / n

    dense = np.tile(np.arange(40000, dtype=np.int32), 4)
    assert size(dense) < 1.2
    assert size(dense[::10]) < 5.2


def image(spark, width=50, height=40):
    rows = [
        (x, y, None if (x + y) % 7 == 0 else x * 1000 + y, float(x - y))
        for x in range(width) for y in range(height) if (x * y) % 11
    ]
    return spark.createDataFrame(rows, "gx bigint, gy bigint, a int, b float")


def test_windows_of_a_mosaic(spark, tmp_path):
    pixels = image(spark)
    value = {(r.gx, r.gy): (r.a, r.b) for r in pixels.collect()}
    tiled = pixels.withColumns(MASTER.with_tile(8, 6).cell_of())
    kinds = P.kinds_of(tiled, ["a", "b"])
    path = str(tmp_path / "mosaic")
    stores.write_packed(P.pack_tiles(tiled, ["col", "row"], kinds, 8, 6, unique=True), path, block=2)
    asked = {"one": (0, 0, 50, 40), "two": (7, 5, 9, 7), "out": (-9, -9, 3, 70), "none": (900, 0, 901, 1),
             "empty": (5, 5, 5, 9), "pixel": (13, 14, 14, 15)}
    windows = spark.createDataFrame([(k, *v) for k, v in asked.items()], "window_id string, x0 long, y0 long, x1 long, y1 long")
    for block in (None, 2):
        found = P.read_windows(spark.read.parquet(path), windows, [], kinds, 8, 6, block)
        rows = P.unpack(found, ["window_id", "x0", "y0", "window_width"], kinds, "window_width").collect()
        got = {}
        for r in rows:
            got.setdefault(r.window_id, {})[r.x0 + r.column_index, r.y0 + r.row_index] = (r.a, r.b)
        assert set(got) == {"one", "two", "out", "pixel"}
        for name, cells in got.items():
            x0, y0, x1, y1 = asked[name]
            assert cells == {
                (x, y): value.get((x, y), (None, None)) for x in range(x0, x1) for y in range(y0, y1)
            }


def test_a_pyramid_is_read_by_level_and_window(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "BLOCK", 2)
    pixels = image(spark)
    value = {(r.gx, r.gy): (r.a, r.b) for r in pixels.collect()}
    path = str(tmp_path / "pyramid")
    squares, kinds = stores.pack_pyramid(pixels, ["a", "b"], [2, 4], 8)
    stores.write_packed(squares, path, ["factor"], block=2)
    part = stores.pyramid_part(spark, path, 2, 3, 4, 11, 9, 8)
    assert {(r.factor, r.col, r.row) for r in part.collect()} == {(2, c, r) for c in (0, 1) for r in (0, 1)}
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "factor" in filters and "block_col" in filters and "PushedFilters" in plan

    asked = [("w", f, 1, 2, 12, 9) for f in (1, 2, 4)]
    windows = spark.createDataFrame(asked, "window_id string, factor int, x0 long, y0 long, x1 long, y1 long")
    found = stores.pyramid_windows(spark, path, windows, kinds, 8)
    got = {
        (r.factor, r.x0 + r.column_index, r.y0 + r.row_index): (r.a, r.b, r.mask)
        for r in P.unpack(found, ["factor", "x0", "y0", "window_width"], kinds, "window_width").collect()
    }
    expected = {}
    for f in (1, 2, 4):
        for x in range(1, 12):
            for y in range(2, 9):
                a, b = value.get((x * f, y * f), (None, None))
                mask = None if (x * f, y * f) not in value else 255 if a is not None else 0
                expected[f, x, y] = (a, b, mask)
    assert got == expected


def test_all_levels_are_packed_in_one_shuffle(spark):
    squares, _ = stores.pack_pyramid(image(spark), ["a", "b"], [2, 4], 8)
    plan = squares._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "collect_list" not in plan


@pytest.mark.parametrize("at_once", [1, 50, 1 << 18])
def test_windows_do_not_depend_on_batches(spark, monkeypatch, at_once):
    """Parts of a tile or window may lie in several batches, and several tiles in one step."""
    pixels = image(spark)
    value = {(r.gx, r.gy): (r.a, r.b) for r in pixels.collect()}
    kinds = P.kinds_of(pixels, ["a", "b"])
    monkeypatch.setattr(P, "PIXELS_AT_ONCE", at_once)
    tiled = pixels.withColumns(MASTER.with_tile(3, 5).cell_of()).repartition(7)
    windows = spark.range(40).selectExpr(
        "if(id = 5, null, concat('w', id)) as window_id", "id - 4 as x0", "id * 2 % 37 as y0",
        "id - 3 + id % 9 as x1", "id * 2 % 37 + 1 + id % 11 as y1",
    )
    asked = {r.window_id: r for r in windows.collect()}
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, 3)
    try:
        found = P.read_windows(P.pack_tiles(tiled, ["col", "row"], kinds, 3, 5, unique=True), windows, [], kinds, 3, 5)
        rows = P.unpack(found, ["window_id", "x0", "y0", "window_width"], kinds, "window_width").collect()
    finally:
        spark.conf.set(batch, before)
    got = {}
    for r in rows:
        place = r.x0 + r.column_index, r.y0 + r.row_index
        assert place not in got.setdefault(r.window_id, {})
        got[r.window_id][place] = (r.a, r.b)
    covered = {(x // 3, y // 5) for x, y in value}
    for name, w in asked.items():
        inside = [(x, y) for x in range(w.x0, w.x1) for y in range(w.y0, w.y1)]
        touched = any((x // 3, y // 5) in covered for x, y in inside)
        assert got.get(name) == ({place: value.get(place, (None, None)) for place in inside} if touched else None)


def test_small_tiles_cost_no_call_each(spark):
    """No group of Spark's for each tile or window, and many of them in a batch."""
    pixels = image(spark).withColumns(MASTER.with_tile(2, 2).cell_of())
    kinds = P.kinds_of(pixels, ["a", "b"])
    tiles = P.pack_tiles(pixels, ["col", "row"], kinds, 2, 2, unique=True)
    windows = spark.range(30).selectExpr("id as window_id", "id as x0", "id as y0", "id + 5 as x1", "id + 5 as y1")
    found = P.read_windows(tiles, windows, [], kinds, 2, 2)
    flat = P.unpack(found, ["window_id", "x0", "y0", "window_width"], kinds, "window_width")
    assert "FlatMapGroupsInArrow" not in flat._jdf.queryExecution().executedPlan().toString()

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows], pa.int64())})

    one_task = P.unpack(tiles.coalesce(1), ["col", "row"], kinds, 2).mapInArrow(sizes, "n long").collect()
    assert max(r.n for r in one_task) > 4
