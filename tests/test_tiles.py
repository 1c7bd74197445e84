from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tilecast import MASTER
from tilecast.operators import tiles as T

LAYOUT = MASTER.with_tile(3, 2)

cells = st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=6, max_size=6)


def frame(spark, arrays):
    rows = [(i % 2, i // 2, a) for i, a in enumerate(arrays)]
    return spark.createDataFrame(rows, "col bigint, row bigint, v array<int>")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cells, min_size=1, max_size=4))
def test_assemble_inverts_explode(spark, arrays):
    tiles = frame(spark, arrays)
    pixels = T.explode_tiles(tiles, ["v"], 3)
    for unique in (False, True):
        back = T.assemble_tiles(pixels, ["col", "row"], ["v"], LAYOUT, unique)
        assert {(r.col, r.row): list(r.v) for r in back.collect()} == {
            (i % 2, i // 2): a for i, a in enumerate(arrays)
        }
        # Leaving out the empty pixels must not change anything but all-empty tiles.
        sparse = T.assemble_tiles(pixels.where("v is not null"), ["col", "row"], ["v"], LAYOUT, unique)
        assert {(r.col, r.row): list(r.v) for r in sparse.collect()} == {
            (i % 2, i // 2): a for i, a in enumerate(arrays) if any(v is not None for v in a)
        }


def test_explode_order(spark):
    pixels = T.explode_tiles(frame(spark, [[10, 11, 12, 13, 14, 15]]), ["v"], 3)
    got = {(r.column_index, r.row_index): r.v for r in pixels.collect()}
    assert got == {(0, 0): 10, (1, 0): 11, (2, 0): 12, (0, 1): 13, (1, 1): 14, (2, 1): 15}


def test_repeated_pixels_keep_the_largest(spark):
    pixels = T.explode_tiles(frame(spark, [[1, 2, 3, 4, 5, None]]), ["v"], 3)
    other = T.explode_tiles(frame(spark, [[9, 0, None, 4, 7, 6]]), ["v"], 3)
    both = T.assemble_tiles(pixels.union(other), ["col", "row"], ["v"], LAYOUT)
    assert list(both.first().v) == [9, 2, 3, 4, 7, 6]


def test_assemble_reuses_a_partitioning_by_cell(spark):
    pixels = T.explode_tiles(frame(spark, [[1] * 6] * 4).repartition("col", "row"), ["v"], 3)
    plan = T.assemble_tiles(pixels, ["col", "row"], ["v"], LAYOUT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_erode(spark):
    tile = spark.createDataFrame([(list(range(30)),)], "v array<int>")
    got = tile.select(T.erode_tile("v", 6, 5, 2)).first()[0]
    assert list(got) == [14, 15]


def test_retile_keeps_every_pixel(spark):
    arrays = [[i * 10 + k for k in range(6)] for i in range(4)]
    coarse = T.retile(frame(spark, arrays), ["v"], LAYOUT, 2).collect()
    assert len(coarse) == 1
    assert list(coarse[0].v) == [
        0, 1, 2, 10, 11, 12, 3, 4, 5, 13, 14, 15,
        20, 21, 22, 30, 31, 32, 23, 24, 25, 33, 34, 35,
    ]


def test_retile_fills_missing_cells(spark):
    coarse = T.retile(frame(spark, [[1] * 6, [2] * 6, [3] * 6]), ["v"], LAYOUT, 2).first().v
    assert Counter(coarse) == {1: 6, 2: 6, 3: 6, None: 6}


def test_overview_levels():
    assert T.overview_factors(2000) == [2, 4]
    assert T.overview_factors(255) == []
    assert T.overview_factors(512) == [2]


def test_overviews_take_upper_left_pixels(spark):
    pixels = spark.range(64).selectExpr("id % 8 as gx", "id div 8 as gy", "id as v")
    got = T.overviews(pixels, [2, 4]).collect()
    assert Counter(r.factor for r in got) == {2: 16, 4: 4}
    assert all(r.v == r.gy * r.factor * 8 + r.gx * r.factor for r in got)
    plan = T.overviews(pixels, [2, 4])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_publication_shuffles_pixels_once(spark):
    from tilecast.sources.publish import probability_tiles

    scored = spark.range(36).selectExpr(
        "id % 2 as col", "0L as row", "cast(id % 3 as int) as column_index",
        "cast(id div 18 as int) as row_index", "id / 36.0D as p_field",
    )
    plan = probability_tiles(scored, LAYOUT, factor=2, unique=True)._jdf.queryExecution().executedPlan().toString()
    # Packed parts of tiles go to their coarse cell.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "collect_list" not in plan
