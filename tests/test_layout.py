import pytest

from tilecast import MASTER, Layout, SourceGrid

SMALL = Layout(0.0, 0.0, 8.0, 6.0, cols=4, rows=3, tile_cols=5, tile_rows=2)


def test_master_pixels():
    assert MASTER.pixel_width == pytest.approx(0.000025)
    assert MASTER.pixel_height == pytest.approx(0.000025)


def test_extents_cover_the_area_without_gaps(spark):
    cells = spark.range(12).selectExpr("id % 4 as col", "id div 4 as row")
    rows = cells.select("col", "row", *[v.alias(k) for k, v in SMALL.extent().items()]).collect()
    boxes = {(r.col, r.row): r for r in rows}
    assert boxes[0, 0].xmin == 0.0 and boxes[0, 0].ymax == 6.0
    assert boxes[3, 2].xmax == 8.0 and boxes[3, 2].ymin == 0.0
    for (col, row), box in boxes.items():
        if (col + 1, row) in boxes:
            assert box.xmax == pytest.approx(boxes[col + 1, row].xmin)
        if (col, row + 1) in boxes:
            assert box.ymin == pytest.approx(boxes[col, row + 1].ymax)


def test_buffer_grows_by_pixels(spark):
    cell = spark.sql("select 1L as col, 1L as row")
    plain = cell.select(*[v.alias(k) for k, v in SMALL.extent().items()]).first()
    grown = cell.select(*[v.alias(k) for k, v in SMALL.extent(2).items()]).first()
    assert plain.xmin - grown.xmin == pytest.approx(2 * SMALL.pixel_width)
    assert grown.ymax - plain.ymax == pytest.approx(2 * SMALL.pixel_height)


def test_pixel_position_round_trip(spark):
    pixels = spark.range(120).selectExpr("id % 20 as gx", "id div 20 as gy")
    back = pixels.withColumns(SMALL.cell_of()).drop("gx", "gy").withColumns(SMALL.global_pixel())
    assert back.select("gx", "gy").exceptAll(pixels).isEmpty()
    assert back.where(~SMALL.contains()).isEmpty()


def test_negative_pixels_fall_left_of_the_grid(spark):
    got = spark.sql("select -1L as gx, -1L as gy").withColumns(SMALL.cell_of()).first()
    assert (got.col, got.row, got.column_index, got.row_index) == (-1, -1, 4, 1)


def test_coarsen():
    coarse = MASTER.coarsen(10)
    assert (coarse.cols, coarse.rows, coarse.tile_cols, coarse.tile_rows) == (1380, 1460, 2000, 2000)
    assert coarse.pixel_width == pytest.approx(MASTER.pixel_width)
    with pytest.raises(ValueError):
        MASTER.coarsen(7)


def test_source_grid_from_transform():
    same = SourceGrid.from_transform(
        SMALL, SMALL.xmin, SMALL.ymax, SMALL.pixel_width, SMALL.pixel_height
    )
    assert same.aligned
    half = SourceGrid.from_transform(
        SMALL, SMALL.xmin, SMALL.ymax, SMALL.pixel_width / 2, SMALL.pixel_height / 2
    )
    assert (half.scale_x, half.offset_x) == pytest.approx((2.0, 0.5))
