import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast import MASTER, SourceGrid
from tilecast.functions import kernels
from tilecast.functions.columns import feature_names
from tilecast.operators import focal
from tilecast.operators.resample import resample, resample_scenes
from tilecast.operators.windows import Layer, scene_grids
from tilecast.sources import imagery

T = 6
LAYOUT = MASTER.with_tile(T, T)
COLS, ROWS = 4, 3
BANDS = (1, 2)


def scene(seed):
    rng = np.random.default_rng(seed)
    image = rng.integers(0, 1000, (2, ROWS * T, COLS * T)).astype(float)
    image[:, rng.random((ROWS * T, COLS * T)) < 0.1] = np.nan
    return image


IMAGES = {("GS", "left"): scene(1), ("GS", "right"): scene(2), ("OS", "all"): scene(3)}


def columns_of(name):
    """Cells that a scene covers: the two GS scenes share the middle columns."""
    return {"left": range(0, 3), "right": range(1, 4), "all": range(0, 4)}[name]


@pytest.fixture(scope="module")
def tiles(spark):
    rows = []
    for (season, name), image in IMAGES.items():
        for col in columns_of(name):
            for row in range(ROWS):
                part = image[:, row * T : (row + 1) * T, col * T : (col + 1) * T]
                bands = [[None if np.isnan(v) else float(v) for v in b.ravel()] for b in part]
                rows.append((season, name, col, row, *bands))
    schema = "season string, scene_id string, col bigint, row bigint, b1 array<double>, b2 array<double>"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def targets(spark):
    rows = [
        (col, row, name, "all") for name in ("left", "right") for col in columns_of(name) for row in range(ROWS)
    ]
    return spark.createDataFrame(rows, "col bigint, row bigint, GS string, OS string").cache()


def canvas(season, name, col, row, buffer):
    """What a window must hold: pixels of the scene's own cells, NaN elsewhere."""
    image = IMAGES[season, name].copy()
    covered = np.zeros(image.shape[1:], bool)
    for c in columns_of(name):
        covered[:, c * T : (c + 1) * T] = True
    image[:, ~covered] = np.nan
    padded = np.pad(image, ((0, 0), (buffer, buffer), (buffer, buffer)), constant_values=np.nan)
    return padded[:, row * T : (row + 1) * T + 2 * buffer, col * T : (col + 1) * T + 2 * buffer]


def brute(a, size, how):
    """Statistic over each full window, one pixel at a time."""
    h, w = a.shape[0] - size + 1, a.shape[1] - size + 1
    out = np.full((h, w), np.nan)
    for y in range(h):
        for x in range(w):
            box = a[y : y + size, x : x + size]
            box = box[~np.isnan(box)]
            if box.size:
                out[y, x] = how(box)
    return out


def as_array(values):
    return np.array([np.nan if v is None else v for v in values], float).reshape(T, T)


@pytest.mark.parametrize("size", [3, 5, 11])
def test_kernels_against_brute_force(size):
    a = scene(7)[:, :15, :16]
    for band in range(2):
        np.testing.assert_allclose(kernels.focal_mean(a, size)[band], brute(a[band], size, np.mean))
        np.testing.assert_allclose(
            kernels.focal_stddev(a, size)[band], brute(a[band], size, np.std), atol=1e-9
        )


def test_all_nodata_window_is_nodata():
    a = np.full((1, 5, 5), np.nan)
    assert np.isnan(kernels.focal_mean(a, 3)).all() and np.isnan(kernels.focal_stddev(a, 3)).all()


def test_windows_eroded_separately_or_together_agree():
    a = scene(4)
    np.testing.assert_array_equal(
        kernels.erode(kernels.focal_mean(a, 5), 3), kernels.focal_mean(kernels.erode(a, 3), 5)
    )


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_features_of_overlapping_scenes(tiles, targets, max_broadcast):
    got = focal.features(tiles, targets, LAYOUT, bands=BANDS, max_broadcast=max_broadcast).collect()
    assert len(got) == 18
    for r in got:
        for season, name in (("GS", r.GS), ("OS", r.OS)):
            a = canvas(season, name, r.col, r.row, 5)
            for b in BANDS:
                raw, avg, std = (as_array(r[f"{season}_{k}_{b}"]) for k in ("raw", "avg", "std"))
                np.testing.assert_array_equal(raw, a[b - 1, 5:-5, 5:-5])
                np.testing.assert_allclose(avg, brute(a[b - 1], 11, np.mean))
                np.testing.assert_allclose(std, brute(a[b - 1, 3:-3, 3:-3], 5, np.std), atol=1e-9)


def test_feature_names():
    names = feature_names()
    assert len(names) == 24
    assert names[:4] == ["GS_raw_1", "GS_avg_1", "GS_std_1", "GS_raw_2"] and names[-1] == "OS_std_4"


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_imagery_is_shuffled_once(spark, tiles, targets, max_broadcast):
    """Few targets: one exchange. Many: imagery and keys are each sent to the cells once."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = focal.features(tiles, targets, LAYOUT, bands=BANDS, max_broadcast=max_broadcast)
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == (1 if max_broadcast else 2)
    assert plan.count("Sort [") == 1, plan


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_layers_join_the_group(spark, tiles, targets, max_broadcast):
    heights = spark.createDataFrame([(0, 0, [None] + [7] * 35)], "col bigint, row bigint, height array<smallint>")
    named = targets.where("row = 0").withColumn("tag", F.concat("GS", F.lit("!")))
    got = focal.features(
        tiles, named, LAYOUT, bands=BANDS, layers={"height": heights}, carry=["tag"], max_broadcast=max_broadcast
    )
    for r in got.collect():
        assert r.tag == r.GS + "!"
        assert r.height == ([None] + [7.0] * 35 if r.col == 0 else None)


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
@pytest.mark.parametrize("method", ["bilinear", "nearest"])
@pytest.mark.parametrize(
    "grid",
    [
        SourceGrid(offset_x=0.25, offset_y=-0.5),
        SourceGrid(scale_x=0.5, offset_x=3.25, scale_y=0.75, offset_y=1.0),
        SourceGrid(scale_x=1.5, offset_x=-2.0, scale_y=1.25, offset_y=0.5),
    ],
)
def test_resampling_against_brute_force(tiles, targets, grid, method, max_broadcast):
    image = IMAGES["OS", "all"]
    height, width = image.shape[1:]
    got = resample(tiles, targets, LAYOUT, grid, method, ["OS"], BANDS, max_broadcast=max_broadcast)
    rows = got.collect()
    assert rows
    for r in rows:
        for b in BANDS:
            values = as_array(r[f"OS_raw_{b}"])
            for j in range(T):
                for i in range(T):
                    fx = (r.col * T + i) * grid.scale_x + grid.offset_x
                    fy = (r.row * T + j) * grid.scale_y + grid.offset_y
                    if method == "nearest":
                        points = [(int(np.floor(fx + 0.5)), int(np.floor(fy + 0.5)), 1.0)]
                    else:
                        x0, y0 = int(np.floor(fx)), int(np.floor(fy))
                        points = [
                            (x, y, (1 - abs(fx - x)) * (1 - abs(fy - y)))
                            for x in (x0, x0 + 1) for y in (y0, y0 + 1)
                        ]
                    total = weight = 0.0
                    for x, y, w in points:
                        if 0 <= x < width and 0 <= y < height and w > 0 and not np.isnan(image[b - 1, y, x]):
                            total += w * image[b - 1, y, x]
                            weight += w
                    want = total / weight if weight else np.nan
                    np.testing.assert_allclose(values[j, i], want, err_msg=str((r.col, r.row, i, j)))


def points_of(fx, fy, method):
    """Source pixels of a position, and their weights."""
    if method == "nearest":
        return [(int(np.floor(fx + 0.5)), int(np.floor(fy + 0.5)), 1.0)]
    x0, y0 = int(np.floor(fx)), int(np.floor(fy))
    return [(x, y, (1 - abs(fx - x)) * (1 - abs(fy - y))) for x in (x0, x0 + 1) for y in (y0, y0 + 1)]


def slow_resample(image, col, row, grid, method):
    """A target cell of an image that lies on ``grid``; NaN where no pixel with data is near."""
    out = np.full((T, T), np.nan)
    for j in range(T):
        for i in range(T):
            fx = (col * T + i) * grid.scale_x + grid.offset_x
            fy = (row * T + j) * grid.scale_y + grid.offset_y
            total = weight = 0.0
            for x, y, w in points_of(fx, fy, method):
                if 0 <= x < image.shape[1] and 0 <= y < image.shape[0] and w > 0 and not np.isnan(image[y, x]):
                    total += w * image[y, x]
                    weight += w
            out[j, i] = total / weight if weight else np.nan
    return out


def covered(season, name, band):
    image = IMAGES[season, name][band].copy()
    gone = [c for c in range(COLS) if c not in columns_of(name)]
    for c in gone:
        image[:, c * T : (c + 1) * T] = np.nan
    return image


OWN = {
    "left": SourceGrid(offset_x=0.25, offset_y=-0.5),
    "right": SourceGrid(scale_x=0.5, offset_x=7.25, scale_y=0.75, offset_y=1.125),
    "all": SourceGrid(scale_x=1.5, offset_x=-2.125, scale_y=1.25, offset_y=0.375),
}


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_scenes_of_different_grids_in_one_call(spark, tiles, targets, method, max_broadcast):
    rows = [(name, g.scale_x, g.offset_x, g.scale_y, g.offset_y) for name, g in OWN.items() if name != "left" or method == "nearest"]
    grids = spark.createDataFrame(rows, "scene_id string, scale_x double, offset_x double, scale_y double, offset_y double")
    got = resample_scenes(tiles, targets, LAYOUT, grids, method, ["GS", "OS"], BANDS, max_broadcast=max_broadcast).collect()
    listed = {r[0] for r in rows}
    assert len(got) == targets.count() and {r.GS for r in got} == {"left", "right"}
    for r in got:
        for season, name in (("GS", r.GS), ("OS", r.OS)):
            grid = OWN[name] if name in listed else SourceGrid()  # a scene without a row is aligned
            for b in BANDS:
                want = slow_resample(covered(season, name, b - 1), r.col, r.row, grid, method)
                np.testing.assert_allclose(as_array(r[f"{season}_raw_{b}"]), want, err_msg=str((r.col, r.row, name)))


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_features_of_scenes_of_different_grids(spark, tiles, targets, max_broadcast):
    """The halo too is read through each scene's grid: like features of one grid, scene by scene."""
    rows = [(name, g.scale_x, g.offset_x, g.scale_y, g.offset_y) for name, g in OWN.items()]
    grids = spark.createDataFrame(rows, "scene_id string, scale_x double, offset_x double, scale_y double, offset_y double")
    mixed = focal.features(tiles, targets, LAYOUT, ["GS"], BANDS, grids=grids, max_broadcast=max_broadcast).collect()
    for name in ("left", "right"):
        alone = focal.features(tiles, targets.where(F.col("GS") == name), LAYOUT, ["GS"], BANDS, grid=OWN[name])
        want = {(r.col, r.row): r for r in alone.collect()}
        found = [r for r in mixed if r.GS == name]
        assert len(found) == len(want)
        for r in found:
            for c in feature_names(["GS"], BANDS):
                np.testing.assert_allclose(as_array(r[c]), as_array(want[r.col, r.row][c]))


def test_grids_from_transforms(spark):
    corners = [("a", LAYOUT.xmin, LAYOUT.ymax, LAYOUT.pixel_width, LAYOUT.pixel_height), ("b", LAYOUT.xmin - 0.01, LAYOUT.ymax + 0.02, 0.003, 0.004)]
    table = spark.createDataFrame(corners, "scene_id string, xmin double, ymax double, pixel_width double, pixel_height double")
    for r in scene_grids(table, LAYOUT).collect():
        want = SourceGrid.from_transform(LAYOUT, *next(c[1:] for c in corners if c[0] == r.scene_id))
        np.testing.assert_allclose(r[1:], (want.scale_x, want.offset_x, want.scale_y, want.offset_y), atol=1e-9)


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
@pytest.mark.parametrize("method", ["bilinear", "nearest"])
def test_coarser_layers_join_the_group(spark, tiles, targets, method, max_broadcast):
    rng = np.random.default_rng(9)
    image = rng.integers(0, 100, (2 * T, 2 * T)).astype(float)
    image[rng.random(image.shape) < 0.1] = np.nan
    rows = [
        (c, r, [None if np.isnan(v) else float(v) for v in image[r * T : (r + 1) * T, c * T : (c + 1) * T].ravel()])
        for c in range(2) for r in range(2) if (c, r) != (1, 1)
    ]
    image[T:, T:] = np.nan  # a tile that the layer does not have
    coarse = spark.createDataFrame(rows, "col bigint, row bigint, height array<double>")
    masks = spark.createDataFrame([(0, 0, [1] * 36)], "col bigint, row bigint, mask array<int>")
    grid = SourceGrid(scale_x=0.25, offset_x=-0.375, scale_y=0.5, offset_y=-0.25)
    got = focal.features(
        tiles, targets, LAYOUT, bands=BANDS, layers={"height": Layer(coarse, grid, method), "mask": masks}, max_broadcast=max_broadcast
    ).collect()
    plain = {(r.col, r.row, r.GS): r for r in focal.features(tiles, targets, LAYOUT, bands=BANDS).collect()}
    assert len(got) == len(plain)
    for r in got:
        np.testing.assert_allclose(as_array(r.height), slow_resample(image, r.col, r.row, grid, method))
        assert (r.mask is None) == ((r.col, r.row) != (0, 0))
        for c in feature_names(bands=BANDS):
            np.testing.assert_array_equal(as_array(r[c]), as_array(plain[r.col, r.row, r.GS][c]))
    far = focal.features(tiles, targets, LAYOUT, bands=BANDS, layers={"height": Layer(coarse.where("false"), grid)}, max_broadcast=max_broadcast)
    assert all(r.height is None for r in far.select("height").collect())


def test_slope_of_a_plane():
    y, x = np.mgrid[0:5, 0:5].astype(float)
    got = kernels.slope((3 * x + 4 * y)[None], 1.0, 1.0)
    np.testing.assert_allclose(got, np.degrees(np.arctan(5.0)))


def test_gather_counts_site_rows(spark, tiles, targets):
    sites = spark.createDataFrame(
        [("a", 0, 0, "train"), ("a", 0, 0, "train"), ("b", 3, 2, "validate")],
        "name string, col bigint, row bigint, usage string",
    )
    masks = spark.createDataFrame(
        [(c, r, [1] * 36) for c in range(COLS) for r in range(ROWS)], "col bigint, row bigint, mask array<int>"
    )
    pixels = focal.gather(tiles, targets, sites, LAYOUT, masks, bands=BANDS)
    counts = {(r.col, r.row, r.usage): (r.n, r.copies) for r in pixels.groupBy("col", "row", "usage").agg(
        F.count("*").alias("n"), F.max("copies").alias("copies")).collect()}
    assert counts == {(0, 0, "train"): (36, 2), (3, 2, "validate"): (36, 1)}
    once = focal.gather(tiles, targets, sites, LAYOUT, masks, bands=BANDS, dedupe=True)
    assert once.where("copies <> 1").isEmpty() and once.count() == 72


def test_stored_tiles_are_pruned_by_block(spark, tiles, targets, tmp_path):
    path = str(tmp_path / "tiles")
    imagery.write_tiles(tiles, path)
    stored = imagery.read_tiles(spark, path, ["b1"])
    assert "b2" not in stored.columns
    near = stored.where("season = 'GS' and block_col = 0 and block_row = 0")
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "b2" not in plan
    frame = focal.features(imagery.read_tiles(spark, path), targets, LAYOUT, bands=BANDS)
    direct = focal.features(tiles, targets, LAYOUT, bands=BANDS)
    assert frame.exceptAll(direct).isEmpty()
    assert "dynamicpruning" in executed(frame)


def test_masks_of_listed_cells(spark, tmp_path):
    masks = spark.createDataFrame([(0, 0, [1]), (1, 0, [0])], "col bigint, row bigint, mask array<int>")
    imagery.write_tiles(masks, str(tmp_path / "m"))
    sites = spark.createDataFrame([("x", 1, 0), ("x", 1, 0)], "name string, col bigint, row bigint")
    assert [tuple(r) for r in imagery.read_masks(spark, str(tmp_path / "m"), sites).collect()] == [(1, 0, [0])]


def test_many_targets_read_only_the_blocks_they_need(spark, tiles, targets, tmp_path):
    """Folders are pruned and other tiles dropped before imagery is shuffled."""
    far = tiles.select("season", "scene_id", (F.col("col") + 100_000).alias("col"), "row", "b1", "b2")
    path = str(tmp_path / "tiles")
    imagery.write_tiles(tiles.unionByName(far), path)
    stored = imagery.read_tiles(spark, path, ["b1", "b2"])
    wanted = targets.where("col = 0 and row = 0")
    frame = focal.features(stored, wanted, LAYOUT, bands=BANDS, max_broadcast=0)
    expected = focal.features(tiles, wanted, LAYOUT, bands=BANDS).collect()
    plan = executed(frame)
    assert "dynamicpruningexpression" in plan.lower()
    below = plan[plan.index("Generate explode") :] if "Generate explode" in plan else plan
    assert "getbit" in below or "getbit" in plan
    assert sorted(map(str, frame.collect())) == sorted(map(str, expected))


@pytest.mark.parametrize("scale", [0.9, 1.0, 4.0, 10.0])
def test_bound_on_source_tiles_holds(spark, scale):
    from tilecast.operators.windows import _axes

    x, _ = _axes(LAYOUT, SourceGrid(scale_x=scale, offset_x=0.3), 2)
    most = spark.range(-50, 50).select(F.size(x.sources("id")).alias("n")).agg(F.max("n")).first()[0]
    assert most <= x.most_sources() <= most + 2


@pytest.mark.parametrize("rate", [0.3, 20.0])
@pytest.mark.parametrize("max_broadcast", [0, 10**6])
def test_pixels_drawn_inside_the_group_are_those_of_the_sample(spark, tiles, targets, rate, max_broadcast):
    from tilecast.operators.sampling import poisson_sample
    from tilecast.operators.tiles import PIXEL

    sites = targets.select("col", "row").distinct()
    reading = {"bands": BANDS, "max_broadcast": max_broadcast}
    keys = ["col", "row", *PIXEL]
    every = focal.gather(tiles, targets, sites, LAYOUT, **reading)
    want = poisson_sample(every, rate, 3, keys)
    got = focal.gather(tiles, targets, sites, LAYOUT, sample=(rate, 3), **reading)
    assert sorted(got.columns) == sorted(want.columns) and got.schema["drawn"].dataType == want.schema["drawn"].dataType
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_sampled_groups_return_only_what_is_drawn(tiles, targets):
    frame = focal.features(tiles, targets, LAYOUT, bands=BANDS, sample=(0.1, 1))
    sizes = frame.selectExpr("size(GS_raw_1) as n", "size(_place) as p", "size(drawn) as d").collect()
    assert all(r.n == r.p == r.d for r in sizes)
    assert 0.04 < sum(r.n for r in sizes) / (len(sizes) * T * T) < 0.16
    with pytest.raises(ValueError):
        focal.features(tiles, targets, LAYOUT, bands=BANDS, sample=(9.0, 1))
    with pytest.raises(ValueError):
        focal.gather(tiles, targets, targets, LAYOUT, masks=tiles, sample=(0.1, 1))
