import numpy as np
import pytest
from pyspark.sql import functions as F

from tilecast import MASTER
from tilecast.functions.columns import feature_names
from tilecast.operators import model as forest
from tilecast.operators.tiles import explode_tiles
from tilecast.plans.iteration import Inputs, Iteration, Settings
from tilecast.plans.load import load_results
from tilecast.sources import publish, tables

T, COLS, ROWS = 8, 4, 4
LAYOUT = MASTER.with_tile(T, T)
FOREST = {"trees": 8, "max_depth": 5, "subsampling": 1.0}


@pytest.fixture(scope="module")
def inputs(spark):
    """Fields are bright in the growing season: an easy landscape of two classes."""
    rng = np.random.default_rng(0)
    field = np.kron(rng.integers(0, 2, (ROWS * 2, COLS * 2)), np.ones((T // 2, T // 2)))
    images = {
        season: [100 + 50 * field * (season == "GS") * b + rng.normal(0, 5, field.shape) for b in range(1, 5)]
        for season in ("GS", "OS")
    }

    def cut(a, c, r):
        return [float(v) for v in a[r * T : (r + 1) * T, c * T : (c + 1) * T].ravel()]

    cells = [(c, r) for r in range(ROWS) for c in range(COLS)]
    tiles = spark.createDataFrame(
        [(s, f"{s}0", c, r, *[cut(b, c, r) for b in bands]) for s, bands in images.items() for c, r in cells],
        "season string, scene_id string, col bigint, row bigint, " + ", ".join(f"b{b} array<double>" for b in range(1, 5)),
    )
    masks = spark.createDataFrame(
        [(c, r, [int(v) for v in cut(field, c, r)]) for c, r in cells], "col bigint, row bigint, mask array<int>"
    )
    pool = spark.createDataFrame([(f"n{c}{r}", c, r, f"n{c}{r}_{c}_{r}") for c, r in cells], tables.SITES)
    incoming = spark.createDataFrame(
        [(f"n{c}{r}", 0, 3, True, "validate" if r == 1 else "train", "true") for c, r in cells if r < 2]
        + [("n03", 0, 7, True, "train", "false"), ("n13", 1, 9, True, "train", "true")],
        tables.INCOMING,
    )
    catalog = spark.createDataFrame(
        [(c, r, s, f"{s}0", f"s3://x/{s}0.tif") for s in ("GS", "OS") for c, r in cells], tables.CATALOG
    )
    return Inputs(pool, pool.where("col < 2"), incoming, catalog, tiles.cache(), masks.cache())


@pytest.fixture(scope="module")
def step(inputs):
    return Iteration(inputs, Settings(
        run=0, aoi="here", seed=1, layout=LAYOUT, test_rate=0.5, worst_share=0.5,
        number_outgoing=3, coarse_factor=2, forest=FOREST,
    ))


@pytest.fixture(scope="module")
def model(step):
    return step.train()


def test_forest_learns_the_landscape(step, model):
    report = step.report(model)
    row = report.first()
    assert report.columns == tables.METRICS.names
    assert (row.run, row.iteration, row.aoi) == (0, 4, "here")
    assert row.accuracy > 0.95 and row.AUC > 0.97 and row.tss == pytest.approx(row.tpr - row.fpr)


def test_parameters_of_the_forest(model):
    stage = model.stages[-1]
    assert stage.getNumTrees == 8 and stage.getMaxDepth() == 5
    defaults = forest.pipeline(feature_names(), "mask").getStages()[-1]
    assert (defaults.getNumTrees(), defaults.getMaxDepth(), defaults.getSubsamplingRate()) == (60, 15, 0.1)


def test_training_partitions_stop_growing(spark, monkeypatch):
    """Every partition sends the statistics of all open nodes, so many rows must not mean many partitions."""
    class Seen:
        def fit(self, rows):
            return rows.rdd.getNumPartitions()

    monkeypatch.setattr(forest, "PARTITION_ROWS", 10)
    monkeypatch.setattr(forest, "pipeline", lambda *_, **__: Seen())
    rows = spark.range(2000).selectExpr("id", "cast(id as double) as a", "id % 2 as mask")
    assert forest.train(rows, ["a"], "mask", ["id"]) == forest.MAX_PARTITIONS
    assert forest.train(rows.where("id < 35"), ["a"], "mask", ["id"]) == 4
    assert forest.training_partitions(100 * forest.FULL_PARTITION_ROWS) == 100


def test_rows_keep_the_node_that_they_reached():
    assert forest.pipeline(["a"], "mask").getStages()[-1].getCacheNodeIds()


def test_training_is_repeatable(step, model):
    assert step.train().stages[-1].toDebugString.split("\n")[1:] == model.stages[-1].toDebugString.split("\n")[1:]


def test_selected_names_are_unlabelled_pool_sites(step, model):
    names = step.names(model)
    rows = names.collect()
    assert names.columns == tables.NAMES.names
    assert len(rows) == 3
    assert all(r.name[2] in "23" and (r.run, r.iteration, r.processed, r.usage) == (0, 4, False, "train") for r in rows)


def test_probability_images(step, model):
    coarse = step.images(model)
    tiles = coarse.collect()
    assert sorted((r.col, r.row) for r in tiles) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert all(len(r.value) == (2 * T) ** 2 and all(0 <= v <= 100 for v in r.value) for r in tiles)
    scored = explode_tiles(coarse, ["value"], 2 * T).withColumns(
        {"gx": F.col("col") * 2 * T + F.col("column_index"), "gy": F.col("row") * 2 * T + F.col("row_index")}
    )
    truth = explode_tiles(step.inputs.masks, ["mask"], T).withColumns(LAYOUT.global_pixel()).select("gx", "gy", "mask")
    right = scored.join(truth, ["gx", "gy"]).agg(F.avg(((F.col("value") > 50) == (F.col("mask") == 1)).cast("int"))).first()[0]
    assert right > 0.95


def test_images_of_sampled_scenes_cover_the_scene(step, model):
    assert step.images(model, 8).count() == 4  # the single scene covers every cell
    assert step.images(model, 0).count() == 0


def test_several_scenes_per_cell_keep_one_value_per_pixel(inputs, model):
    more = inputs.catalog.unionByName(inputs.catalog.where("col = 0 and season = 'GS'").withColumn("scene_id", F.lit("GS1")))
    tiles = inputs.tiles.unionByName(inputs.tiles.where("col = 0 and season = 'GS'").withColumn("scene_id", F.lit("GS1")))
    step = Iteration(
        Inputs(inputs.pool, inputs.qs, inputs.incoming, more, tiles, inputs.masks),
        Settings(run=0, aoi="here", layout=LAYOUT, coarse_factor=2),
    )
    assert all(len(r.value) == (2 * T) ** 2 for r in step.images(model).collect())


def test_published_tiles_carry_their_path(spark, step, model, tmp_path):
    publish.publish(step.images(model), str(tmp_path / "out"), "/p/{}_{}_{}_{}_{}.tif", "here", 0, 4)
    got = spark.read.parquet(str(tmp_path / "out")).where("aoi = 'here' and run = 0 and iteration = 4")
    assert sorted(r.path for r in got.collect())[0] == "/p/0_0_here_0_4.tif"


def test_model_round_trip(model, step, tmp_path):
    forest.save(model, str(tmp_path / "m"))
    again = forest.load(str(tmp_path / "m"))
    pixels = step.labelled_pixels()
    one = forest.classify(model, pixels, ["col", "row", "column_index", "row_index"])
    two = forest.classify(again, pixels, ["col", "row", "column_index", "row_index"])
    assert one.exceptAll(two).isEmpty()


def test_drop_nodata_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1.0, None), (None, 1), (2.0, 3)], "a double, b int")
    assert [r.a for r in forest.drop_nodata(df, ["a", "label"]).collect()] == [1.0, 2.0]


def results(spark, names):
    metrics = spark.createDataFrame([(0, i, *[0.5] * 7, "here", "t") for i in (4, 8)], tables.METRICS)
    return metrics, spark.createDataFrame(names, tables.NAMES)


def test_load_appends_metrics_before_names(spark, inputs):
    written = []
    metrics, names = results(spark, [("n02", 0, 8, False, "train"), ("n03", 0, 4, False, "train")])
    load_results(metrics, names, inputs.incoming, 0, lambda df, table: written.append((table, df.collect())))
    assert [t for t, _ in written] == ["iteration_metrics", "incoming_names"]
    assert written[0][1][0].iteration == 8 and [r.name for r in written[1][1]] == ["n02"]


def test_load_without_names(spark, inputs):
    written = []
    metrics, names = results(spark, [])
    with pytest.raises(publish.NoNewNames):
        load_results(metrics, names, inputs.incoming, 0, lambda df, table: written.append(table))
    assert written == ["iteration_metrics"]
    with pytest.raises(ValueError, match="run 42"):
        load_results(metrics, names, inputs.incoming, 42, lambda df, table: None)
