"""One query per operator, each over whole input tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilecast import SourceGrid
from tilecast.functions import columns as fn
from tilecast.operators import focal, metrics, packed, sampling, selection, sites, tiles
from tilecast.operators import model as forest
from tilecast.operators.resample import resample
from tilecast.operators.resample import resample_scenes as own_grids
from tilecast.operators.windows import Layer
from tilecast.plans.iteration import PIXEL_KEYS, Inputs, Iteration, Settings
from tilecast.runtime import materialize, shared_path
from tilecast.sources import imagery, publish, reports, tables
from tilecast.sources import packed as stores
from workload.fixtures import BANDS, LAYOUT, PIXEL, TILE, Fixtures

RUN, AOI, NEXT = 0, "aoi0", 5
CELL = ["col", "row"]

Query = Callable[[Fixtures], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, *prefixes: str) -> DataFrame:
    """Round irrational results, whose last digits depend on the order of summation."""
    return df.select(
        *[F.round(c, 9).alias(c) if any(p in c for p in prefixes) else c for c in df.columns]
    )


RATES = ("tss", "accuracy", "precision", "recall", "fpr", "tpr", "AUC", "auc")


def via_csv(fx: Fixtures, df: DataFrame, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    path = shared_path(fx.spark, "scan")
    tables.write_csv(df, path)
    return read(fx.spark, path)


def stored_tiles(fx: Fixtures, df: DataFrame, bands: list[str]) -> DataFrame:
    path = shared_path(fx.spark, "tiles")
    imagery.write_tiles(df, path)
    return imagery.read_tiles(fx.spark, path, bands)


def _labelled(fx: Fixtures) -> DataFrame:
    return sites.labelled(fx.incoming_merged(), RUN)


def _test_sites(fx: Fixtures) -> DataFrame:
    return sites.unlabelled_sites(fx.pool(), _labelled(fx))


def _pairs(fx: Fixtures) -> DataFrame:
    return sites.season_pairs(fx.catalog(), "scene_id")


def _targets(fx: Fixtures, season: str) -> DataFrame:
    return fx.catalog().where(F.col("season") == season).select(
        "col", "row", F.col("scene_id").alias(season)
    )


def _certainty(fx: Fixtures) -> DataFrame:
    return selection.cell_certainty(selection.restrict(fx.scored(), _test_sites(fx)), "p_no_field")


def _with_pixel_position(df: DataFrame) -> DataFrame:
    return df.withColumns(LAYOUT.global_pixel()).drop("col", "row", *PIXEL)


def _scenes(fx: Fixtures) -> DataFrame:
    """The scene of each season per cell, NULL where a season has none."""
    one, other = (_targets(fx, season) for season in fn.SEASONS)
    return one.join(other, CELL, "outer")


def _by_season(frame: DataFrame, kind: str, out: str) -> DataFrame:
    """One row per season, with the season's arrays under names without the season."""
    seasons = [
        F.struct(
            F.lit(s).alias("season"), F.col(s).alias("scene_id"),
            *[F.col(f"{s}_{kind}_{b}").alias(f"{out}{b}") for b in fn.BANDS],
        )
        for s in fn.SEASONS
    ]
    return frame.select(*CELL, F.explode(F.array(*seasons)).alias("_s")).select(*CELL, "_s.*").where(
        "scene_id is not null"
    )


def _pixels(frame: DataFrame, out: str) -> DataFrame:
    names = [f"{out}{b}" for b in fn.BANDS]
    return rounded(_with_pixel_position(tiles.explode_tiles(frame, names, TILE)), out)


# -- sources ---------------------------------------------------------------------------


@query
def scan_pool(fx):
    return via_csv(fx, fx.pool(), tables.read_sites)


@query
def scan_qs(fx):
    return via_csv(fx, fx.qs(), tables.read_sites)


@query
def scan_incoming(fx):
    return via_csv(fx, fx.incoming(), tables.read_incoming)


@query
def incoming_merged(fx):
    paths = [shared_path(fx.spark, "incoming") for _ in range(2)]
    tables.write_csv(fx.incoming(), paths[0])
    tables.write_csv(fx.incoming_static(), paths[1])
    return tables.read_incoming(fx.spark, *paths)


@query
def scan_catalog(fx):
    return via_csv(fx, fx.catalog(), tables.read_catalog)


@query
def scan_pixels(fx):
    stored = stored_tiles(fx, fx.tiles(), BANDS).drop("block_col", "block_row")
    return _with_pixel_position(tiles.explode_tiles(stored, BANDS, TILE))


@query
def scan_masks(fx):
    path = shared_path(fx.spark, "masks")
    imagery.write_tiles(fx.mask_tiles(), path)
    return tiles.explode_tiles(imagery.read_masks(fx.spark, path, fx.pool()), ["mask"], TILE)


def _history(fx: Fixtures) -> DataFrame:
    """Reports of earlier iterations: actual is the label, predicted the processed flag."""
    rows = fx.incoming_merged().select(
        "run", (F.col("iteration") + 1).alias("iteration"),
        (F.coalesce("label", F.lit("false")) == "true").cast("int").alias("actual"),
        F.col("processed").cast("int").alias("predicted"),
    )
    report = metrics.binary_metrics(rows, "actual", "predicted", by=["run", "iteration"]).withColumns(
        {
            "AUC": F.col("tpr") - F.col("fpr"),
            "aoi": F.format_string("aoi%d", "run"),
            "iteration_time": F.format_string("2020-01-0%d 00:00:00.000000", "iteration"),
        }
    )
    return rounded(report.select(*tables.METRICS.names), *RATES)


@query
def readback_metrics(fx):
    return via_csv(fx, _history(fx), tables.read_metrics)


# -- sinks -----------------------------------------------------------------------------


@query
def metrics_report(fx):
    report = metrics.metrics_report(fx.eval_pairs(), "label", "prediction", "score", RUN, NEXT, AOI)
    return rounded(report.drop("iteration_time"), *RATES)


@query
def report_times(fx):
    """Times of events, as reports have them."""
    return fx.table("events").select("event_id", metrics.format_time(F.col("ts")).alias("iteration_time"))


@query
def parallel_reports(fx):
    """Two runs report on the same iteration, another one on the next: nothing is lost, the clash is named."""
    folder = shared_path(fx.spark, "reports")
    written = [("north", NEXT, 0), ("south", NEXT, 1), ("north", NEXT + 1, 1)]
    for writer, iteration, parity in written:
        rows = fx.eval_pairs().where(F.col("score") % 2 == parity)
        report = metrics.binary_metrics(rows, "label", "prediction").select(
            *[F.col(c) for c in RATES if c.lower() != "auc"]
        )
        with suppress(reports.ReportConflict):
            reports.write_report(report, folder, RUN, iteration, writer)
    kept = reports.read_reports(fx.spark, folder, report.schema)
    clashes = reports.conflicts(kept).select("run", "iteration", F.concat_ws(",", "writers").alias("writers"))
    return rounded(kept.join(clashes, ["run", "iteration"], "left"), *RATES)


@query
def outgoing_names(fx):
    return selection.select_names(_certainty(fx), fx.pool(), LAYOUT, 10, RUN, NEXT, seed=7)


@query
def load_metrics(fx):
    iteration = sites.current_iteration(fx.incoming(), RUN).first()[0]
    return publish.metrics_rows(via_csv(fx, _history(fx), tables.read_metrics), RUN, iteration)


@query
def load_names(fx):
    iteration = sites.current_iteration(fx.incoming(), RUN).first()[0]
    worst = selection.worst_cells(_certainty(fx), LAYOUT)
    names = selection.outgoing_names(worst, fx.pool(), RUN, NEXT)
    return publish.names_rows(via_csv(fx, names, tables.read_names), RUN, iteration)


@query
def publish_tiles(fx):
    folder = shared_path(fx.spark, "published")
    factor = 5
    publish.publish(
        publish.probability_tiles(fx.scored(), LAYOUT, factor=factor),
        folder, "img_{}_{}_{}_{}_{}.tif", AOI, RUN, NEXT,
    )
    written = fx.spark.read.parquet(folder)
    pixels = tiles.explode_tiles(written, ["value"], factor * TILE)
    return pixels.where("value is not null")


# -- projections and predicates --------------------------------------------------------


@query
def labelled_incoming(fx):
    return _labelled(fx).select(
        "name", "iteration", "processed", "usage", F.col("label").try_cast("boolean").alias("is_labelled")
    )


@query
def nodata_filter(fx):
    return forest.drop_nodata(fx.px().join(fx.mask(), ["gx", "gy"]), [*BANDS, "mask"])


@query
def tile_paths(fx):
    return fx.pool().select(
        "name",
        fn.mask_path("labels").alias("mask_path"),
        fn.output_path("s3://out/image_{}_{}_{}_{}_{}.tif", "col", "row", F.lit(AOI), F.lit(RUN), F.lit(NEXT)).alias("image_path"),
    )


# -- joins -----------------------------------------------------------------------------


@query
def season_pairs(fx):
    return sites.season_pairs(fx.catalog())


@query
def test_names(fx):
    return _test_sites(fx)


@query
def all_names(fx):
    return sites.sites_with_usage(fx.pool(), _labelled(fx))


@query
def site_uris(fx):
    return sites.site_images(sites.season_pairs(fx.catalog()), _test_sites(fx))


@query
def comprehensive_names(fx):
    return sites.all_sites(fx.pool(), fx.qs())


@query
def scene_expand(fx):
    sampled = sampling.bernoulli_sample(_test_sites(fx), 0.1, 42, CELL)
    return sites.scene_sites(sampled, fx.catalog(), sites.all_sites(fx.pool(), fx.qs()))


@query
def restrict_scored(fx):
    worst = selection.worst_cells(_certainty(fx), LAYOUT)
    return selection.restrict(fx.scored(), worst).select(*PIXEL_KEYS, "s")


# -- aggregates ------------------------------------------------------------------------


@query
def class_counts(fx):
    return sampling.class_counts(fx.mask(), "mask")


@query
def last_iteration(fx):
    return sites.last_iteration(_labelled(fx))


@query
def current_iteration(fx):
    return sites.current_iteration(fx.incoming(), RUN)


@query
def cell_certainty(fx):
    return rounded(_certainty(fx), "certainty")


@query
def certainty_topk(fx):
    cells = materialize(_certainty(fx), "cells")
    worst = selection.worst_cells(cells, LAYOUT)
    return rounded(worst, "certainty").withColumn("n_cells", F.lit(cells.count()).cast("bigint"))


@query
def confusion_matrix(fx):
    return metrics.confusion_matrix(fx.eval_pairs(), "label", "prediction")


@query
def binary_metrics(fx):
    return rounded(metrics.binary_metrics(fx.eval_pairs(), "label", "prediction"), *RATES)


@query
def auc_roc(fx):
    return rounded(metrics.area_under_roc(fx.eval_pairs(), "label", "score"), "auc")


# -- geometry and map algebra ----------------------------------------------------------


@query
def layout_geometry(fx):
    plain = LAYOUT.extent()
    buffered = LAYOUT.extent(focal.HALO)
    return fx.pool().select(
        "name",
        F.round(F.lit(LAYOUT.pixel_width), 12).alias("pixel_width"),
        F.round(F.lit(LAYOUT.pixel_height), 12).alias("pixel_height"),
        *[F.round(v, 9).alias(k) for k, v in plain.items()],
        *[F.round(v, 9).alias(f"buffered_{k}") for k, v in buffered.items()],
    )


@query
def halo_window(fx):
    frame = focal.buffered_windows(fx.tiles(), _scenes(fx), LAYOUT)
    pixels = tiles.explode_tiles(_by_season(frame, "raw", "b"), BANDS, TILE + 2 * focal.HALO)
    return pixels.withColumns({c: F.col(c) - focal.HALO for c in PIXEL})


def _resampled(fx: Fixtures, grid: SourceGrid, method: str) -> DataFrame:
    frame = resample(fx.tiles(), _scenes(fx), LAYOUT, grid, method)
    return _pixels(_by_season(frame, "raw", "b"), "b")


@query
def resample_bilinear(fx):
    return _resampled(fx, SourceGrid(offset_x=0.25, offset_y=0.5), "bilinear")


@query
def resample_nearest(fx):
    return _resampled(fx, SourceGrid(offset_x=0.25, offset_y=0.75), "nearest")


@query
def erode_tile(fx):
    eroded = fx.vec_tile().select("cell", tiles.erode_tile("cells", 8, 8, 2).cast("array<double>").alias("value"))
    return tiles.explode_tiles(eroded, ["value"], 4)


@query
def focal_mean(fx):
    frame = focal.focal_means(fx.tiles(), _scenes(fx), LAYOUT)
    return _pixels(_by_season(frame, "avg", "avg_"), "avg_")


@query
def focal_stddev(fx):
    frame = focal.focal_stddevs(fx.tiles(), _scenes(fx), LAYOUT)
    return _pixels(_by_season(frame, "std", "std_"), "std_")


@query
def focal_slope(fx):
    frame = focal.focal_slopes(fx.tiles(), _scenes(fx), LAYOUT, 30.0, 30.0)
    return _pixels(_by_season(frame, "slope", "slope_"), "slope_")


@query
def explode_tiles(fx):
    vectors = fx.vec_tile().select("cell", "label", F.col("cells").cast("array<double>").alias("value"))
    return tiles.explode_tiles(vectors, ["value"], 8)


def _as_text(cells: str) -> F.Column:
    return F.array_join(F.transform(cells, lambda v: v.cast("string")), ",", "null")


@query
def assemble_tiles(fx):
    """Pixels without data are left out, so that the gaps are filled."""
    present = fx.px().where("b1 is not null").withColumns(LAYOUT.cell_of())
    tiled = tiles.assemble_tiles(present, [*CELL, "season"], BANDS, LAYOUT)
    return tiled.select(*CELL, "season", F.size("b1").alias("n_cells"), *[_as_text(b).alias(b) for b in BANDS])


@query
def scale_to_int8(fx):
    return fx.scored().select(*PIXEL_KEYS, fn.scale_to_int8("p_field").alias("percent"))


@query
def retile_coarse(fx):
    small = tiles.assemble_tiles(fx.px().withColumns(LAYOUT.cell_of()), ["season", *CELL], BANDS, LAYOUT)
    coarse = tiles.retile(small, BANDS, LAYOUT, 5)
    return coarse.select("season", *CELL, F.size("b1").alias("n_cells"), *[_as_text(b).alias(b) for b in BANDS])


@query
def overview_pyramid(fx):
    return tiles.overviews(fx.px(), [2, 4, 8])


def _windows(fx: Fixtures, margin: int, side: int, factors: list[int]) -> DataFrame:
    """A window around every site, at several levels; it starts ``margin`` pixels before the site."""
    factor = F.explode(F.array(*[F.lit(f) for f in factors]))
    corners = {"x0": F.col("col"), "y0": F.col("row")}
    placed = fx.pool().select(F.col("name").alias("window_id"), *CELL, factor.alias("factor")).withColumns({
        c: F.floor(key * TILE / F.col("factor")).cast("bigint") - margin for c, key in corners.items()
    })
    return placed.select(
        "window_id", "factor", "x0", "y0", (F.col("x0") + side).alias("x1"), (F.col("y0") + side).alias("y1")
    )


@query
def mosaic_window(fx):
    """Windows over the borders of packed sub-tiles, stored by coarse cell."""
    pixels = fx.px().where("season = 'GS'").withColumns(LAYOUT.cell_of())
    kinds = packed.kinds_of(pixels, BANDS)
    path = shared_path(fx.spark, "mosaic")
    stores.write_packed(packed.pack_tiles(pixels, CELL, kinds, TILE, TILE, unique=True), path, block=5)
    stored = fx.spark.read.parquet(path)
    windows = _windows(fx, 4, 17, [1]).drop("factor")
    found = packed.read_windows(stored, windows, [], kinds, TILE, TILE, block=5)
    found = packed.unpack(found, ["window_id", "x0", "y0", "window_width"], kinds, "window_width")
    return found.where("b1 is not null").drop("window_width")


@query
def pyramid_window(fx):
    """Windows of the image and two overviews, with the mask, from one stored pyramid."""
    chunk, path = 16, shared_path(fx.spark, "pyramid")
    squares, kinds = stores.pack_pyramid(fx.px().where("season = 'GS'"), BANDS, [2, 4], chunk)
    stores.write_pyramid(squares, path)
    found = stores.pyramid_windows(fx.spark, path, _windows(fx, 3, 13, [1, 2, 4]), kinds, chunk)
    pixels = packed.unpack(found, ["window_id", "factor", "x0", "y0", "window_width"], kinds, "window_width")
    return pixels.where("mask is not null").drop("window_width")


@query
def validity_mask(fx):
    return fx.px().select("gx", "gy", "season", fn.validity_mask(BANDS).alias("valid"))


def _feature_pixels(frame: DataFrame, names: list[str]) -> DataFrame:
    return rounded(tiles.explode_tiles(frame, names, TILE), "_avg_", "_std_")


@query
def resample_scenes(fx):
    frame = own_grids(fx.tiles(), _scenes(fx), LAYOUT, fx.scene_grids())
    return _pixels(_by_season(frame, "raw", "b"), "b")


@query
def coarse_layer(fx):
    terrain = Layer(fx.terrain_tiles(), SourceGrid(scale_x=0.25, offset_x=-0.375, scale_y=0.25, offset_y=-0.375))
    frame = focal.features(fx.tiles(), _targets(fx, "GS"), LAYOUT, ["GS"], layers={"terrain": terrain})
    pixels = _feature_pixels(frame.withColumnRenamed("GS", "scene_id"), [*fn.feature_names(["GS"]), "terrain"])
    return rounded(pixels, "terrain")


@query
def feature_frame(fx):
    frame = focal.features(fx.tiles(), _targets(fx, "GS"), LAYOUT, ["GS"])
    return _feature_pixels(frame.withColumnRenamed("GS", "scene_id"), fn.feature_names(["GS"]))


@query
def join_features(fx):
    frame = focal.features(fx.tiles(), _pairs(fx), LAYOUT).drop(*fn.SEASONS)
    return _feature_pixels(frame, fn.feature_names())


@query
def training_pixels(fx):
    """Pixels of the training and the validation sites, as one pass serves both."""
    listed = sites.sites_with_usage(fx.pool(), _labelled(fx)).where("usage is not null")
    pixels = focal.gather(fx.tiles(), _pairs(fx), listed, LAYOUT, fx.mask_tiles())
    return rounded(pixels, "_avg_", "_std_")


@query
def test_pixels(fx):
    return rounded(focal.gather(fx.tiles(), _pairs(fx), _test_sites(fx), LAYOUT), "_avg_", "_std_")


@query
def sampled_pixels(fx):
    """A tenth of the test pixels, drawn before the features leave their group."""
    drawn = focal.gather(fx.tiles(), _pairs(fx), _test_sites(fx), LAYOUT, sample=(0.1, 7))
    return rounded(drawn, "_avg_", "_std_")


# -- sampling --------------------------------------------------------------------------



@query
def poisson_sample(fx):
    return sampling.poisson_sample(fx.scored(), 0.1, 7, ["gx", "gy"]).select("gx", "gy", "drawn")


@query
def bernoulli_sample(fx):
    return sampling.bernoulli_sample(fx.pool(), 0.3, 42, CELL).select("name", *CELL)


@query
def take_sample(fx):
    pool = selection.with_cell_index(fx.pool(), LAYOUT)
    return sampling.take_sample(pool, 25, 7, CELL, "cell_index").select("name", *CELL)


@query
def balance_samples(fx):
    return sampling.balance_samples(fx.mask(), "mask", 7, ["gx", "gy"])


# -- learning --------------------------------------------------------------------------


def _iteration(fx: Fixtures, imagery_tiles: DataFrame | None = None) -> Iteration:
    inputs = Inputs(
        fx.pool(), fx.qs(), fx.incoming_merged(), fx.catalog(), fx.tiles() if imagery_tiles is None else imagery_tiles,
        fx.mask_tiles(),
    )
    return Iteration(inputs, Settings(run=RUN, aoi=AOI, seed=7, layout=LAYOUT, coarse_factor=5))


@query
def train_classify(fx):
    """Train on the training sites, report on the validation sites.

    What a model reports is no fact of SQL; how many pixels were judged, and how the rates hang
    together, is.
    """
    step = _iteration(fx)
    model = step.train()
    pixels = step.labelled_pixels().where("usage = 'validate'")
    judged = forest.classify(model, pixels, ["mask", "copies"])
    counts = metrics.confusion_matrix(judged, "mask", "prediction", copies="copies")
    total = counts.select((F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("judged"))
    rates = step.report(model).select(
        (F.abs(F.col("tss") - (F.col("tpr") - F.col("fpr"))) < 1e-9).alias("tss_agrees"),
        (F.col("recall") == F.col("tpr")).alias("recall_agrees"),
        F.col("AUC").between(0, 1).alias("auc_in_range"),
    )
    return total.crossJoin(rates)  # a row each


@query
def classify(fx):
    """Every pixel of the test sites is classified, by the larger of two shares of one."""
    stored = materialize(fx.tiles(), "tiles")  # read for training and for the test sites
    step = _iteration(fx, stored)
    pixels = focal.gather(stored, step.pairs, step.test_sites(), LAYOUT)
    found = forest.classify(step.train(), pixels, PIXEL_KEYS)
    return found.select(
        *PIXEL_KEYS,
        (F.abs(F.col("p_no_field") + F.col("p_field") - 1) < 1e-9).alias("sums_to_one"),
        (F.col("prediction") == (F.col("p_field") > F.col("p_no_field")).cast("double")).alias("agrees"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Query):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Fixtures(spark, sf_dir))

        return run

    return {name: bind(build) for name, build in QUERIES.items()}
