"""One active-learning iteration: train, validate, score, select, publish."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions.columns import BANDS, SEASONS, feature_names
from tilecast.layout import MASTER, Layout, SourceGrid
from tilecast.operators import model as forest
from tilecast.operators.focal import gather
from tilecast.operators.metrics import metrics_report
from tilecast.operators.sampling import balance_weights, bernoulli_sample
from tilecast.operators.selection import WORST_SHARE, cell_certainty, select_names
from tilecast.operators.sites import (
    all_sites,
    labelled,
    last_iteration,
    scene_sites,
    season_pairs,
    unlabelled_sites,
    usage_counts,
)
from tilecast.runtime import materialize
from tilecast.sources.publish import COARSE_FACTOR, probability_tiles

PIXEL_KEYS = ["col", "row", "column_index", "row_index"]

# Fixed value: share of the test pixels that is scored to rank cells.
TEST_RATE = 0.1


@dataclass(frozen=True)
class Inputs:
    """Source tables. ``incoming`` holds all lists; ``full_catalog`` serves the complete map."""

    pool: DataFrame
    qs: DataFrame
    incoming: DataFrame
    catalog: DataFrame
    tiles: DataFrame
    masks: DataFrame
    full_catalog: DataFrame | None = None


@dataclass(frozen=True)
class Settings:
    run: int
    aoi: str
    seed: int = 0
    layout: Layout = MASTER
    grid: SourceGrid = SourceGrid()
    resampling: str = "bilinear"
    bands: tuple[int, ...] = BANDS
    test_rate: float = TEST_RATE
    worst_share: float = WORST_SHARE
    number_outgoing: int = 10
    coarse_factor: int = COARSE_FACTOR
    dedupe: bool = False
    forest: dict = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return feature_names(SEASONS, self.bands)


class Iteration:
    """Steps of one iteration. Each step returns a frame and can be used on its own."""

    def __init__(self, inputs: Inputs, settings: Settings):
        self.inputs, self.settings = inputs, settings
        self.labelled = labelled(inputs.incoming, settings.run)
        self.pairs = season_pairs(inputs.catalog, "scene_id")
        self._labelled_pixels: DataFrame | None = None
        self.next_iteration = (last_iteration(self.labelled).first()[0] or 0) + 1

    def _gather(
        self, sites: DataFrame, masks: DataFrame | None = None, pairs: DataFrame | None = None,
        sample: tuple[float, int] | None = None,
    ) -> DataFrame:
        s = self.settings
        return gather(
            self.inputs.tiles, self.pairs if pairs is None else pairs, sites, s.layout, masks,
            SEASONS, s.bands, s.dedupe, sample, grid=s.grid, method=s.resampling,
        )

    def labelled_pixels(self) -> DataFrame:
        """Features and labels of the sites for training and validation.

        One pass over the imagery serves both uses; the table is written once and kept.
        """
        if self._labelled_pixels is None:
            listed = usage_counts(
                self.inputs.pool, self.labelled.where(F.col("usage").isin("train", "validate"))
            )
            pixels = self._gather(listed, self.inputs.masks)
            complete = forest.drop_nodata(pixels, ["mask", *self.settings.features])
            self._labelled_pixels = materialize(complete, "labelled")
        return self._labelled_pixels

    def train(self) -> PipelineModel:
        """Fit on a class-balanced sample, which repeats rows by weight instead of copying."""
        s = self.settings
        pixels = self.labelled_pixels().where("usage = 'train'")
        sample = balance_weights(pixels, "mask", s.seed, PIXEL_KEYS, copies="copies")
        sample = materialize(sample, "balanced")  # draws are made once, not in every pass
        return forest.train(
            sample, s.features, "mask", PIXEL_KEYS, weight="drawn", seed=s.seed, **s.forest
        )

    def report(self, model: PipelineModel) -> DataFrame:
        s = self.settings
        pixels = self.labelled_pixels().where("usage = 'validate'")
        scored = materialize(forest.classify(model, pixels, ["mask", "copies"]), "validation")
        return metrics_report(
            scored, "mask", "prediction", "p_field", s.run, self.next_iteration, s.aoi, "copies"
        )

    def test_sites(self) -> DataFrame:
        return unlabelled_sites(self.inputs.pool, self.labelled)

    def certainty(self, model: PipelineModel) -> DataFrame:
        """Certainty of each unlabelled cell, from a random part of its pixels."""
        s = self.settings
        sample = self._gather(self.test_sites(), sample=(s.test_rate, s.seed))
        scored = forest.classify(model, sample, [*PIXEL_KEYS, "drawn"])
        return cell_certainty(scored, "p_no_field", "drawn")

    def names(self, model: PipelineModel) -> DataFrame:
        s = self.settings
        return select_names(
            self.certainty(model), self.inputs.pool, s.layout, s.number_outgoing,
            s.run, self.next_iteration, s.seed, s.worst_share,
        )

    def every_site(self) -> DataFrame:
        """Sites of both lists; repeated entries would only repeat the same images."""
        return all_sites(self.inputs.pool.distinct(), self.inputs.qs.distinct())

    def image_sites(self, images: int) -> DataFrame:
        """Sites of all scenes that cover a random choice of about ``images`` test cells."""
        tests = self.test_sites()
        sample = bernoulli_sample(
            tests, min(1.0, images / max(tests.count(), 1)), self.settings.seed, ["col", "row"]
        )
        return scene_sites(sample, self.inputs.catalog, self.every_site())

    def images(self, model: PipelineModel, images: int | None = None) -> DataFrame:
        """Coarse probability tiles around ``images`` sampled cells, or of every site if None."""
        s = self.settings
        pairs = self.pairs
        if images is None:
            sites = self.every_site()
            if self.inputs.full_catalog is not None:
                pairs = season_pairs(self.inputs.full_catalog, "scene_id")
        else:
            sites = self.image_sites(images)
        scored = forest.classify(model, self._gather(sites, pairs=pairs), PIXEL_KEYS)
        # Cells with several pairs of scenes have several scores per pixel.
        unique = pairs.groupBy("col", "row").count().where("count > 1").isEmpty()
        return probability_tiles(scored, s.layout, factor=s.coarse_factor, unique=unique)
