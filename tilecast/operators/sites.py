"""Relational preparation of the site lists and the image catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.functions.columns import SEASONS

SITE_KEYS = ["name", "col", "row", "name_col_row"]


def labelled(incoming: DataFrame, run: int) -> DataFrame:
    """Rows of the run whose label reads as true; malformed labels count as unlabelled."""
    return incoming.where(
        (F.col("run") == run) & F.coalesce(F.col("label").try_cast("boolean"), F.lit(False))
    )


def last_iteration(labelled_rows: DataFrame) -> DataFrame:
    """One row: the highest iteration among labelled rows (of every incoming list)."""
    return labelled_rows.agg(F.max("iteration").alias("last_iteration"))


def current_iteration(incoming: DataFrame, run: int) -> DataFrame:
    """One row: one more than the highest iteration of the run in the current list."""
    return incoming.where(F.col("run") == run).agg(
        (F.max("iteration") + 1).cast("int").alias("current_iteration")
    )


def unlabelled_sites(pool: DataFrame, labelled_rows: DataFrame) -> DataFrame:
    """Pool sites that nobody has labelled yet."""
    return _never_listed(pool, labelled_rows).select(*pool.columns, F.lit("test").alias("usage"))


def _never_listed(pool: DataFrame, rows: DataFrame) -> DataFrame:
    # Distinct names are combined map-side: a name on a third of all rows arrives only once.
    return pool.join(rows.select("name").distinct(), "name", "left_anti")


def sites_with_usage(pool: DataFrame, labelled_rows: DataFrame) -> DataFrame:
    """Every pool site with the usage of its labelled rows.

    A site listed several times comes out several times; a site never listed has no usage.
    This left join is written as an inner join, whose hot names Spark can split at run time,
    and the sites that are missing from it.
    """
    places = pool.select("name", "col", "row")
    listed = labelled_rows.select("name", "usage").join(places, "name")
    missing = _never_listed(places, labelled_rows).withColumn("usage", F.lit(None).cast("string"))
    return listed.select("name", "col", "row", "usage").unionByName(missing)


def usage_counts(pool: DataFrame, labelled_rows: DataFrame) -> DataFrame:
    """``name, col, row, usage, copies``: listed pool sites, and how often each usage is listed.

    Rows are counted before they meet the pool, so a name on a third of all rows joins once.
    """
    counted = labelled_rows.groupBy("name", "usage").agg(F.count("*").alias("copies"))
    return pool.select("name", "col", "row").join(counted, "name").select("name", "col", "row", "usage", "copies")


def all_sites(pool: DataFrame, qs: DataFrame) -> DataFrame:
    """The sites of either list."""
    return pool.select(*SITE_KEYS).join(qs.select(*SITE_KEYS), SITE_KEYS, "outer")


def season_pairs(catalog: DataFrame, column: str = "uri") -> DataFrame:
    """For each cell, every combination of one image per season.

    ``column`` (``uri`` or ``scene_id``) names the image; the result has one column per
    season. Cells without imagery in a season drop out.
    """
    first, *others = [
        catalog.where(F.col("season") == season).select("col", "row", F.col(column).alias(season))
        for season in SEASONS
    ]
    for other in others:
        first = first.join(other, ["col", "row"])
    return first


def site_images(pairs: DataFrame, sites: DataFrame) -> DataFrame:
    """Season pairs of the listed sites, with the site's name."""
    return pairs.join(sites.select("name", "col", "row"), ["col", "row"]).select(
        "name", "col", "row", *[c for c in pairs.columns if c not in ("col", "row")]
    )


def scene_sites(sampled: DataFrame, catalog: DataFrame, sites: DataFrame, season: str = SEASONS[0]) -> DataFrame:
    """All sites covered by any scene that covers a sampled cell.

    The catalog is filtered by the distinct scenes and never joined to each sampled cell.
    Scenes are few, so at run time Spark broadcasts their list once it has seen its size.
    """
    images = catalog.where(F.col("season") == season).select("col", "row", "scene_id")
    touched = (
        images.join(sampled.select("col", "row"), ["col", "row"], "left_semi")
        .select("scene_id").distinct()
    )
    cells = images.join(touched, "scene_id", "left_semi").select("col", "row")
    return sites.select(*SITE_KEYS).join(cells, ["col", "row"], "left_semi").distinct()
