"""Mix sources to target weights by Pareto order sampling.

A source's target, in words, is turned into an expected number of copies of each of its
documents. The whole part is certain: so many whole copies of every document are taken. The rest
is the inclusion probability of one more copy. Documents are ranked by random odds divided by
inclusion odds (Pareto order sampling), and a sample of fixed size, counted in words, is the head
of that ranking: the cut lies where the words come nearest to what the target leaves open.

No document is moved. The ranking is cut by a value per source, found from sums over slices of
the ranking and from the single documents of one slice, so a source with a third of all rows is
never in one task. Copies then are a function of the document and of its source's row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.llm.common import word_count
from tilecast.runtime import broadcast_if_small, materialize

#: Slices of the ranking of a source. The documents of one slice meet in a task.
SLICES = 4096


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from the id and the seed alone: 52 bits of an MD5."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(2.0**52)


def targets(sizes: DataFrame, total: Column, most: float = 2.0) -> DataFrame:
    """Share ``total`` words among the sources by weight, none above ``most`` times its size.

    ``sizes`` has ``source, source_size, weight`` (a row per source). What a source cannot take
    is shared again by weight among the others. Sources are sorted by the level, words per
    weight, at which they are full; the level of all others follows from running sums, so one
    pass replaces the rounds. Adds ``target``. A source without words has the target 0.

    This table is as small as the list of weights that comes with a mix.
    """
    order = Window.orderBy("_full", "source")
    upto, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    cap = F.lit(float(most)) * F.col("source_size")
    level = (total - F.coalesce(F.sum("_cap").over(upto), F.lit(0.0))) / F.sum("weight").over(after)
    leveled = (
        sizes.withColumn("_cap", cap)
        .withColumn("_full", F.col("_cap") / F.col("weight"))
        .withColumn("_level", level)
    )
    # The first source in that order that its level does not fill; all from there on share it.
    shared = F.min(F.when(F.col("_level") < F.col("_full"), F.struct("_full", "source", "_level"))).over(
        Window.partitionBy()
    )
    return leveled.withColumn("_s", shared["_level"]).withColumn(
        "target", F.coalesce(F.least("_cap", F.col("weight") * F.col("_s")), F.col("_cap"))
    ).drop("_cap", "_full", "_level", "_s")


def code_point_weights(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Weights that repeat over the sources in code point order, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place % len(weights) + 1))


def plan_mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, seed: int = 17, weights: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies`` (int): how often the mix takes a document.

    Args:
        docs: has ``doc_id, source, text``. Columns of the new names are replaced.
        share: words of the mix as a share of all words.
        most: a source's target is at most so many times its size; whole copies of a document
            never exceed it rounded up.
        weights: ``source, weight`` (positive); by default 3, 1, 2, repeating in code point order.
            Sources that it does not list get no words.

    Null texts and texts without a word have size 0; they are ranked with their source and take no
    words. Documents that share an id are ranked as one. Without any words, targets are 0.
    """
    # Sizes without the texts: what the ranking is made from.
    size = word_count("text")
    u = uniform(F.col("doc_id"), seed)
    light = materialize(docs.select("source", size.alias("size"), u.alias("u")), "mix-sizes")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        sizes = code_point_weights(sizes)
    else:
        sizes = sizes.join(weights.select("source", "weight"), sizes.source.eqNullSafe(weights.source), "left").select(
            sizes.source, "source_size", F.coalesce("weight", F.lit(0)).alias("weight")
        )
    weighted = sizes.where("weight > 0")
    every = light.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    shared = targets(weighted, F.lit(share * every), most).select("source", "source_size", "target")
    unlisted = sizes.where("weight <= 0").select("source", "source_size", F.lit(0.0).alias("target"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = materialize(
        shared.unionByName(unlisted)
        .withColumn("certain", F.floor(expected))
        .withColumn("inclusion", expected - F.col("certain"))
        .withColumn("open", F.col("target") - F.col("certain") * F.col("source_size")),
        "mix-plan",
    )
    small = broadcast_if_small(plan)
    ranked = (
        light.join(small, light.source.eqNullSafe(small.source))
        .where("inclusion > 0")
        .select(plan.source, "open", "size", pareto(F.col("u"), F.col("inclusion")).alias("rank"))
    )
    cuts = broadcast_if_small(_cuts(ranked))
    # The row travels as one value, so that its columns may have any names.
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row"), "source", size.alias("_size"), u.alias("_u"))
    goal = broadcast_if_small(plan.withColumnRenamed("source", "_source"))
    placed = rows.join(goal, F.col("source").eqNullSafe(F.col("_source")), "left")
    placed = placed.join(cuts.withColumnRenamed("source", "_cut_source"), F.col("source").eqNullSafe(F.col("_cut_source")), "left")
    extra = (F.col("inclusion") > 0) & (pareto(F.col("_u"), F.col("inclusion")) <= F.col("cut"))
    copies = F.col("certain") + F.coalesce(extra, F.lit(False)).cast("int")
    return placed.select("_row.*", F.col("_size").alias("size"), "source_size", "target", copies.cast("int").alias("copies"))


def pareto(u: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds."""
    return (u / (1.0 - u)) / (inclusion / (1.0 - inclusion))


def _cuts(ranked: DataFrame) -> DataFrame:
    """``source, cut``: up to which rank documents are taken, ranks of equal value together.

    A rank counts if less than half of its words lies beyond the words that are open.
    """
    # rank / (1 + rank) lies in (0, 1) for any probabilities: slices keep the order.
    sliced = ranked.withColumn("slice", F.floor(F.col("rank") / (1.0 + F.col("rank")) * SLICES).cast("int"))
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sliced.groupBy("source", "slice").agg(
        F.sum("size").alias("words"), F.max("open").alias("open"), F.max("rank").alias("top")
    )
    # The slice where the words run out (or the last one), and the last rank before it.
    edge = (
        sums.withColumn("base", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .withColumn("below", F.max("top").over(before))
        .where(F.col("base") < F.col("open"))
        .groupBy("source")
        .agg(F.max(F.struct("slice", "base", "below")).alias("e"))
        .select(F.col("source").alias("_source"), F.col("e.slice").alias("_slice"), "e.base", "e.below")
    )
    running = Window.partitionBy("source").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        sliced.join(
            broadcast_if_small(materialize(edge, "mix-edge")),
            F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")),
        )
        .groupBy("source", "rank")
        .agg(F.sum("size").alias("words"), *[F.max(c).alias(c) for c in ("open", "base", "below")])
        .withColumn("_before", F.col("base") + F.coalesce(F.sum("words").over(running), F.lit(0)))
    )
    # Words before a rank plus half of its own never fall along the ranking: this is a head.
    taken = F.col("_before") + F.col("words") / 2.0 < F.col("open")
    return inside.groupBy("source").agg(
        F.coalesce(F.max(F.when(taken, F.col("rank"))), F.max("below")).alias("cut")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row as often as :func:`plan_mix` takes it, same columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source", "text")
    taken = plan_mix(rows, **options).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select("_row.*")
