"""Domain inputs derived from the generic test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilecast import MASTER
from tilecast.operators.tiles import assemble_tiles

TILE = 10
LAYOUT = MASTER.with_tile(TILE, TILE)
BANDS = ["b1", "b2", "b3", "b4"]
PIXEL = ["column_index", "row_index"]


class Fixtures:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _customers(self) -> DataFrame:
        return self.table("customer").where("c_custkey % 10 = 0").select(
            "c_name", F.expr("c_custkey div 10").alias("k")
        )

    def pool(self) -> DataFrame:
        return self._customers().selectExpr("c_name as name", "k % 10 as col", "k div 10 as row").withColumn(
            "name_col_row", F.concat_ws("_", "name", "col", "row")
        )

    def qs(self) -> DataFrame:
        return (
            self.table("supplier")
            .selectExpr(
                "concat('Customer#', lpad(cast(s_suppkey * 20 as string), 9, '0')) as name",
                "(s_suppkey * 2) % 10 as col",
                "(s_suppkey * 2) div 10 as row",
            )
            .withColumn("name_col_row", F.concat_ws("_", "name", "col", "row"))
        )

    def _incoming_all(self) -> DataFrame:
        customers = self.table("customer").select("c_custkey", F.col("c_name").alias("name"))
        orders = self.table("orders").where("o_custkey % 10 = 0")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
            "o_orderkey",
            "name",
            "cast(o_orderkey % 5 as int) as run",
            "cast((o_orderkey div 5) % 5 as int) as iteration",
            "o_orderstatus <> 'P' as processed",
            "case when (o_custkey div 10) % 4 = 3 then 'validate' else 'train' end as usage",
            "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'true'"
            " when o_orderpriority = '5-LOW' then null else 'false' end as label",
        )

    def incoming(self) -> DataFrame:
        return self._incoming_all().where("o_orderkey % 4 <> 3").drop("o_orderkey")

    def incoming_static(self) -> DataFrame:
        return self._incoming_all().where("o_orderkey % 4 = 3").drop("o_orderkey")

    def incoming_merged(self) -> DataFrame:
        return self.incoming().unionByName(self.incoming_static())

    def catalog(self) -> DataFrame:
        scene = F.concat_ws(
            "_", "season", F.expr("((k % 10) div 5 + 2 * ((k div 10) div 3))").cast("string")
        )
        return (
            self._customers()
            .select("k", F.explode(F.array(F.lit("GS"), F.lit("OS"))).alias("season"))
            .where("not (season = 'OS' and k % 17 = 16)")
            .select(
                F.expr("k % 10").alias("col"),
                F.expr("k div 10").alias("row"),
                "season",
                scene.alias("scene_id"),
                F.concat(F.lit("s3://img/"), scene, F.lit(".tif")).alias("uri"),
            )
        )

    def _grid(self) -> DataFrame:
        return self.table("orders").selectExpr(
            "o_orderkey as k",
            "((o_orderkey div 100) % 10) * 10 + o_orderkey % 10 as gx",
            "((o_orderkey div 100) div 10) * 10 + (o_orderkey % 100) div 10 as gy",
            "o_orderstatus",
            "o_orderpriority",
        )

    def px(self) -> DataFrame:
        """Global pixels per season; the bands are NULL where there is no data."""
        lines = self.table("lineitem").groupBy("l_orderkey", "l_linestatus").agg(
            F.expr("sum(cast(l_quantity as bigint))").alias("b1"),
            F.expr("sum(cast(l_extendedprice + 0.5 as bigint))").alias("b2"),
            F.expr("sum(cast(l_discount * 100 + 0.5 as bigint))").alias("b3"),
            F.expr("sum(cast(l_tax * 100 + 0.5 as bigint))").alias("b4"),
        )
        seasons = self._grid().select(
            "k", "gx", "gy",
            F.explode(F.array(F.struct(F.lit("GS").alias("season"), F.lit("O").alias("st")),
                              F.struct(F.lit("OS").alias("season"), F.lit("F").alias("st")))).alias("s"),
        ).select("k", "gx", "gy", "s.season", "s.st")
        return seasons.join(
            lines,
            (F.col("l_orderkey") == F.col("k")) & (F.col("l_linestatus") == F.col("st")),
            "left",
        ).select("gx", "gy", "season", *BANDS)

    def scene_px(self) -> DataFrame:
        """Pixels of the scene that the catalog names for their cell."""
        scenes = self.catalog().select("col", "row", "season", "scene_id")
        return self.px().withColumns(LAYOUT.cell_of()).drop("gx", "gy").join(
            scenes, ["col", "row", "season"]
        )

    def tiles(self) -> DataFrame:
        return assemble_tiles(self.scene_px(), ["season", "scene_id", "col", "row"], BANDS, LAYOUT)

    def scene_grids(self) -> DataFrame:
        """Three kinds of grid, by the scene's number: shifted, half as fine, a quarter finer.

        Scales are about the upper-left pixel of the scene, so that most pixels have a source.
        """
        scenes = self.catalog().select("scene_id").distinct()
        n = F.element_at(F.split("scene_id", "_"), 2).cast("int")
        scale = F.when(n % 3 == 0, 1.0).when(n % 3 == 1, 0.5).otherwise(1.25)
        shift = F.when(n % 3 == 0, 0.5).when(n % 3 == 1, 0.25).otherwise(0.125)
        x, y = n % 2 * 50, F.floor(n / 2) * 30
        return scenes.select(
            "scene_id", scale.alias("scale_x"), (x * (1 - scale) + shift).alias("offset_x"),
            scale.alias("scale_y"), (y * (1 - scale) + shift / 2).alias("offset_y"),
        )

    def terrain_tiles(self) -> DataFrame:
        """A raster of pixels four times as wide and high as the imagery's."""
        coarse = self.px().where("season = 'GS'").selectExpr("gx div 4 as gx", "gy div 4 as gy", "b3")
        pixels = coarse.groupBy("gx", "gy").agg(F.sum("b3").alias("terrain")).withColumns(LAYOUT.cell_of())
        return assemble_tiles(pixels, ["col", "row"], ["terrain"], LAYOUT)

    def mask(self) -> DataFrame:
        return self._grid().selectExpr(
            "gx", "gy",
            "case when o_orderstatus = 'F' then 1"
            " when o_orderpriority = '5-LOW' and k % 7 = 0 then null else 0 end as mask",
        )

    def mask_tiles(self) -> DataFrame:
        pixels = self.mask().withColumns(LAYOUT.cell_of())
        return assemble_tiles(pixels, ["col", "row"], ["mask"], LAYOUT)

    def scored(self) -> DataFrame:
        """Pixel form with the class probabilities."""
        return (
            self._grid().selectExpr("gx", "gy", "cast((k * 7919 + 13) % 1001 as int) as s")
            .withColumns(LAYOUT.cell_of())
            .withColumns({"p_field": F.col("s") / 1000, "p_no_field": 1 - F.col("s") / 1000})
        )

    def eval_pairs(self) -> DataFrame:
        return self.table("labels").join(self.table("documents").select("doc_id", "n_chars"), "doc_id").select(
            F.col("quality").alias("label"), F.col("toxic").alias("prediction"), F.col("n_chars").alias("score")
        )

    def vec_tile(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("cell"), F.col("embedding").alias("cells"), "label"
        )
