"""Site lists, image catalog and result tables, read from CSV with explicit schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SITES = _schema(
    name=T.StringType(), col=T.LongType(), row=T.LongType(), name_col_row=T.StringType()
)

NAMES = _schema(
    name=T.StringType(), run=T.IntegerType(), iteration=T.IntegerType(),
    processed=T.BooleanType(), usage=T.StringType(),
)

INCOMING = T.StructType(NAMES.fields + [T.StructField("label", T.StringType())])

CATALOG = _schema(
    col=T.LongType(), row=T.LongType(), season=T.StringType(),
    scene_id=T.StringType(), uri=T.StringType(),
)

METRICS = _schema(
    run=T.IntegerType(), iteration=T.IntegerType(), tss=T.DoubleType(), accuracy=T.DoubleType(),
    precision=T.DoubleType(), recall=T.DoubleType(), fpr=T.DoubleType(), tpr=T.DoubleType(),
    AUC=T.DoubleType(), aoi=T.StringType(), iteration_time=T.StringType(),
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read columns by header name, so files may order them differently than ``schema``.

    All files below ``path`` must have the same header: a file with another one is an error when
    it is read, never columns in wrong places.
    """
    with_header = spark.read.option("header", True)
    # Reading the header line alone, as text, costs one row of the first file.
    header = with_header.csv(path).columns
    kinds = {f.name: f for f in schema.fields}
    missing = [name for name in kinds if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    ordered = T.StructType([kinds.get(c, T.StructField(c, T.StringType())) for c in header])
    return with_header.option("enforceSchema", False).schema(ordered).csv(path).select(*kinds)


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    """A list of grid cells: the pool, or the additional (qs) list."""
    return read_csv(spark, path, SITES)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Which image covers which cell in which season."""
    return read_csv(spark, path, CATALOG)


def read_incoming(spark: SparkSession, *paths: str) -> DataFrame:
    """Labelled sites; several lists (current and static) are appended."""
    return merge_incoming(*[read_csv(spark, path, INCOMING) for path in paths])


def merge_incoming(*lists: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, lists)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Selected names written by an earlier iteration."""
    return read_csv(spark, path, NAMES)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Metric reports written by earlier iterations."""
    return read_csv(spark, path, METRICS)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """Write CSV with a header, in place of what is there; ``single_file`` is for a few rows only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
