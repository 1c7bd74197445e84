import pytest
from pyspark.sql import functions as F

from tilecast.functions import columns as C
from tilecast.operators import sites
from tilecast.sources import publish, tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path / "c.csv", "scene_id,uri,season,row,col,cloud\ns1,u1,GS,2,1,0.3\n")
    assert tuple(tables.read_catalog(spark, path).first()) == (1, 2, "GS", "s1", "u1")


def test_csv_without_a_needed_column(spark, tmp_path):
    with pytest.raises(ValueError, match="name_col_row"):
        tables.read_sites(spark, write(tmp_path / "s.csv", "name,col,row\na,1,2\n"))


def test_malformed_labels_count_as_unlabelled(spark, tmp_path):
    path = write(
        tmp_path / "i.csv",
        "name,run,iteration,processed,usage,label\n"
        "a,0,1,true,train,True\nb,0,2,false,train,maybe\nc,0,3,True,validate,\nd,1,9,true,train,true\n",
    )
    incoming = tables.read_incoming(spark, path, path)
    rows = sites.labelled(incoming, 0)
    assert [r.name for r in rows.collect()] == ["a", "a"]
    assert sites.last_iteration(rows).first()[0] == 1
    assert sites.current_iteration(incoming, 0).first()[0] == 4


def test_sites_with_usage_is_a_left_join(spark):
    pool = spark.createDataFrame([(n, i, 0) for i, n in enumerate("abc")], "name string, col bigint, row bigint")
    rows = spark.createDataFrame(
        [("a", "train"), ("a", "train"), ("b", None), ("x", "train")], "name string, usage string"
    )
    got = sites.sites_with_usage(pool, rows)
    expected = pool.join(rows, "name", "left")
    assert sorted(got.collect(), key=str) == sorted(expected.select(*got.columns).collect(), key=str)
    # A filter on the usage drops the never-listed sites from the plan.
    plan = got.where("usage = 'train'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "LeftAnti" not in plan


def test_scene_sites_are_whole_scenes_without_repeats(spark):
    catalog = spark.createDataFrame(
        [(0, 0, "GS", "s1", "u"), (1, 0, "GS", "s1", "u"), (1, 0, "GS", "s2", "u"), (2, 0, "GS", "s2", "u"), (3, 0, "GS", "s3", "u")],
        tables.CATALOG,
    )
    pool = spark.createDataFrame([(f"n{i}", i, 0, f"n{i}_{i}_0") for i in range(4)], tables.SITES)
    got = sites.scene_sites(pool.where("col = 1"), catalog, pool)
    assert sorted(r.name for r in got.collect()) == ["n0", "n1", "n2"]


def test_paths(spark):
    row = spark.sql("select 'x' as name, 3L as col, 4L as row").select(
        C.mask_path("p").alias("m"), C.output_path("/o/{}_{}_100%.tif", "col", "row", F.lit("unused")).alias("o")
    ).first()
    assert tuple(row) == ("p/x_3_4.tif", "/o/3_4_100%.tif")


def test_int8(spark):
    values = spark.createDataFrame([(0.9999,), (1.0,), (2.0,), (None,)], "v double")
    assert [r[0] for r in values.select(C.scale_to_int8("v")).collect()] == [99, 100, None, None]


def test_validity_mask_needs_every_band(spark):
    px = spark.createDataFrame([(1, 2), (1, None), (None, None)], "b1 int, b2 int")
    assert [r[0] for r in px.select(C.validity_mask(["b1", "b2"])).collect()] == [255, 0, 0]


METRICS_ROW = (0, 5, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, "aoi", "2020-01-01 00:00:00.000000")


def test_metrics_rows_follow_the_table(spark):
    frame = spark.createDataFrame([METRICS_ROW, (0, 4, *METRICS_ROW[2:])], tables.METRICS)
    got = publish.metrics_rows(frame, 0, 5)
    assert got.columns == publish.METRICS_TABLE
    assert tuple(got.first()) == (0, 5, 0.1, 0.2, "aoi", METRICS_ROW[-1], 0.3, 0.4, 0.5, 0.6, 0.7)
    assert publish.metrics_rows(frame.drop("fpr"), 0, 5).first().fpr is None


def test_reports_round_trip_through_csv(spark, tmp_path):
    frame = spark.createDataFrame([METRICS_ROW], tables.METRICS)
    tables.write_csv(frame, str(tmp_path / "m"), single_file=True)
    assert tuple(tables.read_metrics(spark, str(tmp_path / "m")).first()) == METRICS_ROW


@pytest.mark.parametrize("cluster", ["yarn", "local-cluster[3,2,3000]"])
def test_no_local_scratch_folder_on_a_cluster(cluster):
    from tilecast import runtime

    class Context:
        master = cluster

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_path(Session(), "x")


def test_files_with_different_headers_are_an_error(spark, tmp_path):
    folder = tmp_path / "sites"
    folder.mkdir()
    write(folder / "a.csv", "name,col,row,name_col_row\na,1,2,a_1_2\n")
    write(folder / "b.csv", "name,row,col,name_col_row\nb,2,1,b_1_2\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_sites(spark, str(folder)).collect()


def test_sinks_can_be_written_again(spark, tmp_path):
    tiles = spark.createDataFrame([(0, 0, [1]), (1, 0, [2])], "col bigint, row bigint, value array<tinyint>")
    folder = str(tmp_path / "maps")
    for iteration, part in ((1, tiles), (2, tiles), (1, tiles.where("col = 1"))):
        publish.publish(part, folder, "image_{}_{}_{}_{}_{}.tif", "north", 0, iteration)
    stored = spark.read.parquet(folder)
    assert sorted((r["iteration"], r["col"]) for r in stored.collect()) == [(1, 1), (2, 0), (2, 1)]
    frame = spark.createDataFrame([METRICS_ROW], tables.METRICS)
    for _ in range(2):
        tables.write_csv(frame, str(tmp_path / "m"), single_file=True)
    assert tables.read_metrics(spark, str(tmp_path / "m")).count() == 1


def test_usage_counts_join_each_name_once(spark):
    pool = spark.createDataFrame([(n, i, 0) for i, n in enumerate("abc")], "name string, col bigint, row bigint")
    rows = spark.createDataFrame([("a", "train")] * 500 + [("b", "validate"), ("x", "train")], "name string, usage string")
    got = sites.usage_counts(pool, rows)
    assert sorted(tuple(r) for r in got.collect()) == [("a", 0, 0, "train", 500), ("b", 1, 0, "validate", 1)]
