import math

import pytest
from pyspark.sql import functions as F

from tilecast.functions.columns import poisson_draw, uniform
from tilecast.operators import sampling as S


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20000).select("id", (F.col("id") % 10 == 0).cast("int").alias("mask")).cache()


def ids(df):
    return sorted(tuple(r) for r in df.collect())


def test_numbers_are_uniform(rows):
    r = rows.select(uniform(3, "id").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u"), F.var_pop("u")).first()
    assert 0 <= r[0] < 0.001 and 0.999 < r[1] < 1
    assert r[2] == pytest.approx(0.5, abs=0.01) and r[3] == pytest.approx(1 / 12, abs=0.002)


@pytest.mark.parametrize("rate", [0.1, 1.7, 7.9, 20.5])
def test_poisson_moments(rows, rate):
    drawn = S.poisson_sample(rows, rate, 1, ["id"])
    total, squares = drawn.agg(F.sum("drawn"), F.sum(F.col("drawn") * F.col("drawn"))).first()
    mean = total / 20000
    assert mean == pytest.approx(rate, rel=0.05)
    assert squares / 20000 - mean**2 == pytest.approx(rate, rel=0.07)


def test_samples_do_not_depend_on_partitioning(rows):
    for sample in (
        lambda df: S.poisson_sample(df, 0.1, 7, ["id"]),
        lambda df: S.bernoulli_sample(df, 0.02, 7, ["id"]),
        lambda df: S.take_sample(df, 50, 7, ["id"], "id"),
        lambda df: S.balance_samples(df, "mask", 7, ["id"]).groupBy("id").count(),
    ):
        assert ids(sample(rows.repartition(3))) == ids(sample(rows.repartition(11, "mask")))


def test_seeds_differ(rows):
    assert ids(S.take_sample(rows, 50, 1, ["id"], "id")) != ids(S.take_sample(rows, 50, 2, ["id"], "id"))


def test_take_sample_is_exact_or_everything(rows):
    assert S.take_sample(rows, 123, 1, ["id"], "id").count() == 123
    assert S.take_sample(rows.where("id < 5"), 123, 1, ["id"], "id").count() == 5


def test_bernoulli_of_everything(rows):
    assert S.bernoulli_sample(rows, 1.0, 1, ["id"]).count() == 20000


def test_classes_come_out_even(rows):
    counts = {r["mask"]: r["count"] for r in S.balance_samples(rows, "mask", 1, ["id"]).groupBy("mask").count().collect()}
    assert counts[0] == pytest.approx(10000, rel=0.03) and counts[1] == pytest.approx(10000, rel=0.04)


def test_weights_equal_repeated_rows(rows):
    weights = S.balance_weights(rows, "mask", 1, ["id"])
    repeated = S.balance_samples(rows, "mask", 1, ["id"]).groupBy("id").count()
    assert ids(weights.select("id", "drawn")) == ids(repeated)


def test_copies_count_as_rows(rows):
    listed = rows.withColumn("copies", F.when(F.col("mask") == 1, 3).otherwise(1))
    assert S.balance_rates(listed, "mask", "copies") == pytest.approx({0: 24000 / 36000, 1: 24000 / 12000})
    sums = S.balance_weights(listed, "mask", 1, ["id"], copies="copies").groupBy("mask").agg(F.sum("drawn")).collect()
    assert {r[0]: r[1] for r in sums} == pytest.approx({0: 12000, 1: 12000}, rel=0.03)


def test_missing_class_is_named(rows):
    with pytest.raises(ValueError, match="class 1"):
        S.balance_rates(rows.where("mask = 0"), "mask")


def test_unlabelled_rows_count_on_request(rows):
    more = rows.unionByName(rows.withColumn("mask", F.lit(None).cast("int")))
    assert S.balance_rates(more, "mask")[1] == pytest.approx(5.0)
    assert S.balance_rates(more, "mask", keep_unlabelled=True)[1] == pytest.approx(10.0)


@pytest.mark.parametrize("mean", [0.1, 3.0, 9.9, 10.0, 11.0, 35.0, 1000.0, 1e6])
def test_draws_of_any_mean_have_its_moments(rows, mean):
    drawn = rows.select(poisson_draw(F.lit(mean), 4, "id").alias("n"))
    r = drawn.agg(F.avg("n"), F.var_pop("n"), F.min("n"), F.skewness("n")).first()
    assert r[0] == pytest.approx(mean, abs=5 * (mean / 20000) ** 0.5)
    assert r[1] == pytest.approx(mean, rel=0.06)
    assert r[2] >= 0 and r[3] == pytest.approx(mean**-0.5, abs=0.12)


def test_small_means_are_inverted_without_spare_steps(rows):
    """Draws are the whole inversion's, at all numbers; a mean near one takes far fewer than 80 steps."""
    def whole(u, mean):
        term = total = math.exp(-mean)
        n = 0
        for i in range(1, 81):
            n += u >= total
            term *= mean / i
            total += term
        return n

    means = rows.withColumn("mean", F.col("id") % 999 / 100)
    drawn = means.select("mean", uniform(4, "id").alias("u"), poisson_draw(F.col("mean"), 4, "id").alias("n"))
    assert all(r.n == whole(r.u, r.mean) for r in drawn.collect())
    assert "sequence(1, 80" not in drawn._jdf.queryExecution().analyzed().toString()


def test_many_copies_cost_no_more_numbers(rows):
    listed = rows.withColumn("copies", F.lit(10_000_000))
    sums = S.balance_weights(listed, "mask", 1, ["id"], copies="copies").agg(F.sum(F.col("drawn").cast("bigint"))).first()[0]
    assert sums == pytest.approx(20000 * 10_000_000, rel=1e-4)
