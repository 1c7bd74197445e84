import random

import pytest

from tilecast.operators.ranking import running_totals, smallest


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(5)
    # A third of all rows share one value.
    rows = [(i, 0.25 if i % 3 == 0 else rng.randrange(40) / 64) for i in range(600)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id bigint, v double").repartition(7).cache()


@pytest.mark.parametrize("slice_rows", [10**6, 7])
def test_running_totals(spark, values, slice_rows):
    counts = values.groupBy("v").count()
    got = running_totals(counts, "v", ["count"], slice_rows).collect()
    everything = [r.v for r in values.collect()]
    assert len(got) == len(set(everything))
    for r in got:
        assert r["before_count"] == sum(v < r.v for v in everything)


def test_running_totals_of_nothing(spark, values):
    assert running_totals(values.where("v > 9"), "v", ["id"]).isEmpty()


@pytest.mark.parametrize("n", [0, 1, 37, 150, 222, 599, 600, 900])
def test_cut_off_selects_what_a_sort_selects(values, n):
    expected = sorted((r.v, r.id) for r in values.collect())[:n]
    for limit in (10**6, -1):
        got = smallest(values, n, "v", "id", max_limit=limit).collect()
        assert sorted((r.v, r.id) for r in got) == expected


def test_large_selection_has_no_single_partition(values):
    plan = smallest(values, 222, "v", "id", max_limit=0)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan


@pytest.fixture(scope="module")
def gaps(spark):
    rng = random.Random(6)
    choices = [None, float("nan"), 0.5, 0.25, 0.125, -1.0]
    rows = [(i, rng.choice(choices)) for i in range(120)]
    return spark.createDataFrame(rows, "id bigint, v double").repartition(5).cache()


@pytest.mark.parametrize("n", [0, 1, 2, 30, 79, 80, 81, 119, 120, 130])
def test_missing_values_come_last_in_both_paths(gaps, n):
    def rank(r):
        return (r.v is None or r.v != r.v, r.v if r.v is not None and r.v == r.v else 0, r.id)

    expected = [r.id for r in sorted(gaps.collect(), key=rank)][:n]
    for limit in (10**6, -1):
        assert sorted(r.id for r in smallest(gaps, n, "v", "id", max_limit=limit).collect()) == sorted(expected)


@pytest.mark.parametrize("slice_rows", [10**6, 2, 1])
def test_running_totals_keep_missing_values(gaps, slice_rows):
    counts = gaps.groupBy("v").count()
    got = [(r.v, r["before_count"]) for r in running_totals(counts, "v", ["count"], slice_rows).collect()]
    assert len(got) == 6
    before = 0
    for v, total in sorted(got, key=lambda r: (r[0] is None, r[0] is not None and r[0] != r[0], r[0] or 0)):
        assert total == before
        same = gaps.where("v is null") if v is None else gaps.where("isnan(v)") if v != v else gaps.where(f"v = {v}")
        before += same.count()


def test_nothing_but_missing_values(spark):
    df = spark.createDataFrame([(i, None) for i in range(9)], "id bigint, v double")
    for limit in (10**6, -1):
        assert sorted(r.id for r in smallest(df, 4, "v", "id", max_limit=limit).collect()) == [0, 1, 2, 3]
