"""How blocks and queries of the exact search meet: nothing that grows with the input is sent to the driver."""

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm import topk


def table(spark, n: int, width: int = 8, seed: int = 4):
    rng = np.random.default_rng(seed)
    x = np.floor(rng.normal(size=(n, width)) * 60).astype(np.int64)
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, v array<bigint>")


def brute(x: np.ndarray, asking: np.ndarray, k: int = 5) -> list:
    want = []
    for q in asking:
        best = sorted((-int(s), int(c)) for c, s in enumerate(x @ x[q]) if c != q)[:k]
        want += [(int(q), r, c, -s) for r, (s, c) in enumerate(best, 1)]
    return sorted(want)


def test_copies_of_queries_are_never_broadcast(spark, monkeypatch):
    x, df = table(spark, 3000)
    df = df.repartition(3)
    plans, write = [], topk.materialize
    monkeypatch.setattr(topk, "materialize", lambda t, name="table": (plans.append(t), write(t, name))[1])
    found = topk.top_k(df.where("vec_id % 10 = 0"), df, 5, block=64, query_block=16)
    assert sorted(map(tuple, found.collect())) == brute(x, np.arange(0, 3000, 10))
    for plan in (*plans, found):
        # Tables this small are below every threshold, as are the files of queries before they are copied.
        assert "Broadcast" not in plan._jdf.queryExecution().executedPlan().toString()


def test_no_candidate_is_lost_when_spark_deals_to_more_parts(spark, monkeypatch):
    x, df = table(spark, 400)
    for kind in {DataFrame, type(df)}:
        monkeypatch.setattr(kind, "repartition", lambda self, n, *cols, f=kind.repartition: f(self, max(n, 13), *cols))
    got = topk.top_k(df.where("vec_id % 50 = 0"), df, 5, block=150)
    assert sorted(map(tuple, got.collect())) == brute(x, np.arange(0, 400, 50))


def test_parts_with_more_blocks_than_one(spark, monkeypatch):
    x, df = table(spark, 400)
    monkeypatch.setattr(topk, "TASKS", 2)  # and tasks with several blocks
    for kind in {DataFrame, type(df)}:
        monkeypatch.setattr(kind, "repartition", lambda self, n, *cols, f=kind.repartition: f(self, 3, F.expr("if(vec_id < 300, 0, vec_id)")))
    got = topk.top_k(df.where("vec_id % 50 = 0"), df, 5, block=70)
    assert sorted(map(tuple, got.collect())) == brute(x, np.arange(0, 400, 50))


@pytest.mark.parametrize("big", [0, 1, 127, 128, -128, -129, 2**15, -(2**31), 2**31, 2**62, -(2**63)])
def test_packed_integers_are_the_same(big):
    values = np.array([0, 3, big, -1], np.int64)
    packed = topk._narrow(values)
    assert (topk._wide(packed.tobytes(), 4) == values).all()
    assert packed.itemsize == next(n for n in (1, 2, 4, 8) if -(2 ** (8 * n - 1)) <= big < 2 ** (8 * n - 1))
    assert topk._wide(b"", 0).dtype == np.int64 and not len(topk._wide(b"", 0))
