"""Exact search, the registered queries, and the pipeline."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as spec
import corpus_pipeline
from check import TABLES, compare
from tilecast.llm import bpe, oracle, queries, topk

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("block, query_block", [(7, 3), (4096, 512)])
def test_top_k_against_brute_force(spark, block, query_block):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in np.round(rng.normal(size=(120, 6)), 1)]  # many ties
    rows = list(enumerate(vectors)) + [(200, None), (201, [1.0, None]), (202, [float("nan")] * 6), (203, [float("inf")]), (204, []), (205, [1.0] * 3), (None, [9.0] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string")
    found = topk.quantised(df)
    got = topk.top_k(found.where("vec_id % 10 = 0 or vec_id = 204"), found, 5, block, query_block).collect()
    ints = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = []
    for q in ints:
        if q % 10 == 0 or q == 204:
            scores = []
            for c in ints:
                n = min(len(ints[q]), len(ints[c]))
                if c != q:
                    scores.append((-int(ints[q][:n] @ ints[c][:n]) if n else 0, c))
            want += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scores)[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_few_or_none(spark):
    df = topk.quantised(spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>"))
    assert sorted(map(tuple, topk.top_k(df, df).collect())) == [(0, 1, 1, 131072), (1, 1, 0, 131072)]
    assert topk.top_k(df.where("false"), df).count() == topk.top_k(df, df.where("false")).count() == 0


@pytest.mark.parametrize("big", [2.0**30, 2.0**22])
def test_top_k_of_large_numbers_is_exact(big):
    rng = random.Random(1)
    x = np.array([[int(rng.random() * big) for _ in range(4)] for _ in range(50)])
    q = x[:3]
    got = topk.block_top(x, np.arange(50), q, np.arange(3), 5)
    for i in range(3):
        want = sorted(((-sum(int(a) * int(b) for a, b in zip(q[i], x[j])), j) for j in range(50) if j != i))[:5]
        assert sorted(zip(-got[2][got[0] == i], got[1][got[0] == i])) == want


def test_most_queries_stop_before_their_lists_end():
    rng = np.random.default_rng(5)
    x = np.floor(rng.normal(size=(2000, 32)) * 40).astype(np.int64)
    x[7], q = 0, x[:40]
    q[3] = 0  # a query that weighs nothing reads nothing
    ids = np.arange(2000)
    scores = q @ x.T
    scores[np.arange(40), np.arange(40)] = -(10**12)
    want = [[(-int(s), int(c)) for s, c in sorted(zip(-row, ids))[:5]] for row in scores]
    floors = [sorted(row[:500])[-5] for row in scores]
    for given in (None, floors, [w[-1][0] for w in want]):
        depths = []
        got = topk.block_top(x, ids, q, ids[:40], 5, floors=given, depths=depths)
        assert [[(int(s), int(c)) for s, c in zip(got[2][got[0] == i], got[1][got[0] == i])] for i in range(40)] == want
        read = np.array(depths)
        assert (read < 2000).any(axis=1).mean() > 0.5 and read.mean() < 2000 and not read[3].any()
    # A bound above all that a block can give leaves its lists unread.
    depths = []
    assert not len(topk.block_top(x, ids, q[:3], ids[:3], 5, floors=[10**7] * 3, depths=depths)[0])
    assert not np.array(depths).any()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, con, name):
    good, text = compare(spark, con, DATA, name, queries.queries()[name], oracle.oracle_sql().get(name))
    assert good, text


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.queries()) == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(spec.queries())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == names
        docs = docs.cache()
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3]  # rejected, deduplicated, only rewritten
    assert docs.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    tik = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    )
    want = sorted((r.doc_id, hashlib.sha256(" ".join(map(str, tik.encode_ordinary(r.text))).encode()).hexdigest()) for r in docs.collect())
    final = corpus_pipeline.run(spark, DATA).select("doc_id", "ids_sha256")
    assert sorted(map(tuple, final.collect())) == want


def test_pipeline_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DATA)
        assert docs.count() == 0
