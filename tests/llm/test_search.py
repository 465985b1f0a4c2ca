"""Exact top-k search against its SQL twin and brute force."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkflow.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, score string, shard int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def answers(df, **kw):
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 100 == 0, **kw).collect()))


def vectors(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, d)).astype(np.float32)
    v[n // 2:] = v[rng.integers(0, 5, n - n // 2)]  # many equal rows: ties
    return [(int(i), v[i].tolist()) for i in range(n)]


@pytest.mark.parametrize("shards", [dict(), dict(shard_rows=64, block_rows=2)])
def test_equals_the_sql_twin(spark, shards):
    rows = vectors(450)
    random.Random(1).shuffle(rows)
    con = duckdb.connect()
    embeddings = pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))})
    con.register("embeddings", embeddings)
    want = sorted(con.execute(topk.ORACLE).fetchall())
    assert answers(table(spark, rows), **shards) == want


def test_pruning_keeps_every_best_row():
    """One shard of several chunks with few strong terms, so that rows are dropped early."""
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((20, 5000)) * np.geomspace(2000, 1, 20)[:, None])
    ids = np.arange(5000)
    for j in range(8):
        q = np.floor(rng.standard_normal(20) * np.geomspace(2000, 1, 20))
        got = topk.search_one(x, ids, q, j, 10, x.min(axis=1), x.max(axis=1))
        score = q @ x
        want = sorted(((-score[i], i) for i in range(5000) if i != j))[:10]
        assert [(-s, i) for s, i in got] == want


def test_awkward_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf")]), (4, []), (5, [0.5]), (5, [0.5]),
            (None, [1.0]), (6, [1.0, None]), (100, [-1.0, 0.25, 3.0]), (7, [1e30])]
    got = answers(table(spark, rows))
    ints = {0: [1024, 2048], 4: [], 5: [512], 100: [-1024, 256, 3072], 7: [int(np.floor(1024 * np.float64(np.float32(1e30))))]}
    want = []
    for q in (0, 100):
        found = sorted((-sum(a * b for a, b in zip(ints[q], v, strict=False)), i) for i, v in ints.items() if i != q)
        want += [(q, r + 1, i, max(-2**63, min(2**63 - 1, -s))) for r, (s, i) in enumerate(found)]
    assert got == sorted(want)
    assert answers(table(spark, [])) == []
    assert answers(table(spark, [(0, [1.0])])) == []
