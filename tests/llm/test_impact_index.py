"""Top k against scores of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stellate.llm import impact_index as I


def brute(rows, k, asks):
    ok = [(n, i, [math.floor(1024 * float(x)) for x in v]) for n, (i, v) in enumerate(rows)
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if asks(i):
            s = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for m, j, v in ok if m != n]
            out += [(i, r, x[3], -x[0]) for r, x in enumerate(sorted(s)[:k], 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("block,queries", [(4096, 1024), (7, 2)])
def test_matches_all_pairs(spark, block, queries):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.1, 8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # a common vector: ties by id
    rows += [(300, None), (301, [0.1, None] + [0.0] * 6), (302, [float("nan")] * 8), (303, [float("inf")] * 8),
             (304, []), (305, [0.5]), (100, [0.0] * 8), (100, [0.1] * 8), (None, [0.2] * 8), (400, [-0.3] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3) \
        .withColumn("row", F.lit(1)).withColumn("v", F.lit(2)).withColumn("score", F.lit(3))
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = I.top_k(df, F.col("vec_id") % 50 == 0, k=10, block=block, query_block=queries).collect()
    want = brute(rows, 10, lambda i: i is not None and i % 50 == 0)
    assert sorted(str((r.query_id, r["rank"], r.vec_id, r.score)) for r in got) == want


@pytest.mark.parametrize("spread", [3, 400, 10**7])
def test_search_keeps_all_of_the_best(spread):
    rng = np.random.default_rng(spread)
    x = np.rint(rng.normal(0, spread, (3000, 12)) * np.linspace(3, 0.1, 12)).astype(np.int64)
    index, left_out = I.BlockIndex(x), 0
    for q in x[:40]:
        rows, score = index.search(q, 10, -1)
        assert (score == x[rows] @ q).all()
        assert (np.sort(score)[-10:] == np.sort(x @ q)[-10:]).all()
        left_out += len(x) - len(rows)
    assert left_out > 0  # some proof ended a search


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    ask = F.col("vec_id") % 100 == 0
    assert I.top_k(spark.createDataFrame([], schema), ask).count() == 0
    assert I.top_k(spark.createDataFrame([(100, [1.0])], schema), ask).count() == 0
    assert I.top_k(spark.createDataFrame([(100, None), (1, [1.0])], schema), ask).count() == 0
    got = I.top_k(spark.createDataFrame([(100, [1.0]), (7, [0.5])], schema), ask).collect()
    assert [tuple(r) for r in got] == [(100, 1, 7, 1024 * 512)]
