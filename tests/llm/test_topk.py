import math

import numpy as np
import pytest
from quarrymill.llm import topk as op
from quarrymill.llm.common import Scratch


def brute(rows, queries, k):
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ints if i in queries}):
        v = min(w for i, w in ints if i == q)
        s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


def run(spark, rows, queries, k):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<double>, score string").repartition(3)
    return sorted(tuple(r) for r in op.top_k(df, df.where(df.vec_id.isin(list(queries))), k).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("kind", ["mixed", "unit", "near"])
def test_against_all_products(spark, kind):
    r = np.random.default_rng(4)
    v = r.normal(size=(400, 8))
    if kind == "mixed":
        v *= np.exp(r.normal(size=(400, 1)))
    else:
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    if kind == "near":
        v[200:] = v[:200] + 0.01 * r.normal(size=(200, 8))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(500, [0.0] * 8), (501, rows[3][1]), (502, rows[3][1]), (503, None), (504, [math.nan] * 8), (505, [1.0, None] * 4), (506, [1.0, 2.0]), (507, [3.0, 4.0]), (None, rows[0][1]), (7, rows[9][1])]
    queries = {0, 3, 7, 100, 250, 500, 501, 506, 504}
    assert run(spark, rows, queries, 10) == brute(rows, queries, 10)


@pytest.mark.parametrize("length", ["unit", "spread"])
def test_queries_skip_cones_that_they_cannot_reach(spark, length):
    """Vectors of a few directions: the same answers, from fewer blocks."""
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 16))
    v = centres[np.arange(1200) % 12] + 0.05 * r.normal(size=(1200, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    if length == "spread":
        v *= np.exp(0.3 * r.normal(size=(1200, 1)))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    queries = set(range(0, 1200, 40))
    asked = df.where(df.vec_id.isin(list(queries)))
    got = op.top_k(df, asked, 10, block_bytes=16 * 8 * 60, pivot_rows=100)
    assert sorted(tuple(x) for x in got.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, queries, 10)
    sent, held = op._sent_and_held(spark, Scratch(spark), df, asked, 10, op.SCALE, 16 * 8 * 60, 100)
    blocks = held.select("dim", "cls", "pivot", "block").distinct().count()
    assert sent.count() <= 0.4 * blocks * len(queries)


def test_few_and_none(spark):
    rows = [(1, [0.5]), (2, [0.25])]
    assert run(spark, rows, {1, 2}, 10) == brute(rows, {1, 2}, 10) == [(1, 1, 2, 512 * 256), (2, 1, 1, 512 * 256)]
    assert run(spark, [], {1}, 10) == [] and run(spark, [(1, None)], {1}, 10) == []


def test_large_integers_stay_exact():
    q = np.array([[2**30, 1]], np.int64)
    assert op.products(q, q)[0, 0] == 2**60 + 1
