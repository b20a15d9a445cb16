"""Vector operators against brute force, over nulls, ties, repeats, odd lengths and clashing columns."""

import numpy as np
import pytest

from codequarry.llm import curves, exact_topk
from codequarry.llm.vectors import usable

NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    listed = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    listed += [(400 + i, [1.0] * 8) for i in range(60)]  # one vector many times
    listed += [(500, [0.0] * 8), (501, [-1e-9] * 8), (502, [2.0, 3.0])]
    return listed


@pytest.fixture(scope="module")
def table(spark, vectors):
    odd = [(600, None), (601, [1.0, None] * 4), (602, [NAN] * 8), (603, [INF] * 8), (None, [1.0] * 8), vectors[7]]
    rows = [(i, v, None, "x", 0.5) for i, v in vectors + odd]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, block string, score double").repartition(4)


def _as_float(vectors):
    return [(i, np.pad(np.array(v, np.float32).astype(np.float64), (0, 8 - len(v)))) for i, v in vectors]


def _ranked(vectors, queries, k, measure):
    out = []
    for i, q in queries:
        scored = sorted((-measure(q, v), j) for j, v in vectors if j != i)[:k]
        out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [4096, 50])
def test_exact_topk(table, vectors, block_rows):
    whole = [(i, np.pad(np.floor(256 * np.array(v, np.float32).astype(np.float64)), (0, 8 - len(v)))) for i, v in vectors]
    found = exact_topk.quantized(table)
    result = exact_topk.top_k(found, found.filter("vec_id % 20 = 0"), 5, block_rows)
    expected = _ranked(whole, [x for x in whole if x[0] % 20 == 0], 5, lambda a, b: int(a @ b))
    assert sorted(map(tuple, result.collect())) == expected


def test_exact_topk_with_few_candidates(spark):
    rows = spark.createDataFrame([(0, [1.0]), (1, [-2.0]), (2, [])], "vec_id long, embedding array<double>")
    found = exact_topk.quantized(rows)
    result = exact_topk.top_k(found, found.filter("vec_id = 0"), 5)
    assert sorted(map(tuple, result.collect())) == [(0, 1, 2, 0), (0, 2, 1, -131072)]
    assert exact_topk.top_k(found.limit(0), found.limit(0), 5).count() == 0
    assert exact_topk.top_k(found, found.limit(0), 5).count() == 0


def test_exact_topk_refuses_scores_beyond_a_long(spark):
    rows = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        exact_topk.top_k(exact_topk.quantized(rows), exact_topk.quantized(rows), 1)


def test_exact_topk_of_large_components(spark):
    values = [3e5, -7e5, 1e6, 123456.789]
    rows = spark.createDataFrame([(i, [v, v / 3]) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    found = exact_topk.quantized(rows)
    whole = [(i, [int(np.floor(256 * v)), int(np.floor(256 * (v / 3)))]) for i, v in enumerate(values)]
    expected = _ranked(whole, whole, 3, lambda a, b: a[0] * b[0] + a[1] * b[1])
    assert sorted(map(tuple, exact_topk.top_k(found, found, 3).collect())) == expected


def test_nearest_over_one_block_is_exact(table, vectors):
    every = [(i, v) for i, v in _as_float(vectors) if v.any()]
    found = usable(table)
    result = curves.nearest(found, found.filter("vec_id % 20 = 0"), 20)
    measure = lambda a, b: float(np.cumsum(a * b)[-1])
    expected = _ranked(every, [x for x in every if x[0] % 20 == 0], 20, measure)
    assert sorted(map(tuple, result.collect())) == expected


def test_nearest_over_many_blocks_finds_most(table, vectors):
    every = [(i, v) for i, v in _as_float(vectors) if v.any()]
    queries = [x for x in every if x[0] % 5 == 0]
    found = usable(table)
    result = curves.nearest(found, found.filter("vec_id % 5 = 0"), 20, block_rows=16).collect()
    expected = _ranked(every, queries, 20, lambda a, b: float(np.cumsum(a * b)[-1]))
    score = {(i, j): s for i, _, j, s in expected}
    assert all(r.score == score[r.query_id, r.vec_id] for r in result if (r.query_id, r.vec_id) in score)
    hits = {(r.query_id, r.vec_id) for r in result} & score.keys()
    assert len(hits) >= 0.85 * len(expected)
    assert all(r.query_id != r.vec_id for r in result)


def test_nearest_of_nothing(spark, table):
    found = usable(table)
    assert curves.nearest(found.limit(0), found, 5).count() == 0
    assert curves.nearest(found, found.limit(0), 5).count() == 0
    zeros = spark.createDataFrame([(0, [0.0])], "vec_id long, embedding array<float>")
    assert curves.nearest(usable(zeros), usable(zeros), 5).count() == 0


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = curves.hilbert_keys(cells, bits)
    assert sorted(keys.tolist()) == list(range(1 << (bits * dims)))
    walked = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walked, axis=0)).sum(axis=1) == 1).all()
