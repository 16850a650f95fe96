import math
import random

import numpy as np
import pytest

from rasmlens.llm import search

SCHEMA = "vec_id long, embedding array<float>, label int, length double, block int, v string, side string"


def plain(rows, queries, k, scale):
    def whole(v):
        if not v or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(scale * x) for x in v]

    kept = [(id, w) for id, v in rows if id is not None and (w := whole(v)) is not None]
    asked = {}
    for id, v in queries:
        if id is not None and (w := whole(v)) is not None:
            asked[id] = min(w, asked.get(id, w))
    out = []
    for q, w in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(w, c)), id) for id, c in kept if id != q)
        out += [(q, i + 1, id, -s) for i, (s, id) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, queries, k=20, **sizes):
    frame = lambda rs: spark.createDataFrame([(*r, 1, 0.5, 2, "v", "s") for r in rs], SCHEMA)
    out = search.top_k(frame(rows), frame(queries), k, 64.0, **sizes)
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())


def f32(x):
    return float(np.float32(x))


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 40, "seed_rows": 25}])
def test_against_plain(spark, sizes):
    rng = random.Random(3)
    vector = lambda n: [f32(rng.gauss(0, 1) * rng.choice([0.1, 1, 4]) / (1 + i)) for i in range(n)]
    rows = [(i, vector(12)) for i in range(700)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(60)]  # ties
    rows += [(2000, None), (2020, []), (2040, [None] * 12), (2060, [float("nan")] * 12), (2080, [float("inf")] * 12),
             (None, vector(12)), (2100, [0.0] * 12), (2120, vector(5)), (20, rows[20][1])]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    assert run(spark, rows, queries, 7, **sizes) == plain(rows, queries, 7, 64.0)


def test_one_common_vector(spark):
    """A third of all rows are one vector; ids break the ties."""
    rng = random.Random(4)
    common = [f32(rng.gauss(0, 1)) for _ in range(8)]
    rows = [(i, common if i % 3 == 0 else [f32(rng.gauss(0, 1)) for _ in range(8)]) for i in range(600)]
    queries = [r for r in rows if r[0] % 20 == 0]
    assert run(spark, rows, queries, 20, block_rows=64, seed_rows=30) == plain(rows, queries, 20, 64.0)


def test_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert run(spark, rows, rows[:1]) == plain(rows, rows[:1], 20, 64.0)
    assert run(spark, rows[:1], rows[:1]) == []
    assert run(spark, [], []) == []
    assert run(spark, rows, []) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [f32(3e6 + 977 * i), f32(-2e6 + i), f32(1e6 * i)]) for i in range(30)]
    assert run(spark, rows, rows[:1], 5) == plain(rows, rows[:1], 5, 64.0)


def test_query_against_plain(spark, sf_dir):
    from rasmlens.llm.queries import op10_norm_sorted_search
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in op10_norm_sorted_search(spark, sf_dir).collect())
    assert got == plain(rows, [r for r in rows if r[0] % 20 == 0], 20, 64.0)
