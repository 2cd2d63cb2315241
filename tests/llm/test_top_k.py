"""Top-k search against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import top_k

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    clean = []
    for i, (vec_id, vector, _) in enumerate(rows):
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            clean.append((i, vec_id, [math.floor(float(np.float32(x)) * 1024) for x in vector]))
    want = []
    for i, query_id, q in clean:
        if query_id is None or query_id % every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v, strict=True)), d is None, d or 0, d) for j, d, v in clean if j != i and len(v) == len(q)]
        want += [(query_id, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(want, key=str)


def unit(dim):
    v = [random.gauss(0, 1) for _ in range(dim)]
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v]


@pytest.mark.parametrize("dim, count, shard_rows", [(3, 900, 200), (16, 700, 90), (1, 300, 100)])
def test_top_k(spark, dim, count, shard_rows):
    random.seed(dim)
    rows = [(i, unit(dim), 1) for i in range(count)]
    rows += [(count + i, rows[7][1], 1) for i in range(count // 2)]  # a very common vector: ties
    rows += [(30, unit(dim), 1), (30, rows[30][1], 1), (None, rows[7][1], 1), (5000, None, 1), (5010, [None] * dim, 1), (5020, [float("nan")] * dim, 1)]
    rows += [(5030, [float("inf")] * dim, 1), (5040, unit(dim + 1), 1), (5041, unit(dim + 1), 1), (5050, [], 1), (-10, [0.0] * dim, 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("rank", F.lit("x")).withColumn("row", F.lit(0)).repartition(3)
    got = top_k.top_k(df, F.col("vec_id") % 10 == 0, 10, shard_rows=shard_rows, least_rows=shard_rows)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 10, 10)
    assert top_k.top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_large_components(spark):
    random.seed(5)
    rows = [(i, [random.choice([-1, 1]) * random.random() * 1e5 for _ in range(4)], 1) for i in range(200)]
    got = top_k.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 20 == 0, 3, shard_rows=64, least_rows=64)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 3, 20)


def test_search_leaves_most_leaves_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(50, 8)) * 1000
    vectors = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(10000, 8)))
    tree = top_k.Tree(vectors, np.arange(10000), np.arange(10000))
    scanned = []
    products = tree.products
    tree.products = lambda q, v: scanned.append(len(v)) or products(q, v)
    query = vectors[123]
    places, scores = tree.search(query, tree.bounds(query[None])[0], 123, 10, None)
    exact = np.delete(vectors @ query, 123)
    assert sorted(scores, reverse=True) == sorted(exact.astype(int).tolist(), reverse=True)[:10]
    assert sum(scanned) < 2000
