import math
import random

import numpy as np
import pytest
from corpusloom.llm import topk
from pyspark.sql import functions as F


def brute(rows, k, scale=256.0):
    whole = []
    for n, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((n, i, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for n, i, q in whole:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for m, j, v in whole if m != n)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 16])
def test_best_are_those_of_all_scores(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(block)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 7) for _ in range(12)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 12) for i in range(60)]
    rows += [(2000, None), (2050, []), (2100, [1.0, None]), (2150, [float("nan")] * 12), (2200, [float("inf")] * 12), (None, [1.0] * 12)]
    rows += [(2250, [1.0, -2.0]), (100, rows[100][1]), (2300, [0.0] * 12)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(frame, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5)


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, rank int, score int"
    few = spark.createDataFrame([(0, [1.0], 1, 1), (1, [2.0], 1, 1)], schema)
    got = topk.top_k(few, "vec_id", "embedding", F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 131072)]
    assert topk.top_k(few.limit(0), "vec_id", "embedding", F.col("vec_id") % 50 == 0).collect() == []


def test_exact_beyond_doubles():
    a = np.array([[2.0**40, 3.0]])
    assert topk.exact_scores(a, np.array([[2.0**20, 5.0]])).tolist() == [2**60 + 15]
    assert topk.exact_scores(a, np.array([[2.0**40, 5.0]])).tolist() == [2**63 - 1]
