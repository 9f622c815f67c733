import hashlib
import math

import numpy as np
import pytest
from corpusloom.llm.centroids import Centroids, cluster

LONG = 2**63 - 1


def brute(rows, k, rounds, width, scale):
    """The contract in Python integers; rows are (id, list)."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(x * scale) for x in v]))
    name = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], float).tobytes())
    centres = [v for _, v in sorted(kept, key=name)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        own = {}
        for _, v in kept:
            own.setdefault(nearest(v)[1], []).append(v)
        for n, vs in own.items():
            centres[n] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = min(sum(min(d, LONG) for _, d, _ in last), LONG)
    out = []
    for i, d, n in last:
        inertia = min(sum(min(e, LONG) for _, e, m in last if m == n), LONG)
        digest = hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest()
        out.append((i, n, min(d, LONG), inertia, total, digest))
    return sorted(out, key=repr)


def run(spark, rows, k=3, rounds=3, width=4, scale=256.0):
    schema = "key long, vector array<double>, id int, cluster string, distance long, mean int, vec binary"
    frame = spark.createDataFrame([(*r, 1, "c", 2, 3, b"v") for r in rows], schema)
    found = cluster(frame, "key", "vector", k, rounds, width, scale)
    columns = ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in found.select(columns).collect()), key=repr)


@pytest.mark.parametrize("kind, most", [(np.int64, 4), (np.int64, 40), (object, 4)])
def test_walk_finds_the_nearest_and_the_smaller_of_ties(kind, most):
    draw = np.random.default_rng(most)
    vectors = draw.integers(-most, most, size=(300, 5)).astype(kind)
    centres = vectors[:9].copy()
    centres[6] = centres[2]
    best, distance = Centroids(centres).nearest(vectors)
    all_pairs = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (best == all_pairs.argmin(axis=1)).all() and (distance == all_pairs.min(axis=1)).all()


def test_clusters_equal_plain_rounds(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.normal(size=4) + 4 * (i % 3)).tolist()) for i in range(200)]
    assert run(spark, rows) == brute(rows, 3, 3, 4, 256.0)


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [1.0] * 3), (4, [1.0, None, 0.0, 0.0]), (5, [1.0, math.nan, 0.0, 0.0])]
    rows += [(6, [math.inf, 0.0, 0.0, 0.0]), (None, [0.5, -0.5, 0.25, 0.0]), (7, [0.0] * 4), (7, [0.0] * 4), (8, [-3.1, 0.1, 9.0, 2.0])]
    assert run(spark, rows) == brute(rows, 3, 3, 4, 256.0)


def test_components_beyond_64_bits(spark):
    rows = [(i, [1e30 * (i % 3), float(i), -2e25 * i, 1.0]) for i in range(9)] + [(20, [0.0, 1.0, 2.0, 3.0])]
    assert run(spark, rows) == brute(rows, 3, 3, 4, 256.0)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [1.0, 2.0, 3.0, 4.0]), (2, [0.0, 0.0, 0.0, 1.0])]
    assert run(spark, rows) == brute(rows, 3, 3, 4, 256.0)
    assert run(spark, []) == []
