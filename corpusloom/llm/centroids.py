"""Centroid clustering of whole-number vectors, assigned by the threshold algorithm.

Every dimension keeps its centroids sorted by that component. A vector enters
each list at its own value and walks outward, one centroid per list and step;
each centroid met for the first time gets its exact distance. A centroid not met
yet lies, in every dimension, at least as far as that list's frontier, so once
the sum of the squared frontiers strictly exceeds the best exact distance, no
other centroid can be nearer or tie. All vectors of a batch walk together.

Centroids (`k` rows of `width` whole numbers, both parameters) are what goes to
every task. Sums of a round leave a task as one row per centroid and meet per
centroid; sums and means are exact at any size.

Defined results: a vector that is null, has another number of components or
holds a null or non-finite one takes no part; a row without an id takes part and
ranks among the first centroids by an empty id; repeated rows each count; with
fewer than `k` vectors there are fewer centroids; distances and sums beyond 64
bits stand at the end of the range; an empty table gives no rows; other
columns are ignored. A component that scaling takes out of the range of doubles
is non-finite.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import Workspace

#: Beyond this size of a component, distances are summed in Python integers.
_SMALL = 1 << 22
_BATCH = 256
_LONG = (1 << 63) - 1


def _numbers(cells: list[bytes], width: int) -> np.ndarray:
    """Stored vectors as whole numbers: 64-bit ones, or Python's where those could overflow."""
    vectors = np.frombuffer(b"".join(cells), dtype=float).reshape(-1, width)
    if np.abs(vectors).max(initial=0.0) < _SMALL:
        return vectors.astype(np.int64)
    return np.array([[int(x) for x in v] for v in vectors], dtype=object).reshape(-1, width)


def _whole(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < _SMALL for row in rows for x in row)
    return np.array(rows, dtype=np.int64 if small else object)


class Centroids:
    """Centroids with their sorted lists; `nearest` assigns vectors to them."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        k = len(rows)
        order = np.array([sorted(range(k), key=column.__getitem__) for column in rows.T])
        lists = np.take_along_axis(rows.T, order, axis=1)
        # One far value at either end of a list, which stands for no centroid.
        far = 1 << (24 if rows.dtype == np.int64 else 1100)
        self.order = np.pad(order, ((0, 0), (1, 1)), constant_values=k).ravel()
        self.lists = np.pad(lists, ((0, 0), (1, 1)), constant_values=((0, 0), (-far, far))).ravel()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) per vector; ties go to the smaller number."""
        if vectors.dtype != self.rows.dtype:
            return Centroids(self.rows.astype(object)).nearest(vectors.astype(object))
        count, width = vectors.shape
        k = len(self.rows)
        unmet = _LONG if vectors.dtype == np.int64 else 1 << 2300
        exact = np.full((count, k + 1), unmet, dtype=vectors.dtype)
        # `low` and `high` are the places next to be met below and above the value.
        high = np.empty((count, width), dtype=np.int64)
        for d in range(width):
            own = slice(d * (k + 2) + 1, (d + 1) * (k + 2) - 1)
            high[:, d] = own.start + np.searchsorted(self.lists[own], vectors[:, d])
        low, x = high - 1, vectors
        walking = np.arange(count)
        below, above = x - self.lists[low], self.lists[high] - x
        for _ in range(k):
            down = below <= above
            met = self.order[np.where(down, low, high)]
            low, high = low - down, high + ~down
            new = np.zeros((len(walking), k + 1), dtype=bool)
            new[np.arange(len(walking))[:, None], met] = True
            at, centroid = np.nonzero(new[:, :k] & (exact[walking, :k] == unmet))
            apart = x[at] - self.rows[centroid]
            exact[walking[at], centroid] = (apart * apart).sum(axis=1)
            # The frontier: how far the next centroid of each list is at least.
            below, above = x - self.lists[low], self.lists[high] - x
            frontier = np.minimum(below, above)
            on = (frontier * frontier).sum(axis=1) <= exact[walking].min(axis=1)
            if not on.all():
                walking, x, low, high, below, above = (a[on] for a in (walking, x, low, high, below, above))
                if not len(walking):
                    break
        best = exact[:, :k].argmin(axis=1)
        return best, exact[np.arange(count), best]


def _kept(width: int, scale: float):
    """Rows (id, vector) of the vectors that take part, scaled and floored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            # A null vector has no length.
            places = np.flatnonzero([n == width for n in pc.list_value_length(lists).to_pylist()])
            flat = lists.take(pa.array(places)).flatten()
            cells = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
            # A null component is no number here, like the non-finite ones.
            cells = np.floor(cells * scale)
            whole = np.isfinite(cells).all(axis=1)
            cells = cells[whole]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(places[whole])), pa.array([c.tobytes() for c in cells], pa.binary())],
                names=["id", "vector"],
            )

    return run


def _sums(rows: list[list[int]]):
    """Per task one row per centroid that has vectors: their number and exact sums."""
    width = len(rows[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(_whole(rows))
        count = [0] * len(rows)
        total = [[0] * width for _ in rows]
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                vectors = _numbers(batch.column(0).slice(at, _BATCH).to_pylist(), width)
                best, _ = centroids.nearest(vectors)
                for c in np.unique(best):
                    own = vectors[best == c]
                    count[c] += len(own)
                    total[c] = [a + int(b) for a, b in zip(total[c], own.sum(axis=0), strict=True)]
        used = [c for c in range(len(rows)) if count[c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array([count[c] for c in used], pa.int64()),
                pa.array([[str(x) for x in total[c]] for c in used], pa.list_(pa.string())),
            ],
            names=["cluster", "count", "sums"],
        )

    return run


def _means(table: pa.Table) -> pa.Table:
    """The floor of sum / count of one centroid, from its rows of all tasks."""
    count = sum(table["count"].to_pylist())
    total = [sum(int(x) for x in column) for column in zip(*table["sums"].to_pylist(), strict=True)]
    return pa.table(
        {
            "cluster": table["cluster"][:1],
            "mean": pa.array([[str(x // count) for x in total]], pa.list_(pa.string())),
        }
    )


def _assigned(rows: list[list[int]]):
    width = len(rows[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(_whole(rows))
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                best, distance = centroids.nearest(_numbers(part.column(1).to_pylist(), width))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(best.astype(np.int32)),
                        pa.array([min(int(x), _LONG) for x in distance], pa.int64()),
                    ],
                    names=["id", "cluster", "distance"],
                )

    return run


def _first(vectors: DataFrame, k: int, width: int, seed: int) -> list[list[int]]:
    """The `k` vectors whose hashed ids come first; equal ids go by the vector."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = vectors.withColumn("hash", F.sha2(name, 256)).orderBy("hash", "vector").limit(k)
    rows = [r.vector for r in first.select("vector").collect()]
    return [[int(x) for x in np.frombuffer(r, dtype=float)] for r in rows]


def centroid_digest(row: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()


def cluster(
    vectors: DataFrame, vec_id: str, vector: str, k: int, rounds: int, width: int, scale: float = 1.0, seed: int = 2
) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia and centroid_sha256 per vector.

    The vectors are read once per round from a written table; a round's result is
    at most `k` rows, which the driver sends out with the next one.
    """
    spark = vectors.sparkSession
    work = Workspace(spark)
    cells = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    kept = work.save(cells.mapInArrow(_kept(width, scale), "id long, vector binary"), "vectors")
    rows = _first(kept, k, width, seed)
    result = "id long, cluster int, distance long"
    if not rows:
        empty = spark.createDataFrame([], result)
    for _ in range(rounds if rows else 0):
        sums = kept.select("vector").mapInArrow(_sums(rows), "cluster int, count long, sums array<string>")
        means = sums.groupBy("cluster").applyInArrow(_means, "cluster int, mean array<string>")
        for mean in means.collect():
            rows[mean["cluster"]] = [int(x) for x in mean["mean"]]
    assigned = work.save(kept.mapInArrow(_assigned(rows), result) if rows else empty, "assigned")
    work.release(kept)
    # At most `k` rows: sums in decimals, which 64-bit distances cannot overflow.
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum")).collect()
    total = min(int(sum(r["sum"] for r in inertia)), _LONG)
    facts = spark.createDataFrame(
        [(r["cluster"], min(int(r["sum"]), _LONG), total, centroid_digest(rows[r["cluster"]])) for r in inertia],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster")
