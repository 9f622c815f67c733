"""Exact top-k by inner product, in descending order of length, with pruning.

Vectors are sorted by length (a range sort) and kept in blocks of `BLOCK` rows,
queries in blocks of their own. The second-moment matrix of all vectors, summed
map-side, gives the right singular vectors; rotated by them, a vector's first
coordinates carry most of its product. A block of queries meets the longest
vectors first, which gives each query a score that its k-th best reaches at
least. Then

* a pair of blocks is looked at only if the longest vector of the one can reach,
  with some query of the other, that score (Cauchy-Schwarz on lengths);
* within a pair, partial products over the first coordinates plus the product
  of the lengths of the rests bound every score; only what can reach the
  query's score is summed further, and what survives is scored exactly.

Scores are exact integers: vectors are scaled to whole numbers first. Each pair
gives at most k rows per query, ties to the smaller id, and a window over a
query's rows gives the k best.

The pairs of blocks are the stated query set against all rows; no rows are
crossed. The rotation (a square matrix of the dimension) is all that goes to
every task.

Defined results: a vector that is null or holds a null or a non-finite component
takes no part, nor does a row without an id; shorter vectors count as
ending in zeros; repeated rows are candidates and queries each for itself, and
only the query's own row is left out; scores beyond 64 bits stand at the end of
the range; an empty table, or one without queries, gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import Workspace

BLOCK = 4096
QUERY_BLOCK = 512
_BLOCKS = "block long, ids binary, rows binary, vectors binary, longest double"


def _whole(vectors: pa.Array, scale: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that take part, and their scaled components as whole doubles."""
    lists = vectors.to_pylist()
    keep = [
        i
        for i, v in enumerate(lists)
        if v is not None and all(x is not None for x in v) and np.isfinite(np.array(v, dtype=float)).all()
    ]
    out = np.zeros((len(keep), width))
    for row, i in enumerate(keep):
        out[row, : len(lists[i])] = lists[i]
    return np.array(keep, dtype=np.int64), np.floor(out * scale)


def _scaled(scale: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                keep, vectors = _whole(part.column(1), scale, width)
                rows = number + np.arange(len(keep))
                number += len(keep)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(keep)),
                        pa.array(rows),
                        pa.array([v.tobytes() for v in vectors], pa.binary()),
                        pa.array(np.sqrt((vectors**2).sum(axis=1))),
                    ],
                    names=["id", "row", "vector", "length"],
                )

    return run


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            vectors = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=float).reshape(-1, width)
            total += vectors.T @ vectors
        yield pa.RecordBatch.from_pydict({"cell": np.arange(width * width), "value": total.ravel()})

    return run


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        held: list[pa.RecordBatch] = []

        def full(rows: pa.Table) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "block": [number],
                    "ids": [rows["id"].to_numpy().tobytes()],
                    "rows": [rows["row"].to_numpy().tobytes()],
                    "vectors": [b"".join(rows["vector"].to_pylist())],
                    "longest": [max(rows["length"].to_pylist())],
                }
            )

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                yield full(table.slice(0, size))
                number += 1
                held = table.slice(size).to_batches()
        if sum(b.num_rows for b in held):
            yield full(pa.Table.from_batches(held))

    return run


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products of whole numbers as 64-bit integers."""
    top = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * a.shape[1]
    if top < 2**52:
        return (a * b).sum(axis=1).astype(np.int64)
    limit = 2**63
    return np.array(
        [min(max(sum(int(x) * int(y) for x, y in zip(p, q, strict=True)), -limit), limit - 1) for p, q in zip(a, b, strict=True)],
        dtype=np.int64,
    )


def best(
    queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
    rotation: np.ndarray, floor: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, vector number, score) of each query's k best that reach `floor`."""
    width = queries.shape[1]
    q, v = queries @ rotation, vectors @ rotation
    q_norm, v_norm = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    slack = 1 + 1e-9 * q_norm.max(initial=0.0) * v_norm.max(initial=0.0)
    need = (floor - slack)[:, None]
    partial, done = None, 0
    live = np.zeros((0, 2), dtype=np.int64)
    for stop in sorted({max(1, width // 4), max(1, width // 2), width}):
        rest_q = np.sqrt(np.maximum(0, (q[:, stop:] ** 2).sum(axis=1)))
        rest_v = np.sqrt(np.maximum(0, (v[:, stop:] ** 2).sum(axis=1)))
        if partial is None:
            # The first coordinates, for all pairs at once.
            partial = q[:, :stop] @ v[:, :stop].T
            live = np.argwhere(partial + rest_q[:, None] * rest_v[None, :] >= need)
            sums = partial[live[:, 0], live[:, 1]]
        else:
            sums = sums + np.einsum("ij,ij->i", q[live[:, 0], done:stop], v[live[:, 1], done:stop])
            reach = sums + rest_q[live[:, 0]] * rest_v[live[:, 1]] >= need[live[:, 0], 0]
            live, sums = live[reach], sums[reach]
        done = stop
    own = query_rows[live[:, 0]] != rows[live[:, 1]]
    live, sums = live[own], sums[own]
    # Of each query's survivors those far below its k-th best here go; then exact scores.
    order = np.lexsort((-sums, live[:, 0]))
    live, sums = live[order], sums[order]
    first = np.searchsorted(live[:, 0], np.arange(len(queries)))
    end = np.append(first[1:], len(live))
    kth = np.where(end - first >= k, sums[np.minimum(first + k - 1, max(0, len(sums) - 1))] if len(sums) else 0.0, -np.inf)
    near = sums >= kth[live[:, 0]] - 2 * slack
    live = live[near]
    score = exact_scores(queries[live[:, 0]], vectors[live[:, 1]])
    order = np.lexsort((ids[live[:, 1]], -score, live[:, 0]))
    live, score = live[order], score[order]
    rank = np.arange(len(live)) - np.searchsorted(live[:, 0], np.arange(len(queries)))[live[:, 0]]
    top = rank < k
    return live[top, 0], live[top, 1], score[top]


def _score(k: int, rotation: np.ndarray, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                ids, rows = (np.frombuffer(pair[n], dtype=np.int64) for n in ("ids", "rows"))
                vectors = np.frombuffer(pair["vectors"], dtype=float).reshape(-1, width)
                q_ids, q_rows = (np.frombuffer(pair[n], dtype=np.int64) for n in ("q_ids", "q_rows"))
                queries = np.frombuffer(pair["q_vectors"], dtype=float).reshape(-1, width)
                floor = np.full(len(queries), -np.inf) if pair["floor"] is None else np.frombuffer(pair["floor"], dtype=float)
                for at in range(0, len(vectors), 1024):
                    part = slice(at, at + 1024)
                    q, v, score = best(queries, q_rows, vectors[part], ids[part], rows[part], k, rotation, floor)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "query_block": np.full(len(q), pair["q_block"]),
                            "query_row": q_rows[q],
                            "query_id": q_ids[q],
                            "vec_id": ids[part][v],
                            "score": score,
                        }
                    )

    return run


def _floors(width: int, k: int):
    """Per block of queries: scores its k-th best reaches, and the length a vector needs at least."""

    def run(table: pa.Table) -> pa.Table:
        block = table.filter(pa.array([x is not None for x in table["q_rows"].to_pylist()])).to_pylist()[0]
        rows = np.frombuffer(block["q_rows"], dtype=np.int64)
        norm = np.sqrt((np.frombuffer(block["q_vectors"], dtype=float).reshape(-1, width) ** 2).sum(axis=1))
        got: dict[int, list[int]] = {}
        for row, score in zip(table["query_row"].to_pylist(), table["score"].to_pylist(), strict=True):
            if row is not None:
                got.setdefault(row, []).append(score)
        floor = np.array([sorted(got[r])[-k] if len(got.get(r, ())) >= k else -np.inf for r in rows], dtype=float)
        need = np.where(floor > 0, floor / np.maximum(norm, 1e-300), 0.0).min() * (1 - 1e-9)
        return pa.table({"q_block": [block["q_block"]], "floor": [floor.tobytes()], "need": [float(need)]})

    return run


def top_k(
    vectors: DataFrame, vec_id: str, vector: str, is_query: Column, k: int = 5, scale: float = 256.0
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best rows for each row where `is_query` holds."""
    work = Workspace(vectors.sparkSession)
    spark = vectors.sparkSession
    known = vectors.where(F.col(vec_id).isNotNull())
    width = known.agg(F.max(F.size(vector))).first()[0] or 0
    width = max(1, width)
    flagged = known.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = work.save(
        flagged.mapInArrow(_scaled(scale, width), "id long, row long, vector binary, length double"), "rows"
    )
    cells = (
        rows.select("vector")
        .mapInArrow(_moments(width), "cell long, value double")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    moments = np.zeros(width * width)
    for c in cells:
        moments[c["cell"]] = c["value"]
    rotation = np.linalg.eigh(moments.reshape(width, width))[1][:, ::-1].copy()
    count = rows.count()
    spans = max(1, -(-count // (4 * BLOCK)))
    by_length = rows.repartitionByRange(spans, F.desc("length")).sortWithinPartitions(F.desc("length"))
    blocks = work.save(by_length.mapInArrow(_blocks(BLOCK), _BLOCKS), "blocks")
    asked = vectors.where(is_query).select(F.col(vec_id).cast("long").alias("id")).distinct()
    own = rows.join(asked, "id", "left_semi").select("id", "row", "vector", "length")
    queries = work.save(
        own.sortWithinPartitions("id")
        .mapInArrow(_blocks(QUERY_BLOCK), _BLOCKS)
        .select(
            F.col("block").alias("q_block"),
            F.col("ids").alias("q_ids"),
            F.col("rows").alias("q_rows"),
            F.col("vectors").alias("q_vectors"),
        ),
        "queries",
    )
    # The longest vectors with every block of queries. One block, so one row is joined to each.
    longest = blocks.orderBy(F.desc("longest"), "block").limit(1)
    columns = ["q_block", "q_ids", "q_rows", "q_vectors", "ids", "rows", "vectors", "floor"]
    result = "query_block long, query_row long, query_id long, vec_id long, score long"
    seeds = (
        queries.withColumn("one", F.lit(1))
        .join(longest.withColumn("one", F.lit(1)), "one")
        .withColumn("floor", F.lit(None).cast("binary"))
        .select(columns)
        .mapInArrow(_score(k, rotation, width), result)
    )
    seeds = work.save(seeds, "seeds")
    both = queries.select("q_block", "q_rows", "q_vectors").unionByName(
        seeds.select(F.col("query_block").alias("q_block"), "query_row", "score"), allowMissingColumns=True
    )
    floors = work.save(
        both.groupBy("q_block").applyInArrow(_floors(width, k), "q_block long, floor binary, need double"), "floors"
    )
    # Which blocks of queries meet which blocks: two short lists of numbers.
    pairs = floors.join(blocks.select("block", "longest"), F.col("longest") >= F.col("need"))
    pairs = work.save(pairs.select("q_block", "block", "floor"), "pairs")
    scored = (
        pairs.join(queries, "q_block")
        .join(blocks.drop("longest"), "block")
        .select(columns)
        .mapInArrow(_score(k, rotation, width), result)
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
