"""Remove byte strings that occur twice, through sharded suffix arrays.

A window is a run of `length` bytes inside one text. Every byte covered by a window whose
bytes also start anywhere else, in any text or the same, is removed.

1. Each window has an anchor: the byte run of `GRAM` bytes in it with the least
   hash (the last of equals). Consecutive windows with one anchor form a run;
   the anchor's place depends on a window's bytes alone, so equal windows have
   equal anchors, and runs are compared only with runs of the same anchor.
   Anchors met once in the corpus are dropped: their windows are met once.
2. Runs of equal bytes are counted by two hashes (128 bits). What is met twice is
   covered whole, so a passage in a third of all texts costs a row per task.
3. Distinct runs of the remaining anchors go to shards by their anchor. A shard
   builds the suffix array of its runs: suffixes are classed as larger or
   smaller than the next, leftmost smaller ones are named and sorted by doubling,
   and all others are induced from them, bucket by bucket, in linear time. Common
   prefixes of neighbours in the array are then computed in text order (permuted)
   and compared with the window's length.
4. An anchor with more than `HOT` runs is not sorted in one shard: its windows are
   counted one by one by their hashes, which any number of tasks can share.

Texts are carried compressed, with a row number fixed in a written table.

Defined results: a null text is empty; texts shorter than a window lose nothing;
equal texts of at least a window's length lose everything in all copies; null or
repeated ids stay row by row; an empty table gives no rows; other columns are
ignored but for the id. Removed bytes may part a character: what is left is bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.textbytes import Prefixes
from corpusloom.session import Workspace

LENGTH = 200
GRAM = 32
HOT = 5_000
#: Bytes of runs that one suffix array is made for.
SHARD_BYTES = 2_000_000
_PLACE = np.uint64((1 << 24) - 1)
_SEGMENT = 1 << 23


# --- anchors and runs ---------------------------------------------------------


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(anchor hash, text, first window, windows) of every run of windows with one anchor."""
    out = []
    for base in range(0, max(1, len(data) - length + 1), _SEGMENT):
        part = data[base : base + _SEGMENT + length - 1]
        if len(part) >= length:
            out.append(_segment_runs(part, base, offsets, length))
    if not out:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segment_runs(data: np.ndarray, base: int, offsets: np.ndarray, length: int):
    gram = min(GRAM, length)
    width = length - gram + 1
    at = np.arange(len(data) - gram + 1)
    hashed = Prefixes(data, 41).range(at, at + gram)
    least = (hashed & ~_PLACE) | (_PLACE - at.astype(np.uint64))
    covered = 1
    while covered * 2 <= width:
        least = np.minimum(least[:-covered], least[covered:])
        covered *= 2
    if covered < width:
        least = np.minimum(least[: len(least) - (width - covered)], least[width - covered :])
    anchor = (_PLACE - (least & _PLACE)).astype(np.int64)
    start = np.arange(len(anchor)) + base
    text = np.searchsorted(offsets, start, side="right") - 1
    inside = start + length <= offsets[text + 1]
    start, text, anchor = start[inside], text[inside], anchor[inside]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(start)))
    return hashed[anchor[first]], text[first], start[first] - offsets[text[first]], count


# --- suffix arrays ------------------------------------------------------------


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    unique, rank = np.unique(keys, return_inverse=True)
    return rank.astype(np.int64), len(unique)


def _smaller(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one, the end mark, is."""
    n = len(s)
    differs = np.append(s[:-1] != s[1:], True)
    less = np.append(s[:-1] < s[1:], True)
    # Equal neighbours take the class of the next place that differs.
    place = np.where(differs, np.arange(n), n)
    nearest = np.minimum.accumulate(place[::-1])[::-1]
    return less[nearest]


def _sorted_leftmost(s: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """The leftmost smaller suffixes in order.

    Their substrings (to the next leftmost one, included) are named by rank, symbol
    by symbol, only where names are still shared; then names of neighbours are
    doubled until each is its own.
    """
    m = len(leftmost)
    code = s.astype(np.int64) * 2 + smaller
    size = np.append(np.diff(leftmost), 0)
    name, kinds = _ranks(code[leftmost])
    step = 1
    alive = np.arange(m)
    while kinds < m and len(alive):
        shared = np.bincount(name, minlength=kinds)[name[alive]] > 1
        alive = alive[shared & (size[alive] >= step)]
        if not len(alive):
            break
        # Names leave room behind them for the parts of a shared name.
        symbol = np.zeros(m, dtype=np.int64)
        symbol[alive] = code[leftmost[alive] + step] + 1
        name, kinds = _ranks(name * (2 * 260 + 2) + symbol)
        step += 1
    width = 1
    while kinds < m:
        after = np.zeros(m, dtype=np.int64)
        after[:-width] = name[width:] + 1
        name, kinds = _ranks(name * (kinds + 2) + after)
        width *= 2
    order = np.empty(m, dtype=np.int64)
    order[name] = leftmost
    return order


def suffix_array(s: np.ndarray) -> np.ndarray:
    """All suffixes of `s` in order; `s` ends in its only, smallest symbol 0; symbols are below 260."""
    n = len(s)
    smaller = _smaller(s)
    leftmost = np.flatnonzero(smaller & np.append(False, ~smaller[:-1]))
    order = _sorted_leftmost(s, smaller, leftmost)
    count = np.bincount(s, minlength=261)
    head = np.concatenate([[0], np.cumsum(count)])
    larger_count = np.bincount(s[~smaller], minlength=261)
    symbols = np.flatnonzero(count)

    def spread(found: np.ndarray, rows: list[list[np.ndarray]]) -> None:
        """Deal suffixes, keeping their order, to the lists of their first symbols."""
        if not len(found):
            return
        first = s[found]
        by = np.argsort(first, kind="stable")
        cuts = np.flatnonzero(np.diff(first[by], prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(by)), strict=True):
            rows[first[by[a]]].append(found[by[a:b]])

    # Larger suffixes, from the smallest symbol up: first those induced inside
    # the bucket (waves), then what its leftmost smaller suffixes induce.
    seeds: list[list[np.ndarray]] = [[] for _ in range(261)]
    spread(order, seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(261)]
    for c in symbols:
        ready = np.concatenate(larger[c]) if larger[c] else np.zeros(0, np.int64)
        done = [ready]
        while len(ready):
            before = ready[ready > 0] - 1
            before = before[~smaller[before]]
            same = s[before] == c
            # One wave at a time; what goes to later buckets must keep the order of waves.
            done.append(before[same])
            spread(before[~same], larger)
            ready = before[same]
        larger[c] = [np.concatenate(done)]
        own = np.concatenate(seeds[c]) if seeds[c] else np.zeros(0, np.int64)
        before = own[own > 0] - 1
        spread(before[~smaller[before]], larger)
    # Smaller suffixes, from the largest symbol down, filled from the back.
    small: list[list[np.ndarray]] = [[] for _ in range(261)]
    out = np.empty(n, dtype=np.int64)
    for c in symbols[::-1]:
        # Lists are in descending order here.
        ready = np.concatenate(small[c]) if small[c] else np.zeros(0, np.int64)
        done = [ready]
        while len(ready):
            before = ready[ready > 0] - 1
            before = before[smaller[before]]
            same = s[before] == c
            done.append(before[same])
            spread(before[~same], small)
            ready = before[same]
        descending = np.concatenate(done)
        if c == 0:
            descending = np.array([n - 1])
        own = larger[c][0] if larger[c] else np.zeros(0, np.int64)
        out[head[c] : head[c] + larger_count[c]] = own
        out[head[c] + larger_count[c] : head[c + 1]] = descending[::-1]
        before = own[::-1]
        before = before[before > 0] - 1
        spread(before[smaller[before]], small)
    return out


def repeated_starts(s: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Which valid places start `length` bytes that another valid place starts too.

    Of neighbours in the suffix array, the common prefix is taken in text order:
    each place is compared with the valid place before it in the array, eight
    bytes at a time, as long as they agree.
    """
    order = suffix_array(s)
    order = order[valid[order]]
    before = np.full(len(s), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    place = np.flatnonzero(before >= 0)
    raw = s.astype(np.int64) - 1
    padded = np.concatenate([raw, np.zeros(length + 8, np.int64)]).astype(np.uint8)
    words = np.zeros(len(padded) - 7, dtype=np.uint64)
    for j in range(8):
        words |= padded[j : len(padded) - 7 + j].astype(np.uint64) << np.uint64(8 * j)
    for at in [*range(0, length - 7, 8), max(0, length - 8)]:
        place = place[words[place + at] == words[before[place] + at]]
    if length < 8:
        for j in range(length):
            place = place[padded[place + j] == padded[before[place] + j]]
    out = np.zeros(len(s), dtype=bool)
    out[place] = True
    out[before[place]] = True
    return out


# --- Spark --------------------------------------------------------------------


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = [pack((t.as_py() or "").encode()) for t in part.column(0)]
            rows = np.arange(number, number + len(texts))
            number += len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), part.column(1), pa.array(texts, pa.binary())], names=["row", "id", "packed"]
            )


def _unpacked(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x.as_py()) for x in column]


def _all_runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy()
            for first, data, offsets in _byte_slices(batch.column(1)):
                anchor, text, start, count = runs(data, offsets, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array(rows[first + text]),
                        pa.array(start.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                    ],
                    names=["anchor", "row", "start", "count"],
                )

    return run


def _byte_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    held, size, first = [], 0, 0
    unpack = zstandard.ZstdDecompressor().decompress
    for i, x in enumerate(column):
        held.append(unpack(x.as_py()))
        size += len(held[-1])
        if size >= limit or i == len(column) - 1:
            data = np.frombuffer(b"".join(held), dtype=np.uint8)
            yield first, data, np.concatenate([[0], np.cumsum([len(h) for h in held])])
            held, size, first = [], 0, i + 1


_PIECES = "anchor long, c1 long, c2 long, row long, start int, count int, hot boolean, bytes binary"


def _pieces(length: int):
    """The runs of each text with their hashes; bytes only where the task meets them first.

    Runs of hot anchors are given window by window, without bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in batches:
            columns = [batch.column(i) for i in range(3)]
            for first, data, offsets in _byte_slices(columns[1]):
                own = columns[2].slice(first, len(offsets) - 1)
                each = pc.list_value_length(own).to_numpy()
                flat = own.flatten()
                names = ("anchor", "start", "count", "hot")
                anchor, start, count, hot = (flat.field(n).to_numpy(zero_copy_only=False) for n in names)
                text = np.repeat(np.arange(len(each)), each)
                hot = hot.astype(bool)
                times = np.where(hot, count, 1)
                source = np.repeat(np.arange(len(times)), times)
                step = np.arange(len(source)) - np.repeat(np.cumsum(times) - times, times)
                start = start[source] + step
                count = np.where(hot, 1, count)[source]
                text, anchor, hot = text[source], anchor[source], hot[source]
                begin = offsets[text] + start
                stop = begin + count - 1 + length
                c1 = Prefixes(data, 42).range(begin, stop).view(np.int64)
                c2 = Prefixes(data, 43).range(begin, stop).view(np.int64)
                raw = data.tobytes()
                content: list[bytes | None] = []
                for a, b, x, y, h in zip(begin.tolist(), stop.tolist(), c1.tolist(), c2.tolist(), hot.tolist(), strict=True):
                    if h or (x, y) in met:
                        content.append(None)
                    else:
                        content.append(raw[a:b])
                        if len(met) < 1_000_000:
                            met.add((x, y))
                rows = columns[0].slice(first, len(each)).to_numpy()[text]
                arrays = [anchor, c1, c2, rows, start.astype(np.int32), count.astype(np.int32), hot]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, arrays), pa.array(content, pa.binary())],
                    names=["anchor", "c1", "c2", "row", "start", "count", "hot", "bytes"],
                )

    return run


def _shard(length: int):
    """Of each distinct run, the windows that another run of the shard has too, as (first, count) pairs."""

    def run(table: pa.Table) -> pa.Table:
        anchor, c1, c2 = (table[c].to_numpy() for c in ("anchor", "c1", "c2"))
        order = np.lexsort((c2, c1, anchor))
        new = np.ones(len(order), dtype=bool)
        same = np.stack([anchor[order], c1[order], c2[order]], axis=1)
        new[1:] = (same[1:] != same[:-1]).any(axis=1)
        order = order[new]
        # An anchor with one distinct run has nothing to compare.
        _, which, times = np.unique(anchor[order], return_inverse=True, return_counts=True)
        order = order[times[which] > 1]
        out: dict[str, list] = {"c1": [], "c2": [], "inside": []}
        content = table["bytes"].take(pa.array(order)).to_pylist()
        at = 0
        while at < len(content):
            # Whole anchors up to about a shard's bytes.
            size, stop = 0, at
            while stop < len(content) and (size < SHARD_BYTES or anchor[order[stop]] == anchor[order[stop - 1]]):
                size += len(content[stop]) + 1
                stop += 1
            own = content[at:stop]
            joined = np.frombuffer(b"\0".join(own) + b"\0\0", dtype=np.uint8).astype(np.int64) + 2
            sizes = np.array([len(x) for x in own])
            ends = np.cumsum(sizes + 1) - 1
            joined[ends] = 1
            joined[-1] = 0
            valid = np.zeros(len(joined), dtype=bool)
            starts = ends - sizes
            counts = sizes - length + 1
            places = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            valid[places] = True
            found = repeated_starts(joined, valid, length)
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(found))):
                mask = found[starts[i] : starts[i] + counts[i]]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                out["c1"].append(int(c1[order[at + i]]))
                out["c2"].append(int(c2[order[at + i]]))
                out["inside"].append(edge.astype("<i4").tobytes())
            at = stop
        return pa.table(
            {"c1": pa.array(out["c1"], pa.int64()), "c2": pa.array(out["c2"], pa.int64()), "inside": pa.array(out["inside"], pa.binary())}
        )

    return run


def _covered(n: int, marks: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes of a text of n bytes."""
    edges = np.zeros(n + 1, dtype=np.int64)
    for mark in marks:
        if mark["inside"] is None:
            spans = [(0, mark["count"])]
        else:
            spans = np.frombuffer(mark["inside"], dtype="<i4").reshape(-1, 2).tolist()
        for a, b in spans:
            edges[mark["start"] + a] += 1
            edges[mark["start"] + b - 1 + length] -= 1
    inside = np.cumsum(edges[:-1]) > 0
    cut = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    return list(zip(cut[::2].tolist(), cut[1::2].tolist(), strict=True))


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: dict[str, list] = {"kept": [], "n_bytes": [], "n_removed": [], "n_spans": []}
                for text, marks in zip(_unpacked(part.column(1)), part.column(2).to_pylist(), strict=True):
                    spans = _covered(len(text), marks, length) if marks else []
                    kept, last = [], 0
                    for a, b in spans:
                        kept.append(text[last:a])
                        last = b
                    out["kept"].append(b"".join([*kept, text[last:]]))
                    out["n_bytes"].append(len(text))
                    out["n_removed"].append(sum(b - a for a, b in spans))
                    out["n_spans"].append(len(spans))
                columns = [part.column(0), pa.array(out["kept"], pa.binary())]
                columns += [pa.array(out[n], pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *out])

    return run


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """`id`, `kept` (bytes), `n_bytes`, `n_removed` and `n_spans` of every row of `documents`."""
    work = Workspace(documents.sparkSession)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(text).cast("string"), F.col(doc_id))
    texts = work.save(rows.mapInArrow(_stored, f"row long, id {kind}, packed binary"), "texts")
    every = texts.select("row", "packed").mapInArrow(_all_runs(length), "anchor long, row long, start int, count int")
    every = work.save(every, "runs")
    # A hot anchor's rows are combined map-side; windows of one text may repeat too.
    anchors = every.groupBy("anchor").agg(F.count("*").alias("n"), F.sum("count").alias("windows")).where("n > 1")
    # Saved, so that the join below has two plain sides and a hot anchor's can be split.
    anchors = work.save(anchors.select("anchor", (F.col("n") > HOT).alias("hot")), "anchors")
    repeated = every.join(anchors, "anchor").groupBy("row").agg(
        F.collect_list(F.struct("anchor", "start", "count", "hot")).alias("runs")
    )
    near = texts.select("row", "packed").join(repeated, "row").select("row", "packed", "runs")
    pieces = work.save(near.mapInArrow(_pieces(length), _PIECES), "pieces")
    work.release(every, anchors)
    whole = pieces.groupBy("c1", "c2").agg(F.count("*").alias("n")).where("n > 1").select("c1", "c2")
    with_bytes = pieces.where("bytes IS NOT NULL")
    total = with_bytes.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    parts = (
        with_bytes.select(F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard"), "anchor", "c1", "c2", "bytes")
        .groupBy("shard")
        .applyInArrow(_shard(length), "c1 long, c2 long, inside binary")
    )
    marks = (
        whole.withColumn("inside", F.lit(None).cast("binary"))
        .unionByName(parts)
        .groupBy("c1", "c2")
        .agg(F.max(F.col("inside").isNull()).alias("is_whole"), F.max("inside").alias("inside"))
        .select("c1", "c2", F.when(~F.col("is_whole"), F.col("inside")).alias("inside"))
    )
    marks = work.save(marks, "marks")
    found = pieces.select("c1", "c2", "row", "start", "count").join(marks, ["c1", "c2"])
    by_text = found.groupBy("row").agg(F.collect_list(F.struct("start", "count", "inside")).alias("marks"))
    by_text = work.save(by_text, "covers")
    work.release(pieces, marks)
    return texts.join(by_text, "row", "left").select("id", "packed", "marks").mapInArrow(
        _cut(length), f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long"
    )
