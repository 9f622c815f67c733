"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

Texts are sets of shingles (runs of five lower-cased words; a shorter text is one
shingle). The join finds all pairs of texts whose sets have a Jaccard similarity
of the threshold or more.

1. Rows with the same words are one class from the start; only one row of a
   class goes on, with the number of its copies.
2. Each class gets a MinHash signature, cut into the labels of `TREES` prefix
   tries. Two sets of similarity s agree in the first d values of a label with
   probability s^d. Matching starts from whole labels and shortens the matched
   prefix until 1 - (1 - s^d)^TREES reaches the target recall at the threshold.
   Classes below one trie node (equal prefix of that length) are compared by
   their signatures; those that could reach the threshold (`MARGIN` standard
   errors of the estimate below it) become candidates, told as a spanning
   forest of the node, never as all pairs.
3. Connected candidates are verified together and exactly: every pair of a
   component, by the sizes of intersections of their shingle sets. So candidates
   need only hang together for no pair of them to be missed.
4. Verified links are counted per class and connected again to groups.

Nodes and components of any size are cut into blocks, and each pair of blocks is
one unit of work; small ones are bundled. A node or component with a third of
all texts is thus spread over many tasks, and no task holds more than two blocks.
What hangs together inside a block is told by the unit of that block alone; a unit of
two blocks adds only edges between the groups it finds in them, and every group hangs
on its least key. So a group's edges are about its texts, however many blocks it has
and however many tries it lies in.
What leaves a task is counts and spanning edges, at most a few rows per text.
Joins with texts and signatures are merge joins at every size, and texts are
shuffled compressed.

Words are what white space separates. Defined results: a null text is empty; rows without words
are copies of each other; repeated rows are copies; null ids take part and count
as links, and a group's id is its least non-null one; an empty table gives no rows;
other columns are ignored.
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

from corpusloom.llm.components import components
from corpusloom.llm.textbytes import Prefixes, mix, shingles, text_slices, word_bounds
from corpusloom.session import Workspace

SIZE = 5
THRESHOLD = 0.8
RECALL = 0.9995
TREES = 16
LABEL = 5
#: Standard errors that an estimate may lie below the threshold.
MARGIN = 4.5
#: Classes in a block of a trie node, and of a component (which carries texts).
NODE_BLOCK = 1024
TEXT_BLOCK = 256

_random = np.random.Generator(np.random.PCG64(99))
_FACTORS = _random.integers(0, 2**63, TREES * LABEL, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 2**64, TREES * LABEL, dtype=np.uint64)


def prefix_length(threshold: float, recall: float = RECALL) -> int:
    """The longest prefix whose matches reach the target recall at the threshold."""
    length = LABEL
    while length > 1 and 1 - (1 - threshold**length) ** TREES < recall:
        length -= 1
    return length


def _text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each word and the place of each text's first word."""
    start, stop = word_bounds(data, offsets)
    return Prefixes(data, 31).range(start, stop), Prefixes(data, 32).range(start, stop), np.searchsorted(start, offsets)


def signatures(values: np.ndarray, splits: np.ndarray) -> np.ndarray:
    """MinHash values (texts x values) of shingle hashes; rows of empty sets are zero."""
    out = np.zeros((len(splits) - 1, len(_FACTORS)), dtype=np.uint32)
    filled = np.flatnonzero(np.diff(splits))
    if len(filled):
        for j, (factor, offset) in enumerate(zip(_FACTORS, _OFFSETS, strict=True)):
            hashed = ((values * factor + offset) >> np.uint64(32)).astype(np.uint32)
            out[filled, j] = np.minimum.reduceat(hashed, splits[:-1][filled])
    return out


def _sequence_keys(one: np.ndarray, two: np.ndarray, splits: np.ndarray) -> list[bytes]:
    """128 bits for each text's sequence of words."""
    place = np.arange(len(one)) - np.repeat(splits[:-1], np.diff(splits))
    halves = []
    for words, salt in ((one, 0x51), (two, 0x77)):
        spread = mix(words + mix(place.astype(np.uint64) + np.uint64(salt)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread)])
        halves.append(mix(sums[splits[1:]] - sums[splits[:-1]] + np.diff(splits).astype(np.uint64)))
    both = np.stack(halves, axis=1)
    return [row.tobytes() for row in both]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 40
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = pc.utf8_lower(pc.fill_null(batch.column(0), ""))
        for first, data, offsets in text_slices(texts):
            one, two, splits = _text_words(data, offsets)
            values, shingle_splits = shingles(one, splits, SIZE)
            n = len(offsets) - 1
            marks = signatures(values, shingle_splits)
            raw = data.tobytes()
            packed = [pack(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + n)),
                    batch.column(1).slice(first, n),
                    pa.array(_sequence_keys(one, two, splits), pa.binary()),
                    pa.array(np.diff(splits)),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                    pa.array(packed, pa.binary()),
                ],
                names=["row", "id", "key", "words", "signature", "packed"],
            )
            number += n


def _node_of(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint32).reshape(-1, TREES, LABEL)
            hashed = np.broadcast_to(np.arange(TREES, dtype=np.uint64), marks.shape[:2]).copy()
            for j in range(length):
                hashed = mix(hashed * np.uint64(0x9E3779B97F4A7C15) + marks[:, :, j].astype(np.uint64))
            rows = np.repeat(np.arange(batch.num_rows), TREES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed.ravel().view(np.int64)), batch.column(0).take(pa.array(rows))], names=["node", "key"]
            )

    return run


class _Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)

    def edges(self, inside: _Forest | None = None) -> tuple[list[int], list[int]]:
        """Every item but the roots, with its root. What the forest `inside` joins already
        is left out: only its roots are told."""
        roots = [self.root(i) for i in range(len(self.up))]
        own = [i for i, r in enumerate(roots) if r != i and (inside is None or inside.root(i) == i)]
        return own, [roots[i] for i in own]


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal rows of sorted columns."""
    n = len(columns[0])
    new = np.ones(n, dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(new)
    return list(zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True))


def _sorted(table: pa.Table, name: str) -> pa.Table:
    """By unit of work, and by key inside: the first row of a group is its least key."""
    return table.sort_by([(c, "ascending") for c in (name, "low", "high", "key")])


def _candidates(threshold: float):
    least = threshold - MARGIN * (threshold * (1 - threshold) / (TREES * LABEL)) ** 0.5

    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table, "node")
        node, low, high, block = (table[c].to_numpy() for c in ("node", "low", "high", "block"))
        keys = table["key"]
        marks = np.frombuffer(b"".join(table["signature"].to_pylist()), dtype=np.uint32).reshape(-1, TREES * LABEL)
        left, right = [], []
        for a, b in _runs(node, low, high):
            own, at_home = marks[a:b], block[a:b]
            forest = _Forest(b - a)
            inside = _Forest(b - a) if low[a] != high[a] else None
            for at in range(0, b - a, 64):
                # Only pairs once: with those after each row.
                part = own[at : at + 64]
                same = (part[:, None, :] == own[None, at:, :]).mean(axis=2)
                for i, j in (at + np.argwhere(np.triu(same >= least, 1))).tolist():
                    forest.join(i, j)
                    if inside and at_home[i] == at_home[j]:
                        inside.join(i, j)
            x, y = forest.edges(inside)
            left += [a + i for i in x]
            right += [a + i for i in y]
        return pa.table({"a": keys.take(pa.array(left, pa.int64())), "b": keys.take(pa.array(right, pa.int64()))})

    return run


def similar_pairs(values: np.ndarray, owner: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """(i, j), i < j, of the sets (0..n-1) whose exact Jaccard similarity reaches the threshold.

    `values` holds the distinct members of all sets and `owner` the set of each.
    """
    size = np.bincount(owner, minlength=n).astype(np.float64)
    unique, column = np.unique(values, return_inverse=True)
    count = np.bincount(column, minlength=len(unique))
    shared = count[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    common = np.zeros((n, n), dtype=np.float64)
    width = int(column.max()) + 1 if len(column) else 0
    step = max(1, 4_000_000 // max(1, n))
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for low in range(0, width, step):
        a, b = np.searchsorted(column, [low, low + step])
        dense = np.zeros((n, min(step, width - low)), dtype=np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        common += dense @ dense.T
    union = size[:, None] + size[None, :] - common
    return np.argwhere(np.triu(common >= threshold * union - 1e-9, 1) & (union > 0))


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table, "group")
        group, low, high, block = (table[c].to_numpy() for c in ("group", "low", "high", "block"))
        copies = table["copies"].to_numpy()
        keys = table["key"]
        left, right, links = [], [], np.zeros(len(group), dtype=np.int64)
        unpack = zstandard.ZstdDecompressor().decompress
        for a, b in _runs(group, low, high):
            values, splits = [], [0]
            texts = pa.array([unpack(x.as_py()).decode() for x in table["packed"].slice(a, b - a)], pa.large_string())
            for _, data, offsets in text_slices(texts):
                one, _, word_splits = _text_words(data, offsets)
                found, cuts = shingles(one, word_splits, SIZE)
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    values.append(np.unique(found[x:y]))
                    splits.append(splits[-1] + len(values[-1]))
            owner = np.repeat(np.arange(b - a), np.diff(splits))
            pairs = similar_pairs(np.concatenate(values), owner, b - a, threshold)
            forest = _Forest(b - a)
            for i, j in pairs.tolist():
                forest.join(i, j)
            # Pairs inside a block belong to the unit of that block alone.
            inside = None
            if low[a] != high[a]:
                crossing = block[a:b][pairs[:, 0]] != block[a:b][pairs[:, 1]]
                inside = _Forest(b - a)
                for i, j in pairs[~crossing].tolist():
                    inside.join(i, j)
                pairs = pairs[crossing]
            np.add.at(links, a + pairs[:, 0], copies[a + pairs[:, 1]])
            np.add.at(links, a + pairs[:, 1], copies[a + pairs[:, 0]])
            x, y = forest.edges(inside)
            left += [a + i for i in x]
            right += [a + i for i in y]
        # One row per text that has links, and one per spanning edge.
        some = np.flatnonzero(links)
        a = pa.concat_arrays([*keys.take(pa.array(some)).chunks, *keys.take(pa.array(left, pa.int64())).chunks])
        b = pa.concat_arrays([pa.nulls(len(some), pa.binary()), *keys.take(pa.array(right, pa.int64())).chunks])
        n = pa.array([*links[some].tolist(), *[0] * len(left)], pa.int64())
        return pa.table({"a": a, "b": b, "links": n})

    return run


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """Rows (members, key, ...) once for each unit of work they belong to.

    Sets of more than `block` members are cut into blocks by the key's hash, and
    every pair of blocks is a unit.
    """
    cuts = F.ceil(F.col("members") / block).cast("int")
    rows = rows.withColumn("cuts", cuts).withColumn("block", F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    rows = rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    return rows.drop("other")


def _bundled(rows: DataFrame, name: str, block: int) -> DataFrame:
    """`bundle` names the group of rows for one task: a unit of a cut set has one to
    itself, uncut sets share, about `block` rows each."""
    total = rows.count()
    bundles = max(1, -(-total // block))
    unit = F.when(F.col("cuts") > 1, F.xxhash64(name, "low", "high")).otherwise(
        F.pmod(F.xxhash64(name), F.lit(bundles))
    )
    return rows.withColumn("bundle", unit)


def link(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of `documents`: `id`, `class_id` (the least id of all rows
    that links connect with it), `copies` (rows with the same words, itself
    included) and `n_links` (other rows of similarity `threshold` or more, copies
    included)."""
    work = Workspace(documents.sparkSession)
    kind = documents.schema[doc_id].dataType.simpleString()
    rows = documents.select(F.col(text).cast("string"), F.col(doc_id))
    signed = work.save(
        rows.mapInArrow(_signed, f"row long, id {kind}, key binary, words long, signature binary, packed binary"), "signed"
    )
    found = _linked(signed, threshold, work)
    least = found.groupBy("label").agg(F.min("id").alias("class_id"))
    found = found.join(least, "label").select(
        "key", "class_id", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return signed.select("id", "key").join(found, "key").drop("key")


def first_of_classes(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Of each class of linked rows the one with the least id (null ids last), whole."""
    work = Workspace(documents.sparkSession)
    names = [f"c{i}" for i in range(len(documents.columns))]
    plain = documents.toDF(*names)
    at, identity = documents.columns.index(text), f"c{documents.columns.index(doc_id)}"
    numbered = work.save(plain.withColumn("number", F.monotonically_increasing_id()), "numbered")
    key = F.struct(F.col(identity).isNull().alias("unnamed"), F.col(identity).alias("name"), "number")
    rows = numbered.select(F.col(f"c{at}").cast("string"), key.alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = work.save(
        rows.mapInArrow(_signed, f"row long, id {kind}, key binary, words long, signature binary, packed binary"), "signed"
    )
    chosen = _linked(signed, threshold, work).groupBy("label").agg(F.min("id").alias("id"))
    return numbered.join(chosen.select(F.col("id.number").alias("number")), "number", "left_semi").drop("number").toDF(
        *documents.columns
    )


def _linked(signed: DataFrame, threshold: float, work: Workspace) -> DataFrame:
    """Classes of equal words (key, id, copies) with their group's `label` and their `links`."""
    classes = work.save(
        signed.groupBy("key").agg(F.min("row").alias("row"), F.min("id").alias("id"), F.count("*").alias("copies")), "classes"
    )
    firsts = signed.where("words > 0").join(classes.select("row"), "row", "left_semi")
    marks = work.save(firsts.select("key", "signature"), "marks")
    nodes = work.save(marks.mapInArrow(_node_of(prefix_length(threshold)), "node long, key binary"), "nodes")
    shared = nodes.groupBy("node").agg(F.count("*").alias("members")).where("members > 1")
    inside = work.save(_blocked(nodes.join(shared.hint("merge"), "node"), NODE_BLOCK), "inside")
    inside = _bundled(inside.join(marks.hint("merge"), "key"), "node", NODE_BLOCK)
    edges = work.save(
        inside.groupBy("bundle").applyInArrow(_candidates(threshold), "a binary, b binary"), "candidates"
    )
    joined = components(edges, work)
    sizes = joined.groupBy("label").agg(F.count("*").alias("members"))
    members = joined.join(sizes, "label").select(F.xxhash64("label").alias("group"), "members", F.col("node").alias("key"))
    members = members.join(classes.select("key", "row", "copies"), "key")
    units = work.save(_blocked(members, TEXT_BLOCK), "units")
    units = _bundled(units, "group", TEXT_BLOCK).join(signed.select("row", "packed").hint("merge"), "row")
    verified = work.save(
        units.groupBy("bundle").applyInArrow(_verify(threshold), "a binary, b binary, links long"), "verified"
    )
    links = verified.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    groups = components(verified.where("b IS NOT NULL").select("a", "b"), work)
    found = classes.select("key", "id", "copies").join(groups.withColumnRenamed("node", "key"), "key", "left")
    return found.withColumn("label", F.coalesce("label", "key")).join(links, "key", "left")
