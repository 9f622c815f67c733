"""Find test items inside training documents: BM25 retrieval, then overlap.

The test items are indexed, and every passage of every document is the query.
An item's BM25 weights are divided by the score the item gives itself, so one
threshold holds for all: an item is retrieved by a passage that reaches the
share `least_score` of the item's own score. No top-k: all items at or above it
are retrieved. The search is block-max WAND, over all passages of a slice of
texts at once:

* A term's largest weight over all items bounds what it can add. Passages whose
  bounds add up to less than the threshold stop here; of the others, the weakest
  terms that cannot reach the threshold together are set aside, and only
  the postings of the remaining (pivot) terms are opened.
* Postings are cut into blocks of items with the largest weight of each; blocks
  whose bounds, with what terms set aside can add there, stay below the
  threshold are skipped.
* Items of the blocks left are bounded once more by their own weights; where that
  reaches the threshold, the blocks of the terms set aside that hold such items are
  opened too. Only what still reaches it is scored from its own terms.

An item's question (all but the last sentence) and its answer (the last sentence)
are indexed each, in parts of at most `PART_WORDS` words; together they are the
item, which is indexed as a whole only where it is one sentence, or where the
answer is too short to be asked for and the question has under `SHORT` words. How
often a term occurs and how long parts are is counted over all items. An item with
a retrieved part is verified on runs of `gram` words that the whole document holds
too, whatever the item's length: it is found if `least_overlap` of the question's
runs, of the answer's or of the whole item's are there. A question or answer of fewer
than `gram` words (than the item, if that is shorter) has no runs and overlap 0.

Documents are only mapped, nothing of them is shuffled. The index is sent to all
tasks, so the items go through in slices of at most `SLICE_CHARS` characters of
text, whose number follows the size of the test set.

Texts are lower-cased; words are runs of ASCII letters and digits and of other
characters than ASCII. Defined results: null texts are empty; a document or item without words
matches nothing; equal items are reported one by one; null ids are carried
along; empty tables give no rows; other columns of the input are ignored unless
asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusloom.llm.textbytes import Prefixes, shingles, text_slices
from corpusloom.session import Workspace

PART_WORDS = 64
SLICE_CHARS = 4_000_000
BLOCK_ITEMS = 16
#: Ceilings for which it is kept what a part's terms below them add up to.
LEVELS = 64
#: Cells of the largest array of sums over passages and parts, and the postings that
#: are opened for them at a time.
SUMS = 1_000_000
SHORT = 20
K1, B = 1.2, 0.75

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x30:0x3A] = _LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_SENTENCE_END = re.compile(r"[.!?]\s+(?=\S)")


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the place of each text's first word (one more at the end)."""
    inside = np.zeros(len(data) + 1, dtype=bool)
    inside[:-1] = _LETTER[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    start = np.flatnonzero(inside & (~before | edge))
    stop = np.flatnonzero(before & (~inside | edge))
    return Prefixes(data, 21).range(start, stop), np.searchsorted(start, offsets)


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(pc.utf8_lower(text).as_py().encode(), dtype=np.uint8)
    return term_hashes(data, np.array([0, len(data)]))[0]


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    return shingles(words, np.array([0, len(words)]), size)[0]


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence and the last; a single sentence is both."""
    ends = [m.end() for m in _SENTENCE_END.finditer(text)]
    return (text[: ends[-1]], text[ends[-1] :]) if ends else (text, text)


def _sides(text: str, gram: int) -> tuple[int, list[np.ndarray]]:
    """Words of a run, and the words of the item, its question and its answer."""
    every = _words(text)
    return min(gram, len(every)), [every, *map(_words, question_and_answer(text))]


def _parts(size: int, sides: list[np.ndarray]) -> list[np.ndarray]:
    """The parts that an item is searched by."""
    whole, question, answer = sides
    # A side without runs decides nothing.
    used = [x for x in (question, answer) if size <= len(x) < len(whole)]
    if not used or (len(used) == 1 and len(used[0]) < SHORT):
        used.append(whole)
    return [cut for x in used if len(x) for cut in np.array_split(x, -(-len(x) // PART_WORDS))]


@dataclass
class Index:
    """Postings of the parts of a slice of items, with weights as shares of a part's own score."""

    ids: list
    gram: int
    part_of: np.ndarray = field(init=False)  # item of each part
    runs: list = field(init=False)  # runs of words of each item: all, question, answer

    def build(self, texts: list[str], statistics=None) -> Index:
        """`statistics` gives, for hashes of terms, the parts of all items that hold each,
        the number of parts and their mean length; without it these items are all."""
        self.runs, self.sizes, owner, words = [], [], [], []
        for item, text in enumerate(texts):
            size, sides = _sides(text, self.gram)
            self.sizes.append(size)
            self.runs.append([np.unique(_grams(x, size)) if len(x) and len(x) >= size else x[:0] for x in sides])
            cuts = _parts(size, sides)
            owner += [item] * len(cuts)
            words += cuts
        self.part_of = np.array(owner, dtype=np.int64)
        self.terms, inverse = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]), return_inverse=True)
        part = np.repeat(np.arange(len(words)), [len(w) for w in words])
        pair, tf = np.unique(inverse.astype(np.int64) * max(1, len(words)) + part, return_counts=True)
        term, part = pair // max(1, len(words)), pair % max(1, len(words))
        length = np.array([len(w) for w in words], dtype=float)
        if statistics is None:
            df, parts, mean = np.bincount(term, minlength=len(self.terms)), len(words), length.mean() if len(length) else 1
        else:
            df, parts, mean = statistics(self.terms)
        idf = np.log1p((parts - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[part] / max(1.0, mean)))
        own = np.bincount(part, weights=weight, minlength=len(words))
        self.weight = weight / own[part]
        self.post_part = part
        self.post_at = np.searchsorted(term, np.arange(len(self.terms) + 1))
        self.ceiling = np.maximum.reduceat(self.weight, self.post_at[:-1]) if len(self.terms) else np.zeros(0)
        block = term * (len(words) // BLOCK_ITEMS + 1) + part // BLOCK_ITEMS
        first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
        self.block_max = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.block_of = part[first] // BLOCK_ITEMS if len(first) else first
        self.post_of = np.append(first, len(part))
        self.block_at = np.searchsorted(term[first], np.arange(len(self.terms) + 1)) if len(first) else np.zeros(1, np.int64)
        # The terms of each part, for exact scores.
        order = np.argsort(part, kind="stable")
        self.own_term, self.own_weight = term[order], self.weight[order]
        self.own_at = np.searchsorted(part[order], np.arange(len(words) + 1))
        # What terms up to each of some ceilings add to a part, and to any part of a block.
        self.levels = np.quantile(self.ceiling, np.linspace(0, 1, LEVELS)) if len(self.terms) else np.zeros(LEVELS)
        level = np.searchsorted(self.levels, self.ceiling[term])
        blocks = len(words) // BLOCK_ITEMS + 1
        low = np.bincount(level * len(words) + part, weights=self.weight, minlength=LEVELS * len(words))
        self.low = np.cumsum(low.reshape(LEVELS, len(words)), axis=0)
        padded = np.zeros((LEVELS, blocks * BLOCK_ITEMS))
        padded[:, : len(words)] = self.low
        self.block_low = padded.reshape(LEVELS, blocks, BLOCK_ITEMS).max(axis=2)
        self.seen = _seen(self.terms)
        # Runs of each length, with the sides of the items (three each) that have them.
        self.lengths = np.array([[len(own) for own in sides] for sides in self.runs]).ravel()
        self.held = {}
        for size in set(self.sizes) - {0}:
            own = [(3 * i + k, x) for i, n in enumerate(self.sizes) if n == size for k, x in enumerate(self.runs[i])]
            runs = np.concatenate([x for _, x in own])
            sides = np.repeat([i for i, _ in own], [len(x) for _, x in own])
            order = np.argsort(runs, kind="stable")
            runs, starts = np.unique(runs[order], return_index=True)
            self.held[size] = (runs, np.append(starts, len(order)), sides[order], _seen(runs))
        return self

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The term's number of each hash, or -1."""
        return _places(self.terms, self.seen, hashes)

    def shares(self, hashes: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text * sides + side, share) for every side of an item of which a text holds a run."""
        keys, shares = [np.zeros(0, np.int64)], [np.zeros(0)]
        sides_in_all = len(self.lengths)
        for size, (runs, starts, sides, seen) in self.held.items():
            own, own_splits = shingles(hashes, splits, size)
            place = _places(runs, seen, own)
            at = np.flatnonzero(place >= 0)
            text = np.searchsorted(own_splits, at, side="right") - 1
            # A run that a text repeats counts once.
            text, place = np.divmod(np.unique(text * len(runs) + place[at]), max(1, len(runs)))
            owner, where = _spread(starts[place], starts[place + 1] - starts[place])
            key, count = np.unique(text[owner] * sides_in_all + sides[where], return_counts=True)
            keys.append(key)
            shares.append(count / self.lengths[key % sides_in_all])
        return np.concatenate(keys), np.concatenate(shares)


def _seen(sorted_hashes: np.ndarray) -> np.ndarray:
    """A first look at 16 bits of a hash, which spares most words the binary search."""
    seen = np.zeros(1 << 16, dtype=bool)
    seen[sorted_hashes >> np.uint64(48)] = True
    return seen


def _places(sorted_hashes: np.ndarray, seen: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash stands among `sorted_hashes`, or -1."""
    out = np.full(len(hashes), -1, dtype=np.int64)
    maybe = np.flatnonzero(seen[hashes >> np.uint64(48)])
    at = np.minimum(np.searchsorted(sorted_hashes, hashes[maybe]), len(sorted_hashes) - 1)
    known = sorted_hashes[at] == hashes[maybe]
    out[maybe[known]] = at[known]
    return out


def _spread(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of several ranges, its number and all its places."""
    owner = np.repeat(np.arange(len(counts)), counts)
    begin = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - begin[owner] + starts[owner]


def retrieve(index: Index, hashes: np.ndarray, splits: np.ndarray, least: float):
    """(first word, last word + 1, text, part, score) of every passage and part at or above `least`.

    Passages are windows of two parts' length that start at every part's length,
    so each run of `PART_WORDS` words lies whole in one of them.
    """
    none = tuple(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, np.int64, float))
    if not len(index.terms) or not len(hashes):
        return none
    number = index.numbers(hashes)
    at = np.flatnonzero(number >= 0)
    text = np.searchsorted(splits, at, side="right") - 1
    count = np.diff(splits)
    windows = np.maximum(1, -(-count // PART_WORDS))
    first = np.concatenate([[0], np.cumsum(windows)])
    here = first[text] + (at - splits[text]) // PART_WORDS
    earlier = here > first[text]
    window = np.concatenate([here, here[earlier] - 1])
    term = np.concatenate([number[at], number[at][earlier]])
    keys = np.unique(window * len(index.terms) + term)
    window, term = keys // len(index.terms), keys % len(index.terms)
    bound = index.ceiling[term]
    eps = 1e-9
    total = np.bincount(window, weights=bound, minlength=first[-1])
    keep = total[window] >= least - eps
    window, term, bound = window[keep], term[keep], bound[keep]
    if not len(window):
        return none
    held = window * len(index.terms) + term  # sorted, for exact scores
    order = np.lexsort((bound, window))
    window, term, bound = window[order], term[order], bound[order]
    running = np.cumsum(bound)
    new = np.flatnonzero(np.concatenate([[True], window[1:] != window[:-1]]))
    base = np.repeat(running[new] - bound[new], np.diff(np.append(new, len(window))))
    pivot = running - base >= least - eps
    aside = np.bincount(window[~pivot], weights=bound[~pivot], minlength=first[-1])
    weakest = np.zeros(first[-1])
    np.maximum.at(weakest, window[~pivot], bound[~pivot])
    level = np.minimum(np.searchsorted(index.levels, weakest), LEVELS - 1)
    opened = np.bincount(window, weights=index.post_at[term + 1] - index.post_at[term], minlength=first[-1])
    weak_window, weak_term = window[~pivot], term[~pivot]
    window, term = window[pivot], term[pivot]
    # A run of passages at a time, so that the sums below stay small arrays.
    parts = len(index.part_of)
    width = parts // BLOCK_ITEMS + 1
    near: list[np.ndarray] = []
    run = max(1, SUMS // (width * BLOCK_ITEMS))
    for low, high in _runs(opened, run):
        a, b = np.searchsorted(window, (low, high))
        own_term, own_window = term[a:b], window[a:b] - low
        n = high - low
        # At most what was set aside in all, and what such weak terms add to the part.
        rest, own_level = aside[low : low + n, None], level[low : low + n]
        block_rest = np.minimum(rest, index.block_low[own_level]).ravel()
        part_rest = np.minimum(rest, index.low[own_level]).ravel()
        # Blocks of the pivot terms' postings, bounded together per passage.
        owner, place, cell = _blocks(index, own_window, own_term, width)
        ceiling = np.bincount(cell, weights=index.block_max[place], minlength=n * width)
        live = (ceiling > 0) & (ceiling + block_rest >= least - eps)
        # Parts with a pivot term in a live block, bounded once more.
        kept = live[cell]
        cell, place = _postings(index, own_window[owner[kept]], place[kept])
        pivots = np.bincount(cell, weights=index.weight[place], minlength=n * parts)
        bounded = np.flatnonzero((pivots > 0) & (pivots + part_rest >= least - eps))
        # Of the terms set aside, the blocks that hold such parts: what they add in fact.
        at, part = np.divmod(bounded, parts)
        live = np.zeros(n * width, dtype=bool)
        live[at * width + part // BLOCK_ITEMS] = True
        a, b = np.searchsorted(weak_window, (low, high))
        own_term, own_window = weak_term[a:b], weak_window[a:b] - low
        owner, place, cell = _blocks(index, own_window, own_term, width)
        kept = live[cell]
        cell, place = _postings(index, own_window[owner[kept]], place[kept])
        total = pivots + np.bincount(cell, weights=index.weight[place], minlength=n * parts)
        near.append(bounded[total[bounded] >= least - 2 * eps] + low * parts)
    # What is left is scored exactly, a bounded number of pairs at a time.
    unique = np.concatenate([*near, np.zeros(0, np.int64)])
    scores = [np.zeros(0)]
    for i in range(0, len(unique), SUMS // PART_WORDS):
        window, part = np.divmod(unique[i : i + SUMS // PART_WORDS], parts)
        scores.append(_scores(index, held, window, part))
    score = np.concatenate(scores)
    good = score >= least - eps
    window, part, score = unique[good] // parts, unique[good] % parts, score[good]
    text = np.searchsorted(first, window, side="right") - 1
    begin = splits[text] + (window - first[text]) * PART_WORDS
    return begin, np.minimum(begin + 2 * PART_WORDS, splits[text + 1]), text, part, score


def _scores(index: Index, held: np.ndarray, window: np.ndarray, part: np.ndarray) -> np.ndarray:
    """What the terms of each part add that its passage holds, by the sorted pairs `held`."""
    owner, place = _spread(index.own_at[part], index.own_at[part + 1] - index.own_at[part])
    key = window[owner] * len(index.terms) + index.own_term[place]
    at = np.minimum(np.searchsorted(held, key), len(held) - 1)
    held_weight = np.where(held[at] == key, index.own_weight[place], 0.0)
    return np.bincount(owner, weights=held_weight, minlength=len(window))


def _blocks(index: Index, window: np.ndarray, term: np.ndarray, width: int):
    """Blocks of postings of each passage's terms: whose they are, their place and their cell."""
    owner, place = _spread(index.block_at[term], index.block_at[term + 1] - index.block_at[term])
    return owner, place, window[owner] * width + index.block_of[place]


def _postings(index: Index, window: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of passage and part, and place, of the postings of some passages' blocks."""
    owner, place = _spread(index.post_of[block], index.post_of[block + 1] - index.post_of[block])
    return window[owner] * len(index.part_of) + index.post_part[place], place


def _runs(opened: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most `most` passages that open at most `SUMS` postings, or are one passage."""
    total = np.cumsum(opened)
    low = 0
    while low < len(opened):
        before = total[low - 1] if low else 0
        high = int(np.searchsorted(total, before + SUMS, side="right"))
        high = min(max(high, low + 1), low + most, len(opened))
        if total[high - 1] > before:
            yield low, high
        low = high


def find(index: Index, data: np.ndarray, offsets: np.ndarray, least_score: float, least_overlap: float):
    """{(text, item): (score, overlap, question overlap, answer overlap)} of verified matches."""
    hashes, splits = term_hashes(data, offsets)
    best: dict[tuple[int, int], float] = {}
    _, _, texts, parts, scores = retrieve(index, hashes, splits, least_score)
    if not len(texts):
        return {}
    for key, score in zip(zip(texts.tolist(), index.part_of[parts].tolist(), strict=True), scores.tolist(), strict=True):
        best[key] = max(best.get(key, 0.0), score)
    # Runs are looked up for all texts with a retrieved item at once.
    some = np.unique(texts)
    _, place = _spread(splits[some], splits[some + 1] - splits[some])
    keys, shares = index.shares(hashes[place], np.concatenate([[0], np.cumsum(splits[some + 1] - splits[some])]))
    text, side = np.divmod(keys, max(1, len(index.lengths)))
    text = some[text]
    overlaps: dict[tuple[int, int], list[float]] = {}
    for t, x, share in zip(text.tolist(), side.tolist(), shares.tolist(), strict=True):
        overlaps.setdefault((t, x // 3), [0.0, 0.0, 0.0])[x % 3] = share
    return {
        key: (best[key], *own) for key, own in sorted(overlaps.items()) if key in best and max(own) >= least_overlap
    }


def _indexes(items: DataFrame, item_id: str, text: str, gram: int) -> Iterator[Index]:
    """Indexes over slices of the items, each small enough to be sent to all tasks."""
    rows = items.select(F.col(item_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = -(-size // SLICE_CHARS)
    statistics = _statistics(rows, gram) if slices > 1 else None
    for i in range(slices):
        own = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == i).collect()
        yield Index([r["id"] for r in own], gram).build([r["text"] for r in own], statistics)


def _statistics(rows: DataFrame, gram: int):
    """What `Index.build` asks for, counted over all items: parts per term, all parts
    and their mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [np.unique(cut) for t in batch.column(0).to_pylist() for cut in _parts(*_sides(t, gram))]
            words = sum(len(cut) for t in batch.column(0).to_pylist() for cut in _parts(*_sides(t, gram)))
            terms, counts = np.unique(np.concatenate([*cuts, np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array([*terms.view(np.int64).tolist(), None], pa.int64()),
                    "n": pa.array([*counts.tolist(), len(cuts)], pa.int64()),
                    "words": pa.array([0] * len(terms) + [words], pa.int64()),
                }
            )

    counted = rows.select("text").mapInArrow(run, "term long, n long, words long")
    work = Workspace(rows.sparkSession)
    counted = work.save(counted.groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "terms")
    total = counted.where("term IS NULL").first()

    def of(terms: np.ndarray) -> tuple[np.ndarray, int, float]:
        # The terms of one slice, which bounds them.
        own = rows.sparkSession.createDataFrame([(int(t),) for t in terms.view(np.int64)], "term long")
        found = {r["term"]: r["n"] for r in counted.join(own, "term", "left_semi").collect()}
        df = np.array([found[int(t)] for t in terms.view(np.int64)])
        return df, total["n"], total["words"] / max(1, total["n"])

    return of


def matches(
    documents: DataFrame,
    items: DataFrame,
    keys: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_score: float = 0.5,
    least_overlap: float = 0.5,
    gram: int = 5,
) -> DataFrame:
    """One row for each document and item found in it: `keys`, then `item_id`,
    `score`, `overlap`, `question_overlap`, `answer_overlap`."""
    rows = documents.select(F.col(text).alias("text"), *[F.col(k) for k in keys])
    numbers = [StructField(n, DoubleType()) for n in ("score", "overlap", "question_overlap", "answer_overlap")]
    schema = StructType([*rows.schema.fields[1:], StructField("item_id", items.schema[item_id].dataType), *numbers])
    arrow = to_arrow_schema(schema)

    def task(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                for first, data, offsets in text_slices(pc.utf8_lower(batch.column(0))):
                    found = find(index, data, offsets, least_score, least_overlap)
                    if not found:
                        continue
                    at = pa.array([first + t for t, _ in found])
                    own = [c.take(at) for c in batch.columns[1:]]
                    own.append(pa.array([index.ids[i] for _, i in found], arrow.field("item_id").type))
                    own += [pa.array(list(x), pa.float64()) for x in zip(*found.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays(own, schema=arrow)

        return run

    result = documents.sparkSession.createDataFrame([], schema)
    for index in _indexes(items, item_id, item_text, gram):
        shared = documents.sparkSession.sparkContext.broadcast(index)
        result = result.union(rows.mapInArrow(task(shared), schema))
    return result


def clean(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_score: float = 0.5,
    least_overlap: float = 0.5,
    gram: int = 5,
) -> DataFrame:
    """`documents`, all columns, without those that hold an item."""
    at = documents.columns.index(text)

    def task(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for first, data, offsets in text_slices(pc.utf8_lower(batch.column(at))):
                    for t, _ in find(shared.value, data, offsets, least_score, least_overlap):
                        keep[first + t] = False
                yield batch.filter(pa.array(keep))

        return run

    for index in _indexes(items, item_id, item_text, gram):
        shared = documents.sparkSession.sparkContext.broadcast(index)
        documents = documents.mapInArrow(task(shared), documents.schema)
    return documents
