"""Toxicity of texts from subword-bag embeddings and a linear softmax.

A word is a bag of subwords: itself and its n-grams of bytes, each hashed to
one row of an embedding table. A word's vector is the mean of its subwords', a
segment's the mean of its words', and a linear softmax over the two classes
reads the segment. Embeddings and softmax are trained together, by numpy and
Adam, on segments of labelled texts; words never seen share n-grams with those
that were, so misspellings land near them.

A text is scored whole, in segments of `SEGMENT` words that overlap by half: one
offensive sentence in a long text counts like one in a short text. Its score is
the highest of its segments. Segments inherit the label of their text, so most
segments of a toxic text teach a low probability, and the classes' prior is set
right by `positives`: the threshold on segment scores is chosen on the training texts
and moved to 0.5.

Training reads at most `TRAINING_TEXTS` labelled texts, toxic ones up to half of
them (either class fills what the other leaves), each class taken by the hash of
the id, of at most `TRAINING_CHARS` characters each; that is the only bound, and it
holds for learning alone. The threshold counts a class's errors by its share of all
labels, not of the sample. Every subword has a row of its own or shares one by hash;
decay holds back those of few texts. Everything is scored.

Scoring maps the documents; the model (a few megabytes, of fixed size) goes to
all tasks. A word's share of a segment's logit is one number, kept per worker
for the words met first.

Defined results: a null or empty text has no words and the score of the bias
alone; null labels teach nothing; without labelled texts of both classes every
score is the share of toxic ones (0 if there are none); repeated rows are scored
row by row; other columns are kept, but one named like a result is replaced.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from corpusloom.llm.textbytes import Prefixes

TRAINING_TEXTS = 4000
TRAINING_CHARS = 50_000
BUCKETS = 1 << 16
WIDTH = 8
SEGMENT = 8
#: A segment's mean vector is stretched by this, so that one word in it can decide.
STRETCH = 8.0
EPOCHS = 40
DECAY = 1.0
RATE = 0.02
WORDS_KEPT = 500_000
#: Ranges summed at a time while training, which bounds the driver's memory.
GATHERED = 10_000
#: Texts scored at a time.
SCORED = 128

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word's place, row) of each subword: the word itself and its runs of three to
    five bytes, ends marked. All words at once, by rolling hashes."""
    raw = [f"<{w}>".encode() for w in words]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    start = np.cumsum(size) - size
    hashed = Prefixes(data, 51)
    places, rows = [np.arange(len(words))], [hashed.range(start, start + size)]
    for width in (3, 4, 5):
        count = np.maximum(size - width + 1, 0)
        place = np.repeat(np.arange(len(words)), count)
        begin = np.arange(len(place)) - np.repeat(np.cumsum(count) - count, count) + start[place]
        places.append(place)
        rows.append(hashed.range(begin, begin + width))
    return np.concatenate(places), (np.concatenate(rows) % np.uint64(BUCKETS)).astype(np.int32)


def segment_starts(n: int) -> range:
    """First words of segments over n words; half of each overlaps the next."""
    return range(0, max(1, n - SEGMENT // 2), SEGMENT // 2)


@dataclass
class Model:
    table: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.rows = (self.table @ self.weights).astype(np.float64)
        self.kept: dict[str, float] = {}

    def words(self, words: list[str]) -> list[float]:
        """What each word adds to the logit of a segment of one word."""
        if not words:
            return []
        place, row = subwords(words)
        return (np.bincount(place, weights=self.rows[row]) / np.bincount(place)).tolist()

    def highest(self, texts: list[str | None]) -> list[float]:
        """The highest logit of each text's segments."""
        listed = [words_of(t) for t in texts]
        kept = self.kept
        missing = list({w for own in listed for w in own if w not in kept})
        known = dict(zip(missing, self.words(missing), strict=True))
        room = WORDS_KEPT - len(kept)
        if room >= len(known):
            kept.update(known)
        out = []
        for own in listed:
            if not own:
                out.append(self.bias)
                continue
            values = np.array([kept[w] if w in kept else known[w] for w in own])
            sums = np.concatenate([[0.0], np.cumsum(values)])
            start = np.array(segment_starts(len(own)))
            stop = np.minimum(start + SEGMENT, len(own))
            out.append(float((STRETCH * (sums[stop] - sums[start]) / (stop - start)).max() + self.bias))
        return out

    def scores(self, texts: list[str | None]) -> list[float]:
        return (1 / (1 + np.exp(-np.clip(np.array(self.highest(texts)), -500, 500)))).tolist()

    def word(self, word: str) -> float:
        return self.words([word])[0]

    def score(self, text: str | None) -> float:
        return self.scores([text])[0]

    def __getstate__(self):
        return {"table": self.table, "weights": self.weights, "bias": self.bias}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()


def _gather(splits: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sums of `rows[places]` over consecutive ranges of places, none of them empty."""
    out = np.empty((len(splits) - 1, *rows.shape[1:]), dtype=rows.dtype)
    for low in range(0, len(out), GATHERED):
        own = splits[low : low + GATHERED + 1]
        out[low : low + GATHERED] = np.add.reduceat(rows[places[own[0] : own[-1]]], own[:-1] - own[0], axis=0)
    return out


def cut_between(highest: np.ndarray, labels: np.ndarray, odds: float = 1.0) -> float:
    """The threshold of least errors; a missed toxic text counts `odds` times. It lies
    between unequal logits or beyond all: above, when nothing tells the classes apart."""
    order = np.argsort(-highest, kind="stable")
    value = highest[order]
    edges = np.concatenate([[value[0] + 1], value, [value[-1] - 1]])
    hits = np.concatenate([[0], np.cumsum(labels[order])])
    wrong = odds * (hits[-1] - hits) + (np.arange(len(hits)) - hits)
    wrong[edges[:-1] <= edges[1:]] = np.inf
    if value[0] == value[-1]:
        wrong[-1] = np.inf
    least = int(np.argmin(wrong))
    return float(edges[least] + edges[least + 1]) / 2


def train(texts: list[str], labels: list[int], seed: int = 7, odds: float = 1.0) -> Model:
    """Fit the table and the softmax together on segments of the texts."""
    labels_ = np.array(labels, dtype=np.float64)
    share = float(labels_.mean()) if len(labels_) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros((BUCKETS, WIDTH)), np.zeros(WIDTH), 40.0 if share else -40.0)
    number: dict[str, int] = {}
    word_ids, seg_splits, seg_text = array("i"), array("q", [0]), array("i")
    for i, text in enumerate(texts):
        ids = [number.setdefault(w, len(number)) for w in words_of(text)]
        for start in segment_starts(len(ids)):
            own = ids[start : start + SEGMENT]
            if own:
                word_ids.extend(own)
                seg_splits.append(len(word_ids))
                seg_text.append(i)
    # Words a few at a time: the arrays behind the hashes are many times their result.
    listed, parts, counts = list(number), [], []
    for low in range(0, len(listed), GATHERED):
        own = listed[low : low + GATHERED]
        place, row = subwords(own)
        # Places in a table of 2^16 rows fit two bytes.
        parts.append(row[np.argsort(place, kind="stable")].astype(np.uint16))
        counts.append(np.bincount(place, minlength=len(own)))
    row_ids = np.concatenate(parts)
    row_splits = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    del parts, listed, number
    word_ids, seg_splits, seg_text = map(np.array, (word_ids, seg_splits, seg_text))
    n_words = len(row_splits) - 1
    row_share = 1.0 / np.diff(row_splits)
    seg_share = STRETCH / np.diff(seg_splits)
    target = labels_[seg_text]
    row_counts, seg_sizes = np.diff(row_splits), np.diff(seg_splits)
    used = np.unique(row_ids)

    random = np.random.Generator(np.random.PCG64(seed))
    table = np.zeros((BUCKETS, WIDTH), dtype=np.float32)
    table[used] = random.normal(0, 0.1, (len(used), WIDTH)).astype(np.float32)
    weights = random.normal(0, 0.5, WIDTH).astype(np.float32)
    bias = np.float32(np.log(share / (1 - share)))
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (table[used], weights, np.zeros(1, np.float32))]

    def step(value, grad, moment, turn):
        moment[0][...] = 0.9 * moment[0] + 0.1 * grad
        moment[1][...] = 0.98 * moment[1] + 0.02 * grad * grad
        return value - RATE * (moment[0] / (1 - 0.9**turn)) / (np.sqrt(moment[1] / (1 - 0.98**turn)) + 1e-7)

    for turn in range(1, EPOCHS + 1):
        word_vec = _gather(row_splits, table, row_ids) * row_share[:, None].astype(np.float32)
        seg_vec = _gather(seg_splits, word_vec, word_ids) * seg_share[:, None].astype(np.float32)
        logit = seg_vec @ weights + bias
        error = ((1 / (1 + np.exp(-logit)) - target)).astype(np.float32)
        grad_weights = seg_vec.T @ error + 1e-3 * weights
        to_seg = (error * seg_share).astype(np.float32)
        to_word = np.zeros(n_words)
        for low in range(0, len(to_seg), GATHERED):
            own = slice(low, low + GATHERED)
            ends = seg_splits[[low, min(low + GATHERED, len(to_seg))]]
            weight = np.repeat(to_seg[own], seg_sizes[own])
            to_word += np.bincount(word_ids[ends[0] : ends[1]], weights=weight, minlength=n_words)
        to_word *= row_share
        to_row = np.zeros(BUCKETS)
        for low in range(0, n_words, GATHERED):
            own = slice(low, low + GATHERED)
            ends = row_splits[[low, min(low + GATHERED, n_words)]]
            weight = np.repeat(to_word[own], row_counts[own])
            to_row += np.bincount(row_ids[ends[0] : ends[1]], weights=weight, minlength=BUCKETS)
        grad_rows = to_row[used].astype(np.float32)[:, None] * weights[None, :]
        table[used] = step(table[used], grad_rows + DECAY * table[used], moments[0], turn)
        weights = step(weights, grad_weights, moments[1], turn)
        bias = step(bias, np.array([error.sum()], dtype=np.float32), moments[2], turn)[0]
    model = Model(table, weights, float(bias))
    del row_ids, word_ids
    # The words of a few texts at a time, as in scoring: as objects they are many times the text.
    highest = np.concatenate([model.highest(texts[low : low + SCORED]) for low in range(0, len(texts), SCORED)])
    # Texts that training saw look better apart than they are: the threshold stands
    # between the classes where the smoothed count of errors is least.
    return Model(table, weights, float(bias) - cut_between(highest, labels_, odds))


def training_rows(
    documents: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, limit: int = TRAINING_TEXTS
) -> tuple[list, float]:
    """At most `limit` labelled texts whose id is not held out, toxic ones up to half of
    them, and how many times as many labels a toxic one of them stands for as another.
    Labels of documents that are not there, or are longer than training takes, leave
    their place to others."""
    texts = documents.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).where(
        F.length("text") <= TRAINING_CHARS
    )
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    every = (
        marked.where(F.col("label").isin(0, 1) & ~held_out(F.col("id")))
        .join(texts, F.col("id") == F.col("doc"), "left_semi")
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    counts = dict(every.groupBy("label").count().collect())
    clean, toxic = counts.get(0, 0), counts.get(1, 0)
    taken = {1: min(toxic, max(limit // 2, limit - clean))}
    taken[0] = min(clean, limit - taken[1])
    ones, zeros = (
        every.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(taken[y]) for y in (1, 0)
    )
    known = ones.union(zeros)
    # A repeated id is read once; the sample is small enough to be sent to all tasks.
    rows = texts.join(F.broadcast(known), F.col("doc") == F.col("id")).groupBy("id").agg(
        F.max("label").alias("label"), F.min("text").alias("text")
    )
    odds = toxic * taken[0] / (taken[1] * clean) if taken[0] and taken[1] else 1.0
    return rows.orderBy("id").collect(), odds


def held_out(doc_id):
    """True where crc32 of the id's text leaves no remainder by five; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(documents: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic") -> Model:
    rows, odds = training_rows(documents, labels, doc_id, text, label)
    return train([r["text"] for r in rows], [r["label"] for r in rows], odds=odds)


def score(documents: DataFrame, model: Model, text: str = "text", result: str = "score") -> DataFrame:
    """`documents`, all columns, with the score of each text."""
    if result.lower() != text.lower():
        documents = documents.drop(result)
    at = documents.columns.index(text)
    schema = StructType([*documents.schema.fields, StructField(result, DoubleType())])
    arrow = to_arrow_schema(schema)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            scores = []
            for low in range(0, batch.num_rows, SCORED):
                scores += own.scores(batch.column(at).slice(low, SCORED).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], schema=arrow)

    return documents.mapInArrow(task, schema)
