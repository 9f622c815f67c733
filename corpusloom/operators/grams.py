"""Byte trigrams of documents and their counts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import GRAM_BYTES, has_grams, normalized_bytes
from corpusloom.session import reach

# Fixed values of the stored layout: two tiers for each doubling of the windows of a
# document; documents of fewer than 2^10 windows share the lowest one.
TIERS_PER_DOUBLING = 2
LOWEST_TIER = 10 * TIERS_PER_DOUBLING

# Windows generated from one slice of a text. Bounds the memory of a row,
# whatever the length of its text.
_SLICE = 64 * 1024

# Bytes of text whose grams are counted at a time.
_COUNTED = 1 << 20


def window_count(text_cols: Sequence[str]) -> Column:
    """How many grams the texts of a document have."""
    return sum(
        F.greatest(F.octet_length(F.coalesce(c, F.lit(""))) - (GRAM_BYTES - 1), F.lit(0)).cast("long")
        for c in text_cols
    )


def size_tier(windows: Column) -> Column:
    """The tier of a document by its windows."""
    step = F.floor(F.log2(F.greatest(windows, F.lit(1))) * TIERS_PER_DOUBLING)
    return F.greatest(step, F.lit(LOWEST_TIER)).cast("int")


def tier_limit(tier: Column) -> Column:
    """More windows than any document of a tier has, so more hits than it can get."""
    return F.ceil(F.pow(F.lit(2.0), (tier + 1) / TIERS_PER_DOUBLING)) + 1


def _text_slices(documents: DataFrame, text_cols: Sequence[str]) -> DataFrame:
    """The further columns of every document, and `data`: its texts as normalised bytes,
    field by field, in slices that overlap so that no window is lost."""
    field = F.explode(F.array(*text_cols)) if len(text_cols) > 1 else F.col(text_cols[0])
    keys = [c for c in documents.columns if c not in text_cols]
    texts = documents.select(*keys, field.alias("text")).where(has_grams("text"))
    data = texts.select(*keys, normalized_bytes("text").alias("data"))
    last = F.octet_length("data") - (GRAM_BYTES - 1)
    return data.select(
        *keys, "data", F.explode(F.sequence(F.lit(1), last, F.lit(_SLICE))).alias("start")
    ).select(
        *keys, F.substring(F.col("data"), F.col("start"), F.lit(_SLICE + GRAM_BYTES - 1)).alias("data")
    )


def explode_grams(documents: DataFrame, id_col: str, text_cols: Sequence[str]) -> DataFrame:
    """One row (doc_id, gram) for every three-byte window of every text column.

    Fields are cut up apart, so no gram spans two of them. Positions are
    exploded rather than arrays of grams: a plain integer sequence and a
    `substring` stay in generated code, a lambda over an array does not.
    """
    slices = _text_slices(documents.select(F.col(id_col).alias("doc_id"), *text_cols), text_cols)
    last = F.octet_length("data") - (GRAM_BYTES - 1)
    windows = slices.select(
        "doc_id", "data", F.explode(F.sequence(F.lit(1), last)).alias("pos")
    )
    return windows.select(
        "doc_id", F.substring(F.col("data"), F.col("pos"), F.lit(GRAM_BYTES)).alias("gram")
    )


def gram_codes(data: np.ndarray) -> np.ndarray:
    """The windows of a byte array as numbers in the order of the grams."""
    wide = data.astype(np.int64)
    return wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]


def _gram_array(codes: np.ndarray) -> pa.Array:
    data = codes.astype(">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes()
    offsets = np.arange(len(codes) + 1, dtype=np.int32) * GRAM_BYTES
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _new_documents(ids: pa.Array) -> np.ndarray:
    """Where an id is not that of the row before."""
    before, after = ids.slice(0, len(ids) - 1), ids.slice(1)
    other = pc.or_(
        pc.fill_null(pc.not_equal(before, after), False), pc.xor(pc.is_null(before), pc.is_null(after))
    )
    return np.concatenate([[True], other.to_numpy(zero_copy_only=False)])


def _ranks(keys: pa.RecordBatch, order: Sequence[str]) -> np.ndarray:
    """The place of every row by the columns of `order`; equal rows share it."""
    ranks = np.zeros(keys.num_rows, dtype=np.int64)
    for name in order:
        own = pc.rank(keys.column(name), "ascending", null_placement="at_start", tiebreaker="dense")
        both = ranks * (keys.num_rows + 1) + own.to_numpy().astype(np.int64)
        ranks = np.unique(both, return_inverse=True)[1]
    return ranks


def _count_slices(batches: Iterator[pa.RecordBatch], order: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    """Postings of rows (doc_id, further columns, data) that lie together by document.

    Some megabytes of text are counted at a time; the counts of the last document are
    held until the next one begins, so a task's memory is that of one document's grams.
    The postings of those texts come by the columns of `order`, by gram and by document:
    a sort that follows merges a few long runs.
    """
    held: tuple[pa.RecordBatch, np.ndarray, np.ndarray] | None = None

    def postings(keys: pa.RecordBatch, rows: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        columns = dict(zip(keys.schema.names, keys.take(pa.array(rows)).columns, strict=True))
        return pa.RecordBatch.from_pydict({"gram": _gram_array(codes), **columns, "tf": pa.array(counts, pa.int64())})

    def one(held: tuple[pa.RecordBatch, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return postings(held[0], np.zeros(len(held[1]), dtype=np.int64), held[1], held[2])

    for whole in batches:
        sizes = pc.binary_length(whole.column("data")).to_numpy(zero_copy_only=False).astype(np.int64)
        part = np.cumsum(sizes) // _COUNTED
        for start, stop in zip(*_runs(part), strict=True):
            batch = whole.slice(start, stop - start)
            data = batch.column("data").cast(pa.large_binary())
            offsets = np.frombuffer(data.buffers()[1], dtype=np.int64)[data.offset : data.offset + len(data) + 1]
            text = np.frombuffer(data.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
            keys = batch.select([c for c in batch.schema.names if c != "data"])
            first = _new_documents(keys.column("doc_id"))
            numbers = np.cumsum(first) - 1
            starts = np.flatnonzero(first)
            # Every row holds a window, so there are fewer documents, and ranks, than 2^19.
            places = (_ranks(keys.take(pa.array(starts)), order) << 44 | np.arange(len(starts)))[numbers]
            # A window belongs to the row of its first byte, and ends inside it.
            own = np.repeat(places, np.diff(offsets))
            inside = np.ones(len(text), dtype=bool)
            ends = offsets[1:] - offsets[0]
            inside[ends - 1] = inside[ends - 2] = False
            found = (own[:-2] | gram_codes(text) << 20)[inside[:-2]]
            found, counts = np.unique(found, return_counts=True)
            of, codes = found & 0xFFFFF, found >> 20 & 0xFFFFFF
            last = numbers[-1]
            if held is not None and keys.column("doc_id")[0] == held[0].column("doc_id")[0]:
                again = of == 0
                merged, where = np.unique(np.concatenate([held[1], codes[again]]), return_inverse=True)
                sums = np.zeros(len(merged), dtype=np.int64)
                np.add.at(sums, where, np.concatenate([held[2], counts[again]]))
                held = (held[0], merged, sums)
                if last == 0:
                    continue
                of, codes, counts = of[~again], codes[~again], counts[~again]
            if held is not None:
                yield one(held)
            late = of == last
            if not late.all():
                yield postings(keys, starts[of[~late]], codes[~late], counts[~late])
            held = (keys.slice(int(starts[-1]), 1), codes[late], counts[late])
    if held is not None:
        yield one(held)


def _runs(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of equal numbers."""
    edges = np.flatnonzero(np.diff(part)) + 1
    return np.concatenate([[0], edges])[: len(part)], np.concatenate([edges, [len(part)]])[: len(part)]


def spread_texts(
    documents: DataFrame,
    id_col: str,
    text_cols: Sequence[str],
    partitions: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, columns to `keep`, texts) spread by document id over `partitions` parts
    (default: the session's shuffle partitions)."""
    texts = documents.select(F.col(id_col).alias("doc_id"), *keep, *text_cols)
    return texts.repartition(partitions, "doc_id") if partitions else texts.repartition("doc_id")


def count_spread(spread: DataFrame, text_cols: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Postings (gram, doc_id, tf) of spread texts; further columns are one value per document.
    Texts that are counted together give them in the order of the columns `order`, then by gram."""
    reach(spread.sparkSession)
    slices = _text_slices(spread.sortWithinPartitions("doc_id"), text_cols)
    keys = slices.drop("data").schema.fields
    schema = T.StructType([T.StructField("gram", T.BinaryType()), *keys, T.StructField("tf", T.LongType())])
    kept = [f.name for f in keys if f.name != "doc_id"]
    return slices.mapInArrow(partial(_count_slices, order=tuple(order)), schema).select("gram", "doc_id", "tf", *kept)


def count_grams(
    documents: DataFrame,
    id_col: str,
    text_cols: Sequence[str],
    partitions: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Postings (gram, doc_id, tf): how often each gram occurs in a document.

    The texts are spread and sorted by document id. All slices of a document then lie
    together, and its grams, many times the size of the text, are counted one document
    at a time: without a shuffle, and in memory that does not grow with a task's part.
    `partitions` sets how many parts the texts are spread over. Columns to `keep` are
    one value per document.
    """
    return count_spread(spread_texts(documents, id_col, text_cols, partitions, keep), text_cols)


def vocabulary(postings: DataFrame, unique: bool = False) -> DataFrame:
    """(gram, docs, occurrences) for every distinct gram of an index.

    `unique` says that (gram, doc_id) does not repeat, as in `count_grams`: then
    one row per gram and task is shuffled instead of all pairs. An index that
    was appended to repeats them.
    """
    docs = F.count(F.lit(1)) if unique else F.count_distinct("doc_id")
    return postings.groupBy("gram").agg(docs.alias("docs"), F.sum("tf").alias("occurrences"))
