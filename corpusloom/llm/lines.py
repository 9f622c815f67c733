"""Drop lines that many documents share, through a sharded minimal perfect hash.

Every line has a key: the line without white space at both ends, A-Z
lower-cased. Two jobs look at the texts.

1. The distinct key hashes of each document are counted. The keys of one shard
   (top bits of the hash) go to one task, which builds a minimal perfect hash
   over the distinct hashes and two compact arrays behind it: a fingerprint of
   64 further hash bits and the number of documents, one byte, which stands
   still at 255 or at the threshold if that is higher in wider arrays. A shard's
   index is one row of bytes.
2. Documents probe the arrays. Lines (text hash, line number, key hash) are
   routed to the shard that holds their key and answered there from the arrays;
   no line is joined with a line. A shard with many lines is asked in several
   tasks, each with its own copy of the row, so a line in a third of all
   documents slows no task down. Only hits go back to the documents.

A key is told by 128 hash bits (64 for the place in the arrays, 64 in the
fingerprint). Lines of one text with the same hash have the same result, so
lines are routed and returned by the hash of the text: repeated rows, repeated
or null ids need no care and stay row by row.

Defined results: a null or empty text is one empty line; the empty key counts as
a key only if `min_chars` is 0; an empty table gives no rows; all columns of the
input are kept, but those named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.llm.textbytes import Prefixes, lowered, mix, spaces, text_slices
from corpusloom.session import Workspace

#: Lines asked of one copy of a shard's arrays, and keys that one shard is made for.
LINES_PER_TASK = 50_000
KEYS_PER_SHARD = 50_000


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit keys, as levels of bit arrays.

    At each level the remaining keys are thrown into `gamma` times as many bits;
    keys alone in their bit stay there, the others go on to the next level. A
    key's number is the count of set bits before its own.
    """

    GAMMA = 2.0

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        self.n = len(keys)
        while len(keys):
            size = max(8, int(self.GAMMA * len(keys)))
            slot = self._slot(keys, len(self.levels), size)
            alone = np.bincount(slot, minlength=size) == 1
            self.levels.append(alone)
            keys = keys[~alone[slot]]
        self._rank()

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64)) % np.uint64(size)).astype(np.int64)

    def _rank(self) -> None:
        bits = np.concatenate([*self.levels, np.zeros(0, dtype=bool)])
        self.before = np.concatenate([[0], np.cumsum(bits)])
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in self.levels])]).astype(np.int64)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """A number below n for each key; keys it was not built for get any number or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            slot = self._slot(keys[left], level, len(bits))
            here = bits[slot]
            out[left[here]] = self.before[self.starts[level] + slot[here]]
            left = left[~here]
        return out

    def dump(self) -> tuple[bytes, bytes]:
        sizes = np.array([len(x) for x in self.levels], dtype=np.int64)
        return sizes.tobytes(), np.packbits(np.concatenate([*self.levels, np.zeros(0, dtype=bool)])).tobytes()

    @classmethod
    def load(cls, sizes: bytes, bits: bytes) -> PerfectHash:
        self = cls(np.zeros(0, dtype=np.uint64))
        lengths = np.frombuffer(sizes, dtype=np.int64)
        flat = np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).astype(bool)[: lengths.sum()]
        self.levels = np.split(flat, np.cumsum(lengths)[:-1]) if len(lengths) else []
        self._rank()
        self.n = int(self.before[-1])
        return self


def _line_keys(data: np.ndarray, offsets: np.ndarray):
    """Of every line: its text's row, its number in the text, its key's length, two key hashes."""
    # One more byte at each text's end, so that each text ends like a line.
    rows = len(offsets) - 1
    shifted = np.insert(data, offsets[1:], 0x0A)
    ends = np.flatnonzero(shifted == 0x0A)
    last = offsets[1:] + np.arange(1, rows + 1)
    row = np.searchsorted(last, ends, side="right")
    starts = np.concatenate([[0], ends[:-1] + 1])
    first_line = np.searchsorted(ends, np.concatenate([[0], last[:-1]]))
    number = np.arange(len(ends)) - first_line[row]
    solid = np.flatnonzero(~spaces(shifted))
    a = np.searchsorted(solid, starts)
    b = np.searchsorted(solid, ends)
    has = b > a
    padded = np.append(solid, 0)
    begin = np.where(has, padded[a], 0)
    stop = np.where(has, padded[np.maximum(b - 1, 0)] + 1, 0)
    low = lowered(shifted)
    chars = np.concatenate([[0], np.cumsum((shifted & 0xC0) != 0x80)])
    length = chars[stop] - chars[begin]
    return row, number, length, Prefixes(low, 11).range(begin, stop), Prefixes(low, 12).range(begin, stop)


def _distinct_keys(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0)):
                row, _, length, h1, h2 = _line_keys(data, offsets)
                keep = length >= min_chars
                row, h1, h2 = row[keep], h1[keep], h2[keep]
                order = np.lexsort((h2, h1, row))
                row, h1, h2 = row[order], h1[order], h2[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
                # Summed over the slice: a line of many documents leaves as one row.
                pairs = np.stack([h1[new], h2[new]], axis=1)
                pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
                first = np.ones(len(pairs), dtype=bool)
                first[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
                at = np.flatnonzero(first)
                n = np.diff(np.append(at, len(pairs)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[at, 0].view(np.int64)), pa.array(pairs[at, 1].view(np.int64)), pa.array(n)],
                    schema=schema,
                )

    return run


def _build_shard(ceiling: int):
    width = np.uint8 if ceiling <= 255 else np.uint32

    def run(table: pa.Table) -> pa.Table:
        h1 = table["h1"].to_numpy().view(np.uint64)
        h2 = table["h2"].to_numpy().view(np.uint64)
        n = np.minimum(table["n"].to_numpy(), ceiling)
        # Two keys may agree in the first 64 bits; the rarer one is then kept beside the arrays.
        order = np.lexsort((-n, h1))
        h1, h2, n = h1[order], h2[order], n[order]
        main = np.ones(len(h1), dtype=bool)
        main[1:] = h1[1:] != h1[:-1]
        perfect = PerfectHash(h1[main])
        number = perfect.number(h1[main])
        prints = np.zeros(perfect.n, dtype=np.uint64)
        counts = np.zeros(perfect.n, dtype=width)
        prints[number], counts[number] = h2[main], n[main]
        extra = np.stack([h1[~main], h2[~main], n[~main].astype(np.uint64)], axis=1)
        sizes, bits = perfect.dump()
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()], pa.int64()),
                "sizes": pa.array([sizes], pa.binary()),
                "bits": pa.array([bits], pa.binary()),
                "prints": pa.array([prints.tobytes()], pa.binary()),
                "counts": pa.array([counts.tobytes()], pa.binary()),
                "extra": pa.array([extra.tobytes()], pa.binary()),
            }
        )

    return run


def _probe(row: dict, h1: np.ndarray, h2: np.ndarray, wide: bool) -> np.ndarray:
    """Number of documents, as far as the array counts, of each asked key."""
    perfect = PerfectHash.load(row["sizes"], row["bits"])
    prints = np.frombuffer(row["prints"], dtype=np.uint64)
    counts = np.frombuffer(row["counts"], dtype=np.uint32 if wide else np.uint8)
    number = perfect.number(h1)
    known = number >= 0
    known[known] = prints[number[known]] == h2[known]
    out = np.zeros(len(h1), dtype=np.int64)
    out[known] = counts[number[known]]
    for a, b, n in np.frombuffer(row["extra"], dtype=np.uint64).reshape(-1, 3):
        out[(h1 == a) & (h2 == b)] = int(n)
    return out


def _asked(shards: int, min_chars: int):
    schema = pa.schema(
        [("shard", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("text_key", pa.binary()), ("line", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for first, data, offsets in text_slices(texts):
                row, number, length, h1, h2 = _line_keys(data, offsets)
                keep = length >= min_chars
                row, number, h1, h2 = row[keep], number[keep], h1[keep], h2[keep]
                raw = data.tobytes()
                keys = pa.array(
                    [hashlib.md5(raw[offsets[i] : offsets[i + 1]]).digest() for i in range(len(offsets) - 1)], pa.binary()
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((h1 % np.uint64(shards)).astype(np.int64)),
                        pa.array(h1.view(np.int64)),
                        pa.array(h2.view(np.int64)),
                        keys.take(pa.array(row)),
                        pa.array(number.astype(np.int32)),
                    ],
                    schema=schema,
                )

    return run


def _answer(threshold: int):
    wide = threshold > 255

    def run(arrays: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"text_key": pa.array([], pa.binary()), "line": pa.array([], pa.int32())}
        if not arrays.num_rows or not asked.num_rows:
            return pa.table(out)
        h1 = asked["h1"].to_numpy().view(np.uint64)
        h2 = asked["h2"].to_numpy().view(np.uint64)
        hit = _probe(arrays.slice(0, 1).to_pylist()[0], h1, h2, wide) >= threshold
        return asked.filter(pa.array(hit)).select(["text_key", "line"])

    return run


def _rewrite(positions: list[int], schema: pa.Schema):
    text_at, hits_at = positions

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, dropped = [], [], []
            for text, hits in zip(batch.column(text_at).to_pylist(), batch.column(hits_at).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                gone = set(hits or ())
                kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text or "")
                before.append(len(lines))
                dropped.append(len(gone))
            columns = [c for i, c in enumerate(batch.columns) if i != hits_at]
            columns += [pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def index(documents: DataFrame, text: str, shards: int, threshold: int, min_chars: int = 1) -> DataFrame:
    """One row of arrays per shard that has keys."""
    keys = documents.select(F.col(text).alias("text")).mapInArrow(_distinct_keys(min_chars), "h1 long, h2 long, n long")
    counted = keys.groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    # The remainder of the unsigned hash, as numpy takes it in `_asked`.
    high = F.shiftrightunsigned("h1", 1) % shards
    shard = (high * 2 + F.col("h1").bitwiseAND(F.lit(1))) % shards
    return (
        counted.withColumn("shard", shard)
        .groupBy("shard")
        .applyInArrow(
            _build_shard(max(threshold, 255)),
            "shard long, sizes binary, bits binary, prints binary, counts binary, extra binary",
        )
    )


def drop_common_lines(
    documents: DataFrame, text: str = "text", threshold: int = 10, min_chars: int = 1
) -> DataFrame:
    """All rows and columns of `documents` and three more: `kept_text`, `n_lines`
    (before) and `n_dropped`.

    A key of at least `min_chars` code points in at least `threshold` documents
    (rows) loses all its lines. The number of shards follows the number of lines.
    """
    documents = documents.drop(*({"kept_text", "n_lines", "n_dropped"} - {text.lower()}))
    work = Workspace(documents.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    breaks = F.length(whole) - F.length(F.translate(whole, "\n", ""))
    total = documents.select(F.sum(breaks + 1)).first()[0] or 1
    shards = max(1, -(-total // KEYS_PER_SHARD))
    arrays = work.save(index(documents, text, shards, threshold, min_chars), "arrays")
    asked = work.save(
        documents.select(F.col(text).alias("text")).mapInArrow(
            _asked(shards, min_chars), "shard long, h1 long, h2 long, text_key binary, line int"
        ),
        "asked",
    )
    # Copies of a shard's row: as many as its lines need. Rows: one for each shard.
    loads = asked.groupBy("shard").agg(
        F.ceil(F.count("*") / LINES_PER_TASK).cast("long").alias("copies")
    )
    loads = work.save(loads, "loads")
    salt = F.pmod(F.xxhash64("text_key", "line"), F.col("copies"))
    salted = asked.join(loads, "shard").withColumn("copy", salt).drop("copies")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    loads = loads.select(F.col("shard").alias("of"), each.alias("copy"))
    copied = arrays.join(loads, F.col("shard") == F.col("of")).drop("of")
    hits = (
        copied.groupBy("shard", "copy")
        .cogroup(salted.groupBy("shard", "copy"))
        .applyInArrow(_answer(threshold), "text_key binary, line int")
    )
    lines_hit = hits.groupBy("text_key").agg(F.collect_set("line").alias("lines"))
    keyed = documents.withColumn(_free("text_key", documents), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    key = keyed.columns[-1]
    lines_hit = lines_hit.withColumnsRenamed({"text_key": key, "lines": _free("lines", documents)})
    joined = keyed.join(lines_hit, key, "left").drop(key)
    added = [StructField("kept_text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    schema = StructType([*documents.schema.fields, *added])
    positions = [documents.columns.index(text), len(documents.columns)]
    return joined.mapInArrow(_rewrite(positions, to_arrow_schema(schema)), schema)


def _free(name: str, df: DataFrame) -> str:
    """`name`, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name
