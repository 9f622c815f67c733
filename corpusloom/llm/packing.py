"""Pack documents into sequences of a fixed length, certified by lower bounds.

Documents are cut into pieces of at most `capacity` tokens; only longer documents
are cut. A full piece is a sequence by itself. The others are dealt to partitions
of a bounded number of pieces, and each partition is packed by best-fit
decreasing. Dual-feasible functions give a lower bound on the bins that any
packing of the partition's pieces needs: a partition whose bins equal the bound
is certified. The emptiest bins of a partition - more of them the larger its
gap - are opened and their pieces exchanged: they are dealt anew among fewer
partitions and packed again, until one partition is left or a round saves no bin.
A bin's pieces return to their old bin if packing them anew needs more bins.

Pieces are carried by a row number given when they are first written, so equal
rows and null ids stay apart, and no partition holds more than its share of any
group of copies. Only sizes and places move; token ids are not shuffled.

Defined results: a null or empty text has the closing id alone; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.tokens import encoder
from corpusloom.session import Workspace

CAPACITY = 2048
PIECES_PER_PARTITION = 4096
#: Bins opened for each bin above the lower bound, besides the emptiest one.
OPENED_PER_GAP = 8
ROUNDS = 12

_PIECE = "id string, row long, piece int, start long, length long, ids_crc32 long"
_PLACED = "row long, length long, part long, bin long, offset long, open boolean"


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual-feasible functions.

    With x a length as a share of the capacity: rounding to k parts,
    u(x) = x if (k+1)x is whole, else floor((k+1)x)/k, and dropping up to a
    threshold e, with x above 1-e counting 1 and below e nothing. Sums of
    function values over the lengths never exceed the number of bins.
    """
    if not len(lengths):
        return 0
    sizes, counts = np.unique(lengths, return_counts=True)
    best = Fraction(int((sizes * counts).sum()), capacity)
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        exact = scaled % capacity == 0
        whole = Fraction(int(((scaled // capacity) * counts)[~exact].sum()), k)
        best = max(best, whole + Fraction(int((sizes * counts)[exact].sum()), capacity))
    thresholds = sizes[sizes <= capacity // 2]
    for e in thresholds:
        big = int(counts[sizes > capacity - e].sum())
        middle = (sizes >= e) & (sizes <= capacity - e)
        best = max(best, big + Fraction(int((sizes * counts)[middle].sum()), capacity))
    return -(-best.numerator // best.denominator)


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length; `lengths` come in descending order."""
    spare = [[] for _ in range(capacity + 1)]
    present = 0  # bit r: some bin has r tokens to spare
    bins, used = [], 0
    for length in lengths:
        fitting = present >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = spare[room].pop()
            if not spare[room]:
                present &= ~(1 << room)
        else:
            room, chosen = capacity, used
            used += 1
        bins.append(chosen)
        left = room - length
        if left:
            spare[left].append(chosen)
            present |= 1 << left
    return bins


def _arrange(capacity: int, first: bool):
    """Pack one partition; `first` is false if its pieces already have bins to go back to."""

    def run(table: pa.Table) -> pa.Table:
        row, length = table["row"].to_numpy(), table["length"].to_numpy()
        order = np.lexsort((row, -length))
        row, length = row[order], length[order]
        bins = np.array(best_fit_decreasing(length.tolist(), capacity), dtype=np.int64)
        part = int(table["part"][0].as_py())
        n = int(bins.max()) + 1
        if not first:
            old_part, old_bin = table["old_part"].to_numpy()[order], table["old_bin"].to_numpy()[order]
            old = np.unique(np.stack([old_part, old_bin], axis=1), axis=0, return_inverse=True)[1].reshape(-1)
            if old.max() + 1 <= n:
                bins, n = old.astype(np.int64), int(old.max()) + 1
        gap = n - lower_bound(length, capacity)
        fill = np.bincount(bins, weights=length, minlength=n)
        opened = np.argsort(fill, kind="stable")[: 1 + OPENED_PER_GAP * gap]
        opened = opened[fill[opened] < capacity]
        is_open = np.zeros(n, dtype=bool)
        is_open[opened] = True
        place = np.lexsort((row, -length, bins))
        row, length, bins = row[place], length[place], bins[place]
        total = np.cumsum(length) - length
        starts = np.searchsorted(bins, np.arange(n))
        offset = total - total[starts][bins]
        return pa.table(
            {
                "row": pa.array(row, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "part": pa.array(np.full(len(row), part), pa.int64()),
                "bin": pa.array(bins, pa.int64()),
                "offset": pa.array(offset, pa.int64()),
                "open": pa.array(is_open[bins]),
            }
        )

    return run


def _cut(path: str, capacity: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        number = TaskContext.get().partitionId() << 40
        close = b"\0\0\0\0"
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = {name: [] for name in schema.names}
                for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = codec.encode(text.as_py() or "") + close
                    for piece, begin in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[begin : begin + 4 * capacity]
                        out["id"].append(key)
                        out["row"].append(number)
                        out["piece"].append(piece)
                        out["start"].append(begin // 4)
                        out["length"].append(len(own) // 4)
                        out["ids_crc32"].append(zlib.crc32(own))
                        number += 1
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def pieces(documents: DataFrame, doc_id: str, text: str, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents; `row` numbers them without gaps inside a task only."""
    kind = documents.schema[doc_id].dataType
    schema = pa.schema(
        [("id", pa.string()), ("row", pa.int64()), ("piece", pa.int32())]
        + [(n, pa.int64()) for n in ("start", "length", "ids_crc32")]
    )
    rows = documents.select(F.col(doc_id).cast("string"), F.col(text))
    return rows.mapInArrow(_cut(path, capacity, schema), _PIECE).withColumn("id", F.col("id").cast(kind))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (row, length, and any others) with `sequence_id` and `offset`.

    `pieces` must be a stored table: its rows are read once for each round.
    """
    work = Workspace(pieces.sparkSession)
    small = pieces.where(F.col("length") < capacity).select("row", "length")
    count = small.count()
    parts = max(1, -(-count // PIECES_PER_PARTITION))
    dealt = small.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    placed = [work.save(dealt.groupBy("part").applyInArrow(_arrange(capacity, True), _PLACED), "packed")]
    bins = None
    for turn in range(1, ROUNDS):
        opened = placed[-1].where("open")
        state = opened.agg(F.count("*"), F.count_distinct("part", "bin")).first()
        if parts == 1 or not state[0] or (bins is not None and turn > 2 and state[1] >= bins):
            break
        bins = state[1]
        parts = min(-(-parts // 2), max(1, -(-state[0] // PIECES_PER_PARTITION)))
        # A bin's pieces go together, so a partition compares bins with bins.
        again = opened.select(
            "row",
            "length",
            F.pmod(F.xxhash64("part", "bin"), F.lit(parts)).alias("part"),
            F.col("part").alias("old_part"),
            F.col("bin").alias("old_bin"),
        )
        placed[-1] = placed[-1].where(~F.col("open"))
        placed.append(work.save(again.groupBy("part").applyInArrow(_arrange(capacity, False), _PLACED), "packed"))
    full = pieces.where(F.col("length") >= capacity).select(
        "row",
        F.lit(-1).cast("long").alias("round"),
        F.lit(0).cast("long").alias("part"),
        F.col("row").alias("bin"),
        F.lit(0).cast("long").alias("offset"),
    )
    final = full
    for turn, rows in enumerate(placed):
        final = final.unionByName(
            rows.select("row", F.lit(turn).cast("long").alias("round"), "part", "bin", "offset")
        )
    # Full pieces: the row number, with the highest bit of a positive number set.
    sequence = F.when(F.col("round") < 0, F.col("bin").bitwiseOR(F.lit(1 << 62))).otherwise(
        F.shiftleft("round", 56).bitwiseOR(F.shiftleft("part", 16)).bitwiseOR(F.col("bin"))
    )
    return pieces.join(final.select("row", sequence.alias("sequence_id"), "offset"), "row")


def pack_documents(
    documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    work = Workspace(documents.sparkSession)
    stored = work.save(pieces(documents, doc_id, text, path, capacity), "pieces")
    return pack(stored, capacity).drop("row")
