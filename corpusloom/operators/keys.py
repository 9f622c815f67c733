"""Dense surrogate keys without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import Workspace

# Fixed value of the stored layout: ids per folder of an entity table.
BLOCK_ROWS = 1_000_000

# Fixed value of the stored layout: folders of a key table.
KEY_PARTS = 128

# Fixed value of the stored layout: the folder of loads of few keys.
FEW_KEYS_PART = -1

# monotonically_increasing_id() keeps the row number within a partition in its
# lower 33 bits and the partition number above them.
_ROW_BITS = 33


def id_block(id_col: str) -> Column:
    return F.expr(f"{id_col} div {BLOCK_ROWS}")


def key_part(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_PARTS)).cast("int")


def dense_ids(
    rows: DataFrame, order_by: list[str], id_col: str, after: int, work: Workspace
) -> DataFrame:
    """`rows` with ids after+1, after+2, ... in the order of unique `order_by`.

    Rows are range-partitioned and sorted, their position is written down, and
    the id is the position plus the rows in the partitions before. The position
    must be written: it would not be the same if the sort ran again. The
    offsets are one row per partition, which bounds both the window and the
    broadcast.
    """
    placed = work.save(
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id()),
        f"{id_col}-order",
    )
    part = F.shiftright("_at", _ROW_BITS).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(
            (row + F.col("_before") + F.lit(after + 1)).alias(id_col),
            *rows.columns,
        )
    )
