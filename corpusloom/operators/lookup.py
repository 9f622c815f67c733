"""Key lookups and insert-if-absent on stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.keys import BLOCK_ROWS


def by_ids(table: DataFrame, id_col: str, ids: Sequence[int]) -> DataFrame:
    """Rows with one of a few literal ids.

    The ids reach the Parquet scan, and on a stored table their blocks leave
    only the folders that can hold them.
    """
    rows = table.where(F.col(id_col).isin(list(ids)))
    if "id_block" in table.columns:
        rows = rows.where(F.col("id_block").isin(sorted({i // BLOCK_ROWS for i in ids})))
    return rows


def stored_already(table: DataFrame, batch: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of a stored table that share a key with a batch.

    A semi join lets the batch, when it is measured to be small, be sent to the
    table instead of shuffling the table.
    """
    return table.join(batch.select(*on), list(on), "left_semi")


def absent(batch: DataFrame, stored: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of a batch whose key is not in `stored`."""
    return batch.join(stored.select(*on), list(on), "left_anti")
