"""Compaction: the postings of many small loads in one folder each turn into few."""

from __future__ import annotations

import math
import time
import uuid

from pyspark.sql import functions as F

from corpusloom.sources.tables import Tables

FAN = 8


def compact_index(tables: Tables, fan: int = FAN) -> int:
    """Merge loads of the index in use that are of one size class, `fan` or more at a
    time; returns how many merges were made.

    Classes are powers of `fan` in postings, so a posting is rewritten once per
    class and at most `fan - 1` folders a class stay. A merge is written beside its
    loads, and one row makes it visible and them not. Postings stay in their buckets,
    so nothing is shuffled. Loads that repeat other loads' documents stay apart.
    """
    merges = 0
    while True:
        rows = tables.indexed().where(~F.startswith("load_id", F.lit(tables.AGAIN)))
        classes: dict[int, list[str]] = {}
        # One row per load in the index.
        for r in rows.groupBy("load_id").agg(F.max("postings").alias("n")).orderBy("load_id").collect():
            classes.setdefault(int(math.log(max(r["n"], 1), fan)), []).append(r["load_id"])
        full = [loads for loads in classes.values() if len(loads) >= fan]
        if not full:
            return merges
        for loads in full:
            tables.merge_indexed(loads, f"merged-{uuid.uuid4().hex}", time.monotonic())
            merges += 1
