"""Counters of ingest and index as one-row frames."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import duration
from corpusloom.sources.tables import Tables

_SUMMED = [
    "files_processed",
    "parse_errors",
    "duplicate_files",
    "documents_inserted",
    "authors_staged",
    "authors_inserted",
    "relations_inserted",
]


def _operations(staged: str, inserted: str, name: str):
    """Combined counter: a staged row counts twice, an inserted row once more."""
    return (2 * F.col(staged) + F.col(inserted)).alias(name)


def ingest_report(loads: DataFrame) -> DataFrame:
    """Totals per run, with staged and inserted rows and the combined counters."""
    total = loads.groupBy("run_id").agg(
        *[F.sum(c).alias(c) for c in _SUMMED], F.sum("seconds").alias("seconds")
    )
    return total.select(
        "run_id",
        *_SUMMED,
        _operations("files_processed", "documents_inserted", "doc_ops_total"),
        _operations("authors_staged", "authors_inserted", "author_ops_total"),
        _operations("authors_staged", "relations_inserted", "rel_ops_total"),
        duration("seconds").alias("elapsed"),
    )


def ingest_progress(loads: DataFrame) -> DataFrame:
    """Files, errors and relations so far after every load of a run.

    The window runs over one row per load.
    """
    so_far = Window.partitionBy("run_id").orderBy("batch").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return loads.select(
        "run_id",
        "batch",
        F.sum("files_processed").over(so_far).alias("files"),
        F.sum("parse_errors").over(so_far).alias("errors"),
        F.sum("authors_staged").over(so_far).alias("relations"),
        duration(F.sum("seconds").over(so_far)).alias("elapsed"),
    )


def index_report(indexed: DataFrame) -> DataFrame:
    """Documents at hand (also those without grams), the grams that their texts
    generate, the grams inserted as the index counts them, the aggregated rows they
    are stored in, and the time it took; from the stored rows of each load.

    A load that was indexed again has several rows and counts once; its documents
    count once as well where a further load repeats all of them.
    """
    own = ~F.startswith("load_id", F.lit(Tables.AGAIN))
    counted = ["docs_indexed", "grams_generated", "grams_inserted", "postings"]
    loads = indexed.groupBy("load_id").agg(*[F.max(c).alias(c) for c in counted])
    none = F.lit(0).cast("long")
    sums = loads.agg(
        *[F.coalesce(F.sum(F.when(own, F.col(c))), none).alias(c) for c in counted[:2]],
        *[F.coalesce(F.sum(c), none).alias(c) for c in counted[2:]],
    )
    runs = indexed.groupBy("run").agg(F.max("seconds").alias("seconds"))
    spent = runs.agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))
    both = sums.unionByName(spent, allowMissingColumns=True)
    total = both.agg(*[F.max(c).alias(c) for c in (*counted, "seconds")])
    return total.select(*counted, duration("seconds").alias("elapsed"))


def timed(results: DataFrame) -> tuple[list[Row], float]:
    """Rows of a top-k result and the milliseconds it took to get them."""
    started = time.monotonic()
    rows = results.collect()
    return rows, (time.monotonic() - started) * 1000.0
