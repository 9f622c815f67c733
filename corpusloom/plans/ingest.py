"""Ingest: article files into the stored tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.normalize import Load, normalize
from corpusloom.schemas import AUTHOR_KEYS, DOCUMENT_KEYS, LOADS
from corpusloom.session import Workspace, even_tasks, side_by_side
from corpusloom.sources.files import list_and_read
from corpusloom.sources.records import parse_records
from corpusloom.sources.tables import Tables


def ingest(
    tables: Tables, path: str, run_id: str | None = None, author_limit: int | None = None
) -> DataFrame:
    """Read every article file below `path` into `tables` as one run.

    Returns the report row of the run. A file that is empty or cannot be read is a
    counted error, and the run goes on. Running it again over the same files
    adds nothing; after a crash, running it again completes it.
    """
    run_id = run_id or uuid.uuid4().hex
    work = Workspace(tables.spark)
    try:
        with even_tasks(tables.spark):
            listed, raw = list_and_read(tables.spark, path, work, skip_unreadable=True)
        load_records(tables, parse_records(raw, author_limit), run_id, run_id, listed_files=listed)
    finally:
        work.clear()
    return tables.loads().where(F.col("run_id") == run_id)


def load_records(
    tables: Tables,
    records: DataFrame,
    run_id: str,
    load_id: str,
    batch: int = 0,
    claimed: DataFrame | None = None,
    listed_files: DataFrame | None = None,
) -> None:
    """Normalise records and append authors, documents and relations.

    A load is seen as a whole or not at all: its row in `loads` comes last. One that
    was cut off is taken back by the load that comes next, the same one or another.
    """
    with even_tasks(tables.spark):
        _load(tables, records, run_id, load_id, batch, claimed, listed_files)


def _load(
    tables: Tables,
    records: DataFrame,
    run_id: str,
    load_id: str,
    batch: int,
    claimed: DataFrame | None,
    listed_files: DataFrame | None,
) -> None:
    started = time.monotonic()
    work = Workspace(tables.spark)
    try:
        tables.begin(load_id)
        load = normalize(records, tables, work, claimed, listed_files)

        def documents() -> None:
            tables.append_entities(load.documents, "documents", "id", load_id)
            tables.write_results(load_id)

        jobs = [lambda: tables.append_entities(load.relations, "documents_x_authors", "document_id", load_id)]
        # What a load adds is worked out in written tables, so asking is cheap.
        if not load.authors.isEmpty():
            jobs.append(lambda: tables.append_entities(load.authors, "authors", "id", load_id))
            jobs.append(lambda: tables.append_keys(load.authors, "author_keys", AUTHOR_KEYS, load_id))
        if not load.new_keys.isEmpty():
            jobs.append(documents)
            jobs.append(lambda: tables.append_keys(load.new_keys, "document_keys", DOCUMENT_KEYS, load_id))
        if claimed is not None:
            jobs.append(lambda: tables.claim_dois(load.winners, run_id, batch))
        # Nothing of it is seen before the load's row is written.
        side_by_side(tables.spark, *jobs)
        stored = tables.stored_by(load_id)
        last_document, last_author = tables.last_ids()
        counted = load_counts(load, stored, last_document, last_author).select(
            F.lit(batch).cast("bigint").alias("batch"),
            *[f.name for f in LOADS.fields if f.name.endswith(COUNT_SUFFIXES)],
            "last_document_id",
            "last_author_id",
            F.lit(time.monotonic() - started).alias("seconds"),
            F.lit(run_id).alias("run_id"),
            F.lit(load_id).alias("load_id"),
        )
        tables.write_load(counted)
    finally:
        work.clear()


COUNT_SUFFIXES = ("_seen", "_errors", "_files", "_processed", "_staged", "_inserted")


def load_counts(load: Load, stored: dict[str, DataFrame], last_document: int, last_author: int) -> DataFrame:
    """One row of counters, from one small aggregate per table; `stored` are the rows
    that the load has added."""
    counters = {
        "files_seen": F.count(F.lit(1)),
        "parse_errors": F.count("reason"),
        "duplicate_files": F.count(F.when(F.col("reason").isNull(), 1)),
    }
    rows = load.records.agg(*[c.cast("bigint").alias(n) for n, c in counters.items()])
    rows = rows.unpivot([], list(counters), "counter", "n")
    used = load.records.join(load.winners, "file_path", "left_semi")
    names = list(counters)
    for name, frame, n in [
        ("files_processed", load.winners, F.count(F.lit(1))),
        ("authors_staged", used, F.coalesce(F.sum(F.size("authors")), F.lit(0))),
        ("documents_inserted", stored["documents"], F.count(F.lit(1))),
        ("authors_inserted", stored["authors"], F.count(F.lit(1))),
        ("relations_inserted", stored["documents_x_authors"], F.count(F.lit(1))),
        ("last_document_id", stored["documents"], F.coalesce(F.max("id"), F.lit(last_document))),
        ("last_author_id", stored["authors"], F.coalesce(F.max("id"), F.lit(last_author))),
    ]:
        one = frame.agg(n.cast("bigint").alias("n"))
        rows = rows.unionByName(one.select(F.lit(name).alias("counter"), "n"))
        names.append(name)
    wide = rows.agg(
        *[F.max(F.when(F.col("counter") == n, F.col("n"))).alias(n) for n in names]
    )
    # `duplicate_files` was counted as accepted files; the used ones come off.
    return wide.withColumn("duplicate_files", F.col("duplicate_files") - F.col("files_processed"))
