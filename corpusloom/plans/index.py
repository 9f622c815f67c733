"""Index: stored documents into trigram postings."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.grams import count_grams, count_spread, size_tier, spread_texts, window_count
from corpusloom.session import Workspace
from corpusloom.sources.tables import Tables

TEXT = ("title", "abstract")

# Bytes of text per bucket of an index, and so per counting task.
_BYTES_PER_BUCKET = 16 << 20


def build_postings(documents: DataFrame, partitions: int | None = None) -> DataFrame:
    """(gram, doc_id, tf) over title and abstract of (id, title, abstract)."""
    return count_grams(documents, "id", TEXT, partitions)


def _measured(documents: DataFrame, load_id: Column, work: Workspace) -> DataFrame:
    """Per load its documents, their grams and the bytes of their texts."""
    size = sum(F.octet_length(F.coalesce(c, F.lit(""))).cast("long") for c in TEXT)
    loads = documents.groupBy(load_id.alias("load_id")).agg(
        F.count("*").alias("docs_indexed"),
        F.sum(window_count(TEXT)).alias("grams_generated"),
        F.sum(size).alias("bytes"),
    )
    return work.save(loads, "loads")


def _buckets(loads: DataFrame) -> int:
    usual = int(loads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(usual, (loads.agg(F.sum("bytes")).first()[0] or 0) // _BYTES_PER_BUCKET)


def _placed(documents: DataFrame, buckets: int) -> DataFrame:
    """Postings with the load and the tier of their document.

    The texts are spread by document, into as many parts as the index has buckets,
    so each task writes one bucket. Rows that share an id are counted together, and
    the postings belong to each of them.
    """
    tiered = documents.withColumn("tier", size_tier(window_count(TEXT)))
    spread = spread_texts(tiered, "id", TEXT, buckets, ("load_id", "tier"))
    owners = F.collect_list(F.struct("load_id", "tier")).over(Window.partitionBy("doc_id"))
    owned = spread.withColumn("owners", owners)
    # Nearly always one: only the others travel as an array.
    first, more = F.col("owners")[0], F.slice("owners", 2, F.size("owners"))
    owned = owned.select("doc_id", first["load_id"].alias("load_id"), first["tier"].alias("tier"), more.alias("more"), *TEXT)
    postings = count_spread(owned, TEXT, order=("load_id", "tier"))
    each = F.explode(F.concat(F.array(F.struct("load_id", "tier")), "more")).alias("owner")
    return postings.select("gram", "doc_id", "tf", each).select("gram", "doc_id", "tf", "owner.load_id", "owner.tier")


def build_index(tables: Tables, mode: str = "overwrite", partitions: int | None = None) -> None:
    """Index all stored documents.

    `overwrite` replaces the index, in `partitions` buckets or as many as the texts
    need. `append` adds the postings of all documents once more, so that every hit
    count grows by the same amount again.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be 'overwrite' or 'append', not {mode!r}")
    documents = tables.documents()
    if mode == "append":
        _index_as(tables, documents, f"{tables.AGAIN}{uuid.uuid4().hex}", partitions)
        return
    started = time.monotonic()
    work = Workspace(tables.spark)
    loads = _measured(documents, F.col("load_id"), work)
    buckets = partitions or _buckets(loads)
    tables.index_all(_placed(documents, buckets), loads.drop("bytes"), buckets, started)
    work.clear()


def index_load(tables: Tables, load_id: str, partitions: int | None = None) -> None:
    """Index only the documents one load has added; can be repeated. A load that was
    merged into another is in the index already."""
    if tables.is_merged(load_id):
        return
    _index_as(tables, tables.documents().where(F.col("load_id") == load_id), load_id, partitions)


def _index_as(tables: Tables, documents: DataFrame, load_id: str, partitions: int | None) -> None:
    started = time.monotonic()
    work = Workspace(tables.spark)
    loads = _measured(documents, F.lit(load_id), work)
    buckets = tables.open_index(partitions or _buckets(loads))
    tables.index_load(_placed(documents, buckets), load_id, loads.drop("bytes"), started)
    work.clear()
