"""Document view: metadata with ordered authors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.keys import id_block
from corpusloom.operators.lookup import by_ids

SHOWN = ["id", "doi", "title", "abstract", "issn", "pub_year"]
# Relations that a task gathers into lists.
_ROWS_PER_TASK = 500_000
AUTHORS_TYPE = "array<struct<author_order:int,first_name:string,last_name:string>>"


def document_authors(relations: DataFrame, authors: DataFrame) -> DataFrame:
    """(document_id, author_order, first_name, last_name), one row per relation."""
    on = ["author_id"]
    links = relations.select("document_id", "author_id", "author_order")
    if "id_block" in authors.columns:
        on = ["id_block", "author_id"]
        links = links.withColumn("id_block", id_block("author_id"))
    names = authors.withColumnRenamed("id", "author_id").select(*on, "first_name", "last_name")
    return links.join(names, on).select(
        "document_id", "author_order", "author_id", "first_name", "last_name"
    )


def _of_ids(table: DataFrame, wanted: DataFrame, id_col: str) -> DataFrame:
    """The rows of the wanted ids; of a stored table only their blocks are read."""
    on = ["id_block", id_col] if "id_block" in table.columns else [id_col]
    return table.join(wanted.select(*on), on, "left_semi")


def document_view(
    documents: DataFrame,
    relations: DataFrame,
    authors: DataFrame,
    ids: Sequence[int] | DataFrame | None = None,
) -> DataFrame:
    """One row per document with `authors` in author_order.

    `ids` may be a few literal ids, which prune the scans, a frame with a
    column `id`, or None for all documents. An id that is not stored gives no
    row. The array holds the authors of one document.

    Relations are stored in few bytes, so a task that reads them holds many millions:
    they are spread by document, into parts by their number, before they are gathered.
    """
    if isinstance(ids, DataFrame):
        wanted = ids.select("id").distinct().withColumn("id_block", id_block("id"))
        documents = _of_ids(documents, wanted, "id")
        relations = _of_ids(relations, wanted.withColumnRenamed("id", "document_id"), "document_id")
    elif ids is not None:
        documents = by_ids(documents, "id", ids)
        relations = by_ids(relations, "document_id", ids)
    parts = relations.count() // _ROWS_PER_TASK
    named = document_authors(relations, authors)
    # Fewer rows than the session's partitions would hold are left to adaptive execution.
    if parts > 1:
        named = named.repartition(parts, "document_id")
    listed = (
        named.groupBy("document_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("author_order", "author_id", "first_name", "last_name")
                )
            ).alias("listed")
        )
        .select(F.col("document_id").alias("id"), "listed")
    )
    shown = F.transform(
        "listed", lambda a: F.struct(a["author_order"], a["first_name"], a["last_name"])
    ).cast(AUTHORS_TYPE)
    return documents.select(*SHOWN).join(listed, "id", "left").select(
        *SHOWN, F.coalesce(shown, F.array().cast(AUTHORS_TYPE)).alias("authors")
    )
