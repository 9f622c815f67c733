"""Parsed records to the rows that a load adds to the three stored tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.dedup import first_authors, first_files, first_relations
from corpusloom.operators.keys import dense_ids, id_block
from corpusloom.operators.lookup import absent, stored_already
from corpusloom.schemas import AUTHOR_KEYS, DOCUMENT_KEYS
from corpusloom.session import Workspace
from corpusloom.sources.records import accepted, unread
from corpusloom.sources.tables import Tables

NAME = ["first_name", "last_name", "initial"]


@dataclass(frozen=True)
class Load:
    """What one load adds, and the intermediate tables it is counted from.

    records:   all parsed files, rejected ones with their reason
    winners:   (doi, file_path) of the files whose content is used
    listed:    the authors those files list, each once, with their document
    new_keys:  (id, doi, file_path) of the documents to insert
    documents, authors, relations: the rows to insert
    """

    records: DataFrame
    winners: DataFrame
    listed: DataFrame
    new_keys: DataFrame
    documents: DataFrame
    authors: DataFrame
    relations: DataFrame


def normalize(
    records: DataFrame,
    tables: Tables,
    work: Workspace,
    claimed: DataFrame | None = None,
    listed_files: DataFrame | None = None,
) -> Load:
    """The new rows of one run over `records`, given what is stored already.

    A DOI that repeats inside the run counts once: the first file by path
    brings the metadata and the authors, the others are dropped whole. A DOI
    stored by an earlier run keeps its metadata, but authors that the new file
    lists are added and attached to it. `claimed` holds DOIs that earlier
    micro-batches of the same run have used. `listed_files` are the files that should
    have given records; those that did not become records with a reason.

    Records, winners and author rows are written once and read column-pruned
    from there. Everything up to the ids moves keys only; the texts move once,
    joined by file path. Ids that keys have already come from the key tables.
    Author rows, many times the records, get their document while they still are the
    array of a record, which also drops names that it repeats. They are shuffled once,
    for their author's id; only where records share a file path they are dropped again.
    """
    records = work.save(records, "records")
    good = accepted(records)
    if listed_files is not None:
        # Asked for twice below, and few.
        missing = work.save(unread(listed_files, records), "unread")
        records = records.unionByName(missing, allowMissingColumns=True)
    winners = work.save(first_files(good), "first-files")
    if claimed is not None:
        taken = stored_already(claimed, winners, ["doi"])
        winners = work.save(absent(winners, taken, ["doi"]), "winners")

    last_document, last_author = tables.last_ids()
    known = tables.known_ids("document_keys", DOCUMENT_KEYS, winners)
    known = work.save(known.select("doi", F.col("id").alias("document_id")), "known-documents")
    new_keys = dense_ids(absent(winners, known, ["doi"]), ["doi"], "id", last_document, work)
    new_documents = (
        good.drop("doi", "authors", "reason")
        .join(new_keys, "file_path")
        .select(
            "id",
            "doi",
            *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "abstract", "issn")],
            "pub_year",
        )
    )

    document_ids = known.unionByName(new_keys.select("doi", F.col("id").alias("document_id")))
    used = winners.join(document_ids, "doi", "left").select("file_path", "document_id")
    listed = good.select("file_path", "authors").join(used, "file_path")
    listed = work.save(first_authors(listed, "document_id"), "listed-authors")
    names = work.save(listed.select(*NAME).distinct(), "author-names")
    known_authors = work.save(tables.known_ids("author_keys", AUTHOR_KEYS, names), "known-authors")
    new_authors = dense_ids(absent(names, known_authors, NAME), NAME, "id", last_author, work)

    author_ids = known_authors.select("id", *NAME).unionByName(new_authors.select("id", *NAME))
    linked = (
        listed.where(F.col("document_id").isNotNull())
        .join(author_ids.withColumnRenamed("id", "author_id"), NAME)
        .select("document_id", "author_id", "author_order")
    )
    if not good.groupBy("file_path").count().where("count > 1").isEmpty():
        linked = first_relations(linked)
    if known.isEmpty():
        new_relations = linked
    else:
        known = known.withColumn("id_block", id_block("document_id"))
        kept = stored_already(tables.relations(), known, ["id_block", "document_id"])
        new_relations = absent(linked, kept, ["document_id", "author_id"])
    return Load(records, winners, listed, new_keys, new_documents, new_authors, new_relations)
