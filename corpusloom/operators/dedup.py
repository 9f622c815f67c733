"""First-wins rules for files, authors and relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_files(records: DataFrame) -> DataFrame:
    """(doi, file_path) of the first file, by path, of every DOI.

    Only the two key columns are shuffled, after a map-side minimum, so a DOI
    that many files share costs one row per task. The texts are fetched later
    by `file_path`, which is unique.
    """
    return records.groupBy("doi").agg(F.min("file_path").alias("file_path"))


def explode_authors(records: DataFrame, *keys: str) -> DataFrame:
    """One row per author of a record: keys, 0-based author_order and the name parts.

    An author named twice in a record gives two rows; `first_relations` drops one.
    """
    rows = records.select(*keys, F.posexplode("authors").alias("author_order", "author"))
    return rows.select(
        *keys,
        "author_order",
        F.col("author.first").alias("first_name"),
        F.col("author.last").alias("last_name"),
        F.col("author.initial").alias("initial"),
    )


def first_authors(records: DataFrame, *keys: str) -> DataFrame:
    """The rows of `explode_authors`, of a name that a record repeats only the first.

    They are found inside the array of the record, sorted by name: nothing is shuffled
    or held but one record. Keys and name parts may be null.
    """
    parts = ("first", "last", "initial")
    named = F.transform(
        "authors", lambda a, i: F.struct(*[a[p].alias(p) for p in parts], i.alias("author_order"))
    )
    # Generated rather than projected: the filter below looks into it at every element.
    rows = records.select(*keys, F.explode(F.array(F.sort_array(named))).alias("sorted"))

    def is_first(author: Column, at: Column) -> Column:
        before = F.get("sorted", at - 1)
        same = before["first"].eqNullSafe(author["first"])
        for p in parts[1:]:
            same = same & before[p].eqNullSafe(author[p])
        return (at == 0) | ~same

    rows = rows.select(*keys, F.explode(F.filter("sorted", is_first)).alias("author"))
    return rows.select(
        *keys,
        F.col("author.author_order").alias("author_order"),
        F.col("author.first").alias("first_name"),
        F.col("author.last").alias("last_name"),
        F.col("author.initial").alias("initial"),
    )


def first_relations(relations: DataFrame) -> DataFrame:
    """One row per (document_id, author_id), at its smallest author_order."""
    return relations.groupBy("document_id", "author_id").agg(
        F.min("author_order").alias("author_order")
    )
