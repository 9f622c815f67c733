"""Article JSON to typed records, with a reason for every rejected file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.rawjson import array_texts, first_array, first_int, first_object, first_string, first_variant
from corpusloom.functions.variant import array_at, int_at, string_at, variant_at
from corpusloom.schemas import RECORDS

BAD_JSON = "bad_json"
NO_METADATA = "no_metadata"
NO_DOI = "no_doi"
UNREADABLE = "unreadable"
EMPTY = "empty"


def _author(entry: Column) -> Column:
    """Name parts of one entry; entries that are no objects become blank."""
    return F.struct(
        *[
            F.coalesce(string_at(entry, f"$.{part}"), F.lit("")).alias(part)
            for part in ("first", "last", "initial")
        ]
    )


def _authors(doc: Column, path: str, limit: int | None) -> Column:
    listed = array_at(doc, path)
    listed = listed if limit is None else F.slice(listed, 1, limit)
    none = F.array().cast(RECORDS["authors"].dataType)
    return F.coalesce(F.transform(listed, _author), none)


def _author_text(entry: Column) -> Column:
    return F.struct(
        *[F.coalesce(first_string(entry, part), F.lit("")).alias(part) for part in ("first", "last", "initial")]
    )


def _author_texts(metadata: Column, limit: int | None) -> Column:
    listed = first_array(metadata, "authors")
    listed = listed if limit is None else F.slice(listed, 1, limit)
    return F.coalesce(F.transform(listed, _author_text), F.array().cast(RECORDS["authors"].dataType))


def parse_records(raw: DataFrame, author_limit: int | None = None) -> DataFrame:
    """(file_path, value) to `schemas.RECORDS`; `author_limit` authors of a record, or all.

    Spark's JSON parser stops after the first value, so text after the object
    would go unnoticed. The file is therefore parsed as the first element of an
    array that ends in the file's own digest: only when the file is exactly one
    JSON value does the digest come out as the second element.

    Objects that repeat a key are no VARIANT. Files that fail the strict parse are
    taken apart once more, with the first of repeated keys counting; only what
    fails there too is bad JSON. Their authors are taken apart one by one only where an
    author repeats a key.
    """
    texts = raw.select("file_path", F.col("value").alias("text"))
    digested = texts.select("file_path", "text", F.md5("text").alias("digest"))
    wrapped = F.concat(F.lit("["), "text", F.lit(',"'), "digest", F.lit('"]'))
    valid = F.is_valid_utf8("text")
    # Generated rather than projected: a filter on the fields below then stays
    # above the parse instead of having copies of it.
    doc = F.explode(F.array(F.when(valid, F.try_parse_json(wrapped)))).alias("doc")
    parsed = digested.select("file_path", "digest", F.when(valid, wrapped).alias("wrapped"), doc)
    doc = F.col("doc")
    whole = F.coalesce(F.try_variant_get(doc, "$[1]", "string") == F.col("digest"), F.lit(False))
    elements = F.explode(F.array(F.when(~whole, array_texts(F.col("wrapped"))))).alias("elements")
    again = parsed.select("file_path", "digest", "doc", whole.alias("strict"), elements)
    record = F.when(F.get("elements", 1) == F.col("digest"), F.get("elements", 0))
    again = again.select("file_path", "doc", "strict", record.alias("record"))
    metadata = F.explode(F.array(first_object(F.col("record"), "metadata"))).alias("metadata")
    split = again.select("file_path", "doc", "strict", "record", metadata)
    # Authors rarely repeat keys themselves: their array is a VARIANT where it can be.
    listed = F.explode(F.array(first_variant(F.col("metadata"), "authors"))).alias("listed")
    split = split.select("file_path", "doc", "strict", "record", "metadata", listed)
    record, metadata, strict = F.col("record"), F.col("metadata"), F.col("strict")

    def either(exact: Column, lenient: Column) -> Column:
        return F.when(strict, exact).otherwise(lenient)

    fields = split.select(
        "file_path",
        (strict | record.isNotNull()).alias("whole"),
        F.when(strict, variant_at(doc, "$[0].metadata").isNotNull())
        .otherwise(F.get_json_object(record, "$.metadata").isNotNull())
        .alias("has_metadata"),
        either(string_at(doc, "$[0].metadata.doi"), first_string(metadata, "doi")).alias("doi"),
        either(string_at(doc, "$[0].metadata.title"), first_string(metadata, "title")).alias("title"),
        either(string_at(doc, "$[0].abstract"), first_string(record, "abstract")).alias("abstract"),
        either(string_at(doc, "$[0].metadata.issn"), first_string(metadata, "issn")).alias("issn"),
        either(int_at(doc, "$[0].metadata.pub_year"), first_int(metadata, "pub_year")).alias("pub_year"),
        F.when(strict, _authors(doc, "$[0].metadata.authors", author_limit))
        .when(F.col("listed").isNotNull(), _authors(F.col("listed"), "$", author_limit))
        .otherwise(_author_texts(metadata, author_limit))
        .alias("authors"),
    )
    reason = (
        F.when(~F.col("whole"), BAD_JSON)
        .when(~F.col("has_metadata"), NO_METADATA)
        .when(F.coalesce("doi", F.lit("")) == "", NO_DOI)
    )
    return fields.select(
        "file_path", reason.alias("reason"), *[f.name for f in RECORDS.fields[2:]]
    )


def unread(listed: DataFrame, records: DataFrame) -> DataFrame:
    """Files of a listing that gave no record: empty ones, and ones that could not be read."""
    missing = listed.join(records.select("file_path"), "file_path", "left_anti")
    return missing.select("file_path", F.when(F.col("size") == 0, EMPTY).otherwise(UNREADABLE).alias("reason"))


def accepted(records: DataFrame) -> DataFrame:
    return records.where("reason IS NULL")


def rejected(records: DataFrame) -> DataFrame:
    return records.where("reason IS NOT NULL").select("file_path", "reason")
