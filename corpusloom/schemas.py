"""Schemas of the stored tables and of the frames that pass between the jobs."""

from pyspark.sql import types as T

AUTHOR = T.StructType(
    [
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("initial", T.StringType()),
    ]
)

# One parsed article file. `reason` is null for an accepted record.
RECORDS = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("doi", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("issn", T.StringType()),
        T.StructField("pub_year", T.IntegerType()),
        T.StructField("authors", T.ArrayType(AUTHOR)),
    ]
)

_LOAD = [T.StructField("load_id", T.StringType())]
_BLOCK = [T.StructField("id_block", T.LongType())]

DOCUMENTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("doi", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("issn", T.StringType()),
        T.StructField("pub_year", T.IntegerType()),
    ]
    + _LOAD
    + _BLOCK
)

RESULTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("preview", T.StringType()),
    ]
    + _LOAD
    + _BLOCK
)

AUTHORS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("initial", T.StringType()),
    ]
    + _LOAD
    + _BLOCK
)

RELATIONS = T.StructType(
    [
        T.StructField("document_id", T.LongType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("author_order", T.IntegerType()),
    ]
    + _LOAD
    + _BLOCK
)

# Key tables: which id a key has, in folders by a hash of the key.
_KEY_PART = [T.StructField("key_part", T.IntegerType())]

DOCUMENT_KEYS = T.StructType(
    [T.StructField("doi", T.StringType()), T.StructField("id", T.LongType())] + _LOAD + _KEY_PART
)

AUTHOR_KEYS = T.StructType(
    [
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("initial", T.StringType()),
        T.StructField("id", T.LongType()),
    ]
    + _LOAD
    + _KEY_PART
)

# Loads that were begun; one that has no row in the loads is not to be seen.
BEGUN = T.StructType(_LOAD)

POSTINGS = T.StructType(
    [
        T.StructField("gram", T.BinaryType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("tf", T.LongType()),
    ]
    + _LOAD
    + [T.StructField("tier", T.IntegerType())]
)

# Per gram, load and tier of document sizes: the largest count in one document,
# the documents, and all occurrences.
BOUNDS = T.StructType(
    [
        T.StructField("gram", T.BinaryType()),
        T.StructField("most", T.LongType()),
        T.StructField("docs", T.LongType()),
        T.StructField("occurrences", T.LongType()),
    ]
    + _LOAD
    + [T.StructField("tier", T.IntegerType())]
)

# One row per load that an index holds, written when it holds it whole. `seconds`
# is the time of the whole `run` of indexing; `replaces` names the loads that a
# merged one holds instead of them.
INDEXED = T.StructType(
    [
        T.StructField("load_id", T.StringType()),
        T.StructField("docs_indexed", T.LongType()),
        T.StructField("grams_generated", T.LongType()),
        T.StructField("grams_inserted", T.LongType()),
        T.StructField("postings", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("run", T.StringType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)

# One row per batch of searches.
SEARCHES = T.StructType(
    [
        T.StructField("queries", T.LongType()),
        T.StructField("sets", T.LongType()),
        T.StructField("postings_read", T.LongType()),
        T.StructField("postings_skipped", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)

# DOIs already claimed by earlier micro-batches of an unfinished run.
CLAIMED_DOIS = T.StructType(
    [
        T.StructField("doi", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)

# Numbers of finished indexes and their buckets; the highest number is in use.
GENERATIONS = T.StructType(
    [T.StructField("generation", T.LongType()), T.StructField("buckets", T.IntegerType())]
)

# Runs of streams that have ended.
ENDED_RUNS = T.StructType(
    [T.StructField("stream", T.StringType()), T.StructField("number", T.LongType())]
)

# One row per load (a batch ingest, or one micro-batch of a stream), written last:
# it makes the load visible. The last ids are those of the corpus at its end.
LOADS = T.StructType(
    [
        T.StructField("batch", T.LongType()),
        T.StructField("files_seen", T.LongType()),
        T.StructField("parse_errors", T.LongType()),
        T.StructField("duplicate_files", T.LongType()),
        T.StructField("files_processed", T.LongType()),
        T.StructField("authors_staged", T.LongType()),
        T.StructField("documents_inserted", T.LongType()),
        T.StructField("authors_inserted", T.LongType()),
        T.StructField("relations_inserted", T.LongType()),
        T.StructField("last_document_id", T.LongType()),
        T.StructField("last_author_id", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("run_id", T.StringType()),
    ]
    + _LOAD
)

SEARCH_RESULT = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("hits", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("preview", T.StringType()),
    ]
)
