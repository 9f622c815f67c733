"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.fixtures import corpus, records, table
from corpusloom.functions import text as tx
from corpusloom.operators.dedup import explode_authors, first_files, first_relations
from corpusloom.operators.grams import count_grams, explode_grams, vocabulary
from corpusloom.plans.compact import compact_index
from corpusloom.plans.full import run_all
from corpusloom.plans.index import build_index, build_postings, index_load
from corpusloom.plans.ingest import ingest, load_records
from corpusloom.plans.report import index_report, ingest_progress, ingest_report
from corpusloom.plans.search import search, search_batch_stored, search_stored
from corpusloom.plans.view import document_view
from corpusloom.schemas import RECORDS
from corpusloom.session import Workspace
from corpusloom.sources.files import write_files
from corpusloom.sources.records import accepted, parse_records, rejected
from corpusloom.sources.tables import Tables, sample_titles
from corpusloom.streaming.ingest import ingest_stream

SEARCH_TEXT = "data engine"
ACCENTED_TEXT = "L'Été"

_stored: dict[tuple[str, str, str], Tables] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, fill: Callable[[Tables], None]) -> Tables:
    """Tables filled once per session and test scale, then shared by queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        tables = Tables(spark, f"{Workspace(spark).root}-{name}")
        fill(tables)
        _stored[key] = tables
    return _stored[key]


def article_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select(*RECORDS.names)


def ingested(spark: SparkSession, sf_dir: str) -> Tables:
    """documents, authors and relations stored from all records in one run."""

    def fill(tables: Tables) -> None:
        load_records(tables, article_records(spark, sf_dir), "all", "all")

    return _once(spark, sf_dir, "ingested", fill)


def indexed(spark: SparkSession, sf_dir: str) -> Tables:
    """`ingested` with its trigram index."""
    tables = ingested(spark, sf_dir)

    def fill(_: Tables) -> None:
        build_index(tables)

    _once(spark, sf_dir, "index", fill)
    return tables


def ingested_twice(spark: SparkSession, sf_dir: str) -> Tables:
    """A first run over part of the files, then a run over all of them."""

    def fill(tables: Tables) -> None:
        every = Workspace(spark).save(records(spark, sf_dir), "records")
        early = every.where(F.col("doc_id") % 2 == 1)
        load_records(tables, early.select(*RECORDS.names), "first", "first")
        load_records(tables, every.select(*RECORDS.names), "second", "second")

    return _once(spark, sf_dir, "twice", fill)


def article_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, file_path, value): every record as the JSON text of its file."""
    metadata = F.struct("title", "doi", "issn", "pub_year", "authors").alias("metadata")
    return records(spark, sf_dir).select(
        "doc_id", "file_path", F.to_json(F.struct("abstract", metadata)).alias("value")
    )


def streamed(spark: SparkSession, sf_dir: str) -> Tables:
    """The JSON files, one per record, loaded and indexed as a stream."""

    def fill(tables: Tables) -> None:
        folder = tables.path("files")
        write_files(article_json(spark, sf_dir), folder)
        ingest_stream(tables, folder, tables.path("checkpoint"), files_per_batch=600)

    return _once(spark, sf_dir, "streamed", fill)


def _author_text(order: Column, first: Column, last: Column) -> Column:
    return F.concat(order.cast("string"), F.lit(":"), first, F.lit(" "), last)


def _gram_code(gram: str) -> Column:
    return F.conv(F.hex(gram), 16, 10).cast("bigint")


# --- text functions


def ascii_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(tx.ascii_lower("text")).alias("lowered")
    )


def query_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    grams = table(spark, sf_dir, "benchmark").select(
        "item_id", F.explode(tx.query_grams("text")).alias("gram")
    )
    return grams.select("item_id", F.hex("gram").alias("gram"))


def trimmed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("  "), "text", F.lit("\t "))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.trim_spaces(padded).alias("query")
    )


def duration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.col("n_chars") * 7 + 0.75
    return table(spark, sf_dir, "documents").select("doc_id", tx.duration(seconds).alias("elapsed"))


def search_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir).select(
        F.col("id").alias("doc_id"),
        tx.shown_title("title").alias("title"),
        tx.preview("abstract").alias("preview"),
        F.octet_length(tx.preview_bytes("abstract")).alias("preview_bytes"),
    )


# --- grams and index


def _gram_sums(postings: DataFrame) -> DataFrame:
    """Per document: grams with repeats, and sums and bounds of their codes."""
    codes = postings.select("doc_id", "tf", _gram_code("gram").alias("code"))
    return codes.groupBy("doc_id").agg(
        F.sum("tf").alias("grams"),
        F.sum(F.col("code") * F.col("tf")).alias("code_sum"),
        F.min("code").alias("code_min"),
        F.max("code").alias("code_max"),
    )


def gram_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gram_sums(count_grams(table(spark, sf_dir, "documents"), "doc_id", ["text"]))


def field_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and abstract apart, straight from the windows."""
    grams = explode_grams(corpus(spark, sf_dir), "id", ["title", "abstract"])
    return _gram_sums(grams.withColumn("tf", F.lit(1).cast("bigint")))


def postings_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = count_grams(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return postings.select(F.hex("gram").alias("gram"), "doc_id", "tf")


def stored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index as written to and read back from its bucketed layout."""
    postings = indexed(spark, sf_dir).postings()
    return postings.select(F.hex("gram").alias("gram"), "doc_id", "tf")


def gram_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = count_grams(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return vocabulary(postings, unique=True).select(F.hex("gram").alias("gram"), "docs", "occurrences")


def index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows per document after indexing twice in append mode."""

    def fill(tables: Tables) -> None:
        load_records(tables, article_records(spark, sf_dir), "all", "all")
        build_index(tables)
        build_index(tables, mode="append")

    tables = _once(spark, sf_dir, "appended", fill)
    return tables.postings().groupBy("doc_id").agg(F.sum("tf").alias("index_rows"))


# --- search


def search_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_stored(indexed(spark, sf_dir), SEARCH_TEXT)


def search_accented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_stored(indexed(spark, sf_dir), ACCENTED_TEXT)


def search_batch_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = indexed(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return search_batch_stored(tables, asked)


def search_batch_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = indexed(spark, sf_dir)
    asked = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), F.col("text").alias("query")
    )
    return search_batch_stored(tables, asked)


def search_batch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the first 32 windows of every query are searched when so limited."""
    tables = indexed(spark, sf_dir)
    asked = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return search_batch_stored(tables, asked, windows=32)


def search_batch_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn asks under its conversation's id: its answers stand side by side."""
    tables = indexed(spark, sf_dir)
    asked = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("query_id"), F.col("text").alias("query")
    )
    found = search_batch_stored(tables, asked)
    return found.select("query_id", "rank", "doc_id", "hits")


def index_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows per document after a load, a whole build, and the load again."""

    def fill(tables: Tables) -> None:
        load_records(tables, article_records(spark, sf_dir), "one", "one")
        index_load(tables, "one")
        build_index(tables)
        index_load(tables, "one")

    tables = _once(spark, sf_dir, "replayed", fill)
    return tables.postings().groupBy("doc_id").agg(F.sum("tf").alias("index_rows"))


def ingest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents ingested from nested folders of JSON files, some of them damaged,
    with the index rows they get and the run's counters of files."""

    def fill(tables: Tables) -> None:
        files = article_json(spark, sf_dir)
        good = files.select("value", (F.col("doc_id") % 7).alias("part"), F.col("doc_id").alias("n"))
        bad = good.where("n % 10 = 0").withColumn("value", F.concat(F.lit("{"), "value"))
        both = good.unionByName(bad).drop("n")
        folder = tables.path("files")
        write_files(both, folder, by=("part",))
        ingest(tables, folder, run_id="files")
        build_index(tables)

    tables = _once(spark, sf_dir, "files", fill)
    grams = tables.postings().groupBy(F.col("doc_id").alias("id")).agg(F.sum("tf").alias("grams"))
    counters = tables.loads().select("files_seen", "parse_errors", "files_processed")
    return (
        tables.documents()
        .join(grams, "id", "left")
        .join(F.broadcast(counters))
        .select("doi", "title", "abstract", F.coalesce("grams", F.lit(0)).alias("grams"), *counters.columns)
    )


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a run over nested files, some damaged and some empty."""

    def fill(tables: Tables) -> None:
        files = article_json(spark, sf_dir)
        good = files.select("value", (F.col("doc_id") % 3).alias("part"), F.col("doc_id").alias("n"))
        bad = good.where("n % 4 = 0").withColumn("value", F.concat("value", F.lit("}")))
        folder = tables.path("files")
        both = good.unionByName(bad).drop("n")
        write_files(both, folder, by=("part",))
        for nation in range(3):
            spark.range(0).select(F.col("id").cast("string")).write.text(f"{folder}/none={nation}/deep")
        ingest(tables, folder, run_id="manifest")

    tables = _once(spark, sf_dir, "manifest", fill)
    return tables.loads().select(
        "files_seen", "parse_errors", "duplicate_files", "files_processed", "documents_inserted", "last_document_id"
    )


def search_batch_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer asks for its market segment: many copies of few queries."""
    tables = indexed(spark, sf_dir)
    asked = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("query_id"), F.col("c_mktsegment").alias("query")
    )
    found = search_batch_stored(tables, asked)
    return found.select("query_id", "rank", "doc_id", "hits")


def search_short_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries too short for a gram give nothing; padded ones are trimmed."""
    tables = indexed(spark, sf_dir)
    query = F.when(F.col("n_nationkey") % 2 == 0, F.substring("n_name", 1, 2)).otherwise(
        F.concat(F.lit("  "), "n_name", F.lit(" "))
    )
    asked = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("query_id"), query.alias("query")
    )
    return search_batch_stored(tables, asked)


def search_existing_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index built elsewhere: only documents at hand may be ranked."""
    postings = build_postings(corpus(spark, sf_dir))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    at_hand = corpus(spark, sf_dir).join(labels, "id", "left_semi")
    return search(postings, at_hand, SEARCH_TEXT, check_documents=True)


def index_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows per document after six loads, merges of them, and one load again."""

    def fill(tables: Tables) -> None:
        every = records(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("doi"), F.lit(6)))
        every = Workspace(spark).save(every, "records")
        for part in range(6):
            name = f"part-{part:02d}"
            load_records(tables, every.where(F.col("part") == part).select(*RECORDS.names), name, name)
            index_load(tables, name)
        compact_index(tables, fan=3)
        index_load(tables, "part-03")

    tables = _once(spark, sf_dir, "compacted", fill)
    dois = tables.documents().select(F.col("id").alias("doc_id"), "doi")
    grams = tables.postings().groupBy("doc_id").agg(F.sum("tf").alias("index_rows"))
    return grams.join(dois, "doc_id").select("doi", "index_rows")


def full_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in, index, and the answers to a batch of queries, in one call."""
    folder = f"{Workspace(spark).root}-files"
    write_files(article_json(spark, sf_dir), folder)
    asked = table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query")
    )
    return run_all(Tables(spark, f"{Workspace(spark).root}-full"), folder, asked)


# --- records


def _parsed_columns() -> list[Column | str]:
    listed = F.array_join(
        F.transform(
            "authors", lambda a: F.concat(a["first"], F.lit(" "), a["last"], F.lit(" "), a["initial"])
        ),
        "|",
    )
    return ["file_path", "doi", "title", "abstract", "issn", "pub_year", listed.alias("authors")]


def records_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = article_json(spark, sf_dir).select("file_path", "value")
    return accepted(parse_records(raw)).select(*_parsed_columns())


def records_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file damaged in one of ten ways; some damage is none."""
    good = F.col("value")
    damage = [
        good,
        F.concat(F.lit("["), good),
        F.concat(good, F.lit(" x")),
        F.replace(good, F.lit('"metadata"'), F.lit('"meta"')),
        F.replace(good, F.lit('"doi":"10.5555/'), F.lit('"doi":"","old":"10.5555/')),
        F.replace(good, F.lit('"doi":"10.5555/'), F.lit('"old":"10.5555/')),
        F.concat(good, F.lit(","), good),
        F.concat(F.lit("[1,"), good, F.lit("]")),
        F.concat(F.lit("\n "), good, F.lit("\n")),
        F.lit('{"metadata":null}'),
    ]
    value = F.element_at(F.array(*damage), (F.col("doc_id") % len(damage) + 1).cast("int"))
    raw = article_json(spark, sf_dir).select("file_path", value.alias("value"))
    return rejected(parse_records(raw))


def records_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file with a key repeated in one of four ways, of which the first counts;
    every fifth is no JSON for all that."""
    good = F.col("value")
    late = F.substr(good, F.lit(1), F.length(good) - 1)
    again = [
        F.concat(late, F.lit(',"metadata":{"doi":"late","title":"late"}}')),
        F.replace(good, F.lit('"issn":'), F.lit('"doi":"late","title":7,"issn":')),
        F.replace(good, F.lit('"metadata":{'), F.lit('"abstract":["late"],"metadata":{')),
        F.concat(F.lit("\n "), late, F.lit(',"x":{"y":1,"y":{"metadata":2}}} ')),
        F.concat(late, F.lit(',"abstract":"late",}')),
    ]
    value = F.element_at(F.array(*again), (F.col("doc_id") % len(again) + 1).cast("int"))
    raw = article_json(spark, sf_dir).select("file_path", value.alias("value"))
    return parse_records(raw).select("reason", *_parsed_columns())


def author_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the suppliers of a part as authors, 32 at most when so limited."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey"),
        F.struct(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")).alias("line"),
    )
    authors = F.transform(
        F.sort_array(F.collect_list("line")),
        lambda p: F.struct(p["l_orderkey"].cast("string").alias("first"), p["l_suppkey"].cast("string").alias("last")),
    )
    metadata = F.struct(F.col("l_partkey").cast("string").alias("doi"), "authors")
    raw = (
        lines.groupBy("l_partkey")
        .agg(authors.alias("authors"))
        .select(
            F.col("l_partkey").cast("string").alias("file_path"),
            F.to_json(F.struct(metadata.alias("metadata"))).alias("value"),
        )
    )
    named = explode_authors(accepted(parse_records(raw, author_limit=32)), "doi")
    return named.select(
        "doi",
        "author_order",
        F.col("first_name").cast("bigint").alias("orderkey"),
        F.col("last_name").cast("bigint").alias("suppkey"),
        "initial",
    )


# --- normalised tables


def first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_files(article_records(spark, sf_dir))


def documents_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).documents().drop("load_id", "id_block")


def authors_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).authors().drop("load_id", "id_block")


def relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingested(spark, sf_dir).relations().drop("load_id", "id_block")


def relations_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relations of the winning files before any is dropped as a repeat."""
    every = article_records(spark, sf_dir)
    winners = every.join(first_files(every).select("file_path"), "file_path", "left_semi")
    return explode_authors(winners, "doi")


def relations_first_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest position of an author in a document, from staged relations."""
    tables = ingested(spark, sf_dir)
    documents = tables.documents().select("doi", F.col("id").alias("document_id"))
    names = ["first_name", "last_name", "initial"]
    authors = tables.authors().select(F.col("id").alias("author_id"), *names)
    staged = relations_staged(spark, sf_dir).join(documents, "doi").join(authors, names)
    return first_relations(staged)


def reingest_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and authors after two runs, ids included."""
    tables = ingested_twice(spark, sf_dir)
    documents = tables.documents().select(
        F.col("id").alias("document_id"), "doi", "issn", "pub_year"
    )
    authors = tables.authors().select(
        F.col("id").alias("author_id"), "first_name", "last_name", "initial"
    )
    links = tables.relations().select("document_id", "author_id", "author_order")
    return documents.join(links.join(authors, "author_id"), "document_id", "left")


def _viewed(views: DataFrame) -> DataFrame:
    listed = F.transform(
        "authors", lambda a: _author_text(a["author_order"], a["first_name"], a["last_name"])
    )
    return views.withColumn("authors", F.array_join(listed, "|"))


def document_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ingested(spark, sf_dir)
    return _viewed(document_view(tables.documents(), tables.relations(), tables.authors()))


def document_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of the ids that `labels` names; ids that are not stored give none."""
    tables = ingested(spark, sf_dir)
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    views = document_view(tables.documents(), tables.relations(), tables.authors(), ids)
    return _viewed(views)


# --- reports


def report_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_report(ingested(spark, sf_dir).loads()).drop("run_id", "elapsed")


def report_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_progress(ingested_twice(spark, sf_dir).loads()).drop("elapsed")


def report_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index_report(indexed(spark, sf_dir).indexed()).drop("elapsed")


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indexed(spark, sf_dir).counts()


def first_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_titles(ingested(spark, sf_dir).documents())


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed documents with the rows the incremental index holds for them.

    Copies of a text differ in the columns left out here, and which copy comes
    first in a stream is up to the file times.
    """
    tables = streamed(spark, sf_dir)
    grams = tables.postings().groupBy(F.col("doc_id").alias("id")).agg(F.sum("tf").alias("grams"))
    return (
        tables.documents()
        .join(grams, "id", "left")
        .select("doi", "title", "abstract", F.coalesce("grams", F.lit(0)).alias("grams"))
    )


def stream_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of documents by name, streamed in two runs of one checkpoint.

    Of copies of a text, the first file by path is streamed: which one comes first is
    otherwise up to the file times.
    """

    def fill(tables: Tables) -> None:
        every = article_json(spark, sf_dir)
        first = first_files(article_records(spark, sf_dir)).select("file_path")
        files = Workspace(spark).save(every.join(first, "file_path", "left_semi"), "first-files")
        for part in range(2):
            folder = tables.path("files")
            write_files(files.where(F.col("doc_id") % 2 == part), f"{folder}/{part}")
            ingest_stream(tables, folder, tables.path("checkpoint"), files_per_batch=400, index=False)

    tables = _once(spark, sf_dir, "streamed-twice", fill)
    documents = tables.documents().select(F.col("id").alias("document_id"), "doi")
    names = tables.authors().select(F.col("id").alias("author_id"), "first_name", "last_name", "initial")
    links = tables.relations().join(documents, "document_id").join(names, "author_id")
    return links.select("doi", "author_order", "first_name", "last_name", "initial")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ascii_lower": ascii_lower,
    "query_grams": query_grams,
    "trimmed_text": trimmed_text,
    "duration_text": duration_text,
    "search_preview": search_preview,
    "gram_extract": gram_extract,
    "field_grams": field_grams,
    "postings_tf": postings_tf,
    "stored_postings": stored_postings,
    "gram_vocab": gram_vocab,
    "index_append": index_append,
    "index_replay": index_replay,
    "search_single": search_single,
    "search_accented": search_accented,
    "search_batch": search_batch_benchmark,
    "search_batch_conversations": search_batch_conversations,
    "search_batch_windows": search_batch_windows,
    "search_batch_repeated_ids": search_batch_repeated_ids,
    "search_batch_copies": search_batch_copies,
    "search_short_query": search_short_query,
    "search_existing_documents": search_existing_documents,
    "records_parse": records_parse,
    "records_rejects": records_rejects,
    "author_cap": author_cap,
    "first_wins": first_wins,
    "documents_dedup": documents_dedup,
    "authors_distinct": authors_distinct,
    "relations": relations,
    "relations_staged": relations_staged,
    "relations_first_order": relations_first_order,
    "reingest_merge": reingest_merge,
    "document_view": document_views,
    "document_lookup": document_lookup,
    "ingest_report": report_ingest,
    "ingest_progress": report_progress,
    "index_report": report_index,
    "table_counts": table_counts,
    "sample_titles": first_titles,
    "stream_ingest": stream_ingest,
    "ingest_files": ingest_files,
    "ingest_manifest": ingest_manifest,
    "records_repeated_keys": records_repeated_keys,
    "stream_relations": stream_relations,
    "index_compacted": index_compacted,
    "full_pipeline": full_pipeline,
}
