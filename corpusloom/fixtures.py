"""Article records derived from the test tables (documents, lineitem, supplier).

Exact copies of a text share a DOI, which exercises the first-wins rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.schemas import RECORDS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_name(doc_id: str | Column) -> Column:
    return F.concat(F.lpad(F.col(doc_id).cast("string"), 10, "0"), F.lit(".json"))


def _title() -> Column:
    return F.substring_index("text", "\n", 1)


def _abstract() -> Column:
    after_title = F.char_length(_title()) + 2
    rest = F.substring(F.col("text"), after_title, F.char_length("text"))
    return F.when(F.contains(F.col("text"), F.lit("\n")), rest).otherwise("")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, title, abstract): first line and the rest of every text."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), _title().alias("title"), _abstract().alias("abstract")
    )


def record_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, author_order, first, last, initial) from all order lines.

    Order keys are dealt to the documents, whose ids have no gaps.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id")
    count = documents.agg(F.coalesce(F.max("doc_id") + 1, F.lit(1))).first()[0]
    lines = table(spark, sf_dir, "lineitem").withColumn("doc_id", F.col("l_orderkey") % count)
    place = Window.partitionBy("doc_id").orderBy(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"
    )
    ordered = lines.select(
        "doc_id",
        "l_suppkey",
        (F.row_number().over(place) - 1).alias("author_order"),
        F.lit("Supplier").alias("first"),
        F.col("l_returnflag").alias("initial"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("last")
    )
    return (
        ordered.join(documents, "doc_id", "left_semi")
        .join(suppliers, "l_suppkey")
        .select("doc_id", "author_order", "first", "last", "initial")
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table as parsed article records, plus lang and doc_id."""
    authors = (
        record_authors(spark, sf_dir)
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("author_order", "first", "last", "initial"))).alias("placed"))
        .select(
            "doc_id",
            F.transform("placed", lambda p: F.struct(p["first"], p["last"], p["initial"])).alias("authors"),
        )
    )
    documents = table(spark, sf_dir, "documents")
    return (
        documents.join(authors, "doc_id", "left")
        .select(
            "doc_id",
            "lang",
            file_name("doc_id").alias("file_path"),
            F.lit(None).cast("string").alias("reason"),
            F.concat(F.lit("10.5555/"), F.md5("text")).alias("doi"),
            _title().alias("title"),
            _abstract().alias("abstract"),
            F.col("source").alias("issn"),
            (F.lit(1990) + F.col("doc_id") % 35).cast("int").alias("pub_year"),
            F.coalesce("authors", F.array().cast(RECORDS["authors"].dataType)).alias("authors"),
        )
    )
