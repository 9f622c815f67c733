"""The queries of the corpus operators over the given tables."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import centroids, decontaminate, dialogue, extract, jaccard, lines, packing, quality, secrets, suffixes, topk, toxicity, warc
from corpusloom.llm.workers import table
from corpusloom.session import shared_folder


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class that links of similarity 0.8 or more join it to."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.link(documents).select(
        F.col("id").alias("doc_id"), "class_id", "copies", "n_links"
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(documents, path).withColumnRenamed("id", "doc_id")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by a model learned from labels outside the held-out fold."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents, model)
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products for each vector whose id is divisible by 50."""
    embeddings = table(spark, sf_dir, "embeddings")
    return topk.top_k(embeddings, "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents scanned into a new ledger, findings joined back to each of them."""
    documents = table(spark, sf_dir, "documents")
    ledger = secrets.Ledger(spark, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    secrets.scan(documents, ["doc_id"], "text", ledger)
    found = secrets.spans_by_version(documents, ["doc_id"], "text", ledger)
    spans = F.col("spans")
    joined = secrets.span_text(spans)
    return found.select(
        "doc_id",
        secrets.count_kind(spans, "assign").alias("n_assign"),
        secrets.count_kind(spans, "access").alias("n_access"),
        secrets.count_kind(spans, "hex").alias("n_hex"),
        F.sha2(joined.cast("binary"), 256).alias("base_sha256"),
        joined.alias("spans"),
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through ARC files and their conversion, as read back from the WARC files."""
    pages = table(spark, sf_dir, "pages")
    folder = warc.archive_folder(spark)
    warc.write_arc(pages, "page_id", "url", "html", f"{folder}/arc")
    warc.convert(spark, f"{folder}/arc", f"{folder}/warc")
    return warc.read_warc(spark, f"{folder}/warc").where("record_type IN ('response', 'revisit')").select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.drop_common_lines(documents, "text", threshold=10, min_chars=1)
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that start at two places."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(documents).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the overlaps."""
    documents = table(spark, sf_dir, "documents")
    return decontaminate.matches(documents, table(spark, sf_dir, "benchmark"), ["doc_id"])


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's facts, its rules' votes, and the label model's verdict."""
    documents = table(spark, sf_dir, "documents")
    return quality.assess(documents, ["doc_id"], "text").select(
        "key.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "votes",
        F.round("quality", 4).alias("quality"),
    )


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the hash of `conv_id:turn`: 0 drops, 1 empties, 2 takes the
    ends of sentences away, 3 repeats, 4 makes a user row. Nulls are one space."""
    space = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    fate = F.crc32(name.cast("binary")) % 20
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate"))
        .where("fate != 0")
        .withColumn(
            "text",
            F.when(F.col("fate") == 1, "")
            .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")),
        )
        .withColumn("role", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))))
        .drop("fate", "copy")
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged, with its faults and its cheapest repair."""
    conversations = table(spark, sf_dir, "conversations")
    damaged = damaged_conversations(conversations)
    found = dialogue.repair(damaged, "conv_id", "turn", "role", "text", ids=conversations.select("conv_id"))
    return found.withColumnRenamed("conv", "conv_id")


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole vector of 64 components with its cluster after five rounds of 40 centroids."""
    embeddings = table(spark, sf_dir, "embeddings")
    found = centroids.cluster(embeddings, "vec_id", "embedding", k=40, rounds=5, width=64, scale=256.0, seed=2)
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


LLM_QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_toxicity": op3_toxicity,
    "op4_exact_topk": op4_exact_topk,
    "op5_secret_scan": op5_secret_scan,
    "op6_html_extraction": op6_html_extraction,
    "op7_warc": op7_warc,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_quality_rules": op11_quality_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_centroid_clustering": op13_centroid_clustering,
}
