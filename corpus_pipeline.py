"""The corpus pipeline: stages over `documents`, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of `documents`, whatever further columns it has. Rows are
documents: equal ids, null ids and extra columns pass through every stage.

* toxicity: documents with a score of 0.5 or more go. A null text is scored as
  the empty one. The model learns from the labels of `sf_dir`, on the documents
  that came in.
* line_dedup: lines that ten or more documents share leave every text; `n_chars`
  follows the new text. No document goes, also if nothing of its text is left.
* ngram_jaccard_join: of each class of linked documents the first by id (then by
  row) stays. Documents without any words are one class.
* decontamination: documents that hold a benchmark item go.
* best_fit_packing: what is left is tokenised and packed into sequences of 2048.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, jaccard, lines, packing, toxicity
from corpusloom.llm.workers import reach, table
from corpusloom.session import Workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = "toxicity_score" + "_" * max(map(len, docs.columns))  # longer than any name here
    return toxicity.score(docs, model, result=score).where(F.col(score) < 0.5).drop(score)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    # Numbered names: none is one of the operator's.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = plain.columns[docs.columns.index("text")]
    kept = lines.drop_common_lines(plain, text, threshold=10, min_chars=1)
    new = {text: F.col("kept_text")}
    if "n_chars" in docs.columns:
        place = docs.columns.index("n_chars")
        new[plain.columns[place]] = F.length("kept_text").cast(docs.schema.fields[place].dataType)
    # A text without dropped lines stays as it is, also a null one.
    new = {c: F.when(F.col("n_dropped") > 0, e).otherwise(F.col(c)) for c, e in new.items()}
    return kept.withColumns(new).select(*plain.columns).toDF(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    return jaccard.first_of_classes(docs, "doc_id", "text")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    reach(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("ngram_jaccard_join", keep_one_of_each_class),
    ("decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack),
]

#: The learned score of the first stage cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    work = Workspace(spark)
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
