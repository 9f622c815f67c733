"""Every stage on what its predecessor kept, against plain versions."""

import random

import corpus_pipeline
import pytest
from corpusloom.llm import toxicity
from corpusloom.session import Workspace
from test_decontaminate import words
from test_jaccard import brute as brute_links
from test_jaccard import near_copies
from test_lines import brute as brute_lines
from test_toxicity import corpus as toxic_corpus


@pytest.fixture
def tables(spark, odd, tmp_path):
    rng = random.Random(1)
    texts, labels = toxic_corpus(1, 300)
    items = [" ".join(words(rng, 40)) for _ in range(5)]
    texts += near_copies(2, 4, 4)
    texts += [f"same footer line\n{t}" for t in near_copies(3, 12, 1)]
    texts += [" ".join([*words(rng, 60), item, *words(rng, 60)]) for item in items]
    documents = odd(texts)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    known = [(10 + i, 0, y) for i, y in enumerate(labels)]
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_and_run(spark, tables):
    work = Workspace(spark)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns = docs.columns
    kept = {}
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "ngram_jaccard_join", "decontamination", "best_fit_packing",
    ]
    rows = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = work.save(stage(spark, docs, tables), name)
        rows[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
            kept[name] = docs

    pair = lambda r: (str(r.doc_id), str(r.text))
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    model = toxicity.fit(spark.read.parquet(f"{tables}/documents.parquet"), labels)
    good = [r for r in rows["documents"] if model.score(r.text) < 0.5]
    assert len(good) < len(rows["documents"])
    assert sorted(map(pair, rows["toxicity"])) == sorted(map(pair, good))

    lines = brute_lines([r.text for r in rows["toxicity"]], 10, 1)
    expected = [(str(r.doc_id), text if gone else str(r.text)) for r, (text, _, gone) in zip(rows["toxicity"], lines, strict=True)]
    assert sorted(map(pair, rows["line_dedup"])) == sorted(expected)
    assert not any("same footer line" in (r.text or "") for r in rows["line_dedup"])

    classes = {c for _, _, c in brute_links([(r.doc_id, r.text) for r in rows["line_dedup"]])}
    ids = [r.doc_id for r in rows["ngram_jaccard_join"] if r.doc_id is not None]
    assert sorted(ids) == sorted(classes)

    items = [r.text for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    clean = [r for r in rows["ngram_jaccard_join"] if not any(i in (r.text or "") for i in items)]
    assert len(clean) < len(rows["ngram_jaccard_join"])
    assert sorted(map(pair, rows["decontamination"])) == sorted(map(pair, clean))

    packed = rows["best_fit_packing"]
    assert sum(r.piece == 0 for r in packed) == len(clean)
    again = corpus_pipeline.run(spark, tables).collect()
    assert sorted((str(r.doc_id), r.piece, r.ids_crc32) for r in again) == sorted(
        (str(r.doc_id), r.piece, r.ids_crc32) for r in packed
    )


def test_empty_documents(spark, odd, tmp_path, tables):
    docs = odd(rows=[])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.collect() == []


def test_columns_named_like_those_of_a_stage_stay(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    clash = ["n_lines", "n_dropped", "kept_text", "toxicity_score", "text_key", "lines", "shard"]
    for i, name in enumerate(clash):
        docs = docs.withColumn(name, docs.doc_id + i)
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, docs, tables)
        assert kept.columns == docs.columns, name
        rows = kept.select("doc_id", *clash).where("doc_id IS NOT NULL").collect()
        assert rows and all([r[c] - r.doc_id for c in clash] == list(range(len(clash))) for r in rows), name
