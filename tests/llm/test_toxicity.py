import random
from zlib import crc32

import numpy as np
from corpusloom.llm import toxicity


def corpus(seed, n, bad="blargist|snorkwit|grumfeld"):
    rng = random.Random(seed)
    bad = bad.split("|")
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(5, 80))]
        label = int(i % 5 == 0)
        if label:
            for _ in range(2):
                words[rng.randrange(len(words))] = rng.choice(bad)
        texts.append(" ".join(words))
        labels.append(label)
    return texts, labels


def test_held_out_texts_are_told_apart_and_misspellings_lean_the_same_way():
    model = toxicity.train(*corpus(1, 500))
    texts, labels = corpus(2, 200)
    right = np.mean([(model.score(t) >= 0.5) == y for t, y in zip(texts, labels, strict=True)])
    assert right >= 0.95
    assert model.word("blargistt") > model.word("nosiel") + 0.5


def test_whole_text_counts_wherever_the_word_stands():
    model = toxicity.train(*corpus(1, 500))
    clean = " ".join(corpus(3, 200)[0][1:5])
    assert model.score(clean + " xx" * 5000 + " blargist snorkwit") > 0.5


def test_scores_of_odd_rows(spark, odd):
    frame = odd(["blargist snorkwit you", "nice text"])
    model = toxicity.train(*corpus(1, 500))
    scored = toxicity.score(frame, model)
    assert scored.columns == [*[c for c in frame.columns if c != "score"], "score"]
    rows = scored.collect()
    assert len(rows) == frame.count()
    assert all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if not r.text}
    assert empty == {model.score("")}
    assert toxicity.score(odd(rows=[]), model).collect() == []


def test_fit_reads_no_held_out_label(spark):
    texts, labels = corpus(1, 300)
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = [crc32(str(i).encode()) % 5 == 0 for i in range(300)]
    known = spark.createDataFrame([(i, y) for i, y in enumerate(labels)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    wrong = spark.createDataFrame(
        [(i, 1 - y if h else y) for i, (y, h) in enumerate(zip(labels, held, strict=True))], "doc_id long, toxic int"
    )
    one, two = toxicity.fit(documents, known), toxicity.fit(documents, wrong)
    assert np.allclose(one.table, two.table) and one.bias == two.bias
    flags = documents.select("doc_id", toxicity.held_out(documents.doc_id).alias("h")).collect()
    assert [r.h for r in sorted(flags)] == held


def test_without_labels_of_both_classes():
    assert toxicity.train([], []).score("x") < 0.01
    assert toxicity.train(["a", "b"], [1, 1]).score("x") > 0.99


def test_ten_labels_are_learned_from():
    clean, _ = corpus(4, 5, bad="x")
    toxic = [f"{t} blargist snorkwit" for t in corpus(5, 5, bad="x")[0]]
    model = toxicity.train(clean + toxic, [0] * 5 + [1] * 5)
    assert [model.score(t) >= 0.5 for t in clean + toxic] == [False] * 5 + [True] * 5
    assert model.score("you blargist snorkwit you") > model.score("you nosiel ralt you")


def test_a_word_of_few_toxic_texts_is_learned():
    texts, labels = corpus(1, 500, bad="blargist")
    seen = [(t, y) for i, (t, y) in enumerate(zip(texts, labels, strict=True)) if not y or i % 35 == 0]
    assert sum(y for _, y in seen) == 15
    model = toxicity.train(*map(list, zip(*seen, strict=True)))
    texts, labels = corpus(2, 200, bad="blargist")
    ranked = sorted(range(200), key=lambda i: -model.score(texts[i]))
    assert sum(labels[i] for i in ranked[:40]) >= 36


def test_nothing_passes_as_toxic_when_nothing_tells_the_classes_apart():
    for labels in ([0, 1] * 5, [0] + [1] * 9):
        model = toxicity.train(["same words here"] * 10, labels)
        assert model.score("same words here") < 0.5


def test_sample_is_filled_by_class(spark):
    documents = spark.range(2000).selectExpr("id doc_id", "concat('text ', id) text")
    labels = documents.selectExpr("doc_id", "int(doc_id % 50 = 0) toxic")
    open_ = [i for i in range(2000) if crc32(str(i).encode()) % 5]
    toxic = {i for i in open_ if i % 50 == 0}
    rows, odds = toxicity.training_rows(documents, labels, "doc_id", "text", "toxic", limit=100)
    assert {r.id for r in rows if r.label} == toxic and len(rows) == 100
    assert np.isclose(odds, (100 - len(toxic)) / (len(open_) - len(toxic)))
    few = toxicity.training_rows(documents, labels, "doc_id", "text", "toxic", limit=20)[0]
    assert sum(r.label for r in few) == 10 and len(few) == 20


def test_labels_of_other_documents_take_no_place_in_the_sample(spark):
    rows = [(i, f"text {i}") for i in range(200)] + [(999, "long " * 20_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40_000)], "doc_id long, toxic int")
    sample, _ = toxicity.training_rows(documents, labels, "doc_id", "text", "toxic", limit=400)
    assert len(sample) == documents.where(~toxicity.held_out(documents.doc_id)).where("doc_id < 200").count()
