import collections
import os
import re

import pytest
from corpusloom.llm import quality

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The contract's facts of one text."""
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    n, repeats = len(words), len(covered)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeats,
        n < 10 or 100 * repeats > 20 * n,
    )


def plain_posteriors(patterns, prior=quality.Prior(), iterations=quality.ITERATIONS):
    """The label model in plain Python; patterns maps a word of votes to a count."""
    rules = len(next(iter(patterns)))
    good, right, found = prior.good, [prior.right_on_good] * rules, [prior.right_on_bad] * rules

    def share(p):
        g, b = good, 1 - good
        for j, v in enumerate(p):
            g *= {"g": right[j], "b": 1 - right[j], "-": 1}[v]
            b *= {"b": found[j], "g": 1 - found[j], "-": 1}[v]
        return g / (g + b)

    inside = lambda x: min(max(x, quality.EDGE), 1 - quality.EDGE)
    for _ in range(iterations):
        g = {p: n * share(p) for p, n in patterns.items()}
        b = {p: n - g[p] for p, n in patterns.items()}
        rate = lambda j, mass, vote, believed: inside(
            (prior.weight * believed + sum(m for p, m in mass.items() if p[j] == vote))
            / (prior.weight + sum(m for p, m in mass.items() if p[j] != "-"))
        )
        right, found = (
            [rate(j, g, "g", prior.right_on_good) for j in range(rules)],
            [rate(j, b, "b", prior.right_on_bad) for j in range(rules)],
        )
        good = inside((prior.weight * prior.good + sum(g.values())) / (prior.weight + sum(patterns.values())))
    return {p: share(p) for p in patterns}


PROSE = "The quick fox came back over the long green hills before evening. Nobody saw it, though many had been waiting there."
TEXTS = [
    PROSE,
    "a b c d e a b c d e",
    "a b c d e f a b c d e f g\na b c d e f",
    "one two three four five",
    "é𝄞 ß\x0bÄ\x0c\r\n\r\n  \n𝄞 # | <>",
    "same line\nsame line\n \n \nsame line \n",
    " ".join(f"w{i % 7}" for i in range(400)),
    "#$% " * 300,
    " ".join(str(i) for i in range(20_000)),
]


def test_facts_equal_a_plain_count(odd):
    frame = odd(TEXTS)
    found = quality.assess(frame, ["doc_id"], "text").select(
        "key.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    expected = [(r.doc_id, *brute(r.text)) for r in frame.collect()]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_posteriors_equal_a_plain_label_model(spark):
    patterns = {"gggg": 900, "bbgg": 40, "ggbb": 60, "g-gg": 30, "b---": 5, "----": 7, "bgbg": 3}
    rows = spark.createDataFrame(list(patterns.items()), "pattern string, documents long")
    found = {r.pattern: r.quality for r in quality.posteriors(rows, 4).collect()}
    expected = plain_posteriors(patterns)
    assert found == {p: pytest.approx(q, abs=1e-9) for p, q in expected.items()}
    assert found["gggg"] > 0.9 and found["bbgg"] < 0.5 and found["ggbb"] < 0.5


def test_one_vote_against_does_not_fail_a_text(odd):
    """All rules passed is not asked for: a good text with one bad vote may stay."""
    lone = PROSE.replace(". ", ", ").replace("there.", "there")
    texts = [f"{PROSE} {i} {i + 1}." for i in range(200)] + [f"{lone} {i}" for i in range(30)]
    texts += ["word### other$$$ thing%%% more&&& signs*** " * 3 + str(i) for i in range(30)]
    found = quality.assess(odd(rows=list(enumerate(texts))), ["doc_id"], "text").select("key.doc_id", "kept", "votes", "base_failed")
    rows = {r.doc_id: r for r in found.collect()}
    assert all(rows[i].kept for i in range(230)) and not any(rows[i].kept for i in range(230, 260))
    assert any("b" in rows[i].votes for i in range(200, 230))


def test_empty_table(odd):
    assert quality.assess(odd(rows=[]), ["doc_id"], "text").collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_verdicts_agree_with_the_quality_labels(spark):
    """The labels are not read by the method; documents of ten words or more that pass the limits."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "label")
    found = quality.assess(documents, ["doc_id"], "text").select("key.doc_id", "kept", "base_failed")
    rows = found.join(labels, "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in rows if r.label], [r for r in rows if not r.label]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(not r.kept for r in bad) >= 0.9 * len(bad) and len(bad) > 10
