import random

import numpy as np
from corpusloom.llm import decontaminate
from corpusloom.llm.textbytes import text_slices


def words(rng, n):
    return [f"w{min(int(rng.expovariate(0.02)), 3000)}" for _ in range(n)]


def planted(seed, n_items=30, n_docs=60):
    rng = random.Random(seed)
    items = [" ".join(words(rng, rng.randrange(12, 50))) + ". What? Answer " + " ".join(words(rng, 4)) for _ in range(n_items)]
    docs, leaks = [], set()
    for d in range(n_docs):
        text = words(rng, rng.randrange(5, 600))
        if d % 3 == 0:
            i = d % n_items
            at = rng.randrange(len(text) + 1)
            text[at:at] = [items[i].upper() + "!!"]
            leaks.add((10 + d, i))
        docs.append(" ".join(text))
    return items, docs, leaks


def test_planted_items_are_found_and_clean_documents_stay(spark, odd):
    items, docs, leaks = planted(1)
    frame = odd(docs)
    table = spark.createDataFrame([*enumerate(items), (77, None), (None, ""), (78, "...")], "item_id long, text string")
    got = decontaminate.matches(frame, table, ["doc_id", "line"])
    assert got.columns[:3] == ["doc_id", "line", "item_id"]
    assert {(r.doc_id, r.item_id) for r in got.collect()} == leaks
    kept = decontaminate.clean(frame, table)
    assert kept.columns == frame.columns
    hit = {d for d, _ in leaks}
    expected = [str(r.doc_id) for r in frame.collect() if r.doc_id not in hit]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(expected)


def test_slices_of_items_give_the_same(spark, odd, monkeypatch):
    items, docs, leaks = planted(2)
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", 2000)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(odd(docs), table, ["doc_id"]).collect()} == leaks


def test_what_is_found_does_not_depend_on_the_slices(spark, odd, monkeypatch):
    """Half copies of items: their scores lie near the threshold."""
    rng = random.Random(8)
    items, docs, _ = planted(8, n_items=60)
    for i in range(120):
        own = items[i % 60].split(" ")
        cut = rng.randrange(len(own) // 3, len(own))
        docs.append(" ".join([*words(rng, 40), *own[:cut], *words(rng, 40)]))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    frame = odd(docs)
    rows = lambda: sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in decontaminate.matches(frame, table, ["doc_id"]).collect())
    whole = rows()
    monkeypatch.setattr(decontaminate, "SLICE_CHARS", 3000)
    assert rows() == whole and len(whole) > 50


def test_small_runs_of_passages_give_the_same(monkeypatch):
    items, docs, _ = planted(5)
    import pyarrow as pa

    index = decontaminate.Index(list(range(len(items))), 5).build(items)
    (_, data, offsets), = text_slices(pa.array([d.lower() for d in docs]))
    whole = decontaminate.find(index, data, offsets, 0.5, 0.5)
    monkeypatch.setattr(decontaminate, "SUMS", 100)
    assert decontaminate.find(index, data, offsets, 0.5, 0.5) == whole and whole


def test_search_finds_all_that_plain_scores_reach():
    items, docs, _ = planted(3, n_docs=40)
    index = decontaminate.Index(list(range(len(items))), 5).build(items)
    import pyarrow as pa

    for _, data, offsets in text_slices(pa.array([d.lower() for d in docs])):
        hashes, splits = decontaminate.term_hashes(data, offsets)
        for least in (0.2, 0.5):
            got = {(b, p) for b, _, _, p, _ in zip(*decontaminate.retrieve(index, hashes, splits, least), strict=True)}
            expected = set()
            size = decontaminate.PART_WORDS
            for a, b in zip(splits[:-1], splits[1:], strict=True):
                for begin in range(a, max(b, a + 1), size):
                    own = np.unique(hashes[begin : min(begin + 2 * size, b)])
                    for part in range(len(index.part_of)):
                        at = slice(index.own_at[part], index.own_at[part + 1])
                        score = index.own_weight[at][np.isin(index.terms[index.own_term[at]], own)].sum()
                        if score >= least and len(own):
                            expected.add((begin, part))
            assert got == expected


def test_long_items_are_found_in_parts(spark, odd):
    rng = random.Random(4)
    item = " ".join(words(rng, 300))
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    frame = odd(rows=[(1, " ".join(words(rng, 200)) + " " + item), (2, " ".join(words(rng, 500)))])
    assert [r.doc_id for r in decontaminate.matches(frame, table, ["doc_id"]).collect()] == [1]


def test_empty_tables(spark, odd):
    table = spark.createDataFrame([(1, "some item text")], "item_id long, text string")
    assert decontaminate.matches(odd(rows=[]), table, ["doc_id"]).collect() == []
    assert decontaminate.matches(odd(), table.limit(0), ["doc_id"]).collect() == []
    assert decontaminate.clean(odd(), table.limit(0)).count() == odd().count()


def found(item, doc):
    import pyarrow as pa

    index = decontaminate.Index([0], 5).build([item])
    (_, data, offsets), = text_slices(pa.array([doc.lower()]))
    return decontaminate.find(index, data, offsets, 0.5, 0.5).get((0, 0))


def test_question_or_answer_alone_is_found_at_any_length():
    for length in (60, 64, 65, 200):
        own = [f"t{i}" for i in range(length)]
        for cut in (length // 3, length - length // 3):
            question, answer = " ".join(own[:cut]), " ".join(own[cut:])
            item = f"{question}? {answer}."
            assert found(item, f"before it {question} behind")[2:] == (1.0, 0.0)
            assert found(item, f"before it {answer} behind")[2:] == (0.0, 1.0)
        # One sentence: less than half of its runs is not the item.
        assert found(" ".join(own), " ".join(own[: length // 3])) is None
        assert found(" ".join(own), " ".join(own[: length // 2 + 5])) is not None


def test_short_answers_do_not_decide_alone():
    item = " ".join(f"t{i}" for i in range(30)) + "? Yes."
    assert found(item, "they said yes to it") is None


def test_few_pairs_are_scored_from_the_terms_of_the_item(monkeypatch):
    """Common words, which items and clean texts share, must not bring every item to the exact scores."""
    import pyarrow as pa

    rng = random.Random(12)
    common = [f"c{i}" for i in range(40)]
    items = [" ".join([*rng.choices(common, k=30), *(f"r{rng.randrange(120)}" for _ in range(12))]) for _ in range(120)]
    docs = [" ".join([*rng.choices(common, k=200), *(f"r{rng.randrange(120)}" for _ in range(60))]) for _ in range(60)]
    docs += [" ".join([*rng.choices(common, k=40), item]) for item in items[:20]]
    scored = []

    def counted(index, held, window, part, scores=decontaminate._scores):
        scored.append(len(part))
        return scores(index, held, window, part)

    monkeypatch.setattr(decontaminate, "_scores", counted)
    index = decontaminate.Index(list(range(len(items))), 5).build(items)
    reached = 0
    for _, data, offsets in text_slices(pa.array(docs)):
        hashes, splits = decontaminate.term_hashes(data, offsets)
        reached += len(decontaminate.retrieve(index, hashes, splits, 0.5)[4])
    assert reached >= 20
    assert sum(scored) == reached


def test_slices_of_texts_are_small():
    """A worker keeps arrays of many bytes for each byte of a slice."""
    import pyarrow as pa

    lengths = [len(data) for _, data, _ in text_slices(pa.array(["x" * 2000] * 1000))]
    assert sum(lengths) == 2_000_000 and max(lengths) <= 1 << 18
