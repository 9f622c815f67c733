import random

import numpy as np
from corpusloom.llm import jaccard


def brute(rows):
    """{position: (links, least id of the class)} by all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    linked = [set() for _ in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a | b and len(a & b) >= 0.8 * len(a | b)):
                linked[i].add(j)
                linked[j].add(i)
    classes = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = linked[todo.pop()] - seen
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        classes.append(min(ids) if ids else None)
    return sorted((rows[i][0], len(linked[i]), classes[i]) for i in range(len(rows)) if rows[i][0] is not None)


def near_copies(seed, groups, copies):
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(120)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(120)] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(words))
    return texts


def result(frame):
    rows = frame.select("id", "n_links", "class_id").collect()
    return sorted(tuple(r) for r in rows if r[0] is not None), len(rows)


def test_links_and_classes_are_those_of_all_pairs(odd):
    texts = near_copies(1, 8, 5) + ["One two three four five six", "one TWO three four five six", "one two", "one two"]
    frame = odd(texts)
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    got, count = result(jaccard.link(frame))
    assert got == brute(rows)
    assert count == len(rows)


def test_blocks_give_the_same_as_whole_groups(odd, monkeypatch):
    texts = near_copies(2, 2, 12)
    frame = odd(texts)
    whole = result(jaccard.link(frame))
    monkeypatch.setattr(jaccard, "NODE_BLOCK", 5)
    monkeypatch.setattr(jaccard, "TEXT_BLOCK", 4)
    assert result(jaccard.link(frame)) == whole


def test_first_of_classes_keeps_whole_rows(odd):
    frame = odd(near_copies(3, 3, 3))
    kept = jaccard.first_of_classes(frame)
    assert kept.columns == frame.columns
    classes = {c for _, _, c in result(jaccard.link(frame))[0]}
    # The first of each class, and the class that only a row without an id has.
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(classes)


def test_empty_table(odd):
    assert jaccard.link(odd(rows=[])).collect() == []
    assert jaccard.first_of_classes(odd(rows=[])).collect() == []


def test_prefix_is_shortened_until_the_recall_is_reached():
    length = jaccard.prefix_length(0.8)
    assert 1 - (1 - 0.8**length) ** jaccard.TREES >= jaccard.RECALL
    assert length == jaccard.LABEL or 1 - (1 - 0.8 ** (length + 1)) ** jaccard.TREES < jaccard.RECALL


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    values = np.concatenate([common, a, common, b])
    marks = jaccard.signatures(values, np.array([0, 900, 1800]))
    assert abs((marks[0] == marks[1]).mean() - 0.8) < 0.2


def test_edges_of_a_group_follow_its_texts_not_its_blocks(odd, monkeypatch):
    told = []

    def counted(edges, work, components=jaccard.components):
        told.append(edges.where("a != b").distinct().count())
        return components(edges, work)

    monkeypatch.setattr(jaccard, "components", counted)
    monkeypatch.setattr(jaccard, "NODE_BLOCK", 8)
    monkeypatch.setattr(jaccard, "TEXT_BLOCK", 8)
    words = [f"w{i}" for i in range(150)]
    texts = [" ".join([*words[:i], f"n{i}", *words[i + 1 :]]) for i in range(0, 128, 2)]
    assert jaccard.link(odd(texts)).where("n_links = 63").count() == 64
    # When units of two blocks told all of their edges, these were 583 and 277.
    candidates, links = told
    assert links < 64 + 36 and candidates < 5 * 64
