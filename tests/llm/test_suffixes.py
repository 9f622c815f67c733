import random
from collections import Counter

import numpy as np
import pytest
from corpusloom.llm import suffixes
from hypothesis import given
from hypothesis import strategies as st


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        covered = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                covered[i : i + length] = b"\1" * length
        kept = bytes(x for x, c in zip(b, covered, strict=True) if not c)
        spans = sum(c and (not i or not covered[i - 1]) for i, c in enumerate(covered))
        out.append((kept, len(b), sum(covered), spans))
    return out


def check(frame, length):
    rows = frame.select("doc_id", "text").collect()
    got = [(str(r.id), bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.remove_repeats(frame, length=length).collect()]
    expected = [(str(r.doc_id), *e) for r, e in zip(rows, brute([r.text for r in rows], length), strict=True)]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("hot", [5000, 2])
def test_removed_bytes_are_those_of_counting(odd, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(hot)
    texts = ["".join(rng.choice("ab é") for _ in range(rng.randrange(120))) for _ in range(50)] + ["a" * 300, "é" * 150]
    rows = [(None, None), (1, ""), (2, texts[0]), (2, texts[0]), *enumerate(texts, 10)]
    check(odd(rows=rows), 12)


def test_two_hundred_bytes_shared_or_one_less(odd):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = word(250)
    texts = [word(50) + passage + word(50) for _ in range(5)]
    texts += [word(40) + passage[:199] + word(40), word(9) + passage[10:210], passage[:200]]
    check(odd(rows=list(enumerate(texts))), 200)


def test_long_text_crosses_segments(odd, monkeypatch):
    monkeypatch.setattr(suffixes, "_SEGMENT", 500)
    rng = random.Random(6)
    text = "".join(rng.choice("abcd") for _ in range(3000))
    check(odd(rows=[(1, text + text[700:1500]), (2, text[400:900])]), 50)


def test_empty_table(odd):
    assert suffixes.remove_repeats(odd(rows=[])).collect() == []


@given(st.lists(st.integers(1, 4), max_size=80))
def test_suffix_array_is_sorted(symbols):
    s = [*symbols, 0]
    assert suffixes.suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
