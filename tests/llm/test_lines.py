from collections import Counter

import numpy as np
import pytest
from corpusloom.llm import lines
from hypothesis import given
from hypothesis import strategies as st

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))


def brute(texts, threshold, min_chars):
    count = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for t in texts:
        own = (t or "").split("\n")
        kept = [x for x in own if count[key(x)] < threshold]
        out.append(("\n".join(kept), len(own), len(own) - len(kept)))
    return out


TEXTS = ["A line\nb\n\nc", "a LINE \nd", "\ta line\r\nÉ\né", "\n\n", "b\nb\nb", "a line", "É x", "é x\n ", "\x1ca line"]


@pytest.mark.parametrize("threshold, min_chars", [(2, 1), (3, 0), (2, 7), (300, 1)])
def test_lines_drop_as_by_counting(odd, threshold, min_chars):
    frame = odd(TEXTS)
    rows = frame.select("doc_id", "text").collect()
    got = lines.drop_common_lines(frame, "text", threshold, min_chars)
    assert got.columns == [*frame.columns, "kept_text", "n_lines", "n_dropped"]
    got = [(r.doc_id or -1, r.kept_text, r.n_lines, r.n_dropped) for r in got.collect()]
    expected = brute([r.text for r in rows], threshold, min_chars)
    assert sorted(got) == sorted((r.doc_id or -1, *e) for r, e in zip(rows, expected, strict=True))


def test_many_shards_and_copies_give_the_same(odd, monkeypatch):
    texts = [f"common\nline {i % 7}\nown {i}" for i in range(60)]
    frame = odd(texts)
    whole = sorted(map(str, lines.drop_common_lines(frame, threshold=5).collect()))
    monkeypatch.setattr(lines, "KEYS_PER_SHARD", 20)
    monkeypatch.setattr(lines, "LINES_PER_TASK", 3)
    assert sorted(map(str, lines.drop_common_lines(frame, threshold=5).collect())) == whole


def test_empty_table(odd):
    assert lines.drop_common_lines(odd(rows=[])).collect() == []


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal_and_survives_bytes(keys):
    keys = np.array(sorted(keys), dtype=np.uint64)
    perfect = lines.PerfectHash(keys)
    assert sorted(perfect.number(keys).tolist()) == list(range(len(keys)))
    again = lines.PerfectHash.load(*perfect.dump())
    assert again.number(keys).tolist() == perfect.number(keys).tolist()


def test_keys_that_share_half_their_bits_are_told_apart():
    import pyarrow as pa

    table = pa.table({"h1": [7, 7, 9], "h2": [1, 2, 3], "n": [20, 5, 30], "shard": [0, 0, 0]})
    row = lines._build_shard(255)(table).to_pylist()[0]
    asked = np.array([7, 7, 9, 9], dtype=np.uint64), np.array([1, 2, 3, 4], dtype=np.uint64)
    assert lines._probe(row, *asked, False).tolist() == [20, 5, 30, 0]
