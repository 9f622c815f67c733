import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from corpusloom.llm import packing, tokens
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


@settings(deadline=None, max_examples=150)
@given(st.text(max_size=60) | st.text("aAéÉΣσ's1\n\t <|>endoftext", max_size=60))
def test_chunks_give_the_ids_of_the_whole_text(text):
    codec = tokens.encoder(PATH)
    direct = codec.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == direct


def test_pieces_hold_every_id_and_sequences_have_no_gaps(odd, whole):
    frame = odd(["a b c " * n for n in (1, 5, 50, 700, 900, 2100)])
    rows = packing.pack_documents(frame, PATH).collect()
    texts = [r.text for r in frame.collect()]
    expected = []
    for r in frame.collect():
        ids = whole(r.text)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            expected.append((r.doc_id or -1, piece, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    got = [(r.id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in rows]
    assert sorted(got) == sorted(expected)
    assert len(texts) == sum(r.piece == 0 for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) == packing.lower_bound(np.array([r.length for r in rows]), 2048)


def test_empty_table(odd):
    assert packing.pack_documents(odd(rows=[]), PATH).collect() == []


def test_partitions_exchange_their_emptiest_bins(spark, odd, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_PARTITION", 8)
    lengths = [(i, 300 + 37 * (i % 40)) for i in range(120)]
    path = packing.Workspace(spark).save(spark.createDataFrame(lengths, "row long, length long"), "pieces")

    def sequences():
        rows = packing.pack(path).collect()
        assert len(rows) == 120
        fill = defaultdict(int)
        for r in rows:
            fill[r.sequence_id] += r.length
        assert max(fill.values()) <= 2048
        return len(fill)

    exchanged = sequences()
    monkeypatch.setattr(packing, "ROUNDS", 1)
    assert packing.lower_bound(np.array([n for _, n in lengths]), 2048) <= exchanged < sequences()


@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_bound_is_never_above_the_best_packing(lengths):
    lengths = sorted(lengths, reverse=True)

    def best(i, bins):
        if i == len(lengths):
            return len(bins)
        tried = set()
        counts = [len(lengths)]
        for b, room in enumerate(bins):
            if room >= lengths[i] and room not in tried:
                tried.add(room)
                counts.append(best(i + 1, [*bins[:b], room - lengths[i], *bins[b + 1 :]]))
        if len(bins) < max(packing.best_fit_decreasing(lengths, 30)) + 1:
            counts.append(best(i + 1, [*bins, 30 - lengths[i]]))
        return min(counts)

    assert packing.lower_bound(np.array(lengths), 30) <= best(0, [])
