"""Token ids of texts by a public word-level BPE, with bounded caches.

The tokenizer drops white space and never joins across it, so a text's ids are
the ids of its space-separated chunks in order. Chunks repeat; a worker keeps
the ids of those it met first, up to a stated number, and encodes the others
anew. Latin chunks are cut into the tokenizer's own pre-tokens, whose ids are
kept as well; other chunks go through the tokenizer whole.
"""

from __future__ import annotations

import os
import unicodedata
from functools import lru_cache

import numpy as np
import regex

CHUNKS_KEPT = 300_000
PIECES_KEPT = 500_000

# The pre-token pattern and the special tokens of the vocabulary file.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SPECIAL = "<|"
_WORD_END = "</w>"
#: Up to here normalisation and lower-casing of a chunk need no care.
_LAST_LATIN = "ɏ"


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith(_WORD_END)]] = True
        self.chunks: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _new_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        for i in range(0, len(pieces), 256):
            part = pieces[i : i + 256]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(part):
                raw = ids.tobytes()
                at = [0, *(4 * stops).tolist()]
                out.update((p, raw[a:b]) for p, a, b in zip(part, at, at[1:], strict=False))
            else:
                out.update((p, self._whole(p)) for p in part)
        return out

    def _new_chunks(self, chunks: set[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        cut: dict[str, list[str]] = {}
        unknown: dict[str, None] = {}
        for chunk in chunks:
            if _SPECIAL in chunk or max(chunk) > _LAST_LATIN:
                out[chunk] = self._whole(chunk)
                continue
            low = (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)).lower()
            cut[chunk] = found = _PIECE.findall(low)
            for piece in found:
                if piece not in self.pieces:
                    unknown[piece] = None
        new = self._new_pieces(list(unknown))
        for chunk, found in cut.items():
            out[chunk] = b"".join([self.pieces.get(p) or new.get(p, b"") for p in found])
        room = PIECES_KEPT - len(self.pieces)
        if room > 0:
            self.pieces.update(list(new.items())[:room])
        return out

    def encode(self, text: str) -> bytes:
        chunks = text.replace("\n", " ").split(" ")
        kept = self.chunks
        missing = {c for c in chunks if c not in kept}
        if missing:
            new = self._new_chunks(missing)
            room = CHUNKS_KEPT - len(kept)
            if room >= len(new):
                kept.update(new)
            else:
                return b"".join([kept[c] if c in kept else new[c] for c in chunks])
        return b"".join([kept[c] for c in chunks])


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each worker and file; it lives as long as the worker."""
    return Encoder(path)
