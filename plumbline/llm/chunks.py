"""Byte-level BPE over whole texts by cached chunks.

The splitting pattern of a byte-level tokenizer never joins anything across a
single blank that stands between two non-blank characters: the blank always
starts the next piece.  A text can therefore be cut at such blanks, each chunk
(blank included) encoded on its own, and the ids put together.  Most chunks of a
text are words seen before, so a bounded cache answers them.

``ChunkEncoder`` takes the function that encodes one chunk, which is where the
users of this module differ.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable

import numpy as np

CACHE = 250_000       # entries in each of two cache generations
CACHED_CHARS = 32     # longer chunks are not kept
IRREGULAR = b""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The printable letter a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


def read_tokenizer(path: str) -> tuple[dict[str, int], list[tuple[str, str]], dict[str, int]]:
    """Vocabulary, merges in order and special tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in d["model"]["merges"]]
    return d["model"]["vocab"], merges, {t["content"]: t["id"] for t in d["added_tokens"]}


class Generations:
    """A bounded cache of two generations: what the young one misses is taken
    over from the old one, and a full young one replaces it."""

    def __init__(self, size: int = CACHE):
        self.size, self.new, self.old = size, {}, {}

    def older(self, key):
        return self.old.get(key)

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


def id_bytes(ids: list[int]) -> bytes:
    """Native 32-bit unsigned ids (little-endian on every supported platform)."""
    return array("I", ids).tobytes()


def split_special(text: str, special: dict[str, int]) -> list[str | int]:
    """``text`` cut at the special tokens written in it, those as their ids."""
    parts: list[str | int] = [text] if text else []
    for content, i in special.items():
        if content in text:
            cut: list[str | int] = []
            for p in parts:
                if isinstance(p, int):
                    cut.append(p)
                    continue
                for k, piece in enumerate(p.split(content)):
                    cut += ([i] if k else []) + ([piece] if piece else [])
            parts = cut
    return parts


class ChunkEncoder:
    """Ids of texts as little-endian 32-bit byte strings."""

    def __init__(self, encode: Callable[[str], bytes], special: dict[str, int]):
        self.encode_chunk = encode
        self.special = special
        self.cache = Generations()

    def _miss(self, word: str) -> bytes:
        """Ids of the chunk blank + word; IRREGULAR where the cut is not sure."""
        got = self.cache.older(word)
        if got is None:
            if not word or word[0].isspace() or word[-1].isspace():
                got = IRREGULAR
            else:
                got = self.encode_chunk(" " + word)
        if len(word) <= CACHED_CHARS:
            self.cache.put(word, got)
        return got

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        words = text.split(" ")
        got = list(map(self.cache.new.get, words))
        got[0] = self.encode_chunk(words[0]) if words[0] and not words[0][-1].isspace() else IRREGULAR
        if None in got:
            miss = self._miss
            got = [g if g is not None else miss(w) for g, w in zip(got, words, strict=True)]
        if IRREGULAR not in got:
            return b"".join(got)
        # several blanks in a row, or other white space at a cut: join those pieces first
        out, held = [], [words[0]]
        for w in words[1:]:
            left = held[-1]
            if left and not left[-1].isspace() and w and not w[0].isspace():
                out.append("".join(held))
                held = [" " + w]
            else:
                held.append(" " + w)
        out.append("".join(held))
        return b"".join(self.encode_chunk(c) for c in out if c)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text (null: none)."""
        parts = split_special(text or "", self.special)
        raw = b"".join(id_bytes([p]) if isinstance(p, int) else self._plain(p) for p in parts)
        return np.frombuffer(raw, "<u4")
