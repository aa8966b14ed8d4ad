"""Byte-level BPE encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has exactly one BPE encoding, hence one last token.  The
tokens that end at a position are the suffixes the automaton over the whole
vocabulary reports there.  Such a token is *the* last token of the prefix iff
it can follow the last token of the prefix it leaves, that is, if encoding the
two tokens' bytes gives the two tokens back.  One pass over the bytes stores the
last token of each prefix; following those back from the end gives the ids that
the merge rules would give, without ever applying a merge to the text.

Pair test: while the two neighbours are built up from bytes by their own merges
in rank order, the right edge of the left token meets the left edge of the
right one in a sequence of pairs.  The two tokens are compatible unless one of
those pairs has a merge that comes before both edges grow on (on equal rank the
left-most merge goes first).

Texts are split as the tokenizer's own splitting pattern does; special tokens
written in a text become their ids.  Decoding joins the tokens' bytes; invalid
UTF-8 becomes U+FFFD.

Defined cases: a null or empty text has no ids and decodes to the empty text;
repeated rows are encoded alike; extra columns are ignored.  Very long texts
are encoded whole; the tables a task holds are bounded by the vocabulary and
fixed cache sizes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.chunks import Generations, byte_letters, default_path, id_bytes, read_tokenizer, split_special
from plumbline.llm.common import in_arrow, slices, table, text_frame

PAIR_CACHE = 600_000
STEP_CACHE = 500_000
NEVER = 1 << 60
LATIN_END = "\u0250"  # up to here the classes are spelled out; above, the tokenizer library splits
_LETTER, _NUMBER, _BLANK = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", " \t-\r\x85\xa0"
SPLIT = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
                   f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
CACHE = 350_000       # words in each of two cache generations
CACHED_CHARS = 32     # longer words are not kept


class SuffixAutomaton:
    """States are prefixes of tokens; ``ends[state]`` lists the tokens that are
    suffixes of what has been read, the longest first.  Steps that fall back
    over several suffixes are worked out once and kept."""

    def __init__(self, tokens: dict[bytes, int]):
        self.step: dict[int, int] = {}
        own: list[int] = [-1]
        for raw, i in tokens.items():
            state = 0
            for byte in raw:
                key = state << 8 | byte
                state = self.step.get(key, -1)
                if state < 0:
                    state = self.step[key] = len(own)
                    own.append(-1)
            own[state] = i
        self.shorter = [0] * len(own)
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(own)
        depth = [0] * len(own)
        children: dict[int, list[tuple[int, int]]] = {}
        for key, state in self.step.items():
            children.setdefault(key >> 8, []).append((key & 255, state))
        queue = [0]
        for at in queue:
            for byte, state in children.get(at, ()):
                depth[state] = depth[at] + 1
                back = self.shorter[at]
                if at:
                    while back and (back << 8 | byte) not in self.step:
                        back = self.shorter[back]
                    self.shorter[state] = self.step.get(back << 8 | byte, 0)
                tail = self.ends[self.shorter[state]]
                self.ends[state] = ((own[state], depth[state]), *tail) if own[state] >= 0 else tail
                queue.append(state)
        self.kept: list[int] = []

    def move(self, key: int) -> int:
        """The step for a state and byte that is not in the trie itself."""
        if len(self.kept) >= STEP_CACHE:
            for k in self.kept:
                del self.step[k]
            self.kept = []
        state, byte = key >> 8, key & 255
        while state and (state << 8 | byte) not in self.step:
            state = self.shorter[state]
        got = self.step.get(state << 8 | byte, 0)
        self.step[key] = got
        self.kept.append(key)
        return got


class PrefixBPE:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str):
        vocab, merges, self.special = read_tokenizer(path)
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        self.token_bytes = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(back[c] for c in token)
        self.automaton = SuffixAutomaton({raw: i for i, raw in enumerate(self.token_bytes) if raw})
        for content, i in self.special.items():
            self.token_bytes[i] = content.encode()
        self.size = len(self.token_bytes)
        self.rank = {vocab[a] * self.size + vocab[b]: r for r, (a, b) in enumerate(merges)}
        self.parts = {}
        for r, (a, b) in enumerate(merges):
            self.parts.setdefault(vocab[a + b], (vocab[a], vocab[b], r))
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.splitter = None
        self.known = Generations(CACHE)

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """(token, rank at which it grows on) up one edge of the token's merge
        tree, from the outermost byte to the token itself."""
        store = self.right if side else self.left
        got = store.get(token)
        if got is None:
            got, grows = [(token, NEVER)], self.parts.get(token)
            while grows:
                got.append((grows[side], grows[2]))
                grows = self.parts.get(grows[side])
            got.reverse()
            store[token] = got
        return got

    def _meet(self, a: int, b: int, skip: int = -1) -> bool:
        """Whether no merge crosses the border of a and b (but the merge of rank
        ``skip``)."""
        x, y = self._edge(a, 1), self._edge(b, 0)
        i = j = 0
        rank, size = self.rank, self.size
        while True:
            (s, s_grows), (t, t_grows) = x[i], y[j]
            r = rank.get(s * size + t)
            if r is not None and r != skip and r < s_grows and r <= t_grows:
                return False
            if s_grows == NEVER and t_grows == NEVER:
                return True
            if s_grows <= t_grows:
                i += 1
            else:
                j += 1

    def follows(self, a: int, b: int) -> bool:
        """Whether encoding the bytes of a and b gives (a, b)."""
        key = a * self.size + b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) >= PAIR_CACHE:
                self.pairs.clear()
            got = self.pairs[key] = self._meet(a, b)
        return got

    def stands(self, token: int) -> bool:
        """Whether encoding the token's bytes gives the token."""
        got = self.alone.get(token)
        if got is None:
            p = self.parts.get(token)
            got = self.alone[token] = p is None or (self.stands(p[0]) and self.stands(p[1]) and self._meet(p[0], p[1], p[2]))
        return got

    def encode_word(self, raw: bytes) -> list[int]:
        """Last token of every prefix, then back from the end."""
        n, size, pairs = len(raw), self.size, self.pairs
        step, move, ends = self.automaton.step, self.automaton.move, self.automaton.ends
        last = [0] * (n + 1)
        state = 0
        for p, byte in enumerate(raw, 1):
            key = state << 8 | byte
            state = step.get(key)
            if state is None:
                state = move(key)
            for token, length in ends[state]:
                if length == p:
                    if self.stands(token):
                        last[p] = token
                        break
                else:
                    pair = last[p - length] * size + token
                    ok = pairs.get(pair)
                    if ok is None:
                        ok = self.follows(last[p - length], token)
                    if ok:
                        last[p] = token
                        break
        out, p = [], n
        while p:
            out.append(last[p])
            p -= len(self.token_bytes[last[p]])
        out.reverse()
        return out

    def words(self, text: str) -> list[str]:
        """The pieces the tokenizer's splitting pattern makes of ``text``."""
        if text.isascii() or max(text) < LATIN_END:
            return SPLIT.findall(text)
        if self.splitter is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.splitter = ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def _miss(self, word: str) -> bytes:
        got = self.known.older(word)
        if got is None:
            got = id_bytes(self.encode_word(word.encode("utf-8", "replace")))
        if len(word) <= CACHED_CHARS:
            self.known.put(word, got)
        return got

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a whole text (null: none)."""
        out = []
        for part in split_special(text or "", self.special):
            if isinstance(part, int):
                out.append(id_bytes([part]))
                continue
            words = self.words(part)
            got = list(map(self.known.new.get, words))
            if None in got:
                miss = self._miss
                got = [miss(w) if g is None else g for w, g in zip(words, got, strict=True)]
            out += got
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: list[int]) -> str:
        table = self.token_bytes
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> PrefixBPE:
    """One codec per worker process and file."""
    return PrefixBPE(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs``."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [bpe.encode(t) for t in part.column(1).to_pylist()]
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc_id", "ids"])

    return text_frame(docs).transform(in_arrow, run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with the ids' text as ``decoded``."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([bpe.decode(i or []) for i in part.column(1).to_pylist()], pa.string())],
                    names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").transform(in_arrow, run, "doc_id long, ids array<int>, decoded string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
