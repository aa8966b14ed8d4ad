"""Best-fit packing of token sequences by swap-based local search.

Documents become token ids plus an end id; only a document longer than a
sequence is cut, into full pieces after a first piece that may be shorter.
Pieces are dealt by hash (of a stored row number too, so that repeated rows and
null ids are spread) into groups of about ``GROUP_TOKENS`` tokens, so a
group's work is bounded and the number of groups follows the corpus.  In a
group, best fit decreasing gives a first packing; then the least filled bin is
worked on again and again: its pieces are *moved* into bins with room,
*exchanged one for one* against smaller pieces of other bins, or *two for one*
against one smaller piece.  Every accepted step raises the sum of squared
fills, so the search ends; a bin that runs empty is dropped.  It stops early
when the number of bins equals the lower bound.

Defined cases: a null or empty text is one piece holding only the end id;
repeated rows are packed as rows of their own; a null id is packed like any
other; a full piece is a sequence of its own; extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.chunks import ChunkEncoder, default_path, id_bytes
from plumbline.llm.common import fields, in_arrow, ship, slices, table, text_frame, written

SEQUENCE = 2048
END_ID = 0
GROUP_TOKENS = 1500 * SEQUENCE
LATIN_END = "ɐ"


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """Cached encoder of the tokenizer file.  Chunks of plain and Latin letters
    go to the rank-table encoder of the same vocabulary, all others to the
    tokenizer library itself; both give the tokenizer's ids."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    plain = None
    if path == default_path():
        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                  special_tokens={})._core_bpe.encode_ordinary

    def encode(chunk: str) -> bytes:
        if plain and (chunk.isascii() or max(chunk) < LATIN_END):
            return id_bytes(plain(chunk))
        return id_bytes(tok.encode(chunk, add_special_tokens=False).ids)

    return ChunkEncoder(encode, special)


def pieces(docs: DataFrame, path: str | None = None, size: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = encoder(path)
        end = np.array([END_ID], np.uint32)
        for batch in batches:
            for part in slices(batch, "text"):
                doc, no, start, length, crc, ids = [], [], [], [], [], []
                for d, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    all_ids = np.concatenate((chunks.encode(text), end))
                    n = len(all_ids)
                    first = (n - 1) % size + 1
                    for k, at in enumerate([0, *range(first, n, size)]):
                        own = all_ids[at:first if k == 0 else at + size]
                        doc.append(d)
                        no.append(k)
                        start.append(at)
                        length.append(len(own))
                        crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                        if with_ids:
                            ids.append(own.astype(np.int32))
                cols = [pa.array(doc, pa.int64()), pa.array(no, pa.int32()), *[pa.array(c, pa.int64()) for c in (start, length, crc)]]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    ends = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return text_frame(docs).transform(in_arrow, run, schema + (", ids array<int>" if with_ids else ""))


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, list[int]]:
    """Best fit decreasing: bin of every piece and fill of every bin.  The bins
    of each amount of room are a stack; a bit set names the amounts in use."""
    room: dict[int, list[int]] = {}
    used, fill = 0, []
    where = np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    for i, x in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = used >> x
        if fits:
            left = x + (fits & -fits).bit_length() - 1
            stack = room[left]
            b = stack.pop()
            if not stack:
                used &= ~(1 << left)
        else:
            b, left = len(fill), size
            fill.append(0)
        where[i] = b
        fill[b] += x
        left -= x
        if left:
            room.setdefault(left, []).append(b)
            used |= 1 << left
    return where, fill


def local_search(lengths: np.ndarray, where: np.ndarray, fill: list[int], size: int) -> np.ndarray:
    """Empty the least filled bins by moves and exchanges into the others."""
    fill = np.array(fill, np.int64)
    least = -(-int(lengths.sum()) // size)
    bins = int((fill > 0).sum())
    done = np.zeros(len(fill), bool)            # victims that could not be emptied
    free_piece = np.flatnonzero(fill[where] < size)
    while bins > least:
        open_bins = np.flatnonzero((fill > 0) & (fill < size) & ~done)
        if not len(open_bins):
            break
        victim = int(open_bins[np.argmin(fill[open_bins])])
        while fill[victim]:
            if not _step(lengths, where, fill, size, victim, free_piece):
                break
        if fill[victim]:
            done[victim] = True
        else:
            bins -= 1
    return where


def _step(lengths, where, fill, size, victim, among) -> bool:
    """One accepted step that takes tokens out of ``victim``."""
    mine = among[where[among] == victim]
    if not len(mine):
        return False
    open_bins = np.flatnonzero((fill > 0) & (fill < size))
    open_bins = open_bins[open_bins != victim]
    if not len(open_bins):
        return False
    room = size - fill
    mine = mine[np.argsort(-lengths[mine], kind="stable")]
    # move: the tightest bin with room
    by_room = open_bins[np.argsort(room[open_bins], kind="stable")]
    rooms = room[by_room]
    for i in mine.tolist():
        x = lengths[i]
        at = int(np.searchsorted(rooms, x))
        if at < len(by_room) and fill[by_room[at]] + x > fill[victim]:
            b = int(by_room[at])
            where[i] = b
            fill[b] += x
            fill[victim] -= x
            return True
    # exchange: one or two of the victim's pieces for one smaller piece elsewhere
    others = among[(where[among] != victim)]
    others = others[room[where[others]] > 0]
    if not len(others):
        return False
    y, b = lengths[others], where[others]
    # only the sum given counts: two pieces of a length stand for all of that length,
    # and a bin's distinct lengths are few (their sum is at most its size)
    of = lengths[mine]
    kinds = mine[np.concatenate(([True] * min(2, len(of)), of[2:] != of[:-2]))].tolist()
    gives: dict[int, tuple[int, ...]] = {}
    for i in kinds:
        gives.setdefault(int(lengths[i]), (i,))
    for k, i in enumerate(kinds):
        for j in kinds[k + 1:]:
            gives.setdefault(int(lengths[i] + lengths[j]), (i, j))
    best = None
    for x, which in gives.items():
        gain = x - y
        ok = (gain > 0) & (gain <= room[b]) & (fill[b] + gain > fill[victim])
        if ok.any():
            k = int(np.argmax(np.where(ok, gain, 0)))
            if best is None or gain[k] > best[0]:
                best = int(gain[k]), which, k
    if best is None:
        return False
    gain, which, k = best
    to = int(b[k])
    where[list(which)] = to
    where[others[k]] = victim
    fill[to] += gain
    fill[victim] -= gain
    return True


def arrange(lengths: np.ndarray, size: int = SEQUENCE) -> np.ndarray:
    """Bin of every piece (0-based, gapless) after best fit and local search."""
    if not len(lengths):
        return np.zeros(0, np.int64)
    where, fill = best_fit(lengths, size)
    where = local_search(lengths, where, fill, size)
    return np.unique(where, return_inverse=True)[1]


def _pack_group(size: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        where = arrange(lengths, size)
        order = np.argsort(where, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.searchsorted(where[order], where[order])
        offset = np.empty(len(lengths), np.int64)
        offset[order] = ends - lengths[order] - (ends - lengths[order])[first]
        return pdf.assign(sequence_id=pdf["pack_group"].to_numpy(np.int64) * (1 << 32) + where, offset=offset)

    return run


def pack(table_of_pieces: DataFrame, size: int = SEQUENCE, group_tokens: int = GROUP_TOKENS, row: str | None = None) -> DataFrame:
    """Pieces with (sequence_id, offset); carries every column along but ``row``, a
    stored number that tells repeated pieces apart, so that they share no group."""
    total = table_of_pieces.agg(F.sum("length")).first()[0] or 0
    n = max(1, -(-int(total) // group_tokens))
    ship(table_of_pieces.sparkSession)
    keyed = table_of_pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", *([row] if row else [])), F.lit(n)))
    keyed = keyed.drop(row) if row else keyed
    return (keyed.groupBy("pack_group").applyInPandas(_pack_group(size), f"{fields(keyed)}, sequence_id long, offset long")
            .drop("pack_group"))


def pack_documents(docs: DataFrame) -> DataFrame:
    """Every piece of every document with its place, ids left out."""
    numbered = pieces(docs, with_ids=False).withColumn("_row", F.monotonically_increasing_id())
    return pack(written(numbered, "pieces"), row="_row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
