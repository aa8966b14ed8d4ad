"""MinHash near-duplicates by a multi-index Hamming join.

A document's set holds its distinct five-word shingles (words are runs of
non-blank ASCII-lower-cased text; fewer words make one shingle; no word, no
set).  Two documents are linked when ``100 * |A & B| >= 75 * |A | B|``; a class
is a connected component of links.

Method
    1. *Signatures.*  ``SLOTS`` MinHash slots of ``b = 16`` bits each.  Documents
       with identical shingle sets collapse to one representative first.
    2. *Multi-index.*  The slots are split into ``CHUNKS`` chunks.  If two
       signatures differ in at most ``RADIUS`` slots, the pigeonhole principle
       leaves one chunk with at most one differing slot, so every chunk is
       indexed once for each allowed error position (the slot left out).  All
       pairs within ``RADIUS`` therefore share an index key.  Pairs beyond it
       are still found unless *every* chunk has two errors; at similarity 0.75
       that has a probability of about 5e-6.  A found pair goes on to the exact
       check when its distance is at most ``CHECK`` (4.5 standard deviations
       above the mean at similarity 0.75).
    3. *Contraction.*  Each bucket gives star candidates (document, smallest
       document); every document's closest ones are confirmed on the full sets
       and joined to components, which takes groups of copies together with a
       number of rows linear in the bucket sizes.
    4. *Rest.*  Only buckets that still hold several components are compared
       block by block on signatures, and what comes out is not pairs but
       (document, other component).  Such a document is then confirmed against
       the full sets of the members of that component, so no link between
       different texts is lost, and the pairs of a group are never emitted.

Defined cases: null or blank text gives an empty set (class is the document
itself, kept); a null id is linked with nothing and kept; repeated rows of one
id are one document and give one row each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.llm.common import groups, in_arrow, mix, slices, table, text_frame, written
from plumbline.llm.components import connected

WORDS = 5
PERCENT = 75
SLOTS = 96
CHUNKS = 16
PER = SLOTS // CHUNKS
RADIUS = 2 * CHUNKS - 1
CHECK = 43
BLOCK = 2048          # signature rows of a bucket compared at once
MEMBER_BLOCK = 512    # members of a component checked at once
TRIES = 2             # star candidates confirmed per document before the rest step

_SEED = np.random.default_rng(20240501)
_A = (_SEED.integers(0, 1 << 32, SLOTS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _SEED.integers(0, 1 << 32, SLOTS, dtype=np.uint64).astype(np.uint32)
_WORD_CACHE_MAX = 200_000
_words: dict[bytes, int] = {}


def _word_hash(w: bytes) -> int:
    h = _words.get(w)
    if h is None:
        if len(_words) >= _WORD_CACHE_MAX:
            _words.clear()
        h = _words[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    return h


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    n = len(words) - size + 1
    acc = np.full(n, size, np.uint64)
    for k in range(size):
        acc = mix(acc ^ h[k:k + n])
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))]


def signature(shingles: np.ndarray) -> np.ndarray:
    """``SLOTS`` MinHash values of 16 bits."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(SLOTS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        part = low[at:at + 4096]
        best = np.minimum(best, (_A[:, None] * part + _B[:, None]).min(axis=1))
    best ^= best >> np.uint32(15)
    best *= np.uint32(0x2C1B3C6D)
    return (best >> np.uint32(16)).astype(np.uint16)


def chunk_keys(sigs: np.ndarray) -> np.ndarray:
    """(n, SLOTS) index keys: column c*PER+v is chunk c without its slot v."""
    wide = sigs.astype(np.uint64)
    out = np.empty(sigs.shape, np.uint64)
    for c in range(CHUNKS):
        for v in range(PER):
            key = np.full(len(sigs), c * PER + v + 1, np.uint64)
            for s in range(c * PER, (c + 1) * PER):
                if s != c * PER + v:
                    key = mix(key ^ wide[:, s])
            out[:, c * PER + v] = key
    return out


def _sigs(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint16).reshape(-1, SLOTS)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            n, digest, sig = [], [], []
            for text in part.column(1).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "sig"])


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, digest, sig) of every row."""
    return text_frame(docs).transform(in_arrow, _describe, "doc_id long, n_shingles long, digest binary, sig binary")


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = chunk_keys(_sigs(batch.column(1)))
            flat = pa.array(keys.view(np.int64).ravel())
            ends = pa.array(np.arange(0, keys.size + 1, SLOTS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(ends, flat)], names=["id", "keys"])


def _distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            d = (_sigs(batch.column(2)) != _sigs(batch.column(3))).sum(axis=1)
            near = np.flatnonzero(d <= CHECK)
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(d.astype(np.int32))], names=["a", "b", "d"])
            yield out.take(pa.array(near))


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def _confirm_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text, other) sorted by b: keep the linked (a, b)."""
    held, held_set = None, None
    for batch in batches:
        for part in slices(batch, "text"):
            a, b, keep = part.column(0), part.column(1).to_pylist(), []
            other = part.column(3)
            for i, text in enumerate(part.column(2).to_pylist()):
                if b[i] != held:
                    held, held_set = b[i], shingle_set(other[i].as_py())
                keep.append(_linked(shingle_set(text), held_set))
            out = pa.RecordBatch.from_arrays([a, part.column(1)], names=["a", "b"])
            yield out.filter(pa.array(keep, pa.bool_()))


def _first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For signature pairs that share an index key, the first one's column."""
    wrong = (x != y).reshape(len(x), CHUNKS, PER)
    errors = wrong.sum(axis=2)
    chunk = np.argmax(errors <= 1, axis=1)
    rows = np.arange(len(x))
    slot = np.where(errors[rows, chunk] == 0, 0, np.argmax(wrong[rows, chunk], axis=1))
    return chunk * PER + slot


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one bucket: rows (key, unit, at, id, comp, size, side, sig) ->
    (id, comp) of documents close to a member of another component.  ``unit``
    names a pair of blocks (or one block with itself), ``side`` a block's place
    in it.  A pair counts in the first bucket it shares, nowhere else."""
    for t in groups(batches, ["key", "unit"]):
        at = t.column("at")[0].as_py()
        ids, comp, size = (t.column(c).to_numpy() for c in ("id", "comp", "size"))
        side = t.column("side").to_numpy()
        sig = _sigs(t.column("sig"))
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        found: set[tuple[int, int]] = set()
        for i in left.tolist():
            j = right[comp[right] != comp[i]]
            if side[i] == 0:
                j = j[j > i]
            if not len(j):
                continue
            j = j[(sig[j] != sig[i]).sum(axis=1) <= CHECK]
            j = j[_first_shared(sig[j], np.broadcast_to(sig[i], (len(j), SLOTS))) == at]
            for k in j.tolist():
                # the document of the smaller component is checked against the larger one
                small, big = (i, k) if (size[i], -comp[i]) < (size[k], -comp[k]) else (k, i)
                found.add((int(ids[small]), int(comp[big])))
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())],
                names=["id", "comp"])


def _confirm_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one (comp, unit): members first (role 0), then documents to check
    (role 1); gives one link (a, comp) for each document with a linked member."""
    held, members, flat, owner, sizes, sigs = None, [], None, None, None, None
    for batch in batches:
        for part in slices(batch, "text"):
            keys = list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True))
            role, ids, texts = (part.column(i).to_pylist() for i in (2, 3, 4))
            a, b = [], []
            for key, r, i, text in zip(keys, role, ids, texts, strict=True):
                if key != held:
                    held, members, flat = key, [], None
                if r == 0:
                    members.append(shingle_set(text))
                    continue
                if not members:
                    continue
                if flat is None:
                    sizes = np.array([len(m) for m in members])
                    flat = np.concatenate(members)
                    owner = np.repeat(np.arange(len(members)), sizes)
                    sigs = np.stack([signature(m) for m in members])
                    order = np.argsort(flat, kind="stable")
                    flat, owner = flat[order], owner[order]
                mine = shingle_set(text)
                close = (sigs != signature(mine)).sum(axis=1) <= CHECK
                if not close.any():
                    continue
                lo, hi = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
                hits = np.concatenate([owner[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True) if y > x] or [owner[:0]])
                both = np.bincount(hits, minlength=len(members))
                if (close & (100 * both >= PERCENT * (sizes + len(mine) - both))).any():
                    a.append(i)
                    b.append(key[0])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One text for each wanted id (a repeated id counts once)."""
    return docs.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    texts = text_frame(docs)
    info = written(describe(docs), "minhash")

    # exact copies of a set collapse to their smallest document
    sets = written(info.filter("n_shingles > 0 and doc_id is not null").groupBy("digest")
                   .agg(F.min(F.struct("doc_id", "sig")).alias("r"))
                   .select("digest", F.col("r.doc_id").alias("id"), F.col("r.sig").alias("sig")), "sets")

    # multi-index: keys held by several documents
    keys = sets.select("id", "sig").transform(in_arrow, _index, "id long, keys array<long>").select(
        "id", F.posexplode("keys").alias("at", "key"))
    shared = written(keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("first"))
                     .filter("n > 1").select("key", "first"), "buckets")
    rows = written(keys.join(shared, "key"), "bucket_rows")

    # contraction: closest star candidates, confirmed on full sets
    star = rows.filter("id != first").select("id", F.col("first").alias("b")).distinct()
    sig = sets.select("id", "sig")
    star = (star.join(sig, "id").withColumnRenamed("sig", "sa")
            .join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
            .select("id", "b", "sa", "sb").transform(in_arrow, _distance, "a long, b long, d int"))
    best = W.partitionBy("a").orderBy("d", "b")
    star = written(star.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= TRIES)
                   .select("a", "b"), "star")
    wanted = star.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    near = written(_texts_of(texts, wanted), "near_texts")
    links = written(star.join(near.withColumnRenamed("doc_id", "a"), "a")
                    .join(near.select(F.col("doc_id").alias("b"), F.col("text").alias("other")), "b")
                    .select("a", "b", "text", "other").sortWithinPartitions("b")
                    .transform(in_arrow, _confirm_pairs, "a long, b long"), "links")
    comp = connected(links)

    # rest: buckets that still hold several components
    placed = rows.select("key", "at", "id").join(comp, "id", "left").select(
        "key", "at", "id", F.coalesce("comp", "id").alias("comp"))
    placed = written(placed, "placed")
    open_keys = written(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
                        .filter("lo != hi").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open_keys")
    sizes = written(comp.groupBy("comp").agg(F.count("*").alias("size")), "sizes")
    blocked = (placed.join(open_keys, "key")
               .join(sig, "id").join(sizes, "comp", "left").fillna(1, ["size"])
               .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    # block x meets block y in unit (min, max); side 1 = lower block, 2 = upper, 0 = within
    unit = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        (F.least(F.col("block"), o) * F.col("blocks") + F.greatest(F.col("block"), o)).alias("unit"),
        F.when(o == F.col("block"), 0).when(F.col("block") < o, 1).otherwise(2).alias("side")))
    blocked = blocked.select("key", "at", "id", "comp", "size", "sig", F.explode(unit).alias("u")).select(
        "key", F.col("u.unit").cast("long").alias("unit"), "at", "id", "comp", "size", F.col("u.side").cast("int").alias("side"), "sig")
    rest = (blocked.repartition(F.col("key"), F.col("unit")).sortWithinPartitions("key", "unit")
            .transform(in_arrow, _rest, "id long, comp long").distinct())
    rest = written(rest, "rest")

    # confirm each (document, component) on the full sets of the members
    members = comp.select(F.col("id"), "comp").union(
        rest.join(comp, rest["comp"] == comp["id"], "left_anti").select(F.col("comp").alias("id"), "comp").distinct())
    target = rest.select("comp").distinct()
    members = members.join(target, "comp", "left_semi")
    n_blocks = members.groupBy("comp").agg(F.ceil(F.count("*") / MEMBER_BLOCK).cast("int").alias("blocks"))
    n_blocks = written(n_blocks, "member_blocks")
    inside = members.join(n_blocks, "comp").select(
        "comp", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("unit"), F.lit(0).alias("role"), "id")
    ask = rest.join(n_blocks, "comp").select(
        "comp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("unit"), F.lit(1).alias("role"), "id")
    both = inside.union(ask)
    need = both.select(F.col("id").alias("doc_id")).distinct()
    have = _texts_of(texts, need)
    more = (both.join(have.withColumnRenamed("doc_id", "id"), "id")
            .select("comp", "unit", "role", "id", "text")
            .repartition("comp", "unit").sortWithinPartitions("comp", "unit", "role")
            .transform(in_arrow, _confirm_members, "a long, b long"))
    comp = connected(written(links.union(more), "all_links"))

    # every document: its set's representative, and that one's component
    classes = written(sets.select("digest", "id").join(comp, "id", "left").select(
        "digest", F.coalesce("comp", "id").alias("component_id")), "classes")
    out = info.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    cid = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are the smallest document of their class, with the
    columns of ``docs``; repeated rows of a kept id stay once."""
    kept = near_duplicates(docs).filter("kept")
    lost = kept.filter("doc_id is not null").select("doc_id").distinct()
    held = docs.join(lost, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return held.unionByName(docs.filter(F.col("doc_id").isNull()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
