"""Phrase collocations from depth-truncated suffix subtrees of word prefixes.

A suffix is a word with the next words of its piece, three at most; a phrase
occurs as often as suffixes begin with it.  Vertical partitioning keeps every
subtree of suffixes within a memory budget:

1. *Blocks.*  Texts are cut into pieces and words in bounded blocks of one
   language.  A block's suffixes become a sorted list of distinct ones with
   counts, against the block's own dictionary, and are written once.  A suffix
   that fills the corpus is thereby one row a block.
2. *Plan.*  A prefix weighs as many such rows as begin with it.  Words heavier than
   the limit, and pairs of words after them, are split by one more word.  Blocks
   report prefixes from half their fair share of the limit on, so what is not
   reported adds up to less than half the limit, and a prefix is split once its
   reports exceed the other half: nothing heavier than the limit stays whole, and
   at most 2 * ``MAX_PREFIXES`` prefixes reach the driver.
3. *Subtrees.*  Prefixes are grouped, by hash, into groups of about ``GROUP_ROWS``
   suffix rows.  A task merges the rows of a group into one sorted list, the
   leaves of its subtrees; runs of one, two and three equal words are the nodes,
   and the leaf totals their counts.  Nodes above a split prefix are added up
   over the groups.
4. *Scores.*  Joins of the frequent nodes give every cut its two parts.

Arithmetic is exact (38 digits).  Defined cases: a null text is empty and gives
nothing; a null language is ``und``, together with a language of that name;
ids are not used, so repeated rows and null ids count as often as they occur; a
text of one word or without words adds no phrase; equal scores go to the more
frequent phrase, then to the smaller one in byte order; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.llm.common import groups, in_arrow, mix, slices, table, written

MIN_COUNT, TOP, COVERED_PERCENT = 10, 2000, 50
RUN_BYTES, HELD_BYTES, BLOCK_WORDS = 6 << 20, 32 << 20, 1 << 20
GROUP_ROWS, MAX_PREFIXES = 1 << 20, 1 << 20
BITS = 21                      # of a word's number: a block has at most BLOCK_WORDS + 2 words
LOW = (1 << BITS) - 1
MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")


def runs_of(text: bytes) -> Iterator[bytes]:
    """A text, lower-cased and marked, in runs of whole pieces of about RUN_BYTES."""
    text = text.lower().translate(MARKS)
    at = 0
    while at < len(text):
        stop = text.find(b"\n", at + RUN_BYTES)
        stop = len(text) if stop < 0 else stop
        yield text[at:stop]
        at = stop + 1


def words_of(run: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a run, and the number of each one's piece."""
    raw = np.frombuffer(run, np.uint8)
    ends_piece = raw == 10
    inside = ~(ends_piece | (raw == 32))
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.concatenate(([0], np.cumsum(stop - start))).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(raw[inside]))
    return words, np.cumsum(ends_piece, dtype=np.int32)[start] if len(start) else start


def packed(code: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted suffix codes and their counts: byte planes, compressed."""
    first = code >> (2 * BITS)
    rows = np.concatenate([np.diff(first, prepend=0), (code >> BITS) & LOW, code & LOW]).astype("<i4")
    planes = rows.view(np.uint8).reshape(-1, 4).T
    body = np.ascontiguousarray(planes).tobytes() + count.astype("<i8").tobytes()
    return len(code).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(body[:8], "little")
    raw = zstandard.ZstdDecompressor().decompress(body[8:], max_output_size=20 * n)
    rows = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 12 * n).reshape(4, -1).T).view("<i4").ravel().astype(np.int64)
    code = (np.cumsum(rows[:n]) << (2 * BITS)) | (rows[n:2 * n] << BITS) | rows[2 * n:]
    return code, np.frombuffer(raw, "<i8", n, 12 * n)


def dictionary(words: pa.Array) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress("\n".join(words.to_pylist()).encode())


def entries(body: bytes) -> pa.Array:
    """The words of a written dictionary (words hold no line break)."""
    raw = np.frombuffer(zstandard.decompress(body), np.uint8)
    inside = raw != 10
    ends = np.flatnonzero(~inside)
    at = np.concatenate(([0], ends - np.arange(len(ends)), [inside.sum()])).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(raw[inside]))


def suffixes(words: pa.Array, piece: np.ndarray, start: int, stop: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(dictionary, codes, counts) of the suffixes beginning in [start, stop)."""
    n = stop - start
    part = words.slice(start, n + 2).dictionary_encode()
    order = pc.sort_indices(part.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    own = number[part.indices.to_numpy(zero_copy_only=False)]
    where = piece[start:stop + 2]
    code = own[:n] << (2 * BITS)
    for k in (1, 2):
        m = min(n, len(own) - k)
        same = where[k:k + m] == where[:m]
        code[:m] |= np.where(same, own[k:k + m], 0) << (BITS * (2 - k))
    code, count = np.unique(code, return_counts=True)
    return part.dictionary.take(pa.array(order)), code, count


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def flush(lang: str) -> Iterator[pa.RecordBatch]:
        size.pop(lang)
        for run in runs_of(b"\n".join(held.pop(lang))):
            words, piece = words_of(run)
            for at in range(0, len(words), BLOCK_WORDS):
                stop = min(len(words), at + BLOCK_WORDS)
                known, code, count = suffixes(words, piece, at, stop)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]), pa.array([stop - at], pa.int64()), pa.array([len(code)], pa.int64()),
                     pa.array([dictionary(known)], pa.binary()), pa.array([packed(code, count)], pa.binary())],
                    names=["lang", "n", "rows", "words", "body"])

    for batch in batches:
        for piece in slices(batch, "text", RUN_BYTES):
            langs = piece.column(0).to_pylist()
            for lang, text in zip(langs, piece.column(1).cast(pa.binary()), strict=True):
                raw = text.as_py()
                if not raw:
                    continue
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw) + 1
                if size[lang] >= RUN_BYTES:
                    yield from flush(lang)
            while sum(size.values()) > HELD_BYTES:
                yield from flush(max(size, key=size.get))
    for lang in list(held):
        yield from flush(lang)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes by word number; 0 stands for the end of a piece."""
    return np.array([0, *[xxhash.xxh64_intdigest(w) for w in words.to_pylist()]], np.uint64)


def prefix_hash(lang: str, *parts: np.ndarray) -> np.ndarray:
    h = np.array([xxhash.xxh64_intdigest(lang)], np.uint64)
    for p in parts:
        h = mix(h * np.uint64(0x100000001B3) + p)
    return h


def _each(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch, one at a time."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def _runs(v: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1]))) if len(v) else np.zeros(0, int)


def _heavy(least: float):
    """Prefixes of one and two words holding at least ``least`` rows of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, words, body in _each(batch):
                code, _ = unpacked(body)
                out_w, out_h, out_n = [], [], []
                hashes = None
                for depth in (1, 2):
                    node = code >> (BITS * (3 - depth))
                    at = _runs(node)
                    n = np.diff(np.append(at, len(node)))
                    big = (n >= least) & ((node[at] & LOW) > 0)
                    if not big.any():
                        continue
                    hashes = word_hashes(entries(words)) if hashes is None else hashes
                    node = node[at][big]
                    parts = [hashes[node]] if depth == 1 else [hashes[node >> BITS], hashes[node & LOW]]
                    out_w += [depth] * len(node)
                    out_h.append(prefix_hash(lang, *parts).astype(np.int64))
                    out_n.append(n[big])
                if out_h:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out_w, pa.int32()), pa.array(np.concatenate(out_h)), pa.array(np.concatenate(out_n))],
                        names=["depth", "prefix", "weight"])
    return run


def split_prefixes(blocks: DataFrame, rows: int, n_blocks: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and of the pairs, that are split by one more word.
    (Prefixes that share a hash are split alike, which changes no count.)"""
    least = limit / (2 * n_blocks)
    said = (blocks.select("lang", "words", "body").transform(in_arrow, _heavy(least), "depth int, prefix long, weight long")
            .groupBy("depth", "prefix").agg(F.sum("weight").alias("weight")).filter(F.col("weight") > limit / 2)
            .select("depth", "prefix").toArrow())       # at most 2 * rows / limit of each depth
    depth, prefix = said.column("depth").to_numpy(), said.column("prefix").to_numpy()
    return np.sort(prefix[depth == 1]), np.sort(prefix[depth == 2])


def _among(sorted_: np.ndarray, v: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(v), bool)
    at = np.minimum(np.searchsorted(sorted_, v), len(sorted_) - 1)
    return sorted_[at] == v


def _routed(plan, n_groups: int):
    """Suffix rows of a block by the group of their prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split1, split2 = plan.value
        for batch in batches:
            for lang, known, body in _each(batch):
                code, count = unpacked(body)
                words = entries(known)
                h = word_hashes(words)
                w = [code >> (2 * BITS), (code >> BITS) & LOW, code & LOW]
                key = prefix_hash(lang, h[w[0]])
                deep = _among(split1, key.astype(np.int64))
                if deep.any():
                    pair = prefix_hash(lang, h[w[0][deep]], h[w[1][deep]])
                    deeper = _among(split2, pair.astype(np.int64))
                    pair[deeper] = prefix_hash(lang, *[h[x[deep][deeper]] for x in w])
                    key[deep] = pair
                group = (key % np.uint64(n_groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                at = _runs(group[order])
                for a, b in zip(at, np.append(at[1:], len(order)), strict=True):
                    rows = order[a:b]
                    used, new = np.unique(np.concatenate([x[rows] for x in w]), return_inverse=True)
                    if used[0] > 0:
                        used, new = np.concatenate(([0], used)), new + 1
                    new = new.reshape(3, -1).astype(np.int64)
                    own = (new[0] << (2 * BITS)) | (new[1] << BITS) | new[2]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(group[rows[0]])], pa.int64()), pa.array([lang]),
                         pa.array([dictionary(words.take(pa.array(used[1:] - 1)))], pa.binary()),
                         pa.array([packed(own, count[rows])], pa.binary())], names=["group", "lang", "words", "body"])
    return run


def subtree(parts: list[tuple[pa.Array, np.ndarray, np.ndarray]]) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """Merge blocks' suffixes: (dictionary, the leaves' three word numbers in
    sorted order, leaf totals)."""
    every = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
    number = every.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    w: list[list[np.ndarray]] = [[], [], []]
    at = 0
    for known, code, _ in parts:
        to = np.concatenate(([0], number[at:at + len(known)]))
        at += len(known)
        for k in range(3):
            w[k].append(to[(code >> (BITS * (2 - k))) & LOW])
    cols = [np.concatenate(x) for x in w]
    count = np.concatenate([p[2] for p in parts])
    if len(every.dictionary) <= LOW:
        code = (cols[0] << (2 * BITS)) | (cols[1] << BITS) | cols[2]
        order = np.argsort(code, kind="stable")
    else:
        order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return every.dictionary, [c[first] for c in cols], np.add.reduceat(count[order], first)


def _nodes(plan, min_count: int):
    """Nodes of every group's subtrees: (lang, size, phrase, f, part)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split1, split2 = plan.value
        for t in groups(batches, ["group", "lang"]):
            lang = t.column("lang")[0].as_py()
            parts = [(entries(k.as_py()), *unpacked(b.as_py())) for k, b in zip(t.column("words"), t.column("body"), strict=True)]
            words, w, total = subtree(parts)
            h = None
            part1 = part2 = None
            if len(split1):
                h = word_hashes(words)
                part1 = _among(split1, prefix_hash(lang, h[w[0]]).astype(np.int64))
                part2 = _among(split2, prefix_hash(lang, h[w[0]], h[w[1]]).astype(np.int64))
            new = np.zeros(len(total), bool)
            new[:1] = True
            for size in (1, 2, 3):
                new[1:] |= w[size - 1][1:] != w[size - 1][:-1]
                at = np.flatnonzero(new)
                f = np.add.reduceat(total, at)
                part = np.zeros(len(at), bool) if h is None or size == 3 else (part1 if size == 1 else part2)[at]
                keep = (w[size - 1][at] > 0) & (part | (f >= min_count))
                at, f, part = at[keep], f[keep], part[keep]
                for a in range(0, len(at), 1 << 16):
                    rows = at[a:a + (1 << 16)]
                    text = [words.take(pa.array(w[k][rows] - 1)) for k in range(size)]
                    phrase = pc.binary_join_element_wise(*text, pa.scalar(" ", text[0].type)) if size > 1 else text[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(rows)), pa.array([size] * len(rows), pa.int32()), phrase.cast(pa.string()),
                         pa.array(f[a:a + (1 << 16)]), pa.array(part[a:a + (1 << 16)])],
                        names=["lang", "size", "phrase", "f", "part"])
    return run


def phrase_counts(df: DataFrame, min_count: int = MIN_COUNT, group_rows: int = GROUP_ROWS,
                  text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, size, phrase, f) of all phrases of up to three words found
    ``min_count`` times, (lang, n))."""
    spark = df.sparkSession
    texts = df.select(F.coalesce(df[lang_col].cast("string"), F.lit("und")).alias("lang"), df[text_col].cast("string").alias("text"))
    blocks = written(texts.filter(F.col("text") != "").transform(
        in_arrow, _blocks, "lang string, n long, rows long, words binary, body binary"), "suffix_blocks")
    seen = blocks.agg(F.sum("rows").alias("rows"), F.count("*").alias("blocks")).first()
    rows = seen["rows"] or 0
    n_groups = max(1, -(-rows // group_rows))
    limit = max(group_rows // 8, -(-rows // MAX_PREFIXES))
    plan = spark.sparkContext.broadcast(split_prefixes(blocks, rows, seen["blocks"], limit) if rows else (np.zeros(0, np.int64),) * 2)
    routed = blocks.select("lang", "words", "body").transform(
        in_arrow, _routed(plan, n_groups), "group long, lang string, words binary, body binary")
    nodes = written(routed.repartition("group").sortWithinPartitions("group", "lang").transform(
        in_arrow, _nodes(plan, min_count), "lang string, size int, phrase string, f long, part boolean"), "phrase_nodes")
    split = nodes.filter("part").groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)
    counts = nodes.filter("not part").select("lang", "size", "phrase", "f").unionByName(split)
    return counts, blocks.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(df: DataFrame, min_count: int = MIN_COUNT, covered: int = COVERED_PERCENT, top: int = TOP,
                 group_rows: int = GROUP_ROWS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` of each language."""
    counts, totals = phrase_counts(df, min_count, group_rows)
    word = F.split("phrase", " ")
    tri = counts.filter("size = 3")
    inside = tri.select("lang", "f", F.explode(F.array(F.concat_ws(" ", word[0], word[1]), F.concat_ws(" ", word[1], word[2]))).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    pairs = (counts.filter("size = 2").join(inside, ["lang", "phrase"], "left")
             .filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * covered)))
    cut = lambda k, first, rest: F.struct(F.lit(k).alias("k"), first.alias("first"), rest.alias("rest"))
    pairs = pairs.select("lang", "phrase", F.col("f").alias("a"), F.array(cut(1, word[0], word[1])).alias("cuts"))
    tri = tri.select("lang", "phrase", F.col("f").alias("a"), F.array(
        cut(1, word[0], F.concat_ws(" ", word[1], word[2])), cut(2, F.concat_ws(" ", word[0], word[1]), word[2])).alias("cuts"))
    cuts = pairs.unionByName(tri).select("lang", "phrase", "a", F.inline("cuts"))
    both = counts.filter("size < 3")
    left, right = both.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), both.select(
        "lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    scored = (cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .withColumns({"over": big("a") * big("a") * F.lit(1000000).cast("decimal(7,0)"), "under": big("l") * big("r")})
              .withColumn("score", F.expr("over div under")))
    best = (scored.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    # the best of every share of a language first, then of some shares together, so that
    # no language is sorted in one task
    order = [F.desc("score"), F.desc("a"), "phrase"]
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = best.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    for together in (shares, math.isqrt(shares) + 1, 1):
        best = best.withColumn("share", F.col("share") % together)
        best = best.withColumn("rank", F.row_number().over(W.partitionBy("lang", "share").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("int").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = f"""
WITH pieces AS (
    SELECT row_number() OVER () AS piece, lang, p FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS p
        FROM documents)),
words AS (SELECT piece, lang, list_filter(regexp_split_to_array(p, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
    SELECT lang, 1 AS size, unnest(w) AS phrase FROM words
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words WHERE len(w) > 1
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
              FROM words WHERE len(w) > 2),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
split AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1),
inside AS (
    SELECT lang, p AS phrase, max(f) AS longer FROM (
        SELECT lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS p FROM split WHERE size = 3) GROUP BY ALL),
cuts AS (
    SELECT lang, phrase, f AS a, 1 AS k, w[1] AS first_part, w[2] AS rest FROM split WHERE size = 2
    UNION ALL SELECT lang, phrase, f, 1, w[1], w[2] || ' ' || w[3] FROM split WHERE size = 3
    UNION ALL SELECT lang, phrase, f, 2, w[1] || ' ' || w[2], w[3] FROM split WHERE size = 3),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
           CAST((CAST(c.a AS HUGEINT) * c.a * 1000000) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.first_part AND x.size < 3
    JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest AND y.size < 3
    LEFT JOIN inside i ON i.lang = c.lang AND i.phrase = c.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < {COVERED_PERCENT} * c.a),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP}"""
