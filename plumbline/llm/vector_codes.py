"""Product codes of vectors by Lloyd rounds over partition-local cover trees.

Components become integers, ``floor(SCALE * x)``; vectors are cut into ``PARTS``
consecutive parts, and every part position has a codebook of ``ENTRIES`` entries
that ``ROUNDS`` of Lloyd's method move.  All of it is exact integer arithmetic,
so the codes do not depend on how the rows lie in partitions.

1. *Trees.*  Each task packs its rows into chunks of ``CHUNK_ROWS`` vectors and
   builds, for every chunk and part position, a cover tree: the centres that are
   children of a node lie more than half its covering radius apart, and each
   point of the node is within that radius of one of them.  Points lie in tree
   order, so that a subtree is a range and its sum the difference of two
   cumulative sums.  The chunks, a row each, are written once.
2. *Rounds.*  The codebooks (``PARTS * ENTRIES`` entries) go to the tasks.  A node
   with centre c and radius r belongs whole to the entry e when, by the triangle
   inequality, every other entry f has d(c, f) - d(c, e) > 2 r; its count and its
   sum are then read from the cumulative sums.  Only other nodes descend, and
   points of ambiguous leaves are compared exactly.  The tests on nodes allow for
   the rounding of the square roots; a tie never passes them.
3. Counts and sums come back as sums of base-2**32 digits, so they are exact at
   any number of rows; the driver holds the codebooks only.

Defined cases: rows whose vector is null, or holds null or non-finite
components, go; vectors must be of one length, those of a less frequent length
(ties: the longer) go too, and so do empty ones; a length that is no multiple of
``PARTS`` gives the first parts one component more; a codebook starts from the
smallest distinct non-null vec_ids (of a repeated id the smallest vector), with
fewer than ``ENTRIES`` of them it has fewer entries, with none there is no
codebook and no row; repeated rows and null ids are coded and counted like all
others; components too large for 64-bit squares are computed with Python's
integers, and an error beyond 64 bits is null; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import in_arrow, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK_ROWS, LEAF_ROWS = 4096, 16
SAFE = 1 << 28          # components up to this have 64-bit sums of squares
DIGIT = 32


def finite(vec: Column) -> Column:
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def kept_vectors(df: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, vec, label) of the rows that take part."""
    v = df.select(df[id_col].cast("long").alias("vec_id"), df[vec_col].cast("array<double>").alias("vec"),
                  df[label_col].alias("label"))
    v = v.filter(F.coalesce(finite(F.col("vec")), F.lit(False)) & (F.size("vec") > 0))
    top = v.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    return v.filter(F.size("vec") == (top["dim"] if top else 0))


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as 64-bit integers where their squares fit, else as Python's."""
    if not x.size or np.abs(x).max() * SCALE < SAFE:
        return np.floor(x * SCALE).astype(np.int64)
    # a double times a power of two is exact but for overflow, which integers do not have
    flat = [math.floor(v * SCALE) if abs(v) < 2.0 ** 900 else int(v) * SCALE for v in x.ravel().tolist()]
    out = np.empty(len(flat), object)
    out[:] = flat
    return out.reshape(x.shape)


def cuts(dim: int) -> list[tuple[int, int]]:
    base, more = divmod(dim, PARTS)
    ends = np.cumsum([0] + [base + (p < more) for p in range(PARTS)]).tolist()
    return list(zip(ends, ends[1:], strict=False))


class CoverTree:
    """Nodes as arrays: ``centre`` (row of a point), ``radius`` over the whole
    subtree, ``[lo, hi)`` of ``order``, and the children ``[kid, kid_end)``."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.order = np.arange(n)
        centre, radius, lo, hi, kid, kid_end = [0], [0.0], [0], [n], [0], [0]
        cover = [0.0]
        at = 0
        while at < len(centre):
            a, b = lo[at], hi[at]
            rows = self.order[a:b].copy()
            diff = (x[rows] - x[centre[at]]).astype(np.float64)
            d = np.sqrt((diff * diff).sum(axis=1))
            radius[at] = float(d.max()) if b > a else 0.0
            kid[at] = kid_end[at] = len(centre)
            if b - a > LEAF_ROWS and radius[at] > 0:
                # children cover half of what this node covers; farther than that apart
                half = (cover[at] or radius[at]) / 2
                while half >= radius[at]:
                    half /= 2
                rest, pos = rows, a
                pick, dist = centre[at], d
                while len(rest):
                    near = dist <= half
                    own = rest[near]
                    centre.append(int(pick))
                    radius.append(0.0)
                    cover.append(half)
                    lo.append(pos)
                    hi.append(pos + len(own))
                    kid.append(0)
                    kid_end.append(0)
                    self.order[pos:pos + len(own)] = own
                    pos += len(own)
                    rest = rest[~near]
                    if len(rest):
                        pick = rest[0]
                        diff = (x[rest] - x[pick]).astype(np.float64)
                        dist = np.sqrt((diff * diff).sum(axis=1))
                kid_end[at] = len(centre)
            at += 1
        self.centre = np.array(centre)
        self.radius = np.array(radius)
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.kid, self.kid_end = np.array(kid), np.array(kid_end)


TREE = ("order", "centre", "radius", "lo", "hi", "kid", "kid_end")


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances, (rows, entries)."""
    d = x[:, None, :] - book[None, :, :]
    return (d * d).sum(axis=2)


def assign(x: np.ndarray, tree: CoverTree | None, book: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]:
    """Whole subtrees as (lo, hi, entry), then the rows compared exactly and their entries."""
    if tree is None:
        return [], np.arange(len(x)), squared(x, book).argmin(axis=1)
    whole, left = [], []
    front = np.array([0])
    while len(front):
        d = np.sqrt(squared(x[tree.centre[front]], book).astype(np.float64))
        best = d.argmin(axis=1)
        near = d[np.arange(len(front)), best]
        d[np.arange(len(front)), best] = np.inf
        gap = d.min(axis=1) - near
        sure = gap > 2 * tree.radius[front] + 1e-6 * (1 + tree.radius[front] + near)
        whole += zip(tree.lo[front[sure]].tolist(), tree.hi[front[sure]].tolist(), best[sure].tolist(), strict=True)
        open_ = front[~sure]
        leaf = tree.kid[open_] == tree.kid_end[open_]
        left += [tree.order[a:b] for a, b in zip(tree.lo[open_[leaf]], tree.hi[open_[leaf]], strict=True)]
        inner = open_[~leaf]
        front = np.concatenate([np.arange(a, b) for a, b in zip(tree.kid[inner], tree.kid_end[inner], strict=True)]) if len(inner) else inner
    rows = np.concatenate(left) if left else np.zeros(0, int)
    return whole, rows, squared(x[rows], book).argmin(axis=1) if len(rows) else rows


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (vec_id, vec, label) as rows of (ids, labels, body)."""
    def pack(t: pa.Table) -> pa.RecordBatch:
        col = t.column("vec").combine_chunks()
        x = integers(col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1))
        out = io.BytesIO()
        if x.dtype == object:
            np.savez(out, x=np.array([str(v) for v in x.ravel()]), shape=np.array(x.shape))
        else:
            small = np.int32 if np.abs(x).max() < 1 << 31 else np.int64
            body = {"x": x.astype(small), "shape": np.array(x.shape)}
            for p, (a, b) in enumerate(cuts(x.shape[1])):
                tree = CoverTree(x[:, a:b])
                body |= {f"{k}{p}": getattr(tree, k).astype(np.float64 if k == "radius" else np.int32) for k in TREE}
            np.savez(out, **body)
        ends = pa.array([0, len(col)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(ends, t.column("vec_id").combine_chunks()),
             pa.ListArray.from_arrays(ends, t.column("label").combine_chunks()),
             pa.array([out.getvalue()], pa.binary())], names=["ids", "labels", "body"])

    held, rows = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, CHUNK_ROWS - rows)
            held.append(piece)
            rows += piece.num_rows
            at += piece.num_rows
            if rows == CHUNK_ROWS:
                yield pack(pa.Table.from_batches(held))
                held, rows = [], 0
    if rows:
        yield pack(pa.Table.from_batches(held))


def _opened(body: bytes) -> tuple[np.ndarray, list[CoverTree | None]]:
    z = np.load(io.BytesIO(body))
    if z["x"].dtype.kind == "U":
        x = np.empty(len(z["x"]), object)
        x[:] = [int(v) for v in z["x"]]
        return x.reshape(z["shape"]), [None] * PARTS
    trees = []
    for p in range(PARTS):
        t = object.__new__(CoverTree)
        for k in TREE:
            setattr(t, k, z[f"{k}{p}"])
        trees.append(t)
    return z["x"].astype(np.int64), trees


def _sums(books):
    """Per task: (part, entry, place, digit, value); place -1 is the count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict = {}
        total: dict = {}
        for batch in batches:
            for body in batch.column(0):
                x, trees = _opened(body.as_py())
                for p, (a, b) in enumerate(cuts(x.shape[1])):
                    part, book = x[:, a:b], books.value[p]
                    whole, rows, which = assign(part, trees[p], book)
                    n = np.zeros(len(book), object)
                    s = np.zeros((len(book), b - a), object)
                    if whole:
                        lo, hi, entry = (np.array(v) for v in zip(*whole, strict=True))
                        run_sum = np.concatenate([np.zeros((1, b - a), np.int64), np.cumsum(part[trees[p].order], axis=0)])
                        for e in np.unique(entry):
                            own = entry == e
                            n[e] += int((hi[own] - lo[own]).sum())
                            s[e] += (run_sum[hi[own]] - run_sum[lo[own]]).sum(axis=0).astype(object)
                    for e in np.unique(which):
                        own = rows[which == e]
                        n[e] += len(own)
                        s[e] += part[own].sum(axis=0).astype(object)
                    count[p] = count.get(p, 0) + n
                    total[p] = total.get(p, 0) + s
        out = []
        for p, n in count.items():
            for e in np.flatnonzero(n).tolist():
                for place, v in enumerate([n[e], *total[p][e].tolist()], start=-1):
                    v, digit = int(v), 0
                    while True:                      # base 2**32, the last digit with the sign
                        if -(1 << 30) <= v < 1 << 30:
                            out.append((p, e, place, digit, v))
                            break
                        out.append((p, e, place, digit, v & ((1 << DIGIT) - 1)))
                        v, digit = v >> DIGIT, digit + 1
        cols = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[i], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
            names=["part", "entry", "place", "digit", "value"])
    return run


def _codes(books):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, trees = _opened(batch.column(2)[i].as_py())
                code = np.zeros((len(x), PARTS), np.int64)
                error = np.zeros(len(x), x.dtype)
                for p, (a, b) in enumerate(cuts(x.shape[1])):
                    part, book = x[:, a:b], books.value[p]
                    whole, rows, which = assign(part, trees[p], book)
                    for lo, hi, e in whole:
                        code[trees[p].order[lo:hi], p] = e
                    code[rows, p] = which
                    d = part - book[code[:, p]]
                    error = error + (d * d).sum(axis=1)
                ids, labels = batch.column(0)[i].values, batch.column(1)[i].values
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(["".join(f"{e:02x}" for e in row) for row in code.tolist()], pa.string()),
                     pa.array([int(v) if v < 1 << 63 else None for v in error], pa.int64())],
                    names=["vec_id", "label", "code", "error"])
    return run


def _first(vecs: DataFrame) -> list[np.ndarray]:
    """The starting codebooks."""
    first = (vecs.filter(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("vec").alias("vec"))
             .orderBy("vec_id").limit(ENTRIES).collect())   # ENTRIES rows
    if not first:
        return []
    x = integers(np.array([r["vec"] for r in first], float))
    return [x[:, a:b] for a, b in cuts(x.shape[1])]


def _moved(books: list[np.ndarray], rows: list) -> list[np.ndarray]:
    """Codebooks whose used entries are the floored means."""
    got: dict[tuple[int, int, int], int] = {}
    for r in rows:
        key = (r["part"], r["entry"], r["place"])
        got[key] = got.get(key, 0) + (int(r["value"]) << (DIGIT * r["digit"]))
    out = []
    for p, book in enumerate(books):
        new = book.astype(object)
        for e in range(len(book)):
            n = got.get((p, e, -1), 0)
            if n:
                new[e] = [got[(p, e, place)] // n for place in range(book.shape[1])]
        big = new.size and max(abs(v) for v in new.ravel()) >= SAFE
        out.append(new if big else new.astype(np.int64))
    return out


def product_codes(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                  rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """((vec_id, label, code, error), final codebooks by part)."""
    spark = df.sparkSession
    vecs = kept_vectors(df, id_col, vec_col, label_col)
    kind = vecs.schema["label"].dataType.simpleString()
    books = _first(vecs)
    if not books:
        return spark.createDataFrame([], f"vec_id long, label {kind}, code string, error long"), []
    chunks = written(vecs.transform(in_arrow, _chunks, f"ids array<long>, labels array<{kind}>, body binary"), "cover_trees")
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)
        sums = (chunks.select("body").transform(in_arrow, _sums(held), "part int, entry int, place int, digit int, value long")
                .groupBy("part", "entry", "place", "digit").agg(F.sum("value").alias("value")))
        books = _moved(books, sums.collect())    # a few numbers for each component of the codebooks
    held = spark.sparkContext.broadcast(books)
    coded = chunks.transform(in_arrow, _codes(held), f"vec_id long, label {kind}, code string, error long")
    return coded, books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.ravel()).encode()).hexdigest()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = product_codes(table(spark, sf_dir, "embeddings"))
    coded = written(coded, "vector_codes")
    # every row meets its label's one row; partial sums first, so that a frequent label is no one task's group
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, coded["label"].eqNullSafe(sums["_label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def oracle_sql(dim: int = 64) -> str:
    """DuckDB twin for vectors of ``dim`` components (a multiple of PARTS)."""
    w = dim // PARTS
    steps = [f"""
    v AS MATERIALIZED (SELECT row_number() OVER () AS row_id, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
         WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT row_id, label, p, x[p * {w} + 1 : p * {w} + {w}] AS x
         FROM v, (SELECT unnest(range({PARTS})) AS p)),
    first AS (SELECT row_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT {ENTRIES}),
    book0 AS MATERIALIZED (SELECT p, e, x FROM first JOIN parts USING (row_id))"""]
    for r in range(ROUNDS + 1):
        steps.append(f"""
    own{r} AS MATERIALIZED (SELECT row_id, label, p, x, m.e AS e, m.d AS d FROM (
         SELECT a.row_id, any_value(a.label) AS label, a.p, any_value(a.x) AS x,
                min({{'d': list_sum(list_transform(range(1, {w + 1}), lambda i: (a.x[i] - b.x[i]) * (a.x[i] - b.x[i]))), 'e': b.e}}) AS m
         FROM parts a JOIN book{r} b ON a.p = b.p GROUP BY a.row_id, a.p))""")
        if r < ROUNDS:
            means = ", ".join(
                f"CAST((sum(x[{i}]) - ((sum(x[{i}]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT)"
                for i in range(1, w + 1))
            steps.append(f"""
    mean{r} AS (SELECT p, e, [{means}] AS x FROM own{r} GROUP BY p, e),
    book{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.e = m.e)""")
    last = ROUNDS
    return f"""WITH {','.join(steps)},
    coded AS (SELECT row_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code,
              CAST(sum(d) AS BIGINT) AS error FROM own{last} GROUP BY row_id),
    digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS h FROM book{last})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY c.label) AS BIGINT) AS label_error,
           (SELECT h FROM digest) AS codebooks_sha256
    FROM coded c JOIN v USING (row_id)"""


ORACLE_SQL = oracle_sql()
