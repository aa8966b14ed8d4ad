"""Approximate nearest neighbours by balanced posting lists.

The measure is the largest inner product.  Vectors get one more component that
makes all of them equally long, which turns it into the smallest distance.

1. *Centroids*, about ``LISTS`` * sqrt(n) of them for n vectors, are fitted on a
   bounded sample (``SAMPLE_ROWS``, or ``LIST_SAMPLE`` a list if that is more) by
   rounds of k-means whose assignment charges crowded centroids, so lists come
   out balanced.
2. *Posting lists.*  Every vector goes to its nearest centroid, and a boundary
   vector also to the next ones, up to ``COPIES`` in all.  Boundary vectors are
   the ``SHARE`` of the sample whose two nearest centroids differ least; the
   ratio of distances that sets them apart holds for all vectors.  A long list is
   cut into parts of about ``PART_ROWS`` vectors by a hash, so no list is one
   task's group.
3. *Visits.*  How many lists a query must visit depends on the vectors, so it is
   measured: the true neighbours of ``PROBES`` queries are found among all posted
   vectors in one pass.  The fewest nearest lists that hold ``RECALL`` of them are
   looked at, and the smallest distance ratio to the nearest list that holds
   ``RATIO_RECALL`` of them selects among these; as many lists as surely hold
   ``k`` candidates are always visited.
4. *Search.*  A neighbour graph over the centroids, held in memory by each task,
   is searched best-first from evenly spaced entries, a heap per query, for 1.25
   times as many centroids as lists are visited and ``BEAM`` more; the distance
   ratio then selects the lists.  Queries meet the parts of their lists in one shuffle, each part
   returns its best ``k``, and these are merged per query.

The same steps run at every size.  Vectors without structure (independent random
directions) have their neighbours spread over most lists; then most lists must be
visited for the recall, and little is saved over comparing all.

Scores are sums of products in double precision on the original vectors.
Identical vectors are reduced to the ``k + 1`` smallest ids before indexing:
by the tie rule no other copy can be among anyone's ``k`` nearest.

Defined cases: null ids, and vectors that are null, zero, hold a null or a
non-finite component, or have another length than most vectors take no part;
ties go to the smaller id; a query does not find itself; repeated rows of an id
with one vector are one vector; with fewer than k candidates all are returned;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from plumbline.llm.common import in_arrow, table, written

K = 20
QUERY_EVERY = 20
SAMPLE_ROWS, LIST_SAMPLE = 20_000, 16
LISTS = 1.0
ROUNDS = 8
COPIES, SHARE = 4, 0.1
DEGREE, LINKS, BEAM = 24, 4, 16
PROBES, RECALL, RATIO_RECALL = 100, 0.97, 0.985
PART_ROWS = 4096
QUERY_PART = 4096


def usable(vec: Column) -> Column:
    """A vector that can take part."""
    return (vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(vec, lambda x: x != 0))


def vectors(df: DataFrame) -> DataFrame:
    """(vec_id, embedding array<double>) of the vectors that take part."""
    v = df.select(df["vec_id"].cast("long").alias("vec_id"), df["embedding"].cast("array<double>").alias("embedding"))
    v = v.filter(F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("embedding")), F.lit(False)))
    lengths = v.groupBy(F.size("embedding").alias("dim")).agg(F.count("*").alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    return v.filter(F.size("embedding") == (top["dim"] if top else 0))


def matrix(col: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


class Index:
    """Centroids, in the lengthened space, and the graph over them."""

    def __init__(self, centroids: np.ndarray, longest: float):
        self.c, self.longest = centroids, longest
        self.sq = (centroids ** 2).sum(axis=1)
        n = len(centroids)
        self.boundary, self.sure, self.least, self.ratio = 1.0, n, n, np.inf
        near = np.zeros((n, min(DEGREE, n - 1)), int)
        for at in range(0, n, 512):
            d = self.sq[at:at + 512, None] - 2 * centroids[at:at + 512] @ centroids.T + self.sq
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            near[at:at + 512] = np.argsort(d, axis=1, kind="stable")[:, :near.shape[1]]
        ring = np.stack([np.roll(np.arange(n), s) for s in (1, -1)], axis=1)  # keeps the graph in one piece
        far = np.random.default_rng(29).integers(0, n, (n, LINKS))
        self.graph = [np.unique(row) for row in np.concatenate([near, ring, far], axis=1)]
        self.entries = np.unique(np.linspace(0, n - 1, int(np.ceil(2 * np.sqrt(n)))).astype(int))

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x ** 2).sum(axis=1), 0.0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def distances(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ self.c.T + self.sq, 0.0))

    def lists_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs of the lists that vectors ``x`` are posted to."""
        d = self.distances(self.lengthened(x))
        copies = min(COPIES, d.shape[1])
        near = np.argpartition(d, copies - 1, axis=1)[:, :copies]
        dn = np.take_along_axis(d, near, axis=1)
        take = dn <= np.maximum(self.boundary * dn.min(axis=1, keepdims=True), 1e-12)
        row, at = np.nonzero(take)
        return row, near[row, at]

    def search(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs of the lists that queries ``q`` visit."""
        q = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        rows, lists = [], []
        for i, seeds in enumerate(self.sq[self.entries] - 2 * q @ self.c[self.entries].T):
            d, at = self.walked(q[i], seeds, min(-(-5 * self.least // 4) + BEAM, len(self.c)))
            d = np.sqrt(np.maximum(d + q[i] @ q[i], 0.0))[:self.least]
            at = at[:self.least][(d <= max(self.ratio * d[0], 1e-12)) | (np.arange(len(d)) < self.sure)]
            rows.append(np.full(len(at), i))
            lists.append(at)
        empty = [np.zeros(0, int)]
        return np.concatenate(rows or empty), np.concatenate(lists or empty)

    def walked(self, q: np.ndarray, seeds: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances (less a constant) and numbers of the ``beam`` nearest centroids
        found, nearest first: the nearest open node is opened until none is nearer
        than the farthest of the best."""
        seen = np.zeros(len(self.c), bool)
        seen[self.entries] = True
        found = list(zip(seeds.tolist(), self.entries.tolist(), strict=True))
        waiting, best = found[:], []
        heapq.heapify(waiting)
        for d, at in found:
            heapq.heappush(best, (-d, -at))
            if len(best) > beam:
                heapq.heappop(best)
        while waiting:
            d, at = heapq.heappop(waiting)
            if len(best) == beam and d > -best[0][0]:
                break
            near = self.graph[at]
            near = near[~seen[near]]
            seen[near] = True
            for d, at in zip((self.sq[near] - 2 * self.c[near] @ q).tolist(), near.tolist(), strict=True):
                if len(best) < beam or d <= -best[0][0]:
                    heapq.heappush(waiting, (d, at))
                    heapq.heappush(best, (-d, -at))
                    if len(best) > beam:
                        heapq.heappop(best)
        best = sorted((-d, -at) for d, at in best)
        return np.array([d for d, _ in best]), np.array([at for _, at in best], int)


def fit(sample: np.ndarray, n_lists: int, longest: float) -> Index:
    """Balanced k-means: the price of a centroid rises with its crowd."""
    x = np.concatenate([sample, np.sqrt(np.maximum(longest ** 2 - (sample ** 2).sum(1), 0))[:, None]], axis=1)
    x = np.unique(x, axis=0)
    r = np.random.default_rng(17)
    x = x[r.permutation(len(x))]
    n_lists = max(1, min(n_lists, len(x)))
    c = x[:n_lists].copy()
    price = np.zeros(n_lists)
    fair = len(x) / n_lists
    for _ in range(ROUNDS):
        own = np.empty(len(x), int)
        for at in range(0, len(x), 1024):
            d = (c ** 2).sum(1) - 2 * x[at:at + 1024] @ c.T + price
            own[at:at + 1024] = d.argmin(axis=1)
        size = np.bincount(own, minlength=n_lists)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], c)
        spread = float(((x - c[own]) ** 2).sum(axis=1).mean())
        price = np.maximum(price + 0.1 * spread * (size / fair - 1), 0.0)
    index = Index(c, longest)
    if n_lists > 1 and SHARE > 0:
        ratios = []
        for at in range(0, len(x), 1024):
            d = np.partition(index.distances(x[at:at + 1024]), 1, axis=1)[:, :2]
            ratios.append(d[:, 1] / np.maximum(d[:, 0], 1e-12))
        index.boundary = float(np.quantile(np.concatenate(ratios), SHARE))
    return index


def build(vecs: DataFrame) -> Index | None:
    s = vecs.agg(F.count("*").alias("n"), F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    if not s["n"]:
        return None
    lists = max(1, round(LISTS * s["n"] ** 0.5))
    rows = max(SAMPLE_ROWS, LIST_SAMPLE * lists)
    draw = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = vecs.filter(draw < rows / s["n"]).select("vec_id", "embedding").toArrow()
    if not sample.num_rows:
        sample = vecs.limit(rows).select("vec_id", "embedding").toArrow()
    sample = sample.sort_by("vec_id")
    return fit(matrix(sample.column("embedding")), lists, float(np.sqrt(s["m"])))


def visits(index: Index, posted: DataFrame, asked: DataFrame, k: int) -> tuple[int, int, float]:
    """How many lists surely hold ``k`` candidates; the fewest nearest lists that
    hold ``RECALL`` of the true ``k`` nearest of ``PROBES`` of the queries ``asked``;
    and the smallest ratio of a list's distance to the nearest one's that holds
    ``RATIO_RECALL`` of them."""
    lists, whole = len(index.c), (len(index.c), len(index.c), float("inf"))
    held = np.zeros(lists, np.int64)
    for r in posted.groupBy("list").agg(F.count("*").alias("n")).collect():   # one row a centroid
        held[r["list"]] = r["n"]
    # a vector has COPIES rows at most, so that many of the smallest lists suffice
    sure = min(lists, int(np.searchsorted(np.cumsum(np.sort(held)), COPIES * (k + 1))) + 1)
    drawn = asked.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(PROBES).toArrow()
    if not drawn.num_rows:
        return whole
    probe, probes = drawn.column("vec_id").to_numpy(), matrix(drawn.column("embedding"))
    rows = np.arange(len(probe))
    keep = (k + 1) * COPIES                      # a vector has a row for each of its lists

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = np.full((len(probe), 0), -np.inf)
        ids, lists = np.zeros((len(probe), 0), np.int64), np.zeros((len(probe), 0), np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                s = probes @ matrix(part.column(2)).T
                own = np.broadcast_to(part.column(1).to_numpy(), s.shape)
                s[own == probe[:, None]] = -np.inf
                score = np.concatenate([score, s], axis=1)
                ids = np.concatenate([ids, own], axis=1)
                lists = np.concatenate([lists, np.broadcast_to(part.column(0).to_numpy(), s.shape)], axis=1)
                best = np.argsort(-score, axis=1, kind="stable")[:, :keep]
                score, ids, lists = score[rows[:, None], best], ids[rows[:, None], best], lists[rows[:, None], best]
        row, at = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(ids[row, at]), pa.array(lists[row, at]), pa.array(score[row, at])],
            names=["probe", "id", "list", "score"])

    found = (posted.select("list", "id", "vec").transform(in_arrow, run, "probe long, id long, list int, score double")
             .groupBy("probe", "id").agg(F.max("score").alias("score"), F.collect_set("list").alias("lists")))
    first = W.partitionBy("probe").orderBy(F.desc("score"), "id")
    near = found.withColumn("_at", F.row_number().over(first)).filter(F.col("_at") <= k).collect()  # PROBES * k rows
    if not near:
        return whole
    d = index.distances(np.concatenate([probes, np.zeros((len(probes), 1))], axis=1))
    place = np.argsort(np.argsort(d, axis=1, kind="stable"), axis=1)
    ratio = d / np.maximum(d.min(axis=1, keepdims=True), 1e-12)
    need = np.sort([place[r["probe"], r["lists"]].min() + 1 for r in near])
    wide = np.sort([ratio[r["probe"], r["lists"]].min() for r in near])
    at = lambda share: max(0, int(np.ceil(share * len(near))) - 1)
    return sure, max(sure, int(need[at(RECALL)])), float(wide[at(RATIO_RECALL)]) * (1 + 1e-9)


def _posted(index, method: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                row, which = getattr(index.value, method)(matrix(part.column(1)))
                out = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), out.column(0), out.column(1)],
                                                 names=["list", "id", "vec"])
    return run


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of row pairs, summed in order."""
    s = np.zeros(len(q))
    for d in range(q.shape[1]):
        s += q[:, d] * x[:, d]
    return s


def _best(k: int):
    def top(ids: np.ndarray, score: np.ndarray) -> np.ndarray:
        order = np.lexsort((ids, -score))
        return order[:k]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one (list, unit): vectors first, then queries."""
        held, ids, vecs, x = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            role, own = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            m = matrix(batch.column(4))
            cuts = [0, *[i for i in range(1, len(key)) if key[i] != key[i - 1] or role[i] != role[i - 1]], len(key)]
            out: list[tuple] = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if key[a] != held:
                    held, ids, vecs, x = key[a], [], [], None
                if role[a] == 0:
                    ids.append(own[a:b])
                    vecs.append(m[a:b])
                    continue
                if not ids:
                    continue
                if x is None:
                    x, all_ids = np.concatenate(vecs), np.concatenate(ids)
                for at in range(a, b, 256):
                    q = m[at:min(b, at + 256)]
                    s = q @ x.T
                    want = min(k + 1, s.shape[1])
                    edge = np.partition(s, s.shape[1] - want, axis=1)[:, s.shape[1] - want]
                    edge = edge - 1e-9 * (1 + np.abs(edge))
                    row, col = np.nonzero(s >= edge[:, None])
                    other = all_ids[col] != own[at + row]
                    row, col = row[other], col[other]
                    exact = _exact(q[row], x[col])
                    o = np.lexsort((all_ids[col], -exact, row))
                    row, found, exact = row[o], all_ids[col[o]], exact[o]
                    first = np.searchsorted(row, np.arange(len(q)))
                    for j, (b0, b1) in enumerate(zip(first, np.append(first[1:], len(row)), strict=True)):
                        out.append((int(own[at + j]), found[b0:min(b1, b0 + k)], exact[b0:min(b1, b0 + k)]))
            if out:
                yield _lists(out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial results sorted by query: the best k of each query, kept small
        as the parts stream by."""
        held, ids, score = None, [], []
        done: list[tuple] = []

        def compact() -> tuple[np.ndarray, np.ndarray]:
            both, every = np.concatenate(ids), np.concatenate(score)
            at = np.unique(both, return_index=True)[1]
            both, every = both[at], every[at]
            o = top(both, every)
            return both[o], every[o]

        for batch in batches:
            if not batch.num_rows:
                continue
            lists, scores = batch.column(1), batch.column(2)
            ends, flat, points = lists.offsets.to_numpy(), lists.values.to_numpy(), scores.values.to_numpy()
            for at, q in enumerate(batch.column(0).to_pylist()):
                if q != held:
                    if held is not None:
                        done.append((held, *compact()))
                    held, ids, score = q, [], []
                ids.append(flat[ends[at]:ends[at + 1]])
                score.append(points[ends[at]:ends[at + 1]])
                if len(ids) == 128:
                    i, x = compact()
                    ids, score = [i], [x]
            if done:
                yield _rows(done)
                done = []
            ids, score = [i.copy() for i in ids], [x.copy() for x in score]   # not views that hold the batch
        if held is not None:
            yield _rows([(held, *compact())])

    return search, merge


def _lists(out: list[tuple]) -> pa.RecordBatch:
    ends = pa.array(np.concatenate(([0], np.cumsum([len(o[1]) for o in out]))).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array([o[0] for o in out], pa.int64()),
         pa.ListArray.from_arrays(ends, pa.array(np.concatenate([o[1] for o in out]), pa.int64())),
         pa.ListArray.from_arrays(ends, pa.array(np.concatenate([o[2] for o in out]), pa.float64()))],
        names=["query_id", "ids", "scores"])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    n = [len(o[1]) for o in out]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([o[0] for o in out], n), pa.int64()),
         pa.array(np.concatenate([np.arange(1, x + 1) for x in n]), pa.int32()),
         pa.array(np.concatenate([o[1] for o in out]), pa.int64()),
         pa.array(np.concatenate([o[2] for o in out]), pa.float64())],
        names=["query_id", "rank", "vec_id", "score"])


def nearest(df: DataFrame, queries: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every vector
    that ``queries`` (a condition on vec_id) holds for."""
    spark = df.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    vecs = vectors(df)
    index = build(vecs)
    if index is None:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(index)
    same = W.partitionBy(F.xxhash64("embedding"), "embedding").orderBy("vec_id")
    alike = (vecs.distinct().withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k + 1)
             .select("vec_id", "embedding"))
    posted = written(alike.transform(in_arrow, _posted(held, "lists_of"), "list int, id long, vec array<double>"), "postings")
    index.sure, index.least, index.ratio = visits(index, posted, vecs.filter(queries), k)
    held = spark.sparkContext.broadcast(index)
    asked = written(vecs.filter(queries).distinct().transform(in_arrow, _posted(held, "search"), "list int, id long, vec array<double>"), "asked")
    # parts of a list and of its queries; each pair of parts is one unit of work
    sizes = (posted.groupBy("list").agg(F.count("*").alias("n"))
             .join(asked.groupBy("list").agg(F.count("*").alias("m")), "list")
             .select("list", F.ceil(F.col("n") / PART_ROWS).cast("int").alias("parts"),
                     F.ceil(F.col("m") / QUERY_PART).cast("int").alias("qparts")))
    sizes = F.broadcast(sizes)  # one row per list: about LISTS * sqrt(n), as the centroids
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    left = posted.join(sizes, "list").select(
        "list", F.explode(F.transform(F.sequence(F.lit(0), F.col("qparts") - 1),
                                      lambda p: (deal("parts") * F.col("qparts") + p).cast("long"))).alias("unit"),
        F.lit(0).alias("role"), "id", "vec")
    right = asked.join(sizes, "list").select(
        "list", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                                      lambda p: (p * F.col("qparts") + deal("qparts")).cast("long"))).alias("unit"),
        F.lit(1).alias("role"), "id", "vec")
    search, merge = _best(k)
    found = (left.union(right).repartition("list", "unit").sortWithinPartitions("list", "unit", "role")
             .transform(in_arrow, search, "query_id long, ids array<long>, scores array<double>"))
    return found.repartition("query_id").sortWithinPartitions("query_id").transform(in_arrow, merge, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)
