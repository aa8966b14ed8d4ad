"""Quality rules: base counts and a hashed n-gram likelihood ratio.

Two multinomials over hashed byte n-grams (``GRAM`` bytes, ``BUCKETS``
buckets) are counted: the raw corpus (every n-gram of all documents) and the
trusted target (every n-gram of the documents that ``trusted`` names).  Nothing
is sampled.  The raw corpus is counted where it is read; for the target the
texts meet the trusted ids in one shuffle, the same join at every size, and
null ids, which no label can name, do not travel.  With add-``ALPHA`` smoothing each bucket gets ``log p_target - log p_raw``; a document's score is
the mean of that over its n-grams (length-normalised), and it is kept when the
score reaches ``THRESHOLD`` and no base rule fails.  Every document is judged by
the same threshold.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  Base rules: ``n_words < 50`` or more
than half of the words inside three-word windows that occur at least twice.

Defined cases: a null or empty text has zero counts, score 0 and fails the base
rule; a document without labels is raw only; a repeated row counts again in the
raw corpus and is judged alike; without trusted documents the ratio is 0
everywhere and only the base rules decide.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import in_arrow, mix, slices, table, text_frame

GRAM = 4
BUCKETS = 1 << 16
ALPHA = 1.0
THRESHOLD = -0.4
MIN_WORDS = 50
REPEAT_PERCENT = 50

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every byte n-gram of ``text``."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8) if text else np.zeros(0, np.uint8)
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    code = np.zeros(n, np.uint64)
    for k in range(GRAM):
        code = (code << np.uint64(8)) | raw[k:n + k]
    return (mix(code) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8", "replace").split()
    n = len(words)
    if not n:
        return 0, 0, 0, 0, 0
    chars = len(text) - sum(map(text.count, BLANKS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeat = 0
    if n >= 4:
        h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
        tri = mix(mix(mix(h[:-2]) ^ h[1:-1]) ^ h[2:])
        _, at, times = np.unique(tri, return_inverse=True, return_counts=True)
        twice = times[at] >= 2
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        repeat = int(covered.sum())
    return n, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            n += np.bincount(np.concatenate([buckets(text) for text in part.column(0).to_pylist()]), minlength=BUCKETS)
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, n_raw, n_target) over all texts; ``trusted`` holds doc_id."""
    ids = trusted.select(F.col("doc_id").cast("long")).filter("doc_id is not null").distinct()
    good = text_frame(docs).join(ids.hint("shuffle_hash"), "doc_id", "left_semi")
    counts = lambda df: df.select("text").transform(in_arrow, _count, "bucket long, n long")
    none = F.lit(0).cast("long")
    both = (counts(text_frame(docs)).select("bucket", F.col("n").alias("n_raw"), none.alias("n_target"))
            .union(counts(good).select("bucket", none, "n")))
    return both.groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))


def log_ratio(counts: DataFrame) -> np.ndarray:
    """Smoothed log p_target - log p_raw of every bucket (``BUCKETS`` numbers)."""
    got = counts.toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = got.column("bucket").to_numpy()
    raw[at], target[at] = got.column("n_raw").to_numpy(), got.column("n_target").to_numpy()
    if not target.sum():
        return np.zeros(BUCKETS)
    p = lambda n: np.log((n + ALPHA) / (n.sum() + ALPHA * BUCKETS))
    return p(target) - p(raw)


def judge(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = held.value
        for batch in batches:
            for part in slices(batch, "text"):
                counts, score = [], []
                for text in part.column(1).to_pylist():
                    counts.append(base_counts(text))
                    b = buckets(text)
                    score.append(float(weight[b].sum() / len(b)) if len(b) else 0.0)
                cols = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
                failed = [c[0] < MIN_WORDS or 100 * c[4] > REPEAT_PERCENT * c[0] for c in counts]
                kept = [not f and s >= THRESHOLD for f, s in zip(failed, score, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *cols, pa.array(failed), pa.array(kept), pa.array(score)],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           "base_failed", "kept", "llr"])

    return text_frame(docs).transform(in_arrow, 
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, base_failed boolean, kept boolean, llr double")


def quality_rules(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Base counts, verdict and ratio of every row of ``docs``."""
    return judge(docs, log_ratio(bucket_counts(docs, trusted)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality_rules(table(spark, sf_dir, "documents"), labels.filter("quality = 1").select("doc_id"))
