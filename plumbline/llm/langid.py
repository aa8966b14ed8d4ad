"""Language identification by prediction by partial matching (PPM).

For every learned language a variable-order byte context tree (contexts of 0 to
``ORDER`` bytes) is counted from a sample of labelled documents and frozen.  A
byte is coded in the longest known context; where the context has never seen
it, the escape probability is paid and the next shorter context is asked, down
to the uniform code of 256 bytes (escape method C: a context with ``t`` visits
and ``d`` distinct bytes gives a seen byte ``n / (t + d)`` and an escape
``d / (t + d)``).  The code length of a text is the exact sum over all its
bytes, and the language with the shortest code wins.

Because the statistics are frozen, the code length of a byte depends only on
the ``ORDER`` bytes before it, so the trees are laid out as lookup tables and a
whole batch of texts is coded with array operations.  All 256 byte values keep
their own place: orders 0 and 1 are dense, orders 2 and 3 hold only the contexts
and bytes that some language has seen.

Learning uses only ``text`` and ``lang`` of rows with a non-null language whose
id remainder (crc32 modulo 4) is not 2: about ``SAMPLE_ROWS`` rows per language,
chosen by a hash of the id (documented bound of a labelled sample), each as a
whole text.  Counting is a Spark aggregate.  Prediction reads whole texts.

Defined cases: a null text, an empty text or one without a letter is ``und``
with score 0; a null id is never held out and never learned from; repeated rows
are scored alike, each on its own; ties go to the alphabetically first
language; without any labelled row all documents are ``und``.  Extra columns
are ignored (``predict``) or kept (``annotate``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import fields, fresh, in_arrow, own_columns, remainder, slices, table

ORDER = 3
SAMPLE_ROWS = 1500
FOLDS, HELD_OUT = 4, 2
REJECT_BITS = 8.0       # a text no model codes below 8 bits a byte is no known language
PAD = b"\n" * ORDER

_ascii_letter = re.compile(r"[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_ascii_letter.search(text)) or any(map(str.isalpha, text)))


# ---------------------------------------------------------------- counting

def _windows(data: np.ndarray) -> np.ndarray:
    """Packed (ORDER + 1)-byte windows of a padded byte array."""
    w = data[:-ORDER].astype(np.uint32)
    for k in range(1, ORDER + 1):
        w = (w << np.uint32(8)) | data[k:len(data) - ORDER + k]
    return w


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            by: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                raw = np.frombuffer(PAD + text.encode("utf-8", "replace"), np.uint8)
                if len(raw) > ORDER:
                    by.setdefault(lang, []).append(_windows(raw))
            for lang, parts in by.items():
                grams, n = np.unique(np.concatenate(parts), return_counts=True)
                if lang in held:
                    grams, at = np.unique(np.concatenate([held[lang][0], grams]), return_inverse=True)
                    n = np.bincount(at, weights=np.concatenate([held[lang][1], n])).astype(np.int64)
                held[lang] = grams, n
    for lang, (grams, n) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(grams)), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
            names=["lang", "gram", "n"])


def sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, lang) of about ``rows`` learnable documents per language."""
    learn = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                        docs["lang"].cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder("doc_id", FOLDS) != HELD_OUT))
    per = learn.groupBy("lang").count().collect()  # one row per language, as the model has one table each
    if not per:
        return learn.select("text", "lang")
    n = F.create_map(*[x for r in per for x in (F.lit(r["lang"]), F.lit(r["count"]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return learn.filter(draw * n[F.col("lang")] < rows).select("text", "lang")


# ------------------------------------------------------------------- model

class Seen:
    """Numbers from 1 on for the (node, byte) pairs of a sorted list, 0 for all
    others: a bit for every byte of a node and the count of pairs before it."""

    def __init__(self, pairs: np.ndarray, nodes: int):
        word, bit = pairs >> 6, np.uint64(1) << (pairs & 63).astype(np.uint64)
        self.bits = np.zeros(nodes * 4, np.uint64)
        np.bitwise_or.at(self.bits, word, bit)
        n = np.bincount(word, minlength=nodes * 4)
        self.before = (np.cumsum(n) - n).astype(np.int32)

    def number(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        word = node * 4 + (byte >> 6)
        at = np.uint64(1) << (byte & 63).astype(np.uint64)
        held = self.bits[word]
        rank = self.before[word] + np.bitwise_count(held & (at - np.uint64(1))) + 1
        return np.where(held & at, rank, 0).astype(np.int64)


class Model:
    """Frozen code lengths of every language, as lookup tables.  Strings of two
    and three bytes that any language has seen are numbered from 1 on."""

    def __init__(self, langs: list[str], grams: list[np.ndarray], counts: list[np.ndarray]):
        self.langs = langs
        if not langs:
            return
        nl = len(langs)
        cls = [[(g >> s) & 0xFF for s in (24, 16, 8, 0)] for g in grams]
        # orders 0 and 1, dense: code length of a byte after every byte
        t1 = np.empty((1 << 16, nl))
        for k, (c, n) in enumerate(zip(cls, counts, strict=True)):
            t0 = _code(np.bincount(c[3], n, 256).reshape(1, 256), np.full((1, 256), 8.0))   # uniform over 256 bytes
            n1 = np.bincount(c[2] * 256 + c[3], n, 1 << 16).reshape(256, 256)
            t1[:, k] = _code(n1, np.broadcast_to(t0, (256, 256))).ravel()
        # numbers of the seen strings of two, three and four bytes
        g = np.unique(np.concatenate(grams))
        triples = np.unique(np.concatenate([g >> 8, g & 0xFFFFFF]))
        pairs = np.unique(np.concatenate([triples >> 8, triples & 0xFFFF]))
        self.two = np.zeros(1 << 16, np.int64)
        self.two[pairs] = np.arange(1, len(pairs) + 1)
        three = self.two[triples >> 8] * 256 + (triples & 0xFF)        # sorted like the triples
        self.three = Seen(three, len(pairs) + 1)
        numbers = lambda x: self.three.number(self.two[x >> 8], x & 0xFF)
        four = numbers(g >> 8) * 256 + (g & 0xFF)
        self.four = Seen(four, len(triples) + 1)
        # orders 2 and 3, sparse
        self.t1 = t1.astype(np.float32)
        self.escape2 = np.zeros((len(pairs) + 1, nl), np.float32)
        self.t2 = np.zeros((len(triples) + 1, nl), np.float32)
        self.escape3 = np.zeros((len(triples) + 1, nl), np.float32)
        self.t3 = np.zeros((len(g) + 1, nl), np.float32)
        end = numbers(g & 0xFFFFFF)
        for k, (x, n) in enumerate(zip(grams, counts, strict=True)):
            got = np.bincount(numbers(x & 0xFFFFFF), n, len(triples) + 1)[1:]
            t2, self.escape2[:, k] = _sparse(got, three >> 8, len(pairs) + 1, t1[triples & 0xFFFF, k])
            self.t2[1:, k] = t2
            got = np.bincount(np.searchsorted(g, x), n, len(g))
            self.t3[1:, k], self.escape3[:, k] = _sparse(got, four >> 8, len(triples) + 1, t2[end - 1])

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) code lengths in bits."""
        data = np.frombuffer(PAD + PAD.join(texts) + PAD, np.uint8).astype(np.int64)
        size = np.array([len(t) for t in texts], np.int64)
        start = np.cumsum(size + ORDER) - size - ORDER     # in positions of coded bytes
        pair = data[:-1] * 256 + data[1:]
        two = self.two[pair]
        three = self.three.number(two[:-1], data[2:])      # the string of three bytes from every place on
        four = self.four.number(three[:-1], data[3:])
        cost = self.t3[four]
        miss = np.flatnonzero(four == 0)                   # coded by a shorter context
        cost[miss] = self.escape3[three[miss]] + self.t2[three[miss + 1]]
        miss = miss[three[miss + 1] == 0]
        cost[miss] += self.escape2[two[miss + 1]] + self.t1[pair[miss + 2]]
        cuts = np.empty(2 * len(texts), np.int64)
        cuts[0::2], cuts[1::2] = start, start + size
        total = np.add.reduceat(cost, np.minimum(cuts, len(cost) - 1), axis=0, dtype=np.float64)[0::2]
        total[size == 0] = 0.0
        return total

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, bits a byte) of every text.  The score is the winner's
        share of the languages' mean likelihoods of a byte."""
        raw = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        if not self.langs:
            return [("und", 0.0, 0.0)] * len(texts)
        rate = self.bits(raw) / np.maximum([len(r) for r in raw], 1)[:, None]
        best = np.argmin(rate, axis=1)
        low = rate[np.arange(len(raw)), best]
        share = 1.0 / np.exp2(low[:, None] - rate).sum(axis=1)
        return [(self.langs[b], float(s), float(r)) if has_letter(t) else ("und", 0.0, 0.0)
                for t, b, s, r in zip(texts, best.tolist(), share.tolist(), low.tolist(), strict=True)]


def _code(n: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Code lengths of every byte after every context (rows) from its counts and
    the code lengths ``shorter`` of the next shorter context."""
    kinds = (n > 0).sum(axis=1, keepdims=True)
    base = np.log2(np.maximum(n.sum(axis=1, keepdims=True) + kinds, 1))
    esc = np.where(kinds > 0, base - np.log2(np.maximum(kinds, 1)), 0.0)
    return np.where(n > 0, base - np.log2(np.maximum(n, 1)), esc + shorter)


def _sparse(n: np.ndarray, of: np.ndarray, nodes: int, shorter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like ``_code`` for the listed bytes only, each with its context ``of``; and
    the escape cost of every context (0 where it was never seen)."""
    kinds = np.bincount(of[n > 0], minlength=nodes)
    base = np.log2(np.maximum(np.bincount(of, n, nodes) + kinds, 1))
    esc = np.where(kinds > 0, base - np.log2(np.maximum(kinds, 1)), 0.0)
    return np.where(n > 0, base[of] - np.log2(np.maximum(n, 1)), esc[of] + shorter), esc


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Count the sample with Spark and freeze the tables (their size is bounded
    by the sample)."""
    counts = (sample(docs, rows).transform(in_arrow, _count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())
    lang = np.array(counts.column("lang").to_pylist(), dtype=object)
    gram, n = counts.column("gram").to_numpy(), counts.column("n").to_numpy()
    langs = sorted(set(lang.tolist()))
    order = np.argsort(gram, kind="stable")
    lang, gram, n = lang[order], gram[order], n[order]
    return Model(langs, [gram[lang == x] for x in langs], [n[lang == x] for x in langs])


# -------------------------------------------------------------- prediction

def annotate(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with three columns appended (language, score, bits a byte), in one
    narrow pass; the caller knows them by their place."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = list(docs.columns).index("text")
    more = [fresh(docs, c) for c in ("_lang", "_score", "_bits")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                got = held.value.judge(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64())],
                    names=[*part.schema.names, *more])

    return docs.transform(in_arrow, run, f"{fields(docs)}, {more[0]} string, {more[1]} double, {more[2]} double")


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) of every row."""
    out = annotate(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")),
                   learn(docs))
    return out.select("doc_id", F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"),
                      F.col("_bits").alias("bits_per_byte"))


def keep_known(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (its columns) in a known language: not ``und`` and coded
    by the best model below ``REJECT_BITS`` bits a byte."""
    out = annotate(docs, learn(docs))
    lang, _, bits = out.columns[-3:]
    return out.filter((F.col(lang) != "und") & (F.col(bits) < REJECT_BITS)).select(*own_columns(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
