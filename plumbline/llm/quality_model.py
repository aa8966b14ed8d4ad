"""Quality classifier: gated attention over passages (multiple instances).

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded
from hashed byte trigrams and a few shares of its characters and repeats, by one learned
hidden layer: ``h = tanh(x W + c)``.  Gated attention gives each passage a
weight, the softmax over the document of ``w . (tanh(h V) * sigmoid(h U))``;
the document's representation is the weighted sum of its ``h``, and the score
the logistic function of a linear form of it.  Only document labels are known;
which passages matter is learned through the attention.

Learning reads only text and label, from rows whose id remainder (crc32 modulo
5) is not 0 and that have a label: about ``SAMPLE_ROWS`` documents per label,
chosen by a hash of the id (documented bound of a labelled sample).  Passage
features are computed by Spark; the gradient steps run on the driver over
``SAMPLE_ROWS`` bags of at most ``TRAIN_PASSAGES`` evenly spread passages each.
Scoring reads every passage of every whole text.

Defined cases: a null, empty or blank text is one passage without features and
gets the model's score for that; without labels of both kinds the score is the
share of label 1 (0.5 without any label); repeated rows are scored alike; a
null id is not held out and never learned from; extra columns are ignored
(``predict``) or kept (``keep_good``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import fields, fresh, in_arrow, own_columns, remainder, slices, table

PASSAGE = 64
HASHED = 256
EXTRA = 10
FEATURES = HASHED + EXTRA
HIDDEN, GATE = 24, 12
SAMPLE_ROWS = 1500
TRAIN_PASSAGES = 24
EPOCHS, BATCH, RATE, DECAY = 40, 64, 0.01, 1e-4
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

_KIND = np.zeros(256, np.uint8)          # 1 upper, 2 digit, 3 symbol, 4 other punctuation, 5 non-ASCII
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[ord(c) for c in "#*$%&|<>"]] = 3
_KIND[[ord(c) for c in "!\"'()+,-./:;=?@[\\]^_`{}~"]] = 4
_KIND[128:] = 5
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_WEIGHT = np.random.default_rng(23).integers(1, 1 << 32, 64, dtype=np.uint64).astype(np.uint32)


def features(text: str | None) -> np.ndarray:
    """(passages, FEATURES) of a whole text."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    blank = _BLANK[raw]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1]))) if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros((1, FEATURES), np.float32)
    cuts = starts[::PASSAGE]
    n = len(cuts)
    word_of = np.zeros(len(raw), np.int32)
    word_of[cuts[1:]] = 1
    of = np.cumsum(word_of, dtype=np.int32)
    size = np.bincount(of, minlength=n).astype(np.float32)
    code = raw.astype(np.uint32)
    tri = np.zeros(len(raw), np.uint32)
    tri[:] = code * np.uint32(0x9E3779B1)
    tri[:-1] += code[1:] * np.uint32(0x85EBCA77)
    tri[:-2] += code[2:] * np.uint32(0xC2B2AE3D)
    tri ^= tri >> np.uint32(15)
    tri *= np.uint32(0x2C1B3C6D)
    bucket = (tri >> np.uint32(24)).astype(np.int32)
    out = np.zeros((n, FEATURES), np.float32)
    out[:, :HASHED] = np.bincount(of * HASHED + bucket, minlength=n * HASHED).reshape(n, HASHED)
    out[:, :HASHED] = np.sqrt(out[:, :HASHED] / size[:, None])
    kinds = np.bincount(of * 6 + _KIND[raw], minlength=n * 6).reshape(n, 6)
    out[:, HASHED:HASHED + 5] = kinds[:, 1:] / size[:, None]
    words = np.diff(np.append(np.arange(0, len(starts), PASSAGE), len(starts)))
    out[:, HASHED + 5] = words / PASSAGE
    out[:, HASHED + 6] = words * 6.0 / size
    out[:, HASHED + 7] = min(1.0, len(starts) / 400)
    # words that repeat the word before them, or any earlier word of the passage
    spans = np.diff(np.concatenate(([0], starts[1:], [len(raw)])))
    place = np.arange(len(raw)) - np.repeat(starts, spans)
    name = np.add.reduceat(np.where(blank, np.uint32(0), code * _WEIGHT[place & 63]), starts, dtype=np.uint32)
    bag = np.arange(len(starts)) // PASSAGE
    same = np.append(False, (name[1:] == name[:-1]) & (bag[1:] == bag[:-1]))
    out[:, HASHED + 8] = np.bincount(bag, same, n) / words
    distinct = np.unique(bag.astype(np.uint64) << np.uint64(32) | name)
    out[:, HASHED + 9] = 1 - np.bincount((distinct >> np.uint64(32)).astype(np.int64), minlength=n) / words
    return out


class Attention:
    """The network; ``p`` holds its arrays."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def fresh(cls, seed: int = 7) -> Attention:
        r = np.random.default_rng(seed)
        n = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        return cls({"W": n(FEATURES, HIDDEN), "c": np.zeros(HIDDEN), "V": n(HIDDEN, GATE), "U": n(HIDDEN, GATE),
                    "w": n(GATE), "o": n(HIDDEN), "b": np.zeros(1)})

    def forward(self, x: np.ndarray, cuts: np.ndarray) -> tuple:
        """Scores (before the logistic function) of the bags that start at ``cuts``."""
        p = self.p
        h = np.tanh(x @ p["W"] + p["c"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        a = (t * s) @ p["w"]
        of = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(x))))
        e = np.exp(a - np.maximum.reduceat(a, cuts)[of])
        e /= np.add.reduceat(e, cuts)[of]
        z = np.add.reduceat(e[:, None] * h, cuts, axis=0)
        return z @ p["o"] + p["b"][0], h, t, s, e, of, z

    def gradient(self, x: np.ndarray, cuts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        logit, h, t, s, e, of, z = self.forward(x, cuts)
        d = (1 / (1 + np.exp(-logit)) - y) / len(y)
        dz = d[:, None] * p["o"]
        dh = e[:, None] * dz[of]
        de = (h * dz[of]).sum(axis=1)
        da = e * (de - np.add.reduceat(e * de, cuts)[of])
        dts = da[:, None] * p["w"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        dh += dt @ p["V"].T + ds @ p["U"].T
        dw = dh * (1 - h * h)
        return {"W": x.T @ dw, "c": dw.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ da, "o": z.T @ d,
                "b": np.array([d.sum()])}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        if not bags:
            return np.zeros(0)
        sizes = np.array([len(b) for b in bags])
        logit = self.forward(np.concatenate(bags).astype(np.float64), np.cumsum(sizes) - sizes)[0]
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


class Constant:
    """The model of a table without labels of both kinds."""

    def __init__(self, value: float):
        self.value = value

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        return np.full(len(bags), self.value)


def train(bags: list[np.ndarray], y: np.ndarray) -> Attention:
    """Adam over shuffled batches of bags, both labels weighted by the sample."""
    model = Attention.fresh()
    r = np.random.default_rng(13)
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(x) for k, x in model.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = r.permutation(len(bags))
        rate = RATE * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            sizes = np.array([len(bags[i]) for i in part])
            g = model.gradient(np.concatenate([bags[i] for i in part]).astype(np.float64), np.cumsum(sizes) - sizes, y[part])
            step += 1
            for k, x in model.p.items():
                grad = g[k] + (DECAY * x if x.ndim == 2 else 0)
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                model.p[k] = x - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            out = []
            for text in part.column(0).to_pylist():
                x = features(text)
                if len(x) > TRAIN_PASSAGES:
                    x = x[np.linspace(0, len(x) - 1, TRAIN_PASSAGES).astype(int)]
                out.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(out, pa.binary())],
                                             names=["doc_id", "label", "bag"])


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Attention | Constant:
    marked = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & (remainder("doc_id", FOLDS) != HELD_OUT))
              .groupBy("doc_id").agg(F.min("label").alias("label")))
    share = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        return Constant(float(next(iter(share), 0.5)))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    limit = F.when(F.col("label") == 1, min(1.0, rows / share[1])).otherwise(min(1.0, rows / share[0]))
    chosen = marked.filter(draw < limit)
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    # the sample's ids: about 2 * ``rows`` of them, whatever the size of the tables
    got = (text.join(F.broadcast(chosen), "doc_id").select("text", "doc_id", "label")
           .transform(in_arrow, _bags, "doc_id long, label int, bag binary").toArrow().to_pydict())
    order = sorted(range(len(got["doc_id"])), key=lambda i: (got["doc_id"][i], got["bag"][i]))
    bags = [np.frombuffer(got["bag"][i], np.float32).reshape(-1, FEATURES) for i in order]
    y = np.array([got["label"][i] for i in order], np.float64)
    if len(set(y.tolist())) < 2:
        return Constant(float(y[0]) if len(y) else 0.5)
    return train(bags, y)


def annotate(docs: DataFrame, model: Attention | Constant) -> DataFrame:
    """``docs`` with the score of every whole text appended."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = list(docs.columns).index("text")
    name = fresh(docs, "_quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = held.value.score([features(t) for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score, pa.float64())],
                                                 names=[*part.schema.names, name])

    return docs.transform(in_arrow, run, f"{fields(docs)}, {name} double")


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``."""
    model = learn(docs, labels)
    out = annotate(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), model)
    return out.select("doc_id", F.coalesce(remainder("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      F.col("_quality").alias("score"), (F.col("_quality") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """Rows of ``docs`` (its columns) that are predicted to be of label 1."""
    model = learn(docs if fit_on is None else fit_on, labels)
    out = annotate(docs, model)
    return out.filter(F.col(out.columns[-1]) >= THRESHOLD).select(*own_columns(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
