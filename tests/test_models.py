"""Models against plain versions and by properties (SURVEY §5 (c), (d))."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import blend as B
from plumbline.operators import labels as L
from plumbline.operators import split as S
from plumbline.operators import text as X
from plumbline.plans.q_entity import entity_table
from plumbline.plans.standins import table
from tests.conftest import SF001


def test_language_classifier_beats_majority(spark):
    docs = table(spark, SF001, "documents").select("doc_id", "text", F.col("lang").alias("label"),
                                                   "source")
    d = S.stratified_split(docs, "label", "doc_id", 0.2, 42)
    m = L.fit_label_classifier(d.where("split = 'train'"), "doc_id", "text", "label")
    test = d.where("split = 'test'")
    pred = L.predict_top3(m, test, "doc_id", "text").join(
        test.select("doc_id", F.col("label").alias("actual")), "doc_id")
    acc = pred.agg(F.avg((F.col("actual") == F.col("predicted")).cast("double"))).first()[0]
    major = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > major
    probs = pred.select(F.aggregate("top_probs", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert probs.agg(F.max("s")).first()[0] <= 1.0 + 1e-9


def test_blend_scores_in_range(spark):
    ent = entity_table(spark, SF001)
    model = B.fit_blend(ent, max_depth=3)
    pt = B.prediction_table(model, ent)
    s = pt.agg(F.min("safety_score"), F.max("safety_score"),
               F.max(F.abs(F.col("P_A") + F.col("P_B") + F.col("P_C") - 1))).first()
    assert 1.0 <= s[0] <= s[1] <= 3.0 and s[2] < 2e-4
    sc = B.safety_scores(model, ent)
    assert sc.count() == ent.count()


def _plain_regression(x, y, k, steps, C=1.0):
    """The same steps in floats: (features + intercept, labels) weights."""
    n = len(y)
    s = n / (k * np.bincount(y, minlength=k))[y]
    x = np.hstack([x, np.ones((n, 1))])
    w = ahead = np.zeros((x.shape[1], k))
    reg = np.ones((x.shape[1], 1))
    reg[-1] = 0
    for t in range(1, steps + 1):
        p = _softmax(x @ ahead)
        g = x.T @ (s[:, None] * (p - np.eye(k)[y])) / n + reg * ahead / (C * n)
        new = ahead - g / (1 + 1 / (C * n))
        w, ahead = new, new + (t - 1) / (t + 2) * (new - w)
    return w


def _softmax(z):
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_label_steps_equal_plain_steps(spark, monkeypatch):
    """More labels than a block, grams cut into parts, null and unseen texts."""
    monkeypatch.setattr(L, "PART_DOCS", 7)
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "haven", "inlet", "jetty",
             "knoll", "ledge", "marsh", "north", "oasis", "plaza", "quarry", "ridge", "shore", "trail"]
    rows = [(i, f"the {words[i % 20]} {words[(i * 7) % 20]} house", f"l{i % 20:02d}") for i in range(80)]
    train = spark.createDataFrame([*rows, (900, "no label", None), (901, None, "l00"), (902, "", "l01")], "id int, text string, y string")
    m = L.fit_label_classifier(train, "id", "text", "y", steps=12)
    assert m["vocab"].agg(F.max("parts")).first()[0] > 1
    asked = spark.createDataFrame([*[r[:2] for r in rows], (901, None), (902, ""), (950, "0000 9999")], "id int, text string")
    got = {r["id"]: r for r in L.predict_top3(m, asked, "id", "text").collect()}
    assert len(got) == len(rows) + 3

    vec = X.tfidf_transform(asked, "id", "text", m["model"]).toPandas()
    place = {g: i for i, g in enumerate(sorted(vec["gram"].unique()))}
    at = {i: j for j, i in enumerate([*[r[0] for r in rows], 901, 902, 950])}
    x = np.zeros((len(at), len(place)))
    for r in vec.itertuples():
        x[at[r.doc], place[r.gram]] = r.w
    y = np.array([*[i % 20 for i in range(80)], 0, 1])
    p = _softmax(np.hstack([x, np.ones((len(x), 1))]) @ _plain_regression(x[:82], y, 20, 12))
    for i, j in at.items():
        best = np.argsort(-p[j], kind="stable")[:3]
        assert np.allclose(got[i]["top_probs"], p[j][best], atol=1e-4)
    for i in (901, 902, 950):  # the intercept alone
        assert got[i]["top_probs"] == got[901]["top_probs"]


def test_label_step_rows_are_a_tiles_grams(spark, monkeypatch):
    """A step's rows are the grams of each tile, fewer than the entries; tiles, blocks
    of labels and a repeated id change no sum."""
    rows = [(i % 90, f"house {i % 7} road {i % 3}", f"l{i % 20:02d}") for i in range(91)]
    train = spark.createDataFrame(rows, "id int, text string, y string")
    one = {(r.gram, r.block): r.w for r in _weights(L.fit_label_classifier(train, "id", "text", "y", steps=2))}
    monkeypatch.setattr(L, "TILE_LEAST", 100)
    monkeypatch.setattr(L, "TILE_MOST", 300)
    seen = []

    def watched(packed, held, weights, k, steps=L.tile_gradients):
        seen.append((packed.count(), held.count(), held.distinct().count()))
        return steps(packed, held, weights, k)

    monkeypatch.setattr(L, "tile_gradients", watched)
    many = {(r.gram, r.block): r.w for r in _weights(L.fit_label_classifier(train, "id", "text", "y", steps=2))}
    assert many == one and {b for _g, b in one} == {0, 1}
    entries = X.doc_grams(train, "id", "text").count()
    assert len(seen) == 2
    for tiles, held, distinct in seen:
        assert 5 < tiles <= 90 and held == distinct < entries


def _weights(m):
    return m["weights"].join(m["vocab"].select("idx", "gram"), "idx").collect()


def test_tile_count_keeps_the_bounds():
    assert L.tile_count(1000, 10, 50, 4) == 1
    assert L.tile_count(1 << 40, 1 << 28, 1 << 20, 4) == (1 << 40) // L.TILE_MOST
    assert L.tile_count(1 << 30, 1 << 20, 1 << 24, 64) == (1 << 30) // (L.TILE_WEIGHTS // 64)
    assert L.tile_count(1 << 20, 1 << 20, 100, 1 << 10) == (1 << 30) // L.TILE_SCORES


def test_label_steps_near_the_optimum():
    """30 steps against 3,000: the labels agree."""
    r = np.random.default_rng(5)
    y = r.integers(0, 4, 300)
    x = r.normal(size=(300, 40)) * 0.5 + np.eye(4, 40)[y] * 2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near, far = (np.hstack([x, np.ones((300, 1))]) @ _plain_regression(x, y, 4, n) for n in (L.STEPS, 3000))
    assert (near.argmax(1) == far.argmax(1)).mean() >= 0.97


def test_label_fit_needs_rows(spark):
    with pytest.raises(ValueError, match="No labelled rows"):
        L.fit_label_classifier(spark.createDataFrame([(1, "a", None)], "id int, t string, y string"), "id", "t", "y")
