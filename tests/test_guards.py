import pytest
from pyspark.sql import functions as F

from plumbline.operators import match as MT
from plumbline.operators import tree as T


def test_required_columns_and_features(spark):
    assert T.required_columns(["critical_rate", "score_range"]) == [
        "critical_violations", "total_violations", "min_score", "max_score"]
    df = spark.createDataFrame([(1.0, 2.0)], "min_score double, max_score double")
    with pytest.raises(ValueError):
        T.check_required(df, ["critical_rate"])
    out, feats = T.engineer_features(df, ["score_range", "critical_rate"])
    assert feats == ["score_range"]
    assert out.first()["score_range"] == 1.0
    with pytest.raises(ValueError):
        T.engineer_features(df, ["critical_rate"])


def test_finite_gate(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    out, _ = T.engineer_features(df.withColumnRenamed("x", "mean_score"), ["mean_score"])
    assert out.where(F.col("mean_score").isNull()).count() == 1
    with pytest.raises(ValueError):
        T.assert_finite(out, ["mean_score"])


def test_label_pairs_are_the_whole_product(spark, monkeypatch):
    req = spark.range(0, 7).withColumnRenamed("id", "req_id")
    labels = spark.range(0, 25).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("label"))
    want = sorted((i, f"L{j}") for i in range(7) for j in range(25))
    for buckets in (1, 4, 32):
        monkeypatch.setattr(MT, "LABEL_BUCKETS", buckets)
        got = MT.request_label_pairs(req, labels.unionByName(labels))
        assert sorted((r["req_id"], r["label"]) for r in got.collect()) == want


def test_checkpoint_folder_must_be_shared(spark, monkeypatch):
    from plumbline import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())


def test_title_case(spark):
    from plumbline.functions.columns import title_case
    words = ["staten-island", "o'neil AND sons", "1st AVENUE", "", None, "ÉCOLE élan", "not critical"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(title_case("w")).collect()]
    assert got == [None if w is None else w.title() for w in words]
