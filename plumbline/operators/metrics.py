"""Classification metrics and reports.

Every metric starts from one aggregate, ``groupBy(actual, predicted).count``,
whose size is bounded by (number of classes)^2; everything after that runs
on that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pair_counts(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    return pred.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")) \
               .agg(F.count(F.lit(1)).alias("n"))


def _labels_frame(spark, labels, name="label") -> DataFrame:
    return spark.createDataFrame([(i, c) for i, c in enumerate(labels)], f"ord int, {name} string")


def confusion_matrix(pred: DataFrame, actual: str, predicted: str, labels,
                     normalise: bool = False) -> DataFrame:
    """A19 + J13: dense (actual, predicted) grid in the given label order,
    zero where absent; ``normalise`` divides by the row sum (+1e-9)."""
    spark = pred.sparkSession
    la = _labels_frame(spark, labels, "actual").withColumnRenamed("ord", "i")
    # the grid is labels x labels (a fixed, small literal), built by an
    # explode of the label array instead of a join
    grid = la.select("i", "actual", F.explode(F.array(*[
        F.struct(F.lit(j).alias("j"), F.lit(c).alias("predicted")) for j, c in enumerate(labels)
    ])).alias("p")).select("i", "actual", "p.j", "p.predicted")
    out = grid.join(pair_counts(pred, actual, predicted), ["actual", "predicted"], "left") \
              .select("i", "j", "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))
    if normalise:
        rs = F.sum("n").over(Window.partitionBy("actual"))
        out = out.withColumn("rate", F.col("n") / (rs + F.lit(1e-9)))
    return out


def label_set(pred: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Sorted distinct labels of both columns."""
    return (pred.select(F.col(actual).alias("label"))
            .union(pred.select(F.col(predicted).alias("label")))
            .where(F.col("label").isNotNull()).distinct())


def class_metrics(pred: DataFrame, actual: str, predicted: str, labels=None) -> DataFrame:
    """Per class tp, fp, fn, support, precision/recall/F1 (4 dp,
    zero-division -> 0).  ``labels=None`` uses the union of both columns."""
    c = pair_counts(pred, actual, predicted)
    same = F.col("actual") == F.col("predicted")
    contrib = c.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"),
                 F.when(same, F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("long").alias("fp"),
                 F.when(same, 0).otherwise(F.col("n")).alias("fn"),
                 F.col("n").alias("support")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("tp"),
                 F.when(same, 0).otherwise(F.col("n")).alias("fp"),
                 F.lit(0).cast("long").alias("fn"), F.lit(0).cast("long").alias("support")),
    )).alias("x")).select("x.*")
    per = contrib.groupBy("label").agg(*[F.sum(k).alias(k) for k in ("tp", "fp", "fn", "support")])
    if labels is not None:
        per = _labels_frame(pred.sparkSession, labels).join(per, "label", "left").select(
            "label", *[F.coalesce(k, F.lit(0)).cast("long").alias(k)
                       for k in ("tp", "fp", "fn", "support")])
    else:
        per = per.where(F.col("label").isNotNull())
    p = F.when(F.col("tp") + F.col("fp") > 0,
               F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    r = F.when(F.col("tp") + F.col("fn") > 0,
               F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    out = per.select("label", "tp", "fp", "fn", "support", p.alias("_p"), r.alias("_r"))
    f1 = F.when(F.col("_p") + F.col("_r") > 0,
                F.lit(2.0) * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r"))) \
          .otherwise(F.lit(0.0))
    return out.select("label", F.round("_p", 4).alias("precision"), F.round("_r", 4).alias("recall"),
                      F.round(f1, 4).alias("f1"), "tp", "fp", "fn", "support")


def macro_summary(pred: DataFrame, actual: str, predicted: str, labels=None) -> DataFrame:
    """Macro means of the *rounded* class values, accuracy (4 dp), n.

    Both halves come from the small pair-count table; the accuracy side is
    a scalar subquery.
    """
    per = class_metrics(pred, actual, predicted, labels)
    c = pair_counts(pred, actual, predicted)
    acc = c.agg(F.sum("n").alias("n"),
                F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
                .alias("_ok"))
    n = acc.select("n").scalar()
    ok = acc.select("_ok").scalar()
    mac = per.agg(F.round(F.avg("precision"), 4).alias("macro_precision"),
                  F.round(F.avg("recall"), 4).alias("macro_recall"),
                  F.round(F.avg("f1"), 4).alias("macro_f1"))
    return mac.select("macro_precision", "macro_recall", "macro_f1",
                      F.round(ok / n, 4).alias("accuracy"), n.alias("support"))


def report_rows(pred: DataFrame, actual: str, predicted: str, labels=None) -> DataFrame:
    """Class rows followed by a macro row (UNION ALL)."""
    per = class_metrics(pred, actual, predicted, labels).select(
        "label", "precision", "recall", "f1", "support")
    mac = macro_summary(pred, actual, predicted, labels).select(
        F.lit("macro").alias("label"), F.col("macro_precision").alias("precision"),
        F.col("macro_recall").alias("recall"), F.col("macro_f1").alias("f1"), "support")
    return per.unionByName(mac)


def compare_models(pred: DataFrame, actual: str, pred_a: str, pred_b: str, labels=None) -> DataFrame:
    """Per-class F1/recall of two models side by side + macro row."""
    a = report_rows(pred, actual, pred_a, labels).select(
        "label", F.col("f1").alias("f1_a"), F.col("recall").alias("recall_a"))
    b = report_rows(pred, actual, pred_b, labels).select(
        "label", F.col("f1").alias("f1_b"), F.col("recall").alias("recall_b"))
    return a.join(b, "label", "full")


def topk_hit_rate(pred: DataFrame, actual: str, topk: str) -> DataFrame:
    """Share of rows whose truth is among the k best labels."""
    return pred.agg(F.round(F.avg(F.when(F.array_contains(F.col(topk), F.col(actual)), 1.0)
                                  .otherwise(0.0)), 4).alias("topk_accuracy"),
                    F.count(F.lit(1)).alias("n"))


def agreement_rates(pred: DataFrame, blend: str, a: str, b: str) -> DataFrame:
    """Share of rows where blend = a, blend = b, and both."""
    eq_a = F.col(blend) == F.col(a)
    eq_b = F.col(blend) == F.col(b)
    rate = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 4)
    return pred.agg(rate(eq_a).alias("agree_a"), rate(eq_b).alias("agree_b"),
                    rate(eq_a & eq_b).alias("agree_both"), F.count(F.lit(1)).alias("n"))


def prediction_distribution(pred: DataFrame, cols) -> DataFrame:
    """Counts per (source column, label) via unpivot."""
    long = pred.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("source"), F.col(c).alias("label")) for c in cols])).alias("x"))
    return long.groupBy("x.source", "x.label").agg(F.count(F.lit(1)).alias("n"))


def evaluation_report(split_pred: DataFrame, actual: str, predicted: str, cutoff,
                      split_col: str = "split") -> DataFrame:
    """One row — train/test sizes, cutoff, test metrics."""
    sizes = split_pred.agg(F.count_if(F.col(split_col) == "train").alias("n_train"),
                           F.count_if(F.col(split_col) == "test").alias("n_test"))
    test = split_pred.where(F.col(split_col) == "test")
    m = macro_summary(test, actual, predicted)
    return m.select(sizes.select("n_train").scalar().alias("n_train"),
                    sizes.select("n_test").scalar().alias("n_test"), "*",
                    F.lit(cutoff).alias("cutoff"))
