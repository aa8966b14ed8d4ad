"""Queries for splits and classification metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.operators import metrics as M
from plumbline.operators import split as S
from plumbline.operators.profile import complete_case, label_set_filter
from plumbline.plans.catalog import register
from plumbline.plans.q_entity import ENTITY_CTES, entity_table
from plumbline.plans.standins import table

E = ENTITY_CTES


def graded_complete(spark, sf_dir):
    """F1 + F2: letter-graded entities with all KNN features and a date."""
    ent = label_set_filter(entity_table(spark, sf_dir), "latest_grade")
    return ent.where(complete_case(K.KNN_FEATURES + ["latest_inspection_date"]))


_GRADED_SQL = """,
gc AS (SELECT * FROM ent WHERE latest_grade IN ('A','B','C') AND mean_score IS NOT NULL
       AND critical_violations IS NOT NULL AND total_violations IS NOT NULL
       AND days_since_last_inspection IS NOT NULL AND latest_inspection_date IS NOT NULL)"""


@register("temporal_split", E + _GRADED_SQL + """
SELECT camis, CASE WHEN rn <= floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
FROM (SELECT camis, row_number() OVER (ORDER BY latest_inspection_date, camis) AS rn,
             count(*) OVER () AS n FROM gc)""")
def temporal_split(spark, sf_dir):
    df, _info = S.temporal_split(graded_complete(spark, sf_dir), "latest_inspection_date",
                                 "camis", 0.2)
    return df.select("camis", "split")


_PART_STRAT_SQL = """
SELECT p_partkey, CASE WHEN rn <= round(CAST(0.2 AS DOUBLE) * nc) THEN 'test' ELSE 'train' END
       AS split
FROM (SELECT p_partkey, count(*) OVER (PARTITION BY p_type) AS nc,
             row_number() OVER (PARTITION BY p_type ORDER BY
               substr(md5('42:' || CAST(p_partkey AS VARCHAR)), 1, 15), p_partkey) AS rn
      FROM part) WHERE nc >= 2"""


@register("stratified_split", _PART_STRAT_SQL)
def stratified_split(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return S.stratified_split(part, "p_type", "p_partkey", 0.2, 42).select("p_partkey", "split")


@register("area_split", """
WITH d AS (SELECT p_partkey, p_type,
             CASE WHEN p_brand = 'Brand#1' THEN 'test' ELSE 'train' END AS split FROM part)
SELECT p_partkey, p_type, split FROM d WHERE p_type IN (
  SELECT p_type FROM d WHERE split = 'train' GROUP BY p_type HAVING count(*) >= 10)""")
def area_split(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return S.area_split(part, "p_brand", "p_type", " brand#1 ").select("p_partkey", "p_type", "split")


# --- metrics over rule-based predictions ----------------------------------------

def rule_predictions(spark, sf_dir):
    """Two threshold predictors of the grade (stand-ins for model output)."""
    ent = label_set_filter(entity_table(spark, sf_dir), "latest_grade")

    def rule(c):
        x = F.coalesce(F.col(c), F.lit(0.0))
        return F.when(x < 20, "A").when(x < 35, "B").otherwise("C")
    return ent.select("camis", F.col("latest_grade").alias("actual"),
                      rule("mean_score").alias("pred_a"), rule("latest_score").alias("pred_b"),
                      F.when(F.col("latest_inspection_date") < F.lit("1999-01-01").cast("date"),
                             "train").otherwise("test").alias("split"))


_PR = E + """,
pr AS (SELECT camis, latest_grade AS actual,
  CASE WHEN coalesce(mean_score, 0) < 20 THEN 'A' WHEN coalesce(mean_score, 0) < 35 THEN 'B'
       ELSE 'C' END AS pred_a,
  CASE WHEN coalesce(latest_score, 0) < 20 THEN 'A' WHEN coalesce(latest_score, 0) < 35 THEN 'B'
       ELSE 'C' END AS pred_b,
  CASE WHEN latest_inspection_date < DATE '1999-01-01' THEN 'train' ELSE 'test' END AS split
  FROM ent WHERE latest_grade IN ('A','B','C'))"""


def _cm_sql(pcol: str, labels_sql: str, src: str = "pr") -> str:
    return f"""
cm_{pcol} AS (
  SELECT l.label, tp, fp, fn, support,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE CAST(0 AS DOUBLE) END AS p,
    CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE CAST(0 AS DOUBLE) END AS r
  FROM ({labels_sql}) l, LATERAL (
    SELECT count(*) FILTER (WHERE actual = l.label AND {pcol} = l.label) AS tp,
           count(*) FILTER (WHERE actual <> l.label AND {pcol} = l.label) AS fp,
           count(*) FILTER (WHERE actual = l.label AND {pcol} <> l.label) AS fn,
           count(*) FILTER (WHERE actual = l.label) AS support FROM {src}) x),
m_{pcol} AS (
  SELECT label, round(p, 4) AS precision, round(r, 4) AS recall,
    round(CASE WHEN p + r > 0 THEN CAST(2.0 AS DOUBLE) * p * r / (p + r) ELSE 0 END, 4) AS f1,
    tp, fp, fn, support FROM cm_{pcol}),
mac_{pcol} AS (
  SELECT round(avg(precision), 4) AS macro_precision, round(avg(recall), 4) AS macro_recall,
         round(avg(f1), 4) AS macro_f1,
         (SELECT round(avg(CASE WHEN actual = {pcol} THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) FROM {src})
           AS accuracy,
         (SELECT count(*) FROM {src}) AS support FROM m_{pcol})"""


_UNION_LABELS = "SELECT actual AS label FROM pr UNION SELECT pred_a FROM pr"
_UNION_LABELS_B = "SELECT actual AS label FROM pr UNION SELECT pred_b FROM pr"
_ABC = "SELECT * FROM (VALUES ('A'), ('B'), ('C')) t(label)"


@register("class_metrics", _PR + "," + _cm_sql("pred_a", _UNION_LABELS) + "\nSELECT * FROM m_pred_a")
def class_metrics(spark, sf_dir):
    return M.class_metrics(rule_predictions(spark, sf_dir), "actual", "pred_a")


@register("class_metrics_fixed_labels", _PR + "," + _cm_sql("pred_b", _ABC)
          + "\nSELECT * FROM m_pred_b")
def class_metrics_fixed_labels(spark, sf_dir):
    return M.class_metrics(rule_predictions(spark, sf_dir), "actual", "pred_b", K.LETTER_GRADES)


@register("macro_summary", _PR + "," + _cm_sql("pred_a", _UNION_LABELS) + "\nSELECT * FROM mac_pred_a")
def macro_summary(spark, sf_dir):
    return M.macro_summary(rule_predictions(spark, sf_dir), "actual", "pred_a")


@register("report_rows", _PR + "," + _cm_sql("pred_a", _UNION_LABELS) + """
SELECT label, precision, recall, f1, support FROM m_pred_a
UNION ALL SELECT 'macro', macro_precision, macro_recall, macro_f1, support FROM mac_pred_a""")
def report_rows(spark, sf_dir):
    return M.report_rows(rule_predictions(spark, sf_dir), "actual", "pred_a")


@register("compare_models", _PR + "," + _cm_sql("pred_a", _UNION_LABELS) + ","
          + _cm_sql("pred_b", _UNION_LABELS_B) + """,
ra AS (SELECT label, f1, recall FROM m_pred_a
       UNION ALL SELECT 'macro', macro_f1, macro_recall FROM mac_pred_a),
rb AS (SELECT label, f1, recall FROM m_pred_b
       UNION ALL SELECT 'macro', macro_f1, macro_recall FROM mac_pred_b)
SELECT coalesce(ra.label, rb.label) AS label, ra.f1 AS f1_a, ra.recall AS recall_a,
       rb.f1 AS f1_b, rb.recall AS recall_b
FROM ra FULL JOIN rb ON ra.label = rb.label""")
def compare_models(spark, sf_dir):
    return M.compare_models(rule_predictions(spark, sf_dir), "actual", "pred_a", "pred_b")


@register("label_set", _PR + "\n" + _UNION_LABELS.replace("label FROM pr UNION", "label FROM pr "
                                                          "WHERE actual IS NOT NULL UNION"))
def label_set(spark, sf_dir):
    return M.label_set(rule_predictions(spark, sf_dir), "actual", "pred_a")


@register("confusion_matrix", _PR + """
SELECT a.i, b.j, a.actual, b.predicted, coalesce(c.n, 0) AS n,
       round(coalesce(c.n, 0) / (sum(coalesce(c.n, 0)) OVER (PARTITION BY a.actual)
             + CAST(1e-9 AS DOUBLE)), 9) AS rate
FROM (VALUES (0, 'A'), (1, 'B'), (2, 'C')) a(i, actual)
CROSS JOIN (VALUES (0, 'A'), (1, 'B'), (2, 'C')) b(j, predicted)
LEFT JOIN (SELECT actual, pred_a AS predicted, count(*) AS n FROM pr GROUP BY 1, 2) c
  ON c.actual = a.actual AND c.predicted = b.predicted""")
def confusion_matrix(spark, sf_dir):
    out = M.confusion_matrix(rule_predictions(spark, sf_dir), "actual", "pred_a",
                             K.LETTER_GRADES, normalise=True)
    return out.withColumn("rate", F.round("rate", 9))


@register("topk_hit_rate", _PR + """
SELECT round(avg(CASE WHEN actual IN (pred_a, pred_b) THEN 1.0 ELSE 0.0 END)::DOUBLE, 4)
         AS topk_accuracy, count(*) AS n FROM pr""")
def topk_hit_rate(spark, sf_dir):
    pr = rule_predictions(spark, sf_dir).withColumn("top2", F.array("pred_a", "pred_b"))
    return M.topk_hit_rate(pr, "actual", "top2")


@register("agreement_rates", _PR + """
SELECT round(avg(CASE WHEN actual = pred_a THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) AS agree_a,
       round(avg(CASE WHEN actual = pred_b THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) AS agree_b,
       round(avg(CASE WHEN actual = pred_a AND actual = pred_b THEN 1.0 ELSE 0.0 END)::DOUBLE, 4)
         AS agree_both, count(*) AS n FROM pr""")
def agreement_rates(spark, sf_dir):
    return M.agreement_rates(rule_predictions(spark, sf_dir), "actual", "pred_a", "pred_b")


@register("prediction_distribution", _PR + """
SELECT source, label, count(*) AS n FROM (
  SELECT 'actual' AS source, actual AS label FROM pr UNION ALL
  SELECT 'pred_a', pred_a FROM pr UNION ALL SELECT 'pred_b', pred_b FROM pr)
GROUP BY source, label""")
def prediction_distribution(spark, sf_dir):
    return M.prediction_distribution(rule_predictions(spark, sf_dir),
                                     ["actual", "pred_a", "pred_b"])


@register("evaluation_report", _PR + """,
te AS (SELECT * FROM pr WHERE split = 'test'),""" + _cm_sql("pred_a", "SELECT actual AS label FROM te "
                                                             "UNION SELECT pred_a FROM te", "te")
          + """
SELECT (SELECT count(*) FROM pr WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM pr WHERE split = 'test') AS n_test,
       macro_precision, macro_recall, macro_f1, accuracy, support,
       DATE '1999-01-01' AS cutoff FROM mac_pred_a""")
def evaluation_report(spark, sf_dir):
    import datetime
    return M.evaluation_report(rule_predictions(spark, sf_dir), "actual", "pred_a",
                               datetime.date(1999, 1, 1))
