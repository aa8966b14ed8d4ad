"""Queries for the tree and the blend, with DuckDB twins that unroll the tree
level by level (``tree_sql``), and for the text label classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import score_to_label
from plumbline.operators import blend as B
from plumbline.operators import labels as L
from plumbline.operators import metrics as M
from plumbline.operators import tree as T
from plumbline.plans.catalog import register
from plumbline.plans.label_sql import label_ctes
from plumbline.plans.q_entity import ENTITY_CTES, entity_table
from plumbline.plans.q_eval import _GRADED_SQL, _cm_sql, graded_complete
from plumbline.plans.q_knn import _DOT, _MO, _NRM, _ZCOLS
from plumbline.plans.tree_sql import route_ctes, rule_ctes, tree_ctes
from plumbline.operators import split as S
from plumbline.plans.standins import table
from plumbline.session import cut_lineage

GRADE_DEPTH = 10

_DERIVED = {
    "score_range": "greatest(max_score - min_score, CAST(0 AS DOUBLE))",
    "critical_rate": "critical_violations / greatest(total_violations, 1)",
    "violations_per_inspection": "total_violations / greatest(inspection_count, 1)",
}
_TREE_COLS = ", ".join(f"{_DERIVED.get(f, f)} AS f_{f}" for f in K.TREE_ALL_FEATURES)
_TREE_FEATS = [f"f_{f}" for f in K.TREE_ALL_FEATURES]
_GRADE_TREE_SQL = ENTITY_CTES + _GRADED_SQL + f""",
sp AS MATERIALIZED (SELECT camis, latest_grade, {_TREE_COLS},
  CASE WHEN rn <= least(greatest(floor(n * CAST(0.8 AS DOUBLE)), 1), n - 1) THEN 'train' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY latest_inspection_date, camis) AS rn, count(*) OVER () AS n FROM gc)),
trn AS (SELECT * FROM sp WHERE split = 'train'),
tst AS (SELECT * FROM sp WHERE split = 'test'),
""" + tree_ctes("trn", _TREE_FEATS, "latest_grade", K.LETTER_GRADES, GRADE_DEPTH)
_NODE_VIEW_SQL = ("SELECT node_id, depth, is_leaf, substr(feature, 3) AS feature, round(threshold, 6) AS threshold, n_samples, "
                  "round(gain, 9) AS gain, label, " + ", ".join(f"round(P_{c}, 6) AS P_{c}" for c in K.LETTER_GRADES)
                  + " FROM t_nodes")
_PREDICT_SQL = _GRADE_TREE_SQL + ",\n" + route_ctes("tst", _TREE_FEATS, "camis", GRADE_DEPTH) + """,
pr AS (SELECT l.camis, n.label AS predicted, n.P_A, n.P_B, n.P_C, tst.latest_grade AS actual
       FROM t_leaf l JOIN t_nodes n ON n.node_id = l.leaf JOIN tst ON tst.camis = l.camis)"""


def _grade_tree(spark, sf_dir):
    cols = dict.fromkeys(["camis", "latest_grade", "latest_inspection_date", *T.required_columns(K.TREE_ALL_FEATURES)])
    base = cut_lineage(graded_complete(spark, sf_dir).select(*cols))  # the split, the fit and the scoring read it
    d, _info = S.temporal_split(base, "latest_inspection_date", "camis", 0.2, clamp=True,
                                min_rows=10)
    df, feats = T.engineer_features(d)
    train = df.where(F.col("split") == "train")
    nodes, classes = T.fit_tree(train.select("camis", *feats, "latest_grade"), feats,
                                "latest_grade", max_depth=GRADE_DEPTH)
    return df, feats, nodes, classes


def _node_view(nodes, classes):
    return nodes.select("node_id", "depth", "is_leaf", "feature", F.round("threshold", 6)
                        .alias("threshold"), "n_samples", F.round("gain", 9).alias("gain"),
                        "label", *[F.round(f"P_{c}", 6).alias(f"P_{c}") for c in classes])


@register("tree_fit_grades", _GRADE_TREE_SQL + "\n" + _NODE_VIEW_SQL)
def tree_fit_grades(spark, sf_dir):
    _df, _f, nodes, classes = _grade_tree(spark, sf_dir)
    return _node_view(nodes, classes)


@register("tree_predict_grades", _PREDICT_SQL + "\nSELECT camis, predicted, P_A, P_B, P_C FROM pr")
def tree_predict_grades(spark, sf_dir):
    df, _f, nodes, classes = _grade_tree(spark, sf_dir)
    test = df.where(F.col("split") == "test")
    return T.predict(nodes, test, classes, "camis")


@register("tree_test_metrics", _PREDICT_SQL + "," + _cm_sql("predicted", "SELECT * FROM (VALUES ('A'), ('B'), ('C')) v(label)") + """
SELECT label, precision, recall, f1, support FROM m_predicted
UNION ALL SELECT 'macro', macro_precision, macro_recall, macro_f1, support FROM mac_predicted""")
def tree_test_metrics(spark, sf_dir):
    df, _f, nodes, classes = _grade_tree(spark, sf_dir)
    test = df.where(F.col("split") == "test")
    pred = T.predict(nodes, test, classes, "camis").join(
        test.select("camis", F.col("latest_grade").alias("actual")), "camis")
    return M.report_rows(pred, "actual", "predicted", K.LETTER_GRADES)


@register("tree_importance", _GRADE_TREE_SQL + """
SELECT substr(feature, 3) AS feature, round(sum(weighted_n * gain) / sum(sum(weighted_n * gain)) OVER (), 9) AS importance
FROM t_nodes WHERE NOT is_leaf GROUP BY feature""")
def tree_importance(spark, sf_dir):
    _df, _f, nodes, _c = _grade_tree(spark, sf_dir)
    return T.feature_importance(nodes).select("feature", F.round("importance", 9).alias("importance"))


@register("tree_rules", _GRADE_TREE_SQL + ",\n" + rule_ctes(GRADE_DEPTH) + """
SELECT node_id, replace(rule, 'f_', '') AS rule, label, n_samples, P_A, P_B, P_C
FROM t_nodes JOIN t_rules USING (node_id) WHERE is_leaf ORDER BY n_samples DESC, node_id LIMIT 15""")
def tree_rules(spark, sf_dir):
    _df, _f, nodes, classes = _grade_tree(spark, sf_dir)
    return T.leaf_rules(nodes, classes, 15)


@register("tree_summary", _GRADE_TREE_SQL + """
SELECT max(depth) FILTER (WHERE is_leaf) AS depth, count(*) FILTER (WHERE is_leaf) AS n_leaves, count(*) AS n_nodes
FROM t_nodes""")
def tree_summary(spark, sf_dir):
    _df, _f, nodes, _c = _grade_tree(spark, sf_dir)
    return T.tree_summary(nodes)


def doc_features(spark, sf_dir):
    """Whole-text features of documents with a quality label (imbalanced)."""
    docs = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    d = docs.join(lab, "doc_id")
    words = F.size(F.filter(F.split(F.col("text"), r"\s+"), lambda w: F.length(w) > 0))
    lines = F.size(F.split(F.col("text"), "\n"))
    return d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                    words.cast("double").alias("n_words"), lines.cast("double").alias("n_lines"),
                    (F.length(F.regexp_replace("text", r"[^0-9]", "")) / F.greatest(
                        F.length("text"), F.lit(1))).alias("digit_share"),
                    F.col("quality").cast("string").alias("quality"))


_DOC_FEATS = ["n_chars", "n_words", "n_lines", "digit_share"]
_DOC_TREE_SQL = """WITH df AS MATERIALIZED (SELECT d.doc_id, CAST(n_chars AS DOUBLE) AS n_chars,
  CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS DOUBLE) AS n_words,
  CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines,
  length(regexp_replace(text, '[^0-9]', '', 'g')) / greatest(length(text), 1) AS digit_share,
  CAST(quality AS VARCHAR) AS quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
""" + tree_ctes("df", _DOC_FEATS, "quality", ["0", "1"], GRADE_DEPTH) + ",\n" + route_ctes(
    "df", _DOC_FEATS, "doc_id", GRADE_DEPTH) + """,
pr AS (SELECT df.quality AS actual, n.label AS predicted FROM t_leaf l JOIN t_nodes n ON n.node_id = l.leaf
       JOIN df ON df.doc_id = l.doc_id),""" + _cm_sql("predicted", "SELECT actual AS label FROM pr UNION SELECT predicted FROM pr") + """
SELECT * FROM m_predicted"""


@register("tree_document_quality", _DOC_TREE_SQL)
def tree_document_quality(spark, sf_dir):
    d = doc_features(spark, sf_dir)
    feats = ["n_chars", "n_words", "n_lines", "digit_share"]
    nodes, classes = T.fit_tree(d, feats, "quality")
    pred = T.predict(nodes, d, classes, "doc_id").join(d.select("doc_id", "quality"), "doc_id")
    return M.class_metrics(pred, "quality", "predicted")


BLEND_DEPTH = 12
_REQUIRED = " AND ".join(f"{c} IS NOT NULL" for c in K.BLEND_REQUIRED)
_SHARE = lambda c: f"count(*) FILTER (WHERE label = '{c}') / count(*)"
_BEST = lambda p: (f"CASE WHEN {p}_A = greatest({p}_A, {p}_B, {p}_C) THEN 'A' "  # noqa: E731
                   f"WHEN {p}_B = greatest({p}_A, {p}_B, {p}_C) THEN 'B' ELSE 'C' END")
_MIX = lambda c: f"(CAST(0.35 AS DOUBLE) * k_{c} + CAST({1.0 - 0.35!r} AS DOUBLE) * d_{c})"


def blend_ctes() -> str:
    """CTE ``bl`` (camis, k_*, d_*, b_*, score) for entities with complete
    features; follows the entity CTEs and the graded ones."""
    return f""",
btr AS MATERIALIZED (SELECT *, {_TREE_COLS} FROM gc),
bsc AS MATERIALIZED (SELECT *, {_TREE_COLS} FROM ent WHERE {_REQUIRED}),
mo AS MATERIALIZED (SELECT {_MO} FROM btr),
bzt AS MATERIALIZED (SELECT *, sqrt({_NRM}) + CAST(1e-10 AS DOUBLE) AS nn
  FROM (SELECT camis AS tid, latest_grade AS label, {_ZCOLS} FROM btr, mo)),
bzq AS MATERIALIZED (SELECT *, sqrt({_NRM}) + CAST(1e-10 AS DOUBLE) AS nn FROM (SELECT camis AS qid, {_ZCOLS} FROM bsc, mo)),
btop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY sim DESC, tid) AS r FROM (
  SELECT q.qid, t.tid, t.label, round(({_DOT}) / (q.nn * t.nn), 10) AS sim FROM bzq q, bzt t)) WHERE r <= 7),
bk AS MATERIALIZED (SELECT qid AS camis, {_SHARE("A")} AS k_A, {_SHARE("B")} AS k_B, {_SHARE("C")} AS k_C FROM btop GROUP BY qid),
""" + tree_ctes("btr", _TREE_FEATS, "latest_grade", K.LETTER_GRADES, BLEND_DEPTH) + ",\n" + route_ctes(
        "bsc", _TREE_FEATS, "camis", BLEND_DEPTH) + f""",
bd AS (SELECT l.camis, n.P_A AS d_A, n.P_B AS d_B, n.P_C AS d_C FROM t_leaf l JOIN t_nodes n ON n.node_id = l.leaf),
bl AS MATERIALIZED (SELECT *, b_A * CAST(3.0 AS DOUBLE) + b_B * CAST(2.0 AS DOUBLE) + b_C * CAST(1.0 AS DOUBLE) AS score
  FROM (SELECT *, {_MIX("A")} AS b_A, {_MIX("B")} AS b_B, {_MIX("C")} AS b_C FROM bk JOIN bd USING (camis))),
safe AS MATERIALIZED (SELECT e.camis, coalesce(bl.score, CASE e.latest_grade WHEN 'A' THEN 3.0 WHEN 'B' THEN 2.0 WHEN 'C' THEN 1.0 END,
    2.0)::DOUBLE AS safety_score FROM ent e LEFT JOIN bl USING (camis))"""


_BLEND_SQL = ENTITY_CTES + _GRADED_SQL + blend_ctes()
_BLEND_TABLE_SQL = _BLEND_SQL + f""",
pt AS (SELECT camis, round(b_A, 4) AS P_A, round(b_B, 4) AS P_B, round(b_C, 4) AS P_C, {_BEST("k")} AS knn_pred,
       {_BEST("d")} AS dt_pred, {_BEST("b")} AS combined_pred, round(score, 3) AS safety_score FROM bl)"""


def _blend(spark, sf_dir):
    ent = cut_lineage(entity_table(spark, sf_dir))
    return ent, B.fit_blend(ent, max_depth=BLEND_DEPTH)


@register("blend_prediction_table", _BLEND_TABLE_SQL + "\nSELECT * FROM pt")
def blend_prediction_table(spark, sf_dir):
    ent, model = _blend(spark, sf_dir)
    return B.prediction_table(model, ent)


@register("blend_safety_scores", _BLEND_SQL + """
SELECT camis, round(safety_score, 6) AS safety_score,
       CASE WHEN safety_score >= 2.5 THEN 'A' WHEN safety_score >= 1.5 THEN 'B' ELSE 'C' END AS predicted_grade FROM safe""")
def blend_safety_scores(spark, sf_dir):
    ent, model = _blend(spark, sf_dir)
    return B.safety_scores(model, ent).withColumn("safety_score", F.round("safety_score", 6))


@register("blend_agreement", _BLEND_TABLE_SQL + """
SELECT round(avg(CASE WHEN combined_pred = knn_pred THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) AS agree_a,
       round(avg(CASE WHEN combined_pred = dt_pred THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) AS agree_b,
       round(avg(CASE WHEN combined_pred = knn_pred AND combined_pred = dt_pred THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) AS agree_both,
       count(*) AS n FROM pt""")
def blend_agreement(spark, sf_dir):
    ent, model = _blend(spark, sf_dir)
    pt = B.prediction_table(model, ent)
    return M.agreement_rates(pt, "combined_pred", "knn_pred", "dt_pred")


@register("tree_evaluation", _PREDICT_SQL + "," + _cm_sql("predicted", "SELECT actual AS label FROM pr UNION SELECT predicted FROM pr") + """
SELECT (SELECT count(*) FROM trn) AS n_train, (SELECT count(*) FROM tst) AS n_test, macro_precision, macro_recall, macro_f1,
       accuracy, support, (SELECT min(latest_inspection_date) FROM tst JOIN gc USING (camis)) AS cutoff FROM mac_predicted""")
def tree_evaluation(spark, sf_dir):
    """M16 on the fitted tree: sizes, cutoff and test metrics of one split."""
    df, _f, nodes, classes = _grade_tree(spark, sf_dir)
    pred = df.select("camis", "latest_inspection_date", "split", F.col("latest_grade").alias("actual")).join(
        T.predict(nodes, df, classes, "camis"), "camis")
    cutoff = pred.where(F.col("split") == "test").agg(F.min("latest_inspection_date").alias("d")).scalar()
    return M.evaluation_report(pred, "actual", "predicted", cutoff)


@register("mean_grade_labels", ENTITY_CTES + """
SELECT boro, round(avg(latest_grade_encoded), 9) AS mean_grade,
       CASE WHEN avg(latest_grade_encoded) >= 2.7 THEN 'A' WHEN avg(latest_grade_encoded) >= 1.7 THEN 'B' ELSE 'C' END AS label
FROM ent WHERE latest_grade_encoded IS NOT NULL GROUP BY boro""")
def mean_grade_labels(spark, sf_dir):
    """P17 with the 2.7 / 1.7 cuts used for means of grades."""
    m = entity_table(spark, sf_dir).where(F.col("latest_grade_encoded").isNotNull()).groupBy("boro").agg(
        F.avg("latest_grade_encoded").alias("m"))
    return m.select("boro", F.round("m", 9).alias("mean_grade"), score_to_label("m", 2.7, 1.7).alias("label"))


# --- M11 / M12: text -> label ---------------------------------------------------------

def _part_names(spark, sf_dir):
    from plumbline.functions.columns import normalise_name
    from plumbline.operators.profile import rare_class_filter
    p = table(spark, sf_dir, "part").select("p_partkey", normalise_name("p_name").alias("name"),
                                            F.col("p_type").alias("label"))
    return rare_class_filter(p, "label", K.MIN_LABEL_COUNT)


_PART_LABELS_SQL = """WITH
nm AS (SELECT p_partkey AS doc, trim(regexp_replace(regexp_replace(lower(p_name), '[!-/:-@\\[-`{-~]', '', 'g'), '\\s+', ' ', 'g')) AS text,
  p_type AS label, count(*) OVER (PARTITION BY p_type) AS nc,
  row_number() OVER (PARTITION BY p_type ORDER BY substr(md5('42:' || CAST(p_partkey AS VARCHAR)), 1, 15), p_partkey) AS rn
  FROM part WHERE p_type IS NOT NULL),
sp AS (SELECT doc, text, label, CASE WHEN rn <= round(CAST(0.2 AS DOUBLE) * nc) THEN 'test' ELSE 'train' END AS split
  FROM nm WHERE nc >= """ + str(K.MIN_LABEL_COUNT) + """),
tr AS MATERIALIZED (SELECT doc, text, label FROM sp WHERE split = 'train'),
te AS MATERIALIZED (SELECT doc, text, label FROM sp WHERE split = 'test'),""" + label_ctes()

_DOC_LABELS_SQL = """WITH
sp AS (SELECT doc_id AS doc, text, lang AS label, CASE WHEN lower(trim(source)) = 'src3' THEN 'test' ELSE 'train' END AS split
  FROM documents),
kept AS (SELECT label FROM sp WHERE split = 'train' GROUP BY label HAVING count(*) >= """ + str(K.MIN_LABEL_COUNT) + """),
tr AS MATERIALIZED (SELECT doc, text, label FROM sp WHERE split = 'train' AND label IN (SELECT label FROM kept)),
te AS MATERIALIZED (SELECT doc, text, label FROM sp WHERE split = 'test' AND label IN (SELECT label FROM kept)),""" + label_ctes()

_SEEN_LABELS = "SELECT actual AS label FROM pr UNION SELECT predicted FROM pr"


def _label_eval(spark, sf_dir):
    d = cut_lineage(S.stratified_split(_part_names(spark, sf_dir), "label", "p_partkey", 0.2, 42))
    m = L.fit_label_classifier(d.where(F.col("split") == "train"), "p_partkey", "name", "label")
    test = d.where(F.col("split") == "test")
    # read several times by the reports
    return cut_lineage(L.predict_top3(m, test, "p_partkey", "name").join(
        test.select("p_partkey", F.col("label").alias("actual")), "p_partkey"))


@register("label_classifier_metrics", _PART_LABELS_SQL + "," + _cm_sql("predicted", _SEEN_LABELS) + "\nSELECT * FROM m_predicted")
def label_classifier_metrics(spark, sf_dir):
    return M.class_metrics(_label_eval(spark, sf_dir), "actual", "predicted")


@register("label_classifier_top3", _PART_LABELS_SQL + """
SELECT (SELECT round(avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) FROM (
          SELECT bool_or(label = actual AND rank <= 3) AS hit FROM lp GROUP BY doc)) AS topk_accuracy,
       (SELECT count(*) FROM pr) AS n,
       (SELECT round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END)::DOUBLE, 4) FROM pr) AS accuracy""")
def label_classifier_top3(spark, sf_dir):
    pred = _label_eval(spark, sf_dir)
    acc = M.macro_summary(pred, "actual", "predicted").select("accuracy").scalar()
    return M.topk_hit_rate(pred, "actual", "top_labels").select("*", acc.alias("accuracy"))


def _document_labels(spark, sf_dir):
    """Whole document texts -> language, area hold-out on the source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("label"), "source")
    d = S.area_split(docs, "source", "label", "src3")
    m = L.fit_label_classifier(d.where(F.col("split") == "train"), "doc_id", "text", "label")
    test = d.where(F.col("split") == "test")
    return cut_lineage(L.predict_top3(m, test, "doc_id", "text").join(test.select("doc_id", F.col("label").alias("actual")), "doc_id"))


@register("label_classifier_documents", _DOC_LABELS_SQL + "," + _cm_sql("predicted", _SEEN_LABELS) + """
SELECT label, precision, recall, f1, support FROM m_predicted
UNION ALL SELECT 'macro', macro_precision, macro_recall, macro_f1, support FROM mac_predicted""")
def label_classifier_documents(spark, sf_dir):
    return M.report_rows(_document_labels(spark, sf_dir), "actual", "predicted")


@register("label_classifier_probabilities", _DOC_LABELS_SQL + """
SELECT doc AS doc_id, rank, label, round(p, 6) AS probability FROM lp WHERE rank <= 3""")
def label_classifier_probabilities(spark, sf_dir):
    """The three likeliest labels of every held-out text."""
    top = F.posexplode(F.arrays_zip(F.col("top_labels").alias("l"), F.col("top_probs").alias("p"))).alias("at", "t")
    return _document_labels(spark, sf_dir).select("doc_id", top).select(
        "doc_id", (F.col("at") + 1).cast("long").alias("rank"), F.col("t.l").alias("label"), F.round("t.p", 6).alias("probability"))


# --- exact SQL twin of a depth-1 tree (a stump) ------------------------------------------

def _stump_sql() -> str:
    import numpy as np
    from plumbline.plans.q_entity import ENTITY_CTES
    from plumbline.plans.q_eval import _GRADED_SQL
    feats = K.TREE_ALL_FEATURES
    expr = {
        "score_range": "greatest(max_score - min_score, CAST(0 AS DOUBLE))",
        "critical_rate": "critical_violations / greatest(total_violations, 1)",
        "violations_per_inspection": "total_violations / greatest(inspection_count, 1)",
    }
    xs = ", ".join(f"CAST({expr.get(f, f)} AS DOUBLE) AS x{i}" for i, f in enumerate(feats))
    qs = "[" + ", ".join(f"CAST({float(v)!r} AS DOUBLE)" for v in np.linspace(0.01, 0.99, 50)) + "]"
    th = " UNION ALL ".join(
        f"SELECT {i} AS f, unnest(list_distinct(quantile_cont(x{i}, {qs}))) AS t FROM x "
        f"HAVING min(x{i}) <> max(x{i})" for i in range(len(feats)))
    pick = "CASE th.f " + " ".join(f"WHEN {i} THEN x.x{i}" for i in range(len(feats))) + " END"
    names = "CASE f " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(feats)) + " END"
    cls = ["A", "B", "C"]
    lcw = [f"(l{c} * w.w{c})" for c in cls]
    lw = " + ".join(lcw)
    sq = lambda parts, den: " + ".join(f"({p} / ({den} + CAST(1e-12 AS DOUBLE))) * ({p} / ({den} + CAST(1e-12 AS DOUBLE)))" for p in parts)
    rcw = [f"(p.pw{c} - {lcw[k]})" for k, c in enumerate(cls)]
    return ENTITY_CTES + _GRADED_SQL + f""",
x AS (SELECT camis, latest_grade AS y, {xs} FROM gc),
w AS (SELECT """ + ", ".join(
        f"(SELECT count(*) FROM x) / (3 * (SELECT count(*) FROM x WHERE y = '{c}')) AS w{c}"
        for c in cls) + """),
p AS (SELECT """ + ", ".join(f"(SELECT count(*) FROM x WHERE y = '{c}') * w.w{c} AS pw{c}"
                             for c in cls) + """, (SELECT count(*) FROM x) AS pn FROM w),
p2 AS (SELECT *, pwA + pwB + pwC AS tw FROM p),
p3 AS (SELECT *, CAST(1.0 AS DOUBLE) - ((pwA / tw) * (pwA / tw) + (pwB / tw) * (pwB / tw)
                                         + (pwC / tw) * (pwC / tw)) AS pg FROM p2),
th AS (""" + th + f"""),
ev AS (SELECT th.f, th.t, """ + ", ".join(
        f"count(*) FILTER (WHERE {pick} <= th.t AND x.y = '{c}') AS l{c}" for c in cls) + f"""
       FROM th, x GROUP BY th.f, th.t),
cand AS (
  SELECT ev.f, ev.t, lA + lB + lC AS ln, p.pn - (lA + lB + lC) AS rn,
         {lw} AS lw, p.tw - ({lw}) AS rw, lA, lB, lC,
         p.pg - (({lw}) * (CAST(1.0 AS DOUBLE) - ({sq(lcw, lw)}))
                 + (p.tw - ({lw})) * (CAST(1.0 AS DOUBLE) - ({sq(rcw, f"(p.tw - ({lw}))")}))) / p.tw
           AS dec
  FROM ev, p3 p, w),
best AS (SELECT * FROM cand WHERE ln >= 5 AND rn >= 5 AND lw > 0 AND rw > 0
         ORDER BY dec DESC, f, t LIMIT 1),
kids AS (SELECT 2 AS node_id, lA AS cA, lB AS cB, lC AS cC, ln AS n FROM best
         UNION ALL SELECT 3, p.cA - lA, p.cB - lB, p.cC - lC, rn FROM best,
           (SELECT count(*) FILTER (WHERE y = 'A') AS cA, count(*) FILTER (WHERE y = 'B') AS cB,
                   count(*) FILTER (WHERE y = 'C') AS cC FROM x) p),
kw AS (SELECT node_id, n, cA * wA AS a, cB * wB AS b, cC * wC AS c FROM kids, w)
SELECT CAST(1 AS BIGINT) AS node_id, 0 AS depth, false AS is_leaf, {names} AS feature,
       round(t, 6) AS threshold, (SELECT pn FROM p) AS n_samples, round(dec, 9) AS gain,
       CAST(NULL AS VARCHAR) AS label, CAST(NULL AS DOUBLE) AS P_A, CAST(NULL AS DOUBLE) AS P_B,
       CAST(NULL AS DOUBLE) AS P_C FROM best
UNION ALL
SELECT CAST(node_id AS BIGINT), 1, true, NULL, NULL, n, 0.0,
       CASE WHEN a >= b AND a >= c THEN 'A' WHEN b >= c THEN 'B' ELSE 'C' END,
       round(a / (a + b + c + CAST(1e-12 AS DOUBLE)), 6), round(b / (a + b + c + CAST(1e-12 AS DOUBLE)), 6),
       round(c / (a + b + c + CAST(1e-12 AS DOUBLE)), 6) FROM kw"""


_GATE_SQL = ENTITY_CTES + """,
gf AS (SELECT """ + _TREE_COLS + """ FROM ent)
""" + "UNION ALL".join(f"""
SELECT '{f}' AS feature, count(*) AS n_rows, count(*) FILTER (WHERE f_{f} IS NULL OR NOT isfinite(CAST(f_{f} AS DOUBLE))) AS n_bad FROM gf
""" for f in K.TREE_ALL_FEATURES)


@register("feature_gate", _GATE_SQL)
def feature_gate(spark, sf_dir):
    """The derived features, the columns they need, and the rows that the
    finite-value gate of a fit would reject."""
    ent = entity_table(spark, sf_dir)
    T.check_required(ent, K.TREE_ALL_FEATURES)
    df, feats = T.engineer_features(ent)
    return T.gate(df, feats)


@register("tree_stump_grades", _stump_sql())
def tree_stump_grades(spark, sf_dir):
    df, feats = T.engineer_features(graded_complete(spark, sf_dir))
    nodes, classes = T.fit_tree(df.select(*feats, "latest_grade"), feats, "latest_grade",
                                max_depth=1)
    return _node_view(nodes, classes)
