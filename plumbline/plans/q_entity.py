"""Queries for the entity build (entry point A)."""

from __future__ import annotations

from plumbline.functions import constants as K
from plumbline.operators import entity as E
from plumbline.plans.catalog import register
from plumbline.plans.standins import (INSPECTION_LOG_SQL, REFERENCE_DATE, RID_ORDER_SQL,
                                      inspection_log)

_ID = K.IDENTITY_COLUMNS


def _latest_col_sql(c: str) -> str:
    return (f"v_{c} AS (SELECT camis, {c} FROM (SELECT camis, {c}, row_number() OVER ("
            f"PARTITION BY camis ORDER BY inspection_date DESC NULLS LAST, {RID_ORDER_SQL}) AS rn "
            f"FROM logx WHERE {c} IS NOT NULL) WHERE rn = 1)")


ENTITY_CTES = "WITH " + INSPECTION_LOG_SQL + ",\n" + ",\n".join(_latest_col_sql(c) for c in _ID) + f""",
lr AS (
  SELECT camis, inspection_date AS latest_inspection_date, score AS latest_score,
         action AS latest_action, inspection_type AS latest_inspection_type
  FROM (SELECT *, row_number() OVER (PARTITION BY camis
          ORDER BY inspection_date DESC, {RID_ORDER_SQL}) AS rn
        FROM logx WHERE inspection_date IS NOT NULL) WHERE rn = 1),
gr AS (
  SELECT camis, grade AS latest_grade, grade_date AS latest_grade_date
  FROM (SELECT *, row_number() OVER (PARTITION BY camis
          ORDER BY coalesce(grade IN ('A','B','C'), false) DESC, inspection_date DESC,
                   {RID_ORDER_SQL}) AS rn
        FROM logx WHERE inspection_date IS NOT NULL) WHERE rn = 1),
st AS (
  SELECT camis, avg(score) AS mean_score, min(score) AS min_score, max(score) AS max_score
  FROM (SELECT camis, score, row_number() OVER (PARTITION BY camis, inspection_date
          ORDER BY {RID_ORDER_SQL}) AS rn
        FROM logx WHERE inspection_date IS NOT NULL AND score IS NOT NULL) WHERE rn = 1
  GROUP BY camis),
ic AS (SELECT camis, count(DISTINCT inspection_date) AS n FROM logx GROUP BY camis),
vi AS (
  SELECT camis, count(*) AS tv,
         count(*) FILTER (WHERE critical_flag = 'Critical') AS cv,
         count(*) FILTER (WHERE critical_flag = 'Not Critical') AS nv,
         string_agg(DISTINCT violation_code, ',' ORDER BY violation_code) AS codes
  FROM logx WHERE violation_code IS NOT NULL GROUP BY camis),
ent AS (
  SELECT k.camis, {", ".join(f"v_{c}.{c}" for c in _ID)},
         gr.latest_grade,
         CASE gr.latest_grade WHEN 'A' THEN 3.0 WHEN 'B' THEN 2.0 WHEN 'C' THEN 1.0 END::DOUBLE
           AS latest_grade_encoded,
         gr.latest_grade_date, lr.latest_score, lr.latest_inspection_date, lr.latest_action,
         lr.latest_inspection_type,
         CAST(coalesce(ic.n, 0) AS INTEGER) AS inspection_count,
         st.mean_score, st.min_score, st.max_score,
         CAST(date_diff('day', lr.latest_inspection_date, DATE '{REFERENCE_DATE}') AS INTEGER)
           AS days_since_last_inspection,
         CAST(coalesce(vi.tv, 0) AS INTEGER) AS total_violations,
         CAST(coalesce(vi.cv, 0) AS INTEGER) AS critical_violations,
         CAST(coalesce(vi.nv, 0) AS INTEGER) AS non_critical_violations,
         vi.codes AS unique_violation_codes
  FROM (SELECT DISTINCT camis FROM logx WHERE camis IS NOT NULL) k
  {" ".join(f"LEFT JOIN v_{c} ON v_{c}.camis = k.camis" for c in _ID)}
  LEFT JOIN lr ON lr.camis = k.camis
  LEFT JOIN gr ON gr.camis = k.camis
  LEFT JOIN st ON st.camis = k.camis
  LEFT JOIN ic ON ic.camis = k.camis
  LEFT JOIN vi ON vi.camis = k.camis)
"""


def entity_table(spark, sf_dir):
    return E.build_entity_table(inspection_log(spark, sf_dir), REFERENCE_DATE)


register("entity_table", ENTITY_CTES + "SELECT * FROM ent")(entity_table)


@register("entity_latest_non_null", "WITH " + INSPECTION_LOG_SQL + ",\n"
          + ",\n".join(_latest_col_sql(c) for c in ["phone", "street", "building"])
          + "\nSELECT k.camis, v_phone.phone, v_street.street, v_building.building "
            "FROM (SELECT DISTINCT camis FROM logx) k "
            "LEFT JOIN v_phone ON v_phone.camis = k.camis "
            "LEFT JOIN v_street ON v_street.camis = k.camis "
            "LEFT JOIN v_building ON v_building.camis = k.camis")
def entity_latest_non_null(spark, sf_dir):
    return E.latest_non_null(inspection_log(spark, sf_dir), "camis", "inspection_date", "rid",
                             ["phone", "street", "building"])


@register("entity_latest_row", "WITH " + INSPECTION_LOG_SQL + f"""
SELECT camis, inspection_date AS latest_inspection_date, score AS latest_score,
       action AS latest_action, building AS latest_building
FROM (SELECT *, row_number() OVER (PARTITION BY camis ORDER BY inspection_date DESC,
        {RID_ORDER_SQL}) AS rn FROM logx WHERE inspection_date IS NOT NULL) WHERE rn = 1""")
def entity_latest_row(spark, sf_dir):
    return E.latest_row(inspection_log(spark, sf_dir), "camis", "inspection_date", "rid",
                        ["score", "action", "building"])


@register("entity_most_common", "WITH " + INSPECTION_LOG_SQL + """
SELECT camis, violation_code AS common_code FROM (
  SELECT camis, violation_code, row_number() OVER (PARTITION BY camis
           ORDER BY count(*) DESC, violation_code) AS rn
  FROM logx WHERE violation_code IS NOT NULL GROUP BY camis, violation_code) WHERE rn = 1""")
def entity_most_common(spark, sf_dir):
    return E.most_common(inspection_log(spark, sf_dir), "camis", "violation_code", "common_code")

