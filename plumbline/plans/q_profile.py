"""Queries for filters, profiling and reports (entity table / log)."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import lat_to_row, lng_to_col
from plumbline.operators import profile as P
from plumbline.plans.catalog import register
from plumbline.plans.q_entity import ENTITY_CTES, entity_table
from plumbline.plans.standins import INSPECTION_LOG_SQL, inspection_log, table

E = ENTITY_CTES

BOROS = ["Africa", "Asia", "Middle East"]


@register("explorer_filter", E + """
SELECT camis, dba, boro, latest_grade, cuisine, latest_score FROM ent
WHERE boro IN ('Africa', 'Asia', 'Middle East')
  AND (latest_grade IN ('A', 'B') OR latest_grade IS NULL)
  AND coalesce(regexp_matches(cuisine, 'bu|ho', 'i'), false)
  AND (latest_score IS NULL OR latest_score BETWEEN 0 AND 30)""")
def explorer_filter(spark, sf_dir):
    ent = entity_table(spark, sf_dir)
    out = P.explorer_filter(ent, boros=BOROS, grades=["A", "B"], include_no_grade=True,
                            text="bu|ho", score_range=(0, 30))
    return out.select("camis", "dba", "boro", "latest_grade", "cuisine", "latest_score")


@register("explorer_filter_literal", E + """
SELECT camis, cuisine FROM ent
WHERE cuisine IN ('Building', 'Machinery', 'Household')
  AND coalesce(contains(lower(cuisine), 'in'), false)""")
def explorer_filter_literal(spark, sf_dir):
    ent = entity_table(spark, sf_dir)
    return P.explorer_filter(ent, labels=["Building", "Machinery", "Household"], text="IN",
                             literal_text=True).select("camis", "cuisine")


@register("grade_value_counts", E + """
SELECT coalesce(latest_grade, 'No grade') AS latest_grade, count(*) AS n FROM ent GROUP BY 1""")
def grade_value_counts(spark, sf_dir):
    return P.value_counts(entity_table(spark, sf_dir), "latest_grade", K.NO_GRADE_LABEL)


@register("boro_grade_counts", E + """
SELECT boro, latest_grade, count(*) AS n FROM ent WHERE boro IS NULL OR boro <> '0'
GROUP BY boro, latest_grade""")
def boro_grade_counts(spark, sf_dir):
    ent = P.exclude_value(entity_table(spark, sf_dir), "boro", "0")
    return P.two_key_counts(ent, "boro", "latest_grade")


LOG_COLUMNS = 23  # stand-in log columns without the order id


@register("dataset_summary", "WITH " + INSPECTION_LOG_SQL + f"""
SELECT count(*) AS n_rows, count(DISTINCT camis) AS n_entities, {LOG_COLUMNS} AS n_columns,
       min(inspection_date) AS min_date, max(inspection_date) AS max_date,
       count(*) FILTER (WHERE grade = 'A') AS n_grade_A,
       count(*) FILTER (WHERE grade = 'B') AS n_grade_B,
       count(*) FILTER (WHERE grade = 'C') AS n_grade_C
FROM logx""")
def dataset_summary(spark, sf_dir):
    return P.dataset_summary(inspection_log(spark, sf_dir).drop("rid"))


_ENT_COLS = ["camis"] + K.ENTITY_COLUMN_ORDER


def _missing_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
             f"count({c}) AS n_present, "
             f"round(CAST(100.0 AS DOUBLE) * count(*) FILTER (WHERE {c} IS NULL) / count(*), 1)"
             f" AS pct_missing FROM ent" for c in _ENT_COLS]
    return E + "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") WHERE n_missing > 0"


@register("missing_profile", _missing_sql())
def missing_profile(spark, sf_dir):
    return P.missing_profile(entity_table(spark, sf_dir))


_DESC = ["mean_score", "latest_score", "total_violations", "days_since_last_inspection"]


def _describe_sql() -> str:
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 2) AS mean,
       round(stddev_samp({c}), 2) AS std, round(min({c}), 2)::DOUBLE AS min,
       round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
       round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2)::DOUBLE AS max FROM ent"""
             for c in _DESC]
    return E + "\nUNION ALL\n".join(parts)


@register("describe_columns", _describe_sql())
def describe_columns(spark, sf_dir):
    return P.describe(entity_table(spark, sf_dir), _DESC)


def _hist_sql(by: str | None) -> str:
    extra = f", {by}" if by else ""
    return E + f""", b AS (SELECT min(mean_score) AS lo, max(mean_score) AS hi FROM ent),
h AS (
  SELECT CAST(least(floor((mean_score - b.lo) / ((b.hi - b.lo) / CAST(40 AS DOUBLE))), 39) AS INTEGER)
           AS bin{extra}, b.lo AS blo, (b.hi - b.lo) / CAST(40 AS DOUBLE) AS w
  FROM ent, b WHERE mean_score IS NOT NULL)
SELECT bin{extra}, any_value(blo) + bin * any_value(w) AS lo,
       any_value(blo) + (bin + 1) * any_value(w) AS hi, count(*) AS n
FROM h GROUP BY bin{extra}"""


@register("histogram_mean_score", _hist_sql(None))
def histogram_mean_score(spark, sf_dir):
    return P.histogram(entity_table(spark, sf_dir), "mean_score", 40)


@register("histogram_mean_score_by_grade", _hist_sql("latest_grade"))
def histogram_mean_score_by_grade(spark, sf_dir):
    return P.histogram(entity_table(spark, sf_dir), "mean_score", 40, by="latest_grade")


def sql_row(lat: str) -> str:
    return (f"least(greatest(CAST(trunc(({lat} - CAST({K.LAT_MIN} AS DOUBLE)) / "
            f"CAST({K.GRID_LAT_RES} AS DOUBLE)) AS INTEGER), 0), {K.GRID_ROWS - 1})")


def sql_col(lng: str) -> str:
    return (f"least(greatest(CAST(trunc(({lng} - CAST({K.LNG_MIN} AS DOUBLE)) / "
            f"CAST({K.GRID_LNG_RES} AS DOUBLE)) AS INTEGER), 0), {K.GRID_COLS - 1})")


@register("critical_density", E + f"""
SELECT {sql_row('latitude')} AS grid_row, {sql_col('longitude')} AS grid_col,
       CAST(sum(critical_violations) AS BIGINT) AS weight
FROM ent WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2""")
def critical_density(spark, sf_dir):
    ent = entity_table(spark, sf_dir).where(F.col("latitude").isNotNull()
                                            & F.col("longitude").isNotNull())
    cells = ent.select(lat_to_row("latitude").alias("grid_row"),
                       lng_to_col("longitude").alias("grid_col"), "critical_violations")
    return P.weighted_density(cells, ["grid_row", "grid_col"], "critical_violations")


@register("grade_class_counts", E + """
SELECT c.ord, c.latest_grade, coalesce(k.n, 0) AS n,
       round(CAST(100.0 AS DOUBLE) * coalesce(k.n, 0) / greatest(sum(coalesce(k.n, 0)) OVER (), 1), 1)
         AS pct
FROM (VALUES (0, 'A'), (1, 'B'), (2, 'C')) c(ord, latest_grade)
LEFT JOIN (SELECT latest_grade, count(*) AS n FROM ent GROUP BY 1) k
  ON k.latest_grade = c.latest_grade""")
def grade_class_counts(spark, sf_dir):
    return P.class_counts(entity_table(spark, sf_dir), "latest_grade")


@register("top_labels", E + """
SELECT cuisine, count(*) AS n FROM ent WHERE cuisine IS NOT NULL GROUP BY cuisine
ORDER BY n DESC, cuisine LIMIT 20""")
def top_labels(spark, sf_dir):
    vc = P.value_counts(entity_table(spark, sf_dir), "cuisine")
    return P.top_n(vc, [F.col("n").desc(), F.col("cuisine")], 20)


@register("ranked_positions", E + """
SELECT camis, boro, rank, n_candidates, current_rank, prev_rank, next_rank,
       (rank - 1) = (current_rank - 1) AS is_current
FROM (SELECT camis, boro,
        row_number() OVER (PARTITION BY boro ORDER BY latest_score DESC NULLS LAST, camis) AS rank,
        count(*) OVER (PARTITION BY boro) AS n_candidates FROM ent) t,
LATERAL (SELECT least(greatest(3, 0), n_candidates - 1) AS cur) c,
LATERAL (SELECT CAST(c.cur + 1 AS BIGINT) AS current_rank,
                CAST(greatest(c.cur, 1) AS BIGINT) AS prev_rank,
                CAST(least(c.cur + 2, n_candidates) AS BIGINT) AS next_rank) p""")
def ranked_positions(spark, sf_dir):
    ent = entity_table(spark, sf_dir)
    out = P.ranked_with_position(ent, [F.col("latest_score").desc_nulls_last(), F.col("camis")],
                                 current=3, group=["boro"])
    return out.select("camis", "boro", "rank", "n_candidates", "current_rank", "prev_rank",
                      "next_rank", "is_current")


@register("custom_order_sort", E + """
SELECT camis, latest_grade, latest_score FROM ent
ORDER BY CASE latest_grade WHEN 'A' THEN 0 WHEN 'B' THEN 1 WHEN 'C' THEN 2 ELSE 3 END,
         latest_score NULLS LAST, camis""")
def custom_order_sort(spark, sf_dir):
    ent = entity_table(spark, sf_dir)
    return ent.orderBy(P.grade_order("latest_grade"), F.col("latest_score").asc_nulls_last(),
                       "camis").select("camis", "latest_grade", "latest_score")


@register("random_row", E + """
SELECT camis, dba FROM ent ORDER BY md5('42:' || CAST(camis AS VARCHAR)), camis LIMIT 1""")
def random_row(spark, sf_dir):
    return P.random_row(entity_table(spark, sf_dir), "camis", 42).select("camis", "dba")


@register("distinct_areas", E + """
SELECT DISTINCT boro FROM ent WHERE boro IS NOT NULL AND boro <> '0' ORDER BY boro""")
def distinct_areas(spark, sf_dir):
    return P.distinct_sorted(entity_table(spark, sf_dir), "boro", exclude="0")


@register("map_attributes", E + """
SELECT camis, coalesce(latest_grade, 'No grade') AS grade_text,
       trim(coalesce(building, '') || ' ' || coalesce(street, '')) AS address,
       array_to_string(CASE latest_grade WHEN 'A' THEN [0, 200, 100, 210]
                                         WHEN 'B' THEN [255, 200, 0, 210]
                                         WHEN 'C' THEN [240, 80, 60, 210]
                                         ELSE [158, 158, 158, 140] END, ',') AS color
FROM ent""")
def map_attributes(spark, sf_dir):
    out = P.map_attributes(entity_table(spark, sf_dir))
    return out.select("camis", "grade_text", "address",
                      F.array_join(F.col("color").cast("array<string>"), ",").alias("color"))


_NAME_Q_SQL = """
q AS (SELECT '  ' || upper(c_name) AS query FROM customer
      UNION ALL SELECT s_name AS query FROM supplier)"""


@register("exact_name_lookup", E + "," + _NAME_Q_SQL + """
SELECT q.query, f.cuisine FROM q LEFT JOIN (
  SELECT lower(trim(dba)) AS n, arg_min(cuisine, camis) AS cuisine FROM ent
  WHERE cuisine IS NOT NULL GROUP BY 1) f ON lower(trim(q.query)) = f.n""")
def exact_name_lookup(spark, sf_dir):
    ent = entity_table(spark, sf_dir).where(F.col("cuisine").isNotNull())
    q = (table(spark, sf_dir, "customer").select(F.concat(F.lit("  "), F.upper("c_name")).alias("query"))
         .unionByName(table(spark, sf_dir, "supplier").select(F.col("s_name").alias("query"))))
    return P.exact_name_lookup(ent, q).select("query", "cuisine")


@register("rare_class_filter", E + """
SELECT camis, nta FROM ent WHERE nta IN (
  SELECT nta FROM ent GROUP BY nta HAVING count(*) >= 60)""")
def rare_class_filter(spark, sf_dir):
    ent = entity_table(spark, sf_dir)
    return P.rare_class_filter(ent.select("camis", "nta"), "nta", 60)
