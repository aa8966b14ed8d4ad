"""Queries for the grid and location search."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import col_to_lng, row_to_lat
from plumbline.operators import blend as B
from plumbline.operators import grid as G
from plumbline.operators import search as SR
from plumbline.plans.catalog import register
from plumbline.plans.q_entity import ENTITY_CTES, entity_table
from plumbline.plans.q_eval import _GRADED_SQL
from plumbline.plans.q_model import blend_ctes
from plumbline.plans.q_profile import sql_col, sql_row
from plumbline.plans.q_text import (REQUESTS_SQL, _EM_SQL, _ENT_MATCH_SQL, _LAB_SQL, _LABEL_TAIL_SQL, sql_blank, sql_expand,
                                    sql_model, sql_preset, sql_scale, sql_tf, sql_vec)
from plumbline.plans.search_sql import destination_sql, heat_sql, plan_sql, recursive, result_sql, smooth_sql, warning_sql
from plumbline.plans.standins import entity_coordinates, requests, table
from plumbline.session import cut_lineage
from plumbline.sources.files import at_places, edges_from_rings, presets_table

_ROWS, _COLS = K.GRID_ROWS, K.GRID_COLS


def _kernel_sql() -> str:
    """Gaussian of sigma 1 at -4..4, normalised, by SQL."""
    return ("SELECT d, exp(CAST(-0.5 AS DOUBLE) * d * d) / sum(exp(CAST(-0.5 AS DOUBLE) * d * d)) OVER () "
            "FROM (SELECT unnest(range(-4, 5)) AS d)")


_LABEL_MATCH_CTES = """,
ld AS (SELECT label AS doc, lower(label) AS text FROM lab),""" + sql_tf("l", "ld") + "," \
    + sql_model("l", "ld") + "," + sql_vec("l", "l_model") + f""",
qd AS (SELECT req_id AS doc, {sql_expand('query')} AS text FROM req WHERE NOT {sql_blank('query')}),""" \
    + sql_tf("q", "qd") + "," + sql_vec("q", "l_model") + f""",
sims AS (SELECT q.doc AS req_id, l.doc AS label, sum(q.w * l.w) AS sim
         FROM q_vec q JOIN l_vec l ON l.gram = q.gram GROUP BY 1, 2),
full_ AS (SELECT r.req_id, {sql_blank('r.query')} AS blank, lab.label,
                 coalesce(s.sim, CAST(0 AS DOUBLE)) AS sim
          FROM req r CROSS JOIN lab LEFT JOIN sims s ON s.req_id = r.req_id AND s.label = lab.label),
lmm AS (SELECT req_id, label, CASE WHEN blank THEN CAST(1.0 AS DOUBLE)
                  ELSE {sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')} END AS match
        FROM full_)"""

_PARAMS_SQL = f""",
params AS (SELECT *, {sql_preset(2)} AS gamma, CAST({sql_preset(3)} AS INTEGER) AS max_steps, {sql_preset(4)} AS sigma_km,
                  {sql_row('lat')} AS start_row, {sql_col('lng')} AS start_col FROM req),
cells AS (SELECT camis, cuisine, latest_grade, {sql_row('latitude')} AS row,
                 {sql_col('longitude')} AS col FROM ent
          WHERE latitude IS NOT NULL AND longitude IS NOT NULL
            AND latitude BETWEEN {K.LAT_MIN} AND {K.LAT_MAX}
            AND longitude BETWEEN {K.LNG_MIN} AND {K.LNG_MAX})"""

#: (req_id, camis, row, col, safety, w) of every pair: safety and weight under the grade reward.
GRADE_PAIRS_SQL = ENTITY_CTES + "," + REQUESTS_SQL + _LAB_SQL + _LABEL_MATCH_CTES + _PARAMS_SQL + f""",
mx AS (SELECT req_id, max(match) AS mx FROM lmm GROUP BY req_id),
pw AS (
  SELECT req_id, camis, row, col, safety, safety * match AS w FROM (
  SELECT p.req_id, c.camis, c.row, c.col, coalesce(l.match, CAST(0.05 AS DOUBLE)) AS match,
         CASE WHEN NOT {sql_blank('p.query')} AND p.importance > 0
                   AND coalesce(l.match, CAST(0.05 AS DOUBLE)) < p.importance * mx.mx THEN 0.0
              WHEN c.latest_grade = 'C' AND p.danger_filter THEN 0.0
              ELSE CASE c.latest_grade WHEN 'A' THEN 3.0 WHEN 'B' THEN 2.0 WHEN 'C' THEN 1.0
                   ELSE 0.0 END END::DOUBLE AS safety
  FROM params p CROSS JOIN cells c
  LEFT JOIN lmm l ON l.req_id = p.req_id AND l.label = c.cuisine
  LEFT JOIN mx ON mx.req_id = p.req_id))"""

GRADE_REWARD_SQL = GRADE_PAIRS_SQL + smooth_sql(_kernel_sql())


@register("grade_reward_grid", GRADE_REWARD_SQL + """
SELECT req_id, row, col, round(r, 9) AS r FROM n2 WHERE round(r, 9) > 0""")
def grade_reward_grid(spark, sf_dir):
    _p, _ls, rb = SR.grade_reward(requests(spark, sf_dir), _entities(spark, sf_dir))
    return rb.select("req_id", "row", "col", F.round("r", 9).alias("r")).where(F.col("r") > 0)


@register("grid_cells", ENTITY_CTES + f"""
SELECT camis, {sql_row('latitude')} AS grid_row, {sql_col('longitude')} AS grid_col,
       CAST({K.LAT_MIN} AS DOUBLE) + ({sql_row('latitude')} + CAST(0.5 AS DOUBLE))
         * CAST({K.GRID_LAT_RES} AS DOUBLE) AS centre_lat,
       CAST({K.LNG_MIN} AS DOUBLE) + ({sql_col('longitude')} + CAST(0.5 AS DOUBLE))
         * CAST({K.GRID_LNG_RES} AS DOUBLE) AS centre_lng
FROM ent WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND latitude BETWEEN {K.LAT_MIN} AND {K.LAT_MAX} AND longitude BETWEEN {K.LNG_MIN} AND {K.LNG_MAX}""")
def grid_cells(spark, sf_dir):
    c = G.entity_cells(entity_table(spark, sf_dir))
    return c.select("camis", "grid_row", "grid_col", row_to_lat("grid_row").alias("centre_lat"),
                    col_to_lng("grid_col").alias("centre_lng"))


@register("neighbour_cells", ENTITY_CTES + f""",
oc AS (SELECT DISTINCT {sql_row('latitude')} AS row, {sql_col('longitude')} AS col FROM ent
       WHERE latitude IS NOT NULL AND longitude IS NOT NULL
         AND latitude BETWEEN {K.LAT_MIN} AND {K.LAT_MAX}
         AND longitude BETWEEN {K.LNG_MIN} AND {K.LNG_MAX})
SELECT a.row, a.col, count(b.row) AS occupied_neighbours FROM oc a LEFT JOIN oc b
  ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 AND NOT (a.row = b.row AND a.col = b.col)
GROUP BY a.row, a.col""")
def neighbour_cells(spark, sf_dir):
    c = G.entity_cells(entity_table(spark, sf_dir)).select(
        F.col("grid_row").alias("row"), F.col("grid_col").alias("col")).distinct()
    nb = G.neighbours8(c.withColumn("req_id", F.lit(0)))
    hit = nb.join(c.select(F.col("row").alias("wrow"), F.col("col").alias("wcol")),
                  ["wrow", "wcol"]).groupBy("row", "col").agg(
        F.count(F.lit(1)).alias("occupied_neighbours"))
    return c.join(hit, ["row", "col"], "left").select(
        "row", "col", F.coalesce("occupied_neighbours", F.lit(0)).alias("occupied_neighbours"))


def _area_grades(spark, sf_dir, heat=False):
    return SR.area_search_grades(requests(spark, sf_dir), _entities(spark, sf_dir), heat=heat)


def _flat(res):
    return res.select("req_id", "preset", F.size("cell_path").alias("n_cells"),
                      F.size("grid_route").alias("n_route_points"),
                      F.round("dest_lat", 6).alias("dest_lat"), F.round("dest_lng", 6).alias("dest_lng"),
                      F.round("path_km", 6).alias("path_km"),
                      F.round("walk_minutes", 6).alias("walk_minutes"), "n_destination",
                      F.round("mean_destination_safety", 6).alias("mean_destination_safety"),
                      "n_warnings", "filter_applied",
                      F.array_join(F.transform("top_matches", lambda m: m["label"]), ",").alias("best_labels"),
                      "reference_name")


GRADE_PLAN_SQL = recursive(GRADE_REWARD_SQL) + plan_sql()
_TOP_GRADES_SQL = "SELECT req_id, label, match FROM lmm"


@register("area_search_grades", GRADE_PLAN_SQL + result_sql(_TOP_GRADES_SQL))
def area_search_grades(spark, sf_dir):
    res, _plan = _area_grades(spark, sf_dir)
    return _flat(res)


@register("request_presets", "WITH " + REQUESTS_SQL + f"""
SELECT req_id, preset, {sql_preset(1)} AS walk_km, {sql_preset(2)} AS gamma, CAST({sql_preset(3)} AS INTEGER) AS max_steps,
       {sql_preset(4)} AS sigma_km FROM req""")
def request_presets(spark, sf_dir):
    """IO7: the lookup table of walk presets, joined to the requests."""
    p = presets_table(spark).withColumnRenamed("name", "preset")
    return requests(spark, sf_dir).select("req_id", "preset").join(p, "preset")


_PLACES_SQL = "SELECT unnest([" + ", ".join(
    "{'i': %d, 'place': '%s', 'plat': CAST(%r AS DOUBLE), 'plng': CAST(%r AS DOUBLE)}" % (i, n.replace("'", "''"), lat, lng)
    for i, (n, lat, lng) in enumerate(K.PLACES)) + "], recursive := true)"


@register("place_starts", ENTITY_CTES + "," + REQUESTS_SQL + f""",
pla AS ({_PLACES_SQL}),
sta AS (SELECT req_id, coalesce(plat, lat) AS lat, coalesce(plng, lng) AS lng
       FROM req LEFT JOIN pla ON pla.i = req_id % {len(K.PLACES) + 2})
SELECT sta.req_id, {sql_row("sta.lat")} AS start_row, {sql_col("sta.lng")} AS start_col, count(e.camis) AS n_entities
FROM sta LEFT JOIN ent e ON e.latitude BETWEEN {K.LAT_MIN} AND {K.LAT_MAX} AND e.longitude BETWEEN {K.LNG_MIN} AND {K.LNG_MAX}
  AND abs({sql_row('e.latitude')} - {sql_row('sta.lat')}) <= 2 AND abs({sql_col('e.longitude')} - {sql_col('sta.lng')}) <= 2
GROUP BY 1, 2, 3""")
def place_starts(spark, sf_dir):
    """IO7: requests that start at a named place, with the entities around it."""
    req = requests(spark, sf_dir)
    names = F.array(*[F.lit(n) for n, _lat, _lng in K.PLACES])
    req = req.withColumn("place", F.get(names, (F.col("req_id") % (len(K.PLACES) + 2)).cast("int")))
    start = G.with_preset(at_places(req)).select("req_id", F.col("start_row").alias("dest_row"), F.col("start_col").alias("dest_col"))
    near = G.near_destination(start, G.entity_cells(entity_table(spark, sf_dir))).groupBy("req_id").agg(F.count(F.lit(1)).alias("n"))
    return start.join(near, "req_id", "left").select("req_id", F.col("dest_row").alias("start_row"), F.col("dest_col").alias("start_col"),
                                                     F.coalesce("n", F.lit(0)).alias("n_entities"))


@register("area_destinations", GRADE_PLAN_SQL + destination_sql() + """
SELECT req_id, camis, round(safety, 6) AS safety, round(w, 6) AS weighted FROM dest""")
def area_destinations(spark, sf_dir):
    """The contributing entities around every destination, as rows."""
    _res, plan = _area_grades(spark, sf_dir)
    req, ent = requests(spark, sf_dir), _entities(spark, sf_dir)
    return SR.grade_destinations(req, ent, plan).select("req_id", "camis", F.round("safety", 6).alias("safety"),
                                                        F.round("weighted", 6).alias("weighted"))


@register("area_warnings", GRADE_PLAN_SQL + warning_sql() + """
SELECT req_id, camis FROM warned""")
def area_warnings(spark, sf_dir):
    """The entities of the lowest grade along every path, as rows."""
    _res, plan = _area_grades(spark, sf_dir)
    return SR.path_warnings(requests(spark, sf_dir), _entities(spark, sf_dir), plan).select("req_id", "camis")


@register("value_paths", GRADE_PLAN_SQL + """
SELECT req_id, step, row, col, round(v, 9) AS v FROM paths""")
def value_paths(spark, sf_dir):
    _res, plan = _area_grades(spark, sf_dir)
    return plan.where(F.col("kind") == "path").select("req_id", "step", "row", "col",
                                                      F.round("v", 9).alias("v"))


@register("heat_map", GRADE_PLAN_SQL + heat_sql())
def heat_map(spark, sf_dir):
    _res, plan = _area_grades(spark, sf_dir, heat=True)
    return G.heat_extract(plan).withColumn("v", F.round("v", 9))


def _direct_sql(safety_ctes: str) -> str:
    """``safety_ctes`` end in a CTE ``safe`` (camis, safety_score)."""
    return _ENT_MATCH_SQL + safety_ctes + f""",
em AS (SELECT req_id, camis, {sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')} AS match
       FROM esims),
dparams AS (SELECT *, {sql_preset(1)} AS walk_km, {sql_preset(4)} AS sigma_km FROM req),
dcand AS (
  SELECT p.req_id, e.camis, e.latest_grade, abs(e.latitude - p.lat) > 1e-7 AND abs(e.longitude - p.lng) > 1e-7 AS corner, p.query, p.danger_filter, p.walk_km, p.sigma_km,
         sqrt(((e.latitude - p.lat) * CAST({K.METRES_PER_DEG_LAT} AS DOUBLE))
                * ((e.latitude - p.lat) * CAST({K.METRES_PER_DEG_LAT} AS DOUBLE))
              + ((e.longitude - p.lng) * CAST({K.METRES_PER_DEG_LNG} AS DOUBLE))
                * ((e.longitude - p.lng) * CAST({K.METRES_PER_DEG_LNG} AS DOUBLE)))
           / CAST(1000.0 AS DOUBLE) AS dist_km
  FROM dparams p CROSS JOIN ent e
  WHERE e.latitude IS NOT NULL AND e.longitude IS NOT NULL
    AND e.latitude BETWEEN {K.LAT_MIN} AND {K.LAT_MAX}
    AND e.longitude BETWEEN {K.LNG_MIN} AND {K.LNG_MAX}),
dsc AS (
  SELECT c.req_id, c.camis, c.dist_km, c.corner,
         (CASE WHEN c.latest_grade = 'C' AND c.danger_filter THEN CAST(0.0 AS DOUBLE)
               ELSE safe.safety_score END)
         * coalesce(em.match, CASE WHEN {sql_blank('c.query')} THEN CAST(1.0 AS DOUBLE)
                                   ELSE CAST(0.05 AS DOUBLE) END)
         * CASE WHEN c.dist_km > c.walk_km * CAST(1.5 AS DOUBLE) THEN CAST(0.0 AS DOUBLE)
                ELSE exp(-(c.dist_km * c.dist_km)
                         / (CAST(2.0 AS DOUBLE) * greatest(c.sigma_km, CAST(0.1 AS DOUBLE))
                            * greatest(c.sigma_km, CAST(0.1 AS DOUBLE)))) END AS score
  FROM dcand c JOIN safe ON safe.camis = c.camis LEFT JOIN em ON em.req_id = c.req_id AND em.camis = c.camis
  WHERE c.dist_km <= c.walk_km * CAST(1.5 AS DOUBLE)),
drk AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY score DESC, camis) AS rank
       FROM dsc WHERE score > 0)"""


_GRADE_SAFE_SQL = """,
safe AS (SELECT camis, coalesce(CASE latest_grade WHEN 'A' THEN 3.0 WHEN 'B' THEN 2.0 WHEN 'C' THEN 1.0 END, 2.0)::DOUBLE
  AS safety_score FROM ent)"""
_RANKED_SQL = """
SELECT drk.req_id, rank, camis, round(score, 9) AS combined_score, round(dist_km, 9) AS dist_km,
       count(*) OVER (PARTITION BY drk.req_id) AS n_candidates, n.dba AS reference_name
FROM drk LEFT JOIN (SELECT req_id, dba FROM refs JOIN ent ON ent.camis = ref_entity) n ON n.req_id = drk.req_id
WHERE rank <= 30"""


def _safety(spark, sf_dir, ent):
    model = B.fit_blend(ent)
    return B.safety_scores(model, ent)


def _entities(spark, sf_dir):
    """The entity table, written once: the model queries read it many times."""
    return cut_lineage(entity_table(spark, sf_dir))


_SAFE_BLEND_SQL = _GRADED_SQL + blend_ctes()

#: (req_id, camis, row, col, safety, w) of every pair under the model reward.
MODEL_REWARD_SQL = _ENT_MATCH_SQL + _EM_SQL + _LAB_SQL + _LABEL_TAIL_SQL + _SAFE_BLEND_SQL + _PARAMS_SQL + f""",
mx AS (SELECT req_id, max(match) AS mx FROM lmx GROUP BY req_id),
pw AS (
  SELECT p.req_id, c.camis, c.row, c.col, CASE WHEN c.latest_grade = 'C' AND p.danger_filter THEN CAST(0.0 AS DOUBLE) ELSE s.safety_score END AS safety,
         CASE WHEN c.latest_grade = 'C' AND p.danger_filter THEN CAST(0.0 AS DOUBLE) ELSE s.safety_score END
         * CASE WHEN NOT {sql_blank('p.query')} AND p.importance > 0
                     AND coalesce(l.match, CAST(0.05 AS DOUBLE)) < p.importance * mx.mx THEN CAST(0.0 AS DOUBLE)
                ELSE coalesce(em.match, CASE WHEN {sql_blank('p.query')} THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.05 AS DOUBLE) END) END AS w
  FROM params p CROSS JOIN cells c JOIN safe s ON s.camis = c.camis
  LEFT JOIN em ON em.req_id = p.req_id AND em.camis = c.camis
  LEFT JOIN lmx l ON l.req_id = p.req_id AND l.label = c.cuisine
  LEFT JOIN mx ON mx.req_id = p.req_id)""" + smooth_sql(_kernel_sql())


def _model_context(spark, sf_dir):
    ent, req = _entities(spark, sf_dir), requests(spark, sf_dir)
    return ent, req, SR.text_context(req, ent)


@register("model_reward_grid", MODEL_REWARD_SQL + """
SELECT req_id, row, col, round(r, 9) AS r FROM n2 WHERE round(r, 9) > 0""")
def model_reward_grid(spark, sf_dir):
    """The reward of model scores, aggregated below the similarity join."""
    ent, req, ctx = _model_context(spark, sf_dir)
    r = SR.model_reward(G.with_preset(req), G.entity_cells(ent), _safety(spark, sf_dir, ent), ctx)
    return r.select("req_id", "row", "col", F.round("r", 9).alias("r")).where(F.col("r") > 0)


@register("area_search_model", recursive(MODEL_REWARD_SQL) + plan_sql() + result_sql(
    "SELECT req_id, label, match FROM lmx", "SELECT req_id, dba AS reference_name FROM refs JOIN ent ON ent.camis = ref_entity"))
def area_search_model(spark, sf_dir):
    ent = _entities(spark, sf_dir)
    res, _plan = SR.area_search_model(requests(spark, sf_dir), ent, _safety(spark, sf_dir, ent))
    return _flat(res)


@register("direct_ranking", _direct_sql(_GRADED_SQL + blend_ctes()) + _RANKED_SQL)
def direct_ranking(spark, sf_dir):
    ent = _entities(spark, sf_dir)
    r = SR.direct_ranking(requests(spark, sf_dir), ent, _safety(spark, sf_dir, ent))
    return r.select("req_id", "rank", "camis", F.round("combined_score", 9).alias("combined_score"),
                    F.round("dist_km", 9).alias("dist_km"), "n_candidates", "reference_name")


@register("direct_label_matches", _direct_sql(_GRADE_SAFE_SQL) + _LAB_SQL + _LABEL_TAIL_SQL + f""",
tops AS (SELECT req_id, string_agg(label, ',' ORDER BY match DESC, label) AS labels FROM (
           SELECT lmx.* FROM lmx JOIN req ON req.req_id = lmx.req_id WHERE NOT {sql_blank('req.query')}
           QUALIFY row_number() OVER (PARTITION BY lmx.req_id ORDER BY match DESC, label) <= 5) GROUP BY req_id)
SELECT drk.req_id, drk.rank, drk.camis, t.labels AS best_labels FROM drk LEFT JOIN tops t ON t.req_id = drk.req_id WHERE rank <= 30""")
def direct_label_matches(spark, sf_dir):
    """G17 with the label matches (T15) that come with a ranking."""
    ent, req, ctx = _model_context(spark, sf_dir)
    r = SR.direct_ranking(req, ent, _grade_safety_frame(ent), ctx)
    return r.select("req_id", "rank", "camis", F.array_join(F.transform("top_matches", lambda m: m["label"]), ",").alias("best_labels"))


@register("direct_route", _direct_sql(_GRADED_SQL + blend_ctes()) + f"""
SELECT req_id, camis, rank, round(dist_km, 9) AS dist_km,
       round(dist_km / CAST({K.WALK_SPEED_KMH} AS DOUBLE) * CAST(60.0 AS DOUBLE), 9) AS walk_minutes,
       CASE WHEN corner THEN 3 ELSE 2 END AS n_route_points FROM drk WHERE rank = 1""")
def direct_route(spark, sf_dir):
    ent = _entities(spark, sf_dir)
    req = requests(spark, sf_dir)
    r = SR.direct_ranking(req, ent, _safety(spark, sf_dir, ent))
    out = SR.direct_route(r, req, current=0)
    return out.select("req_id", "camis", "rank", F.round("dist_km", 9).alias("dist_km"),
                      F.round("walk_minutes", 9).alias("walk_minutes"),
                      F.size("grid_route").alias("n_route_points"))


# --- J11 / G20: areas from nations grouped by region ----------------------------------------

def region_edges(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    lat, lng = entity_coordinates(F.col("n_nationkey") * F.lit(31) + F.lit(7))
    rings = n.groupBy(F.col("n_regionkey").alias("feature")).agg(
        F.sort_array(F.collect_list(F.struct("n_nationkey", F.array(lng, lat).alias("pt"))))
        .alias("v")).select("feature", F.lit(0).alias("ring"),
                            F.transform("v", lambda s: s["pt"]).alias("pts"))
    return edges_from_rings(rings)


def _sql_ll(k: str, which: str) -> str:
    from plumbline.plans.standins import _sql_lat, _sql_lng
    return (_sql_lat if which == "lat" else _sql_lng)(k)


POINT_IN_AREA_SQL = ENTITY_CTES + f""",
v AS (SELECT n_regionkey AS feature, 0 AS ring,
             row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i,
             count(*) OVER (PARTITION BY n_regionkey) AS cnt,
             {_sql_ll('(n_nationkey * 31 + 7)', 'lng')} AS x,
             {_sql_ll('(n_nationkey * 31 + 7)', 'lat')} AS y FROM nation),
e AS (SELECT a.feature, a.ring, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN v b
      ON a.feature = b.feature AND b.i = CASE WHEN a.i = 0 THEN a.cnt - 1 ELSE a.i - 1 END),
pts AS (SELECT camis, latitude AS py, longitude AS px FROM ent),
cr AS (SELECT p.camis, e.feature, e.ring,
              count(*) FILTER (WHERE (e.y1 > p.py) <> (e.y2 > p.py)
                AND p.px < (e.x2 - e.x1) * (p.py - e.y1) / (e.y2 - e.y1 + CAST(1e-12 AS DOUBLE)) + e.x1)
                AS k
       FROM pts p CROSS JOIN e GROUP BY 1, 2, 3)
SELECT camis, coalesce(max(k % 2 = 1), false) AS inside FROM cr GROUP BY camis"""


@register("point_in_area", POINT_IN_AREA_SQL)
def point_in_area(spark, sf_dir):
    ent = entity_table(spark, sf_dir)
    return G.point_in_polygons(ent, region_edges(spark, sf_dir), "camis", "latitude", "longitude")


# --- G15-G17 with grade-only safety: exact SQL twin -------------------------------------------

def _grade_safety_frame(ent):
    from plumbline.functions.columns import grade_safety
    return ent.select("camis", F.coalesce(grade_safety("latest_grade"), F.lit(K.NEUTRAL_SAFETY))
                      .alias("safety_score"))


@register("direct_ranking_grade_safety", _direct_sql(_GRADE_SAFE_SQL) + _RANKED_SQL)
def direct_ranking_grade_safety(spark, sf_dir):
    ent = _entities(spark, sf_dir)
    r = SR.direct_ranking(requests(spark, sf_dir), ent, _grade_safety_frame(ent))
    return r.select("req_id", "rank", "camis", F.round("combined_score", 9).alias("combined_score"),
                    F.round("dist_km", 9).alias("dist_km"), "n_candidates", "reference_name")
