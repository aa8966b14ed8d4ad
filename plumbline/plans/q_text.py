"""Queries for the text operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import char_wb_grams, normalise_name, rounded
from plumbline.operators import match as MT
from plumbline.operators import text as X
from plumbline.plans.catalog import register
from plumbline.plans.q_entity import ENTITY_CTES, entity_table
from plumbline.plans.standins import REQUESTS_SQL, requests, table
from plumbline.session import cut_lineage

# --- SQL building blocks (DuckDB) --------------------------------------------------


def sql_trim(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def sql_tf(n: str, docs: str) -> str:
    """(doc, gram, tf) of word-bounded 2..4-grams over the whole text."""
    return f"""
{n}_w AS (SELECT doc, ' ' || w || ' ' AS w FROM (
    SELECT doc, unnest(regexp_split_to_array(lower(text), '\\s+')) AS w FROM {docs}) WHERE w <> ''),
{n}_tf AS (SELECT doc, substr(w, i, n) AS gram, count(*) AS tf
           FROM {n}_w, generate_series(2, 4) g(n), generate_series(1, length(w)) s(i)
           WHERE i <= length(w) - n + 1 GROUP BY doc, gram)"""


def sql_model(n: str, docs: str, max_features: int | None = None) -> str:
    cap = f"ORDER BY ttf DESC, gram LIMIT {max_features}" if max_features else ""
    return f"""
{n}_df AS (SELECT gram, count(*) AS df, sum(tf) AS ttf FROM {n}_tf GROUP BY gram {cap}),
{n}_model AS (SELECT gram, ln((CAST(1 AS DOUBLE) + (SELECT count(*) FROM {docs}))
                             / (CAST(1 AS DOUBLE) + df)) + 1 AS idf FROM {n}_df)"""


def sql_vec(n: str, model: str) -> str:
    return f"""
{n}_raw AS (SELECT t.doc, t.gram, (1 + ln(t.tf)) * m.idf AS w FROM {n}_tf t JOIN {model} m
            ON m.gram = t.gram),
{n}_vec AS (SELECT doc, gram, w / sqrt(sum(w * w) OVER (PARTITION BY doc)) AS w FROM {n}_raw)"""


def sql_expand(q: str) -> str:
    d = f"lower({sql_trim(q)})"
    items = ", ".join(f"CASE WHEN regexp_matches({d}, '{p}') THEN '{e}' END"
                      for p, e in K.KEYWORD_RULES)
    arr = f"list_filter([{items}], lambda x: x IS NOT NULL)"
    return f"CASE WHEN len({arr}) > 0 THEN {d} || ' ' || array_to_string({arr}, ' ') ELSE {d} END"


def sql_blank(q: str) -> str:
    return f"({q} IS NULL OR {sql_trim(q)} = '')"


def sql_preset(i: int) -> str:
    default = next(p[i] for p in K.WALK_PRESETS if p[0] == K.DEFAULT_PRESET)
    return ("coalesce(CASE preset " + " ".join(f"WHEN '{p[0]}' THEN CAST({p[i]} AS DOUBLE)"
                                               for p in K.WALK_PRESETS)
            + f" END, CAST({default} AS DOUBLE))")


def sql_scale(sim: str, mx: str) -> str:
    return (f"CASE WHEN {mx} < CAST(1e-8 AS DOUBLE) THEN CAST(0.05 AS DOUBLE) ELSE "
            f"CAST(0.05 AS DOUBLE) + CAST(0.95 AS DOUBLE) * ({sim} / {mx}) END")


_STOP = ", ".join(f"'{w}'" for w in K.STOPWORDS)

# --- T1, T2, T3-T7 on part names ----------------------------------------------------


@register("name_normalise", """
SELECT c_custkey AS id, trim(regexp_replace(regexp_replace(lower(c_name),
       '[!-/:-@\\[-`{-~]', '', 'g'), '\\s+', ' ', 'g')) AS name_norm FROM customer
UNION ALL
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name),
       '[!-/:-@\\[-`{-~]', '', 'g'), '\\s+', ' ', 'g')) FROM part""")
def name_normalise(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"),
                                                normalise_name("c_name").alias("name_norm"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"),
                                            normalise_name("p_name").alias("name_norm"))
    return c.unionByName(p)


TFIDF_CAP = 50_000  # the vocabulary limit is operator T4 and applies in tfidf_model alone

_PART_DOCS = "pd AS (SELECT p_partkey AS doc, p_name AS text FROM part)"


@register("char_grams", "WITH " + _PART_DOCS + "," + sql_tf("p", "pd")
          + "\nSELECT doc, gram, tf FROM p_tf")
def char_grams(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return X.doc_grams(part, "p_partkey", "p_name")


@register("char_grams_words", """
SELECT c_custkey AS id, count(*) AS n_grams FROM (
  SELECT c_custkey, ' ' || w || ' ' AS w FROM (
    SELECT c_custkey, unnest(regexp_split_to_array(lower(c_mktsegment || ' ' || c_name), '\\s+')) AS w
    FROM customer) WHERE w <> ''), generate_series(2, 4) g(n), generate_series(1, length(w)) s(i)
WHERE i <= length(w) - n + 1 GROUP BY c_custkey""")
def char_grams_words(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    g = char_wb_grams(F.lower(F.concat_ws(" ", "c_mktsegment", "c_name")))
    return c.select(F.col("c_custkey").alias("id"), F.size(g).cast("long").alias("n_grams"))


@register("tfidf_model", "WITH " + _PART_DOCS + "," + sql_tf("p", "pd") + ","
          + sql_model("p", "pd", TFIDF_CAP) + "\nSELECT gram, round(idf, 9) AS idf FROM p_model")
def tfidf_model(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    model, _n = X.tfidf_fit(part, "p_partkey", "p_name", max_features=TFIDF_CAP)
    return model.select("gram", F.round("idf", 9).alias("idf"))


@register("tfidf_vectors", "WITH " + _PART_DOCS + "," + sql_tf("p", "pd") + ","
          + sql_model("p", "pd") + "," + sql_vec("p", "p_model")
          + "\nSELECT doc, gram, round(w, 9) AS w FROM p_vec")
def tfidf_vectors(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    model, _n = X.tfidf_fit(part, "p_partkey", "p_name")
    v = X.tfidf_transform(part, "p_partkey", "p_name", model)
    return v.select("doc", "gram", F.round("w", 9).alias("w"))


# --- requests -------------------------------------------------------------------------

@register("keyword_expansion", "WITH " + REQUESTS_SQL + f"""
SELECT req_id, {sql_expand('query')} AS expanded, {sql_blank('query')} AS blank FROM req""")
def keyword_expansion(spark, sf_dir):
    r = requests(spark, sf_dir)
    return r.select("req_id", X.expand_query("query").alias("expanded"),
                    X.is_blank("query").alias("blank"))


_ENT_DOC = (f"lower({sql_trim('coalesce(dba, {})')} || ' ' || {sql_trim('coalesce(cuisine, {})')}"
            f" || ' ' || {sql_trim('coalesce(boro, {})')})").replace("{}", "''")


@register("entity_documents", ENTITY_CTES + f"\nSELECT camis, {_ENT_DOC} AS doc FROM ent")
def entity_documents(spark, sf_dir):
    return entity_table(spark, sf_dir).select("camis", X.entity_document().alias("doc"))


_REF_SQL = ENTITY_CTES + "," + REQUESTS_SQL + f""",
tok0 AS (SELECT req_id, regexp_split_to_array(lower({sql_trim('query')}), '\\s+') AS toks FROM req),
tok AS (SELECT req_id, tokpos, token FROM (
          SELECT req_id, unnest(toks) AS token, generate_subscripts(toks, 1) - 1 AS tokpos FROM tok0)
        WHERE length(token) >= 3 AND token NOT IN ({_STOP})),
nm AS (SELECT camis AS ent, lower({sql_trim("coalesce(dba, '')")}) AS nm FROM ent
       WHERE length(lower({sql_trim("coalesce(dba, '')")})) >= 3),
cand AS (SELECT t.req_id, t.tokpos, e.ent, least(length(t.token), length(e.nm)) AS score
         FROM tok t JOIN nm e ON contains(e.nm, t.token) OR contains(t.token, e.nm)),
refs AS (SELECT req_id, ent AS ref_entity, score AS ref_score FROM (
           SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY score DESC, tokpos, ent) AS rn
           FROM cand) WHERE rn = 1 AND score >= 4)"""


def _refs(spark, sf_dir):
    return X.detect_reference(requests(spark, sf_dir), entity_table(spark, sf_dir))


@register("reference_detection", _REF_SQL + "\nSELECT req_id, ref_entity, CAST(ref_score AS INTEGER) AS ref_score FROM refs")
def reference_detection(spark, sf_dir):
    return _refs(spark, sf_dir)


_LAB_SQL = ",\nlab AS (SELECT DISTINCT cuisine AS label FROM ent WHERE cuisine IS NOT NULL)"


@register("label_matcher", ENTITY_CTES + "," + REQUESTS_SQL + _LAB_SQL + """,
ld AS (SELECT label AS doc, lower(label) AS text FROM lab),""" + sql_tf("l", "ld") + ","
          + sql_model("l", "ld") + "," + sql_vec("l", "l_model") + f""",
qd AS (SELECT req_id AS doc, {sql_expand('query')} AS text FROM req WHERE NOT {sql_blank('query')}),"""
          + sql_tf("q", "qd") + "," + sql_vec("q", "l_model") + f""",
sims AS (SELECT q.doc AS req_id, l.doc AS label, sum(q.w * l.w) AS sim
         FROM q_vec q JOIN l_vec l ON l.gram = q.gram GROUP BY 1, 2),
full_ AS (SELECT r.req_id, {sql_blank('r.query')} AS blank, lab.label,
                 coalesce(s.sim, CAST(0 AS DOUBLE)) AS sim
          FROM req r CROSS JOIN lab LEFT JOIN sims s ON s.req_id = r.req_id AND s.label = lab.label)
SELECT req_id, label, round(CASE WHEN blank THEN CAST(1.0 AS DOUBLE)
                            ELSE {sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')} END, 9)
       AS match FROM full_""")
def label_matcher(spark, sf_dir):
    labs = entity_table(spark, sf_dir).where(F.col("cuisine").isNotNull()).select(
        F.col("cuisine").alias("label"))
    m = MT.label_matcher(requests(spark, sf_dir), labs)
    return m.select("req_id", "label", F.round("match", 9).alias("match"))


_ENT_MODEL_SQL = f""",
edocs AS (SELECT camis AS doc, {_ENT_DOC} AS text FROM ent),""" + sql_tf("e", "edocs") + "," \
    + sql_model("e", "edocs") + "," + sql_vec("e", "e_model")

_ENT_MATCH_SQL = _REF_SQL + _ENT_MODEL_SQL + f""",
qd AS (SELECT req_id AS doc, {sql_expand('query')} AS text FROM req
       WHERE NOT {sql_blank('query')} AND req_id NOT IN (SELECT req_id FROM refs)),""" \
    + sql_tf("q", "qd") + "," + sql_vec("q", "e_model") + """,
qv AS (SELECT doc, gram, w FROM q_vec
       UNION ALL SELECT r.req_id, v.gram, v.w FROM refs r JOIN e_vec v ON v.doc = r.ref_entity),
esims AS (SELECT q.doc AS req_id, e.doc AS camis, round(sum(q.w * e.w), 12) AS sim
          FROM qv q JOIN e_vec e ON e.gram = q.gram GROUP BY 1, 2)"""


_EM_SQL = f""",
em AS (SELECT req_id, camis, {sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')} AS match
       FROM esims)"""

#: What text matching reads of an entity; nothing else is built for it.
ENT_TEXT = ["camis", "dba", "cuisine", "boro"]


def _text_match(spark, sf_dir):
    ent = cut_lineage(entity_table(spark, sf_dir).select(*ENT_TEXT))
    req = requests(spark, sf_dir)
    model, vecs = MT.entity_text_model(ent)
    return req, ent, MT.text_match(req, cut_lineage(model), vecs, X.detect_reference(req, ent))


def _entity_match(spark, sf_dir):
    ent = cut_lineage(entity_table(spark, sf_dir).select(*ENT_TEXT))
    req = requests(spark, sf_dir)
    model, vecs = MT.entity_text_model(ent)
    m = MT.entity_match(req, cut_lineage(model), vecs, X.detect_reference(req, ent))
    return m.select("req_id", "camis", rounded(F.col("match"), 9).alias("match"))


@register("entity_match", _ENT_MATCH_SQL + f"""
SELECT req_id, camis, round({sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')}, 9) AS match
FROM esims""")
def entity_match(spark, sf_dir):
    """The match of every (request, entity) pair that shares a gram."""
    return _entity_match(spark, sf_dir)


@register("entity_match_top", _ENT_MATCH_SQL + _EM_SQL + """
SELECT req_id, camis, round(match, 9) AS match, rank FROM (
  SELECT em.req_id, em.camis, em.match, row_number() OVER (PARTITION BY em.req_id ORDER BY esims.sim DESC, em.camis) AS rank
  FROM em JOIN esims ON esims.req_id = em.req_id AND esims.camis = em.camis) WHERE rank <= 30""")
def entity_match_top(spark, sf_dir):
    """T14 + W8: the 30 best matches of every request, from all pairs scored in blocks."""
    _req, _ent, tm = _text_match(spark, sf_dir)
    return MT.entity_match_top(tm, 30).select("req_id", "camis", F.round("match", 9).alias("match"), "rank")


@register("entity_match_all", _ENT_MATCH_SQL + f"""
SELECT req_id, camis, round({sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')}, 9) AS match
FROM esims""")
def entity_match_all(spark, sf_dir):
    return _entity_match(spark, sf_dir)


_LABEL_TAIL_SQL = """,
ld AS (SELECT label AS doc, lower(label) AS text FROM lab),""" + sql_tf("l", "ld") + "," \
    + sql_vec("l", "e_model") + f""",
rl AS (SELECT r.req_id, coalesce(e.cuisine, '') AS ref_label FROM refs r JOIN ent e
       ON e.camis = r.ref_entity),
sims AS (SELECT q.doc AS req_id, l.doc AS label, sum(q.w * l.w) AS sim
         FROM q_vec q JOIN l_vec l ON l.gram = q.gram GROUP BY 1, 2),
full_ AS (SELECT r.req_id, {sql_blank('r.query')} AS blank, lab.label, rl.ref_label,
                 coalesce(s.sim, CAST(0 AS DOUBLE)) AS sim
          FROM req r CROSS JOIN lab LEFT JOIN sims s ON s.req_id = r.req_id AND s.label = lab.label
          LEFT JOIN rl ON rl.req_id = r.req_id),
lmx AS (
SELECT req_id, label, CASE WHEN blank THEN CAST(1.0 AS DOUBLE)
         WHEN ref_label IS NOT NULL THEN
           CASE WHEN label = ref_label THEN CAST(1.0 AS DOUBLE)
                WHEN contains(lower(label), lower(ref_label)) OR contains(lower(ref_label), lower(label))
                  THEN CAST(0.6 AS DOUBLE) ELSE CAST(0.08 AS DOUBLE) END
         ELSE {sql_scale('sim', 'max(sim) OVER (PARTITION BY req_id)')} END AS match FROM full_)"""

_ENT_LABEL_SQL = _ENT_MATCH_SQL + _LAB_SQL + _LABEL_TAIL_SQL + """,
lm AS (SELECT req_id, label, round(match, 9) AS match FROM lmx)"""


def _entity_label_match(spark, sf_dir):
    ent = cut_lineage(entity_table(spark, sf_dir).select(*ENT_TEXT))
    req = requests(spark, sf_dir)
    model, _vecs = MT.entity_text_model(ent)
    labs = cut_lineage(ent.where(F.col("cuisine").isNotNull()).select(F.col("cuisine").alias("label")).distinct())
    return MT.label_match_from_entities(req, labs, cut_lineage(model), cut_lineage(X.detect_reference(req, ent)), ent)


@register("entity_label_match", _ENT_LABEL_SQL + "\nSELECT * FROM lm")
def entity_label_match(spark, sf_dir):
    m = _entity_label_match(spark, sf_dir)
    return m.select("req_id", "label", F.round("match", 9).alias("match"))


@register("top_label_matches", _ENT_LABEL_SQL + f"""
SELECT req_id, label, match, rank FROM (
  SELECT lm.*, row_number() OVER (PARTITION BY lm.req_id ORDER BY match DESC, label) AS rank
  FROM lm JOIN req ON req.req_id = lm.req_id WHERE NOT {sql_blank('req.query')}) WHERE rank <= 5""")
def top_label_matches(spark, sf_dir):
    m = _entity_label_match(spark, sf_dir).withColumn("match", F.round("match", 9))
    return MT.top_label_matches(m, requests(spark, sf_dir), 5).select("req_id", "label", "match",
                                                                        "rank")
