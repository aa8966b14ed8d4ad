"""Request-level text matching (T9, T13-T15) built from the text operators.

Requests are a table ``(req_id, query, ...)``; every output is keyed by
``req_id``.  The TF-IDF models are fitted once per call and reused by all
requests (the single-request original refits per request).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import rounded
from plumbline.operators import sparse as SP
from plumbline.operators import text as X
from plumbline.session import cut_lineage

LABEL_BUCKETS = 32


def request_label_pairs(requests: DataFrame, labels: DataFrame, req_id="req_id",
                        label="label") -> DataFrame:
    """Every (request, label) pair: the output itself is this product.

    Labels are hashed into ``LABEL_BUCKETS`` buckets and each request meets every
    bucket in an equi-join, so the product is spread over the buckets and
    neither side is collected anywhere.
    """
    labs = labels.select(F.col(label).alias("label")).distinct()
    lb = labs.withColumn("_b", F.pmod(F.xxhash64("label"), F.lit(LABEL_BUCKETS)).cast("int"))
    rb = requests.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(LABEL_BUCKETS - 1))))
    return rb.join(lb, "_b").drop("_b")


def label_matcher(requests: DataFrame, labels: DataFrame, req_id="req_id", query="query",
                  label="label") -> DataFrame:
    """T15 (label-fitted variant): TF-IDF fitted on the lower-cased labels;
    the expanded query is scored against every label and scaled (T9).
    Returns (req_id, label, match)."""
    labs = labels.select(F.col(label).alias("label")).distinct()
    lab_docs = labs.select(F.col("label").alias("doc_id"), F.lower("label").alias("text"))
    model, _n = X.tfidf_fit(lab_docs, "doc_id", "text")
    lab_vec = X.tfidf_transform(lab_docs, "doc_id", "text", model)
    q = requests.select(F.col(req_id).alias("req"), X.expand_query(query).alias("text"),
                        X.is_blank(query).alias("blank"))
    q_vec = X.tfidf_transform(q.where(~F.col("blank")), "req", "text", model)
    sims = X.sparse_cosine(q_vec, lab_vec, "req", "label")
    pairs = request_label_pairs(q.select("req", "blank"), labs, "req")
    full = pairs.join(sims, ["req", "label"], "left").withColumn(
        "sim", F.coalesce("sim", F.lit(0.0)))
    out = X.scale_matches(full, "req", blank=F.col("blank"))
    return out.select(F.col("req").alias(req_id), "label", "match")


def entity_text_model(entities: DataFrame, id_col="camis", max_features: int | None = None):
    """T11 + fit: entity documents, their model and their vectors."""
    docs = entities.select(F.col(id_col).alias("doc_id"), X.entity_document().alias("text"))
    model, _n = X.tfidf_fit(docs, "doc_id", "text", max_features=max_features)
    vecs = X.tfidf_transform(docs, "doc_id", "text", model)
    return model, vecs


@dataclass(frozen=True)
class TextMatch:
    """Requests against entity documents, before any pair is scored.

    ``asks``: (req, ask) of requests that have a query vector, requests with one
    text or one reference sharing an ask; ``q``: the asks' vectors; ``d``: the
    entities' vectors; ``best``: (ask, top), each ask's highest similarity;
    ``defaults``: (req_id, default_match)."""

    asks: DataFrame
    q: DataFrame
    d: DataFrame
    best: DataFrame
    defaults: DataFrame


def request_vectors(requests: DataFrame, model: DataFrame, ent_vecs: DataFrame, refs: DataFrame,
                    req_id="req_id", query="query") -> tuple[DataFrame, DataFrame]:
    """T14, the query side: ((req, ask, ref_entity), vectors of the asks).

    A request naming an entity (``refs`` from T12) uses that entity's own
    vector as the query; others use the expanded text."""
    q = requests.select(F.col(req_id).alias("req"), X.expand_query(query).alias("text"),
                        X.is_blank(query).alias("blank"))
    r = refs.select(F.col(req_id).alias("req"), "ref_entity")
    # requests with one text, or one reference, are one query
    asked = q.join(r, "req", "left").where(~F.col("blank") | F.col("ref_entity").isNotNull()).select(
        "req", "ref_entity", "text", F.when(F.col("ref_entity").isNotNull(), F.concat(F.lit("r"), F.col("ref_entity").cast("string")))
        .otherwise(F.concat(F.lit("t"), F.col("text"))).alias("ask"))
    asked = cut_lineage(asked)
    v_text = X.tfidf_transform(asked.where(F.col("ref_entity").isNull()).select("ask", "text").distinct(), "ask", "text", model)
    v_ref = asked.where(F.col("ref_entity").isNotNull()).select("ask", "ref_entity").distinct() \
                 .join(ent_vecs.withColumnRenamed("doc", "ref_entity"), "ref_entity") \
                 .select(F.col("ask").alias("doc"), "gram", "w")
    return asked.select("req", "ask", "ref_entity"), v_text.unionByName(v_ref)


def text_match(requests: DataFrame, model: DataFrame, ent_vecs: DataFrame, refs: DataFrame,
               req_id="req_id", query="query") -> TextMatch:
    """The query side and each ask's highest similarity (the scaling of T9 needs
    it): an entity's own vector is its best match; for a text it is searched for."""
    d = cut_lineage(ent_vecs)
    asked, q = request_vectors(requests, model, d, refs, req_id, query)
    asked, q = cut_lineage(asked), cut_lineage(q)
    own = SP.pair_cosine(asked.where(F.col("ref_entity").isNotNull()).select("ask", F.col("ref_entity").alias("doc")), q, d)
    texts = q.join(asked.where(F.col("ref_entity").isNull()).select(F.col("ask").alias("doc")).distinct(), "doc", "left_semi")
    best = own.unionByName(SP.top_cosine(texts, d).drop("rank")).select("ask", F.col("sim").alias("top"))
    return TextMatch(asked.select("req", "ask"), q, d, cut_lineage(best),
                     default_match(requests, req_id, query).withColumnRenamed(req_id, "req_id"))


def scaled(sim: Column, top: Column) -> Column:
    """T9 with the highest similarity given; nothing alike -> the least match."""
    return F.when(F.coalesce(top, F.lit(0.0)) < 1e-8, F.lit(K.MIN_MATCH)).otherwise(
        F.lit(K.MIN_MATCH) + F.lit(1.0 - K.MIN_MATCH) * (F.coalesce(sim, F.lit(0.0)) / top))


def match_pairs(tm: TextMatch, pairs: DataFrame, id_col="camis") -> DataFrame:
    """``pairs`` (req_id, entity, ...) with their match in [0.05, 1] and all
    their columns; exact, and no other pair is scored."""
    p = pairs.join(tm.defaults, "req_id").join(tm.asks.withColumnRenamed("req", "req_id"), "req_id", "left").join(tm.best, "ask", "left")
    sims = SP.pair_cosine(p.where(F.col("top").isNotNull()).select("ask", F.col(id_col).alias("doc")), tm.q, tm.d) \
             .withColumnRenamed("doc", id_col)
    p = p.join(sims, ["ask", id_col], "left")
    m = F.when(F.col("ask").isNull(), F.col("default_match")).otherwise(scaled(F.col("sim"), F.col("top")))
    return p.withColumn("match", m).drop("ask", "top", "sim", "default_match")


def entity_match_top(tm: TextMatch, k: int = 30, id_col="camis") -> DataFrame:
    """T14 + W8: (req_id, entity, match, rank), the k best matches of every request
    that has a query (ties -> smaller entity)."""
    best = SP.top_cosine(tm.q, tm.d, k).join(tm.best, "ask").withColumn("match", scaled(F.col("sim"), F.col("top")))
    return best.join(tm.asks, "ask").select(F.col("req").alias("req_id"), F.col("doc").alias(id_col), "match", "rank")


def entity_match(requests: DataFrame, model: DataFrame, ent_vecs: DataFrame,
                 refs: DataFrame, req_id="req_id", query="query", id_col="camis") -> DataFrame:
    """The match in [0.05, 1] of every (request, entity) pair that shares a
    gram: the output has nearly all pairs where grams are frequent.  Callers that
    need certain pairs use :func:`match_pairs`, or the best :func:`entity_match_top`.

    Every other entity scores the request default (:func:`default_match`: 1.0 for
    a blank query, else 0.05, exactly what the scaling gives a zero similarity).
    """
    tm = text_match(requests, model, ent_vecs, refs, req_id, query)
    # requests with one query share its similarities, and travel with it
    asks = tm.asks.groupBy("ask").agg(F.collect_list(F.struct("req")).alias("reqs")).join(tm.best, "ask", "left")
    pairs = SP.block_pairs(tm.q, tm.d, asks.select("ask", F.struct("reqs", "top").alias("held")))
    out = pairs.select("doc", scaled(rounded(F.col("raw"), SP.SIM_DIGITS), F.col("held.top")).alias("match"), F.explode("held.reqs").alias("r"))
    return out.select(F.col("r.req").alias(req_id), F.col("doc").alias(id_col), "match")


def default_match(requests: DataFrame, req_id="req_id", query="query") -> DataFrame:
    """Match of an entity sharing no gram with the request."""
    return requests.select(req_id, F.when(X.is_blank(query), F.lit(1.0))
                           .otherwise(F.lit(0.05)).alias("default_match"))


def label_match_from_entities(requests: DataFrame, labels: DataFrame, model: DataFrame,
                              refs: DataFrame, entities: DataFrame, req_id="req_id",
                              query="query", label="label", id_col="camis",
                              label_col="cuisine") -> DataFrame:
    """T13 + T15 (entity-vocabulary variant): per (request, label).

    Reference found -> 1.0 / 0.6 / 0.08 against the reference's label;
    otherwise the label text is scored in the *entity* model; blank -> 1.0.
    """
    labs = labels.select(F.col(label).alias("label")).distinct()
    q = requests.select(F.col(req_id).alias("req"), X.expand_query(query).alias("text"),
                        X.is_blank(query).alias("blank"))
    ref_lab = refs.join(entities.select(F.col(id_col).alias("ref_entity"),
                                        F.coalesce(F.col(label_col), F.lit("")).alias("ref_label")),
                        "ref_entity").select(F.col(req_id).alias("req"), "ref_label")
    lab_vec = X.tfidf_transform(labs.select(F.col("label").alias("doc_id"),
                                            F.lower("label").alias("text")),
                                "doc_id", "text", model)
    q_vec = X.tfidf_transform(q.where(~F.col("blank")).join(ref_lab, "req", "left_anti"),
                              "req", "text", model)
    sims = X.sparse_cosine(q_vec, lab_vec, "req", "label")
    pairs = request_label_pairs(q.select("req", "blank"), labs, "req")
    full = pairs.join(sims, ["req", "label"], "left").join(ref_lab, "req", "left") \
                .withColumn("sim", F.coalesce("sim", F.lit(0.0)))
    scaled = X.scale_matches(full, "req", blank=F.col("blank"))
    m = F.when(F.col("blank"), F.lit(1.0)).when(
        F.col("ref_label").isNotNull(),
        X.reference_label_scores(F.col("ref_label"), F.col("label"))).otherwise(F.col("match"))
    return scaled.select(F.col("req").alias(req_id), "label", m.alias("match"))


def top_label_matches(matches: DataFrame, requests: DataFrame, n: int = 5, req_id="req_id",
                      query="query") -> DataFrame:
    """N best labels per non-blank request (ties -> label order)."""
    from pyspark.sql import Window
    nonblank = requests.where(~X.is_blank(query)).select(req_id)
    m = matches.join(nonblank, req_id, "left_semi")
    w = Window.partitionBy(req_id).orderBy(F.col("match").desc(), F.col("label"))
    return m.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
