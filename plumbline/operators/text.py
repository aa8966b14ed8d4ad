"""Text operators: char n-gram TF-IDF, sparse cosine, keyword expansion,
reference-name detection and match scores (T1-T15, J6, J7, J10).

Vectors are long tables ``(doc, gram, w)``.  Fitting is two aggregates
(term counts per doc, then document frequency per gram); transforming is an
inner join with the model table; the cosine product is a join on ``gram``
followed by ``sum(w1*w2)`` grouped by the pair, with map-side partial
aggregation so the shuffle carries one row per (query, doc) pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.columns import char_wb_grams, trim_all_space


CHARS_PER_TASK = 200_000  # text whose grams one task counts


def text_tasks(docs: DataFrame, text_col: str) -> int:
    """Tasks for the grams of ``docs``: they outweigh the texts by far, so the sizes
    that Spark goes by (of files, of shuffled texts) would leave them to a few tasks."""
    chars = docs.agg(F.sum(F.coalesce(F.length(text_col), F.lit(0)) + F.lit(1))).first()[0]
    return max(1, -(-(chars or 0) // CHARS_PER_TASK))


def doc_grams(docs: DataFrame, id_col: str, text_col: str, n_min=2, n_max=4) -> DataFrame:
    """T2 + T3 (raw counts): (id, gram, tf) over the whole text.

    The texts travel, dealt out by id in tasks of ``CHARS_PER_TASK``; their grams
    are counted where they are made."""
    d = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("_t"))
    d = d.repartition(text_tasks(d, "_t"), "doc")
    g = d.select("doc", F.explode(char_wb_grams(F.lower(F.col("_t")), n_min, n_max)).alias("gram"))
    return g.groupBy("doc", "gram").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_fit(docs: DataFrame, id_col: str, text_col: str, n_min=2, n_max=4,
              max_features: int | None = None) -> tuple[DataFrame, int]:
    """T4 + T5 + T7 (fit): model table (gram, idf) and the document count.

    idf = ln((1+n)/(1+df)) + 1 (smoothed); ``max_features`` keeps the grams
    with the largest corpus term frequency (ties -> smaller gram).
    """
    tf = doc_grams(docs, id_col, text_col, n_min, n_max)
    stats = tf.groupBy("gram").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))
    if max_features is not None:
        stats = stats.orderBy(F.col("ttf").desc(), F.col("gram")).limit(max_features)
    # the document count is a scalar subquery: computed once, no join
    n = docs.agg(F.count(F.lit(1))).scalar()
    model = stats.select(
        "gram", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)).alias("idf"))
    return model, n


def tfidf_weights(tf: DataFrame, model: DataFrame, sublinear: bool = True) -> DataFrame:
    """T3 + T6 + T7 (transform): unseen grams dropped, (1+ln tf)*idf, L2 row norm."""
    t = tf.join(model, "gram")
    raw = (F.lit(1.0) + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    t = t.select("doc", "gram", (raw * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return t.select("doc", "gram", (F.col("w") / norm).alias("w"))


def tfidf_transform(docs: DataFrame, id_col: str, text_col: str, model: DataFrame,
                    n_min=2, n_max=4) -> DataFrame:
    return tfidf_weights(doc_grams(docs, id_col, text_col, n_min, n_max), model)


def sparse_cosine(q: DataFrame, d: DataFrame, q_id="qid", d_id="did") -> DataFrame:
    """(qid, did, sim) for pairs sharing at least one gram.

    Inputs are L2-normalised long tables (doc, gram, w).  The join strategy
    is left to adaptive execution: the query side is broadcast when its
    measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
    otherwise the join stays a shuffle join.  Pairs without overlap are
    absent (callers left-join back and fill 0).
    """
    qq = q.select(F.col("doc").alias(q_id), "gram", F.col("w").alias("wq"))
    dd = d.select(F.col("doc").alias(d_id), "gram", F.col("w").alias("wd"))
    return dd.join(qq, "gram").groupBy(q_id, d_id).agg(F.sum(F.col("wq") * F.col("wd")).alias("sim"))


def scale_matches(sims: DataFrame, group: str, sim: str = "sim", blank: Column | None = None,
                  out: str = "match") -> DataFrame:
    """0.05 + 0.95*sim/max per group; max < 1e-8 -> 0.05; blank query -> 1.0."""
    mx = F.max(sim).over(Window.partitionBy(group))
    m = F.when(mx < 1e-8, F.lit(K.MIN_MATCH)).otherwise(
        F.lit(K.MIN_MATCH) + F.lit(1.0 - K.MIN_MATCH) * (F.col(sim) / mx))
    if blank is not None:
        m = F.when(blank, F.lit(1.0)).otherwise(m)
    return sims.withColumn(out, m)


def expand_query(q: str | Column) -> Column:
    """Lower + trim, then the expansions of every matching rule
    appended in rule order (one column expression, no join)."""
    d = F.lower(trim_all_space(F.col(q) if isinstance(q, str) else q))
    extras = F.filter(F.array(*[F.when(d.rlike(p), F.lit(e)) for p, e in K.KEYWORD_RULES]),
                      lambda x: x.isNotNull())
    return F.when(F.size(extras) > 0, F.concat(d, F.lit(" "), F.array_join(extras, " "))) \
            .otherwise(d)


def is_blank(c: str | Column) -> Column:
    cc = F.col(c) if isinstance(c, str) else c
    return cc.isNull() | (trim_all_space(cc) == "")


def entity_document(name="dba", label="cuisine", area="boro") -> Column:
    """lower(trim(name) + ' ' + trim(label) + ' ' + trim(area)); missing = ''."""
    def part(c):
        return trim_all_space(F.coalesce(F.col(c), F.lit("")))
    return F.lower(F.concat(part(name), F.lit(" "), part(label), F.lit(" "), part(area)))


NAME_PART = 20_000  # names of one trigram that one task checks

# --- T12 / J7: reference-name detection ------------------------------------------

def _query_tokens(requests: DataFrame, req_id: str, query: str) -> DataFrame:
    toks = F.split(F.lower(trim_all_space(F.col(query))), r"(?U)\s+")
    t = requests.select(F.col(req_id).alias("req"), F.posexplode(toks).alias("tokpos", "token"))
    return t.where((F.length("token") >= 3) & ~F.col("token").isin(*K.STOPWORDS))


def detect_reference(requests: DataFrame, entities: DataFrame, req_id="req_id", query="query",
                     name="dba", order="camis", min_score: int = 4) -> DataFrame:
    """(req, ref_entity, ref_score) for requests naming an entity.

    A token matches a name when either contains the other; score =
    min(len(token), len(name)); the best score wins, ties -> earlier token,
    then earlier entity; a match needs score >= ``min_score``.

    Exact, with equi-joins only: "name inside token" joins every substring
    (length >= 3) of the short query tokens to the names; "token inside
    name" joins each token's rarest trigram to an index of name trigrams and
    then checks ``contains``, once per distinct token.
    """
    toks = _query_tokens(requests, req_id, query)
    names = entities.select(F.col(order).alias("ent"),
                            F.lower(trim_all_space(F.coalesce(F.col(name), F.lit("")))).alias("nm")) \
                    .where(F.length("nm") >= 3) \
                    .groupBy("nm").agg(F.min("ent").alias("ent"))  # of equal names only the first can win
    # name inside token
    subs = toks.select("req", "tokpos", "token", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(3), F.length("token")),
        lambda L: F.transform(F.sequence(F.lit(1), F.length("token") - L + F.lit(1)),
                              lambda i: F.substring(F.col("token"), i, L))))).alias("nm")).distinct()
    a = subs.join(names, "nm").select("req", "tokpos", "token", "ent", "nm")
    # token inside name: a name that holds the token holds each of its trigrams, so the
    # token's rarest one is looked up; a long list of names is cut into parts
    def trigrams(c: str) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(c) - F.lit(2)), lambda i: F.substring(F.col(c), i, 3))
    tri = names.select("ent", "nm", F.explode(F.array_distinct(trigrams("nm"))).alias("tri"))
    sizes = tri.groupBy("tri").agg(F.count(F.lit(1)).alias("names"))
    tt = toks.select("token", F.explode(F.array_distinct(trigrams("token"))).alias("tri")).distinct()
    # a trigram that no name holds settles its token
    rare = tt.join(sizes, "tri", "left").groupBy("token").agg(
        F.min_by(F.struct("tri", "names"), F.struct(F.coalesce("names", F.lit(0)), "tri")).alias("r")) \
        .where(F.col("r.names").isNotNull()).select("token", "r.tri", F.ceil(F.col("r.names") / F.lit(NAME_PART)).cast("int").alias("parts"))
    used = rare.groupBy("tri").agg(F.max("parts").alias("parts"))
    lists = tri.join(used, "tri").withColumn("part", F.pmod(F.xxhash64("ent"), F.col("parts").cast("long")))
    hits = rare.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1))) \
        .join(lists.drop("parts"), ["tri", "part"]).where(F.contains(F.col("nm"), F.col("token"))).select("token", "ent", "nm")
    # of the names that hold a token only the best can win: the score is the token's length for all of them
    hits = hits.groupBy("token").agg(F.min_by(F.struct("ent", "nm"), "ent").alias("h")).select("token", "h.*")
    b = toks.join(hits, "token").select("req", "tokpos", "token", "ent", "nm")
    cand = a.unionByName(b).distinct().withColumn(
        "score", F.least(F.length("token"), F.length("nm")))
    best = cand.groupBy("req").agg(F.max_by(F.struct("score", "ent"),
                                            F.struct("score", -F.col("tokpos"), -F.col("ent")))
                                   .alias("b"))
    return best.select(F.col("req").alias(req_id), F.col("b.ent").alias("ref_entity"),
                       F.col("b.score").alias("ref_score")).where(F.col("ref_score") >= min_score)


def reference_label_scores(ref_label: Column, label: Column) -> Column:
    """Same label 1.0; either contains the other (lower-case) 0.6; else 0.08."""
    rl, lb = F.lower(ref_label), F.lower(label)
    return (F.when(label == ref_label, F.lit(K.REFERENCE_SAME_LABEL))
            .when(F.contains(lb, rl) | F.contains(rl, lb), F.lit(K.REFERENCE_RELATED_LABEL))
            .otherwise(F.lit(K.REFERENCE_OTHER_LABEL)))
