"""Pruned and pieced forms of the operators against plain versions: sparse
search, running sums, grouped KNN, parallel CSV, rarest trigrams."""
import csv
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import grid as G
from plumbline.operators import knn as N
from plumbline.operators import match as MT
from plumbline.operators import profile as P
from plumbline.operators import ranges as R
from plumbline.operators import search as SR
from plumbline.operators import sparse as SP
from plumbline.operators import text as X
from plumbline.sources import files as S
from tests.conftest import SF0001


def vectors(spark, seed, n, hot=0.34):
    """Unit vectors over 40 grams; one gram is in a third of them, one in all."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = {f"g{r.randint(0, 39)}": r.random() for _ in range(r.randint(1, 6))} | {"all": 0.05 * r.random() + 0.01}
        if r.random() < hot:
            w["hot"] = 0.3 + r.random()
        norm = sum(x * x for x in w.values()) ** 0.5
        rows += [(i, g, x / norm) for g, x in w.items()]
    return rows, spark.createDataFrame(rows, "doc long, gram string, w double")


@pytest.mark.parametrize("part", [7, 20_000])
def test_top_cosine_equals_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(SP, "LIST_PART", part)
    drows, d = vectors(spark, 1, 300)
    qrows, q = vectors(spark, 2, 25)
    q = q.withColumn("doc", F.concat(F.lit("q"), "doc"))
    dd, qq = defaultdict(dict), defaultdict(dict)
    for i, g, w in drows:
        dd[i][g] = w
    for i, g, w in qrows:
        qq[f"q{i}"][g] = w
    for k in (1, 8):
        got = {(r.ask, r["rank"]): (r.doc, r.sim) for r in SP.top_cosine(q, d, k).collect()}
        for ask, w in qq.items():
            sims = sorted((-round(sum(x * v.get(g, 0.0) for g, x in w.items()), 12), i) for i, v in dd.items() if set(v) & set(w))
            want = {(ask, j + 1): (i, -s) for j, (s, i) in enumerate(sims[:k])}
            assert {p: got[p][0] for p in want} == {p: v[0] for p, v in want.items()}
            assert all(abs(got[p][1] - v[1]) < 1e-9 for p, v in want.items())


def test_few_postings_are_read(spark):
    """The gram that all documents hold adds little, so its list is not read."""
    _, d = vectors(spark, 3, 2000)
    q = spark.createDataFrame([("a", "g1", 0.9), ("a", "all", 0.1)], "doc string, gram string, w double")
    stats = SP.list_stats(d)
    best = SP.top_cosine(q, d, 1).first()
    assert best["rank"] == 1 and stats.where("gram = 'all'").count() == 1
    plan = SP.top_cosine(q, d, 1)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def requests_frame(spark, n, rng):
    texts = ["", "sushi bbq tacos", "red house", "blue river house", "at the green hill inn", "zzz"]
    return spark.createDataFrame([(i, 40.6 + rng.random() * 0.02, -74.0 + rng.random() * 0.02, texts[i % len(texts)],
                                   "20 min (~1.5 km)", (i % 3) * 0.3, i % 2 == 0) for i in range(n)],
                                 "req_id long, lat double, lng double, query string, preset string, importance double, danger_filter boolean")


def entities_frame(spark, n, rng):
    words = "red blue green river house hill inn taco sushi bar".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 3))), rng.choice(["bar", "inn", "grill", None]), "North",
             40.6 + rng.random() * 0.03, -74.0 + rng.random() * 0.03, rng.choice(["A", "B", "C", None])) for i in range(n)]
    return spark.createDataFrame(rows, "camis long, dba string, cuisine string, boro string, latitude double, longitude double, latest_grade string")


def test_pairs_rewards_and_ranking_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(SP, "LIST_PART", 50)
    rng = random.Random(8)
    req, ent = requests_frame(spark, 12, rng), entities_frame(spark, 400, rng)
    safety = ent.select("camis", (F.lit(1.0) + F.pmod(F.hash("camis"), F.lit(200)) / 100.0).alias("safety_score"))
    params, cells = G.with_preset(req), G.entity_cells(ent)
    ctx = SR.text_context(req, ent)
    model, vecs = MT.entity_text_model(ent)
    every = {(r.req_id, r.camis): r["match"] for r in MT.entity_match(req, model, vecs, ctx.refs).collect()}
    blank = {r.req_id for r in req.collect() if not r.query}
    match = lambda q, e: 1.0 if q in blank else every.get((q, e), 0.05)
    pairs = req.select("req_id").join(ent.select("camis"), F.pmod(F.hash("camis", "req_id"), F.lit(5)) == 0)
    for r in MT.match_pairs(ctx.match, pairs).collect():
        assert abs(r["match"] - match(r.req_id, r.camis)) < 1e-9
    # model reward: aggregated below the join against the sum over pairs
    E, Q = ent.collect(), params.collect()
    safe = {r.camis: r.safety_score for r in safety.collect()}
    where = {r.camis: (r.grid_row, r.grid_col) for r in cells.collect()}
    keep = {(r.req_id, r.cu): r.keep for r in SR.label_keep(params, ctx.labels).collect()}
    want = defaultdict(float)
    for q in Q:
        for e in E:
            if keep[(q.req_id, e.cuisine or "")] and not (e.latest_grade == "C" and q.danger_filter):
                want[(q.req_id, *where[e.camis])] += safe[e.camis] * match(q.req_id, e.camis)
    sig, raw = SR.raw_model_reward(params, cells, safety, ctx)
    got = {(r.req_id, r.row, r.col): r.r for r in sig.join(raw, "sig").collect()}
    assert set(got) == set(want) and all(abs(got[p] - v) < 1e-8 for p, v in want.items())
    # ranking: the bounds drop nothing that belongs to the best
    ranked = {(r.req_id, r["rank"]): r.camis for r in SR.direct_ranking(req, ent, safety, ctx, top_n=10).collect()}
    cand = G.direct_candidates(params, cells.join(safety, "camis")).collect()
    by = defaultdict(list)
    for c in cand:
        s = 0.0 if c.latest_grade == "C" and c.danger_filter else c.safety_score
        score = s * match(c.req_id, c.camis) * np.exp(-c.dist_km ** 2 / (2 * max(c.sigma_km, 0.1) ** 2))
        if score > 0:
            by[c.req_id].append((-score, c.camis))
    assert ranked == {(q, i + 1): e for q, v in by.items() for i, (_, e) in enumerate(sorted(v)[:10])}
    scored = SR.direct_scored(params, cells.join(safety, "camis"), ctx.match, 10).count()
    assert scored < len(cand)


def test_quantiles_and_describe(spark, monkeypatch):
    r = np.random.default_rng(5)
    a = np.concatenate([np.zeros(700), r.normal(size=300)])
    b = r.integers(0, 4, 1000).astype(float)
    rows = [(float(x), float(y), None if i % 3 else float(x)) for i, (x, y) in enumerate(zip(a, b, strict=True))]
    df = spark.createDataFrame(rows, "a double, b double, c double").withColumn("d", F.lit(None).cast("double"))
    for pieces in (3, 64):
        monkeypatch.setattr(R, "PIECES", pieces)
        got = {(x.f, x.q): x.t for x in R.quantiles(df, ["a", "b", "c", "d"], [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
        for f, v in enumerate([a, b, np.array([x[2] for x in rows if x[2] is not None])]):
            for q in (0.0, 0.1, 0.5, 0.99, 1.0):
                assert abs(got[(f, q)] - np.quantile(v, q)) < 1e-12
        assert not any(f == 3 for f, _ in got)
    d = P.describe(df, ["a", "d"])
    assert "percentile(" not in d._jdf.queryExecution().executedPlan().toString()
    assert {x.column: x["count"] for x in d.collect()} == {"a": 1000, "d": 0}


def test_numbers_have_no_gaps(spark):
    d = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("g"))
    assert sorted(r.n for r in R.number_rows(d, "g", "n").collect()) == list(range(1000))


@pytest.mark.parametrize("k,block", [(5, 2048), (30, 64)])
def test_grouped_neighbours_equal_all_pairs(spark, k, block):
    r = np.random.default_rng(1)
    x = np.vstack([r.normal(size=(6, 5))[r.integers(0, 6, 2000)] * 3 + r.normal(size=(2000, 5)) * .3, np.zeros((3, 5)),
                   np.ones((40, 5)), np.ones((5, 5)) * 1e-12])
    q = np.vstack([x[:150] + r.normal(size=(150, 5)) * .1, np.zeros((1, 5)), -x[:20], r.normal(size=(30, 5))])
    train = spark.createDataFrame([(i, v.tolist(), str(i % 3)) for i, v in enumerate(x)], "id long, v array<double>, l string")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "q long, v array<double>")
    work, got = {}, defaultdict(dict)
    for row in N.neighbours(train, asked, k, "id", "l", "q", block_rows=block, work=work).collect():
        got[row.qid][row["rank"]] = row.tid
    norm = lambda a: np.sqrt((a * a).sum(axis=1)) + 1e-10
    sims = np.round((q @ x.T) / (norm(q)[:, None] * norm(x)[None, :]), 10)
    for i in range(len(q)):
        want = np.lexsort((np.arange(len(x)), -sims[i]))[:k].tolist()
        assert [got[i][j + 1] for j in range(k)] == want
    assert work["compared"] < work["product"] / 2


def test_quoted_csv_by_byte_ranges(spark, tmpdir_path):
    r = random.Random(4)
    rows = [["".join(r.choice(["a", "b", " ", '"', ",", "\n", "é", 'x"y', "\n\n"]) for _ in range(r.randint(0, 12))) for _ in range(4)]
            for _ in range(1500)]
    rows[10][2] = "long\n" * 2000                     # one record over many ranges
    for k, end in enumerate(["\n", "\r\n"]):
        with open(f"{tmpdir_path}/f{k}.csv", "w", newline="") as f:
            w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
            w.writerow(["A", "B b", "C", "D"])
            w.writerows(rows)
    old = spark.read.options(**S.CSV_OPTIONS, emptyValue="").csv(f"{tmpdir_path}/f0.csv").collect()
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            df = S.read_raw_csv(spark, tmpdir_path)
            assert df.columns == ["A", "B b", "C", "D", "rid"]
            got = [tuple(x)[:4] for x in df.orderBy("rid").collect()]
            assert [tuple(x or "" for x in g) for g in got] == [tuple(x) for x in rows] * 2
            assert got[:1500] == [tuple(x) for x in old]
            if size == "1k":
                assert spark.read.text(tmpdir_path, lineSep="\n").rdd.getNumPartitions() > 50
    finally:
        for key, v in held.items():
            spark.conf.set(key, v)


def test_reference_by_rarest_trigram(spark, monkeypatch):
    """A trigram in a third of all names, lists cut into parts of 10."""
    monkeypatch.setattr(X, "NAME_PART", 10)
    r = random.Random(2)
    names = [f"{'the grand ' if i % 3 == 0 else ''}{''.join(r.choice('abcdefg') for _ in range(r.randint(3, 9)))}" for i in range(300)]
    ent = spark.createDataFrame(list(enumerate(names)), "camis long, dba string")
    queries = [f"near {names[i].split()[-1]} grand {names[i + 1][:5]}" for i in range(0, 280, 7)] + ["grand", "zzzz", "", None, "abcd"]
    req = spark.createDataFrame(list(enumerate(queries)), "req_id long, query string")
    got = {x.req_id: (x.ref_entity, x.ref_score) for x in X.detect_reference(req, ent).collect()}
    from plumbline.functions.constants import STOPWORDS
    for i, q in enumerate(queries):
        best, score = None, 0
        for t in [t for t in (q or "").lower().split() if t not in STOPWORDS and len(t) >= 3]:
            for e, nm in enumerate(names):
                s = min(len(t), len(nm)) if t in nm or nm in t else 0
                if s > score:
                    best, score = e, s
        assert got.get(i) == ((best, score) if score >= 4 else None)


def test_trim_takes_all_white_space(spark):
    from plumbline.functions.columns import trim_all_space
    space = "".join(map(chr, [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, 0x2000, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
    words = [space + "a" + space + "b" + space, space, "", "x", None, "​z​"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [tuple(x) for x in df.select(trim_all_space("w"), F.regexp_replace("w", r"(?U)^\s+|\s+$", "")).collect()]
    assert all(a == b for a, b in got) and got[0][0] == "a" + space + "b"


def test_requests_at_places(spark):
    req = spark.createDataFrame([(1, 1.0, 2.0, "Harlem"), (2, 1.0, 2.0, "nowhere"), (3, 1.0, 2.0, None)],
                                "req_id long, lat double, lng double, place string")
    got = {r.req_id: (r.lat, r.lng) for r in S.at_places(req).collect()}
    assert got == {1: (40.8116, -73.9465), 2: (1.0, 2.0), 3: (1.0, 2.0)}
    assert S.places_table(spark).count() == 22


def test_ranks_without_one_task_per_group(spark):
    """A group with most rows, a null group, ties by id, and no group at all."""
    r = random.Random(6)
    rows = [(i, "big" if i % 10 else r.choice(["a", None]), r.choice([None, 1.0, 2.0, 3.0]) if i % 2 else r.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, s double")
    order = [F.col("s").desc_nulls_last(), F.col("id")]
    key = lambda x: (x[2] is None, -(x[2] or 0.0), x[0])
    for group in (["g"], None):
        got = {x.id: (x["rank"], x.n_candidates) for x in P.ranked(df, order, group).collect()}
        for g in {x[1] for x in rows}:
            mine = sorted((x for x in rows if group is None or x[1] == g), key=key)
            assert all(got[x[0]] == (i + 1, len(mine)) for i, x in enumerate(mine))
    assert P.ranked(df.where("id < 0"), order, ["g"]).count() == 0


def test_small_csv_files_do_not_travel(spark, tmpdir_path):
    """Files of one byte range are parsed where they are read, in the order of their names; packed ones too."""
    rows = [(i, f'a "{i}", b\nc', None if i % 3 else f" {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "A int, B string, C string").repartition(3)
    got = []
    for kind in ("none", "gzip"):
        S.write_table(df, f"{tmpdir_path}/{kind}", "csv", compression=kind)
        back = S.read_raw_csv(spark, f"{tmpdir_path}/{kind}")
        plan = back._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "Window" not in plan
        got.append([tuple(r)[:3] for r in back.orderBy("rid").collect()])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the files were large
    try:
        packed = S.read_raw_csv(spark, f"{tmpdir_path}/gzip")
        assert "hashpartitioning" not in packed._jdf.queryExecution().executedPlan().toString()
        ranges = S.read_raw_csv(spark, f"{tmpdir_path}/none")
        assert "Window" in ranges._jdf.queryExecution().executedPlan().toString()
        got.append([tuple(r)[:3] for r in ranges.orderBy("rid").collect()])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got[0] == got[1] == got[2]
    assert sorted(got[0], key=lambda r: int(r[0])) == [(str(a), b, c) for a, b, c in rows]


def test_scored_pairs_meet_whole_vectors(spark):
    """A ranking's pairs meet vectors of one row each; no row for every gram of a pair travels."""
    ent = spark.createDataFrame([(i, f"Cafe {i % 7}", "Thai", "Area", "ABC"[i % 3], 40.6 + i * 1e-4, -74.0, None) for i in range(40)],
                                "camis long, dba string, cuisine string, boro string, latest_grade string, latitude double, longitude double, x string")
    req = spark.createDataFrame([(1, 40.6, -74.0, "thai cafe", "none", 0.0, False), (2, 40.601, -74.0, "", "none", 0.5, True)],
                                "req_id long, lat double, lng double, query string, preset string, importance double, danger_filter boolean")
    safety = ent.select("camis", F.lit(2.0).alias("safety_score"))
    ctx = SR.text_context(req, ent, with_labels=False)
    scored = SR.direct_scored(G.with_preset(req), G.entity_cells(ent).join(safety, "camis"), ctx.match, 5)
    assert "gram" not in scored._jdf.queryExecution().executedPlan().toString()
    pairs = scored.select("req_id", "camis")
    want = {(r.req_id, r.camis): r.match for r in MT.match_pairs(ctx.match, pairs).collect()}
    got = {(r.req_id, r.camis): r.nlp_score for r in scored.collect()}
    assert got == want and len({m for (q, _), m in got.items() if q == 1}) > 1 and all(m == 1.0 for (q, _), m in got.items() if q == 2)


def test_tree_queries_build_the_entities_once(spark):
    """The split, the fit and the scoring of a tree read entities that are written once."""
    from plumbline.plans import q_model
    df, _feats, _nodes, _classes = q_model._grade_tree(spark, SF0001)
    assert len(df.columns) < 20 and "lineitem" not in df._jdf.queryExecution().executedPlan().toString()
