"""Whole jobs and bounded tasks: what a query answers for and what one task holds."""
from collections import Counter

import numpy as np
import pandas as pd

from plumbline.operators import grid as G
from plumbline.operators import knn as N
from plumbline.functions.columns import rounded
from plumbline.operators import propagate as P
from plumbline.operators import search as SR
from plumbline.operators import sparse as SP
from plumbline.operators import text as X
from plumbline.plans import q_text
from pyspark.sql import functions as F


def city(spark, path, n_customers=40, n_suppliers=12):
    """The tables behind entities and requests, few rows each."""
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    write("region", [(0, "NORTH SIDE")], "r_regionkey long, r_name string")
    write("nation", [(0, "ANYLAND", 0)], "n_nationkey long, n_name string, n_regionkey long")
    write("customer", [(i, f"Customer#{i:09d}", 0, ["FURNITURE", "MACHINERY"][i % 2]) for i in range(n_customers)],
          "c_custkey long, c_name string, c_nationkey long, c_mktsegment string")
    write("supplier", [(i, f"Supplier#{i:09d}") for i in range(n_suppliers)], "s_suppkey long, s_name string")
    write("orders", [(i, i, "FOP"[i % 3], 1000.0 * i, f"1995-01-{i % 27 + 1:02d} 00:00:00", ["1-URGENT", "5-LOW"][i % 2]) for i in range(n_customers)],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string")
    write("lineitem", [(i, i, i, 1, 10.0 * i, "ANR"[i % 3]) for i in range(n_customers)],
          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_extendedprice double, l_returnflag string")
    return path


def test_entity_match_answers_for_entities_out_of_reach(spark, tmpdir_path):
    """Every entity shares a gram with a request that names one, however far away it is."""
    sf = city(spark, tmpdir_path)
    rows = q_text.entity_match(spark, sf).collect()
    named = [r for r in rows if r.req_id == 8]  # "ramen or pizza by customer#000000008"
    assert len(named) == 40 and max(r.match for r in named) == 1.0
    assert {r.camis for r in named if r.match == 1.0} == {8}
    assert all(r.req_id % 6 for r in rows)  # a blank query shares no gram


def test_knn_hands_on_visits_in_small_frames():
    """A batch of queries that reach every group is no single product or frame."""
    r = np.random.default_rng(3)
    pivots = N._unit(pd.Series(list(r.normal(size=(600, 4)))))
    q = pd.DataFrame({"qid": np.arange(3000), "v": list(r.normal(size=(3000, 4))), "reached": np.full(3000, -2.0)})
    seen = set()
    for f in N._visits(pivots, dict.fromkeys(range(600), 3.2), 3, True)(iter([q])):
        assert len(f) <= N.ROWS_AT_ONCE
        before = len(seen)
        seen.update(zip(f["qid"], f["grp"]))
        assert len(seen) == before + len(f)
    assert len(seen) == 3000 * 597  # all groups but the three of the first round
    rows = pd.DataFrame({"tid": np.arange(5000), "v": list(r.normal(size=(5000, 4)))})
    frames = list(N._grouped(pivots)(iter([rows])))
    assert max(map(len, frames)) * 600 <= N.CELLS_AT_ONCE and sum(map(len, frames)) == 5000


def test_grams_are_counted_where_the_texts_are(spark, monkeypatch):
    """Texts travel and not their grams, in tasks of bounded text; rows of one id are one document."""
    monkeypatch.setattr(X, "CHARS_PER_TASK", 100)
    docs = spark.createDataFrame([(i % 50, f"red house {i}") for i in range(60)] + [(None, "red"), (None, "red"), (7, None)], "id long, t string")
    g = X.doc_grams(docs, "id", "t")
    want = Counter()
    for i, t in [(r.id, r.t) for r in docs.collect() if r.t]:
        for w in t.split():
            w = f" {w} "
            want.update((i, w[a:a + n]) for n in (2, 3, 4) for a in range(len(w) - n + 1))
    assert {(r["doc"], r.gram): r.tf for r in g.collect()} == want
    plan = g._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    assert X.text_tasks(docs, "t") > 5


def shared_grids(spark):
    """Two grids, seven requests; one far from all reward, one in an empty corner."""
    r = np.random.default_rng(4)
    cells = [("a", i, j, float(r.random())) for i in range(0, 60) for j in range(30, 90) if r.random() < 0.5] + [("b", 3, 4, 1.0), ("b", 109, 112, 0.2)]
    asks = [(1, "a", 20, 50, 0.5), (2, "a", 110, 0, 0.25), (3, "a", 59, 90, 3.0), (4, "b", 3, 4, 0.25), (5, "b", 60, 60, 0.35), (6, "b", 100, 100, 1.0), (7, "a", 0, 0, 0.05)]
    params = spark.createDataFrame([(q, i, j, s) for q, _g, i, j, s in asks], "req_id long, start_row int, start_col int, sigma_km double")
    shared = spark.createDataFrame([(q, g) for q, g, *_ in asks], "req_id long, sig string")
    return spark.createDataFrame(cells, "sig string, row int, col int, r double"), shared, params


def test_requests_weigh_shared_grids_in_place(spark, monkeypatch):
    """The rewards of weighing every cell and sharing by the largest, with no cell of a request moved."""
    monkeypatch.setattr(G, "REQUESTS_A_GRID", 2)
    grids, shared, params = shared_grids(spark)
    out = G.request_rewards(grids, shared, params)
    want = G.normalise_max(G.proximity(grids.join(shared, "sig"), params))
    got = {(x.req_id, x.row, x.col): x.r for x in out.collect()}
    want = {(x.req_id, x.row, x.col): x.r for x in want.collect() if round(x.r, 12) > 0}
    assert set(want) <= set(got) and len({q for q, *_ in want}) >= 4
    assert all(abs(got[k] - want.get(k, 0.0)) <= 1e-12 for k in got)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Exchange" not in plan[:plan.index("Generate explode(t")]


def test_heat_is_that_of_the_whole_grid(spark):
    """Only the box around reward and walk is iterated; the values beyond it are those of all rounds on the whole grid."""
    r = np.random.default_rng(6)
    setup = {1: (0.85, 4, 20, 30), 2: (0.5, 2, 0, 0), 3: (0.7, 3, 110, 60), 4: (0.8, 3, 55, 112)}
    cells = [(q, int(min(max(a + r.integers(-6, 7), 0), 110)), int(min(max(b + r.integers(-6, 7), 0), 112)), round(float(r.random()), 6)) for q, (_g, _s, a, b) in setup.items() for _ in range(25)]
    reward = spark.createDataFrame([(q, i, j, x) for (q, i, j), x in {c[:3]: c[3] for c in cells}.items()], "req_id long, row int, col int, r double")
    params = spark.createDataFrame([(q, *p) for q, p in setup.items()], "req_id long, gamma double, max_steps int, start_row int, start_col int")
    whole = {x.req_id: np.array(x.v) for x in P.value_grids(reward, params).collect()}
    boxes = P.value_boxes(reward, params, edges=True)
    assert boxes.where("height * width < 1500").count() >= 2  # else nothing is shown
    plan = G.plan_paths(reward, params, heat=True).where("kind = 'heat'").collect()
    assert len(plan) == 4 * 56 * 57
    for x in plan:
        v = whole[x.req_id]
        assert x.v == v[x.row, x.col] and x.vmin == v.min() and x.vmax == v.max()


def test_pairs_are_made_where_query_and_entity_meet(spark, tmpdir_path):
    """All pairs are the output, so none of them is shuffled, sorted or grouped."""
    plan = q_text.entity_match(spark, city(spark, tmpdir_path))._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    above = plan[:plan.index("Generate posexplode")]
    assert "Exchange" not in above and "Sort" not in above and "Aggregate" not in above


def product_inputs(spark):
    rng = np.random.default_rng(4)
    def rows(n, tag):
        return [(f"{tag}{i}", f"g{g}", float(rng.random()) + 0.01) for i in range(n) for g in rng.choice(30, rng.integers(1, 9), replace=False)]
    q, d = rows(150, "q"), rows(90, "d")
    q += [("q3", q[0][1], 0.25)]        # a gram may come twice: its weights add up
    frame = lambda r: spark.createDataFrame(r, "doc string, gram string, w double")
    held = spark.createDataFrame([(a, i) for i, a in enumerate(sorted({r[0] for r in q}))], "ask string, at long").select("ask", F.struct("at").alias("held"))
    return q, d, frame(q), frame(d), held


def test_block_pairs_sum_in_compiled_columns(spark, monkeypatch):
    """several blocks, shares and rows a document; no sum is made by an interpreted
    function over arrays, and none is sorted or moved to be grouped."""
    monkeypatch.setattr(SP, "DOCS_A_SHARE", 16)
    qr, dr, q, d, held = product_inputs(spark)
    want = {}
    for a, g, w in qr:
        for e, h, x in dr:
            if g == h:
                want[a, e] = want.get((a, e), 0.0) + w * x
    at = {a: i for i, a in enumerate(sorted({r[0] for r in qr}))}
    for share in (1, 2, 32):
        pairs = SP.block_pairs(q, d, held, share)
        rows = pairs.collect()
        got = {(r.ask, r.doc): r.raw for r in rows}
        assert len(rows) == len(got) and set(got) == set(want) and all(abs(got[p] - v) < 1e-9 for p, v in want.items())
        assert all(r.held["at"] == at[r.ask] for r in rows)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "zip_with" not in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_rounded_is_round_to_the_bit(spark):
    rng = np.random.default_rng(5)
    v = [float(x) for x in np.concatenate([rng.random(3000), -rng.random(500), rng.random(500) * 1e6, (np.arange(500) + 0.5) * 1e-9, (np.arange(500) + 0.5) * 1e-12])]
    v += [0.0, -0.0, 1.0, 1e300, -1e18, 5e-10, -5e-10, 5e-13, float("inf"), float("-inf"), float("nan"), None]
    df = spark.createDataFrame([(x,) for x in v], "x double").repartition(3)
    for n in (9, 12):
        bad = df.select("x", rounded(F.col("x"), n).alias("a"), F.round("x", n).alias("b")).where(~F.col("a").eqNullSafe(F.col("b")))
        assert bad.collect() == []


def test_model_reward_meets_cells_not_entities(spark, monkeypatch):
    """requests meet one vector a cell, however many entities and classes it has, and
    come out as cells; grids are blurred with one exchange."""
    met = []
    def seen(q, d, held, *a, **k):
        met.append(d.select("doc").distinct().count())
        return pairs(q, d, held, *a, **k)
    rows = [(i, f"red house {i}", ["bar", "inn", None][i % 3], "North", 40.6 + i % 2 * 0.02, -74.0, "ABC"[i % 3]) for i in range(60)]
    ent = spark.createDataFrame(rows, "camis long, dba string, cuisine string, boro string, latitude double, longitude double, latest_grade string")
    req = spark.createDataFrame([(i, 40.6, -74.0, f"red bar {i}", "20 min (~1.5 km)", 0.0, i % 2 == 0) for i in range(5)],
                                "req_id long, lat double, lng double, query string, preset string, importance double, danger_filter boolean")
    params, cells = G.with_preset(req), G.entity_cells(ent)
    ctx = SR.text_context(req, ent)
    pairs = SP.block_pairs
    monkeypatch.setattr(SP, "block_pairs", seen)
    sig, raw = SR.raw_model_reward(params, cells, ent.select("camis", F.lit(2.0).alias("safety_score")), ctx)
    assert met == [2] and raw.count() == 2 * sig.select("sig").distinct().count()
    blurred = G.normalise_max(G.gaussian_blur(raw.withColumnRenamed("sig", "req_id").localCheckpoint()))
    assert blurred._jdf.queryExecution().sparkPlan() is not None
    plan = blurred._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
