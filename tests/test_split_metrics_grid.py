import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import grid as G
from plumbline.operators import metrics as M
from plumbline.operators import split as S
from plumbline.sources.files import read_polygon_edges


def test_rank_in_groups_with_hot_group(spark):
    # one group holds most rows (skew); ranks must equal a plain row_number
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise((F.col("id") % 3).cast("string"))
        .alias("g"), ((F.col("id") * 7919) % 1000).alias("k"), F.col("id"))
    got = S.rank_in_groups(df, ["g"], "k", "id", buckets=8)
    ref = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")))
    bad = got.join(ref, ["g", "k", "id"]).where(F.col("_rank") != F.col("r")).count()
    assert bad == 0 and got.count() == 5000


def test_temporal_split_sizes(spark):
    df = spark.range(0, 103).select(F.col("id"), (F.col("id") % 7).alias("d"))
    out, info = S.temporal_split(df, "d", "id", 0.2)
    n_train = out.where("split = 'train'").count()
    assert n_train == int(103 * 0.8) and out.count() == 103
    assert info.first()["n_train"] == n_train
    # every train row precedes every test row in (date, id) order
    mx = out.where("split = 'train'").agg(F.max(F.struct("d", "id"))).first()[0]
    mn = out.where("split = 'test'").agg(F.min(F.struct("d", "id"))).first()[0]
    assert (mx["d"], mx["id"]) < (mn["d"], mn["id"])


def test_stratified_exact_shares(spark):
    df = spark.range(0, 1000).select("id", (F.col("id") % 4).cast("string").alias("c"))
    out = S.stratified_split(df, "c", "id", 0.2, 7)
    per = {r["c"]: r["n"] for r in out.where("split='test'").groupBy("c")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"0": 50, "1": 50, "2": 50, "3": 50}


def test_metrics_properties(spark):
    rows = [("A", "A"), ("A", "B"), ("B", "B"), ("C", "A"), ("C", "C"), ("C", "C")]
    df = spark.createDataFrame(rows, "actual string, pred string")
    cm = M.confusion_matrix(df, "actual", "pred", ["A", "B", "C"])
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == 6
    per = {r["label"]: r for r in M.class_metrics(df, "actual", "pred").collect()}
    assert per["A"]["precision"] == 0.5 and per["A"]["recall"] == 0.5
    assert per["C"]["precision"] == 1.0 and per["C"]["recall"] == round(2 / 3, 4)
    mac = M.macro_summary(df, "actual", "pred").first()
    assert mac["accuracy"] == round(4 / 6, 4) and mac["support"] == 6


def _scipy_like_blur(R):
    k = np.array(G.gaussian_kernel(1.0))
    def along(a, axis):
        n = a.shape[axis]
        out = np.zeros_like(a)
        for t in range(n):
            acc = 0
            for d in range(-4, 5):
                x = t + d
                s = -x - 1 if x < 0 else (2 * n - 1 - x if x >= n else x)
                acc = acc + k[d + 4] * np.take(a, s, axis=axis)
            if axis == 0:
                out[t, :] = acc
            else:
                out[:, t] = acc
        return out
    return along(along(R, 0), 1)


def test_blur_matches_mirrored_convolution(spark):
    rng = np.random.default_rng(1)
    R = np.zeros((G.K.GRID_ROWS, G.K.GRID_COLS))
    pts = [(0, 0), (1, 2), (110, 112), (50, 60), (3, 110), (108, 1)]
    for r, c in pts:
        R[r, c] = rng.uniform(0.5, 2)
    df = spark.createDataFrame([(1, r, c, float(R[r, c])) for r, c in pts],
                               "req_id long, row int, col int, r double")
    got = G.gaussian_blur(df).collect()
    exp = _scipy_like_blur(R)
    dense = np.zeros_like(R)
    for x in got:
        dense[x["row"], x["col"]] = x["r"]
    assert np.max(np.abs(dense - exp)) < 1e-12


def test_plan_helper_fixed_point_and_walk(spark):
    cells = spark.createDataFrame([(1, 10, 10, 1.0), (1, 12, 14, 0.5)],
                                  "req_id long, row int, col int, r double")
    params = spark.createDataFrame([(1, 0.5, 8, 10, 12)],
                                   "req_id long, gamma double, max_steps int, start_row int, start_col int")
    plan = G.plan_paths(cells, params)
    path = [(r["row"], r["col"], r["v"]) for r in plan.where("kind='path'").orderBy("step").collect()]
    assert path[0][:2] == (10, 12)
    vs = [p[2] for p in path]
    assert all(b > a for a, b in zip(vs, vs[1:]))
    assert path[-1][:2] == (10, 10)


def test_corner_route(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (1.0, 1.0), (2.0, 1.0), (3.0, 2.0)],)],
                               "p array<struct<lat:double,lng:double>>")
    r = df.select(G.corner_route(F.col("p")).alias("r")).first()["r"]
    assert [(x["lat"], x["lng"]) for x in r] == [(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (3, 2)]


def _point_in_ring(lat, lng, ring):
    inside = False
    j = len(ring) - 1
    for i in range(len(ring)):
        xi, yi = ring[i]
        xj, yj = ring[j]
        if ((yi > lat) != (yj > lat)) and lng < (xj - xi) * (lat - yi) / (yj - yi + 1e-12) + xi:
            inside = not inside
        j = i
    return inside


def test_point_in_polygon_geojson(spark, tmpdir_path):
    import json
    import os
    concave = [[0, 0], [4, 0], [4, 4], [2, 1], [0, 4], [0, 0]]
    square = [[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]
    gj = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {}, "geometry": {"type": "Polygon",
                                                          "coordinates": [concave]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon",
                                                          "coordinates": [[square]]}}]}
    path = os.path.join(tmpdir_path, "areas.geojson")
    with open(path, "w") as f:
        json.dump(gj, f)
    edges = read_polygon_edges(spark, path)
    rng = np.random.default_rng(3)
    pts = [(i, float(rng.uniform(-1, 13)), float(rng.uniform(-1, 13))) for i in range(300)]
    df = spark.createDataFrame(pts, "id long, lat double, lng double")
    got = {r["id"]: r["inside"] for r in
           G.point_in_polygons(df, edges, "id", "lat", "lng", band=0.5).collect()}
    for i, lat, lng in pts:
        exp = _point_in_ring(lat, lng, concave) or _point_in_ring(lat, lng, square)
        assert got[i] == exp


def test_corner_route_odd_hop(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (0.0, 1.0), (1.0, 2.0)],)],
                               "p array<struct<lat:double,lng:double>>")
    r = df.select(G.corner_route(F.col("p")).alias("r")).first()["r"]
    # hop 1 is diagonal and odd: the corner is (lat2, lng1)
    assert [(x["lat"], x["lng"]) for x in r] == [(0, 0), (0, 1), (1, 1), (1, 2)]


def test_area_split_names_with_hyphens_and_apostrophes(spark):
    from plumbline.operators.split import area_split
    rows = [(i, a, "x") for i, a in enumerate([" staten-island", "Staten-Island ", "STATEN-ISLAND", "o'hara", "O'Hara"] * 10)]
    df = spark.createDataFrame(rows, "id int, area string, label string")
    out = area_split(df, "area", "label", "staten-island").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"test": 30, "train": 20}
    out = area_split(df, "area", "label", "O'HARA").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"test": 20, "train": 30}
