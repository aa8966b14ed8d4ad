"""City grid and location search over a table of requests (G1-G20, J8, J9,
J11, J12, A25, A26, A30).

Every request is a row ``(req_id, lat, lng, query, preset, importance,
danger_filter)``; grids are long tables ``(req_id, row, col, value)`` that
only hold non-zero cells.

* The reward grid factorises through (cell, label, grade class): entities
  are aggregated once per cell for all requests (bounded by grid x labels),
  and only that small table meets the per-request label factors — the cost
  does not grow with requests x entities.
* The Gaussian blur is separable: two scatter passes (explode each cell to
  its 9 kernel targets with mirrored borders, then ``sum``).
* Value propagation and the greedy walk are array expressions over a request's
  fixed 111 x 113 grid (``propagate``).
* Destinations, warnings and direct ranking are cell-keyed equi-joins
  (Chebyshev windows exploded into cells), never requests x entities.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.operators.propagate import greedy_walk, least_value, value_at, value_boxes
from plumbline.session import cut_lineage
from plumbline.functions.columns import (col_to_lng, flat_distance_km, grade_safety, hop_km,
                                         in_bbox, lat_to_row, lng_to_col, row_to_lat, walk_minutes)

NO_LABEL = "\u0000"  # join key for entities without a label


# --- presets and starts ---------------------------------------------------------

def with_preset(requests: DataFrame) -> DataFrame:
    """Attach walk_km, gamma, max_steps, sigma_km (unknown preset -> default)."""
    def pick(i):
        m = F.create_map(*[x for p in K.WALK_PRESETS for x in (F.lit(p[0]), F.lit(p[i]))])
        default = next(p[i] for p in K.WALK_PRESETS if p[0] == K.DEFAULT_PRESET)
        return F.coalesce(m[F.col("preset")], F.lit(default))
    return requests.select("*", pick(1).alias("walk_km"), pick(2).alias("gamma"),
                           pick(3).alias("max_steps"), pick(4).alias("sigma_km"),
                           lat_to_row("lat").alias("start_row"), lng_to_col("lng").alias("start_col"))


def entity_cells(entities: DataFrame, lat="latitude", lng="longitude") -> DataFrame:
    """F4 + G1: entities inside the box, with their cell."""
    e = entities.where(F.col(lat).isNotNull() & F.col(lng).isNotNull() & in_bbox(lat, lng))
    return e.withColumn("grid_row", lat_to_row(lat)).withColumn("grid_col", lng_to_col(lng))


# --- G3: reward from grades ---------------------------------------------------------

def label_factors(requests: DataFrame, label_scores: DataFrame) -> DataFrame:
    """Per (request, label key): match and the strictness keep-flag.

    ``label_scores`` = (req_id, label, match) for every label.  Entities
    whose label is missing or unknown get 0.05 and are compared with the
    same threshold.
    """
    mx = label_scores.groupBy("req_id").agg(F.max("match").alias("max_match"))
    r = requests.select("req_id", "importance", "query").join(mx, "req_id", "left")
    has_desc = ~(F.col("query").isNull() | (F.trim(F.col("query")) == ""))
    thr = F.when(has_desc & (F.col("importance") > 0),
                 F.col("importance") * F.coalesce(F.col("max_match"), F.lit(1.0)))
    known = label_scores.join(r, "req_id").select(
        "req_id", F.col("label").alias("label_key"), "match", thr.alias("thr"))
    other = r.select("req_id", F.lit(NO_LABEL).alias("label_key"), F.lit(K.MIN_MATCH).alias("match"),
                     thr.alias("thr"))
    both = known.unionByName(other)
    return both.select("req_id", "label_key", "match",
                       (F.col("thr").isNull() | (F.col("match") >= F.col("thr"))).alias("keep"))


def grade_cells(cells: DataFrame, label="cuisine", grade="latest_grade") -> DataFrame:
    """A25 input, request-independent: per (cell, label, grade class) the
    number of entities and their grade safety (3/2/1/0)."""
    g = F.when(F.col(grade) == "C", "C").otherwise("other")
    return cells.groupBy("grid_row", "grid_col",
                         F.coalesce(F.col(label), F.lit(NO_LABEL)).alias("label_key"),
                         g.alias("gclass")).agg(
        F.sum(F.coalesce(grade_safety(grade), F.lit(0.0))).alias("safety_sum"))


def reward_from_grades(requests: DataFrame, gcells: DataFrame, factors: DataFrame,
                       known_labels: DataFrame) -> DataFrame:
    """G3 raw grid: sum over entities of safety x match (grade C zeroed when
    the request's danger filter is on; low matches zeroed by strictness)."""
    kl = known_labels.select(F.col("label").alias("label_key"), F.lit(True).alias("_known"))
    gc = gcells.join(kl, "label_key", "left").withColumn(
        "label_key", F.when(F.col("_known"), F.col("label_key")).otherwise(F.lit(NO_LABEL))) \
        .drop("_known")
    f = factors.join(requests.select("req_id", "danger_filter"), "req_id")
    j = gc.join(f, "label_key")  # AQE broadcasts the factor side when it is small
    w = F.when(~F.col("keep"), F.lit(0.0)).when(
        (F.col("gclass") == "C") & F.col("danger_filter"), F.lit(0.0)).otherwise(
        F.col("safety_sum") * F.col("match"))
    return j.groupBy("req_id", F.col("grid_row").alias("row"), F.col("grid_col").alias("col")) \
            .agg(F.sum(w).alias("r")).where(F.col("r") > 0)


# --- G5 blur, A26 normalise, G6 proximity -----------------------------------------------

def gaussian_kernel(sigma: float = 1.0, truncate: float = 4.0) -> list[float]:
    radius = int(truncate * sigma + 0.5)
    x = np.arange(-radius, radius + 1)
    phi = np.exp(-0.5 / (sigma * sigma) * x ** 2)
    return [float(v) for v in phi / phi.sum()]


def _blur_axis(cells: DataFrame, axis: str, n: int, kernel: list[float], val: str) -> DataFrame:
    radius = len(kernel) // 2
    other = "col" if axis == "row" else "row"
    s = F.col(axis)
    # source s feeds target t with weight k[d] when mirror(t + d) == s; the two
    # mirrored candidates can only exist within ``radius`` of a border
    direct, mirrored = [], []
    for d in range(-radius, radius + 1):
        wgt = F.lit(kernel[d + radius])
        direct.append(F.struct((s - d).alias("t"), wgt.alias("w")))
        for t in (-s - 1 - d, F.lit(2 * n - 1) - s - d):
            mirrored.append(F.struct(t.alias("t"), wgt.alias("w")))
    near_border = (s < radius) | (s > n - 1 - radius)
    cands = F.when(near_border, F.array(*(direct + mirrored))).otherwise(F.array(*direct))
    x = cells.select("req_id", other, val, F.explode(cands).alias("c"))
    x = x.where((F.col("c.t") >= 0) & (F.col("c.t") < n))
    return x.groupBy("req_id", F.col("c.t").alias(axis), other).agg(
        F.sum(F.col(val) * F.col("c.w")).alias(val))


def gaussian_blur(cells: DataFrame, sigma: float = 1.0, val: str = "r") -> DataFrame:
    """Separable Gaussian (radius 4 sigma, mirrored border) of a sparse grid.

    A grid's cells travel once, to one task (a grid is bounded): its sums, and what
    is done with the whole grid afterwards, need no further shuffle."""
    if sigma <= 0:
        return cells
    k = gaussian_kernel(sigma)
    n = 4 * int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = _blur_axis(cells.select("req_id", "row", "col", val).repartition(n, "req_id"), "row", K.GRID_ROWS, k, val)
    b = _blur_axis(a, "col", K.GRID_COLS, k, val)
    return b.select("req_id", "row", "col", val)


def normalise_max(cells: DataFrame, val: str = "r") -> DataFrame:
    """Divide by the request's max when it is above 1e-8."""
    mx = F.max(val).over(Window.partitionBy("req_id"))
    return cells.withColumn(val, F.when(mx > 1e-8, F.col(val) / mx).otherwise(F.col(val)))


def proximity(cells: DataFrame, params: DataFrame, val: str = "r") -> DataFrame:
    """R x exp(-d^2 / 2 sigma^2) around the start cell (sigma >= 0.1 km)."""
    p = params.select("req_id", "start_row", "start_col", "sigma_km")
    j = cells.join(p, "req_id")
    return j.select("req_id", "row", "col", (F.col(val) * proximity_of(F.col("row"), F.col("col"))).alias(val))


def proximity_of(row: Column, col: Column) -> Column:
    """The weight of a cell, from the row's ``start_row``, ``start_col`` and ``sigma_km``."""
    dr = (row - F.col("start_row")) * F.lit(K.METRES_PER_ROW)
    dc = (col - F.col("start_col")) * F.lit(K.METRES_PER_COL)
    dkm = F.sqrt(dr * dr + dc * dc) / F.lit(1000.0)
    sg = F.greatest(F.col("sigma_km"), F.lit(0.1))
    return F.exp(-(dkm * dkm) / (F.lit(2.0) * sg * sg))


REQUESTS_A_GRID = 256  # requests that one task weighs a shared grid for
TILE = 8
LEAST_REWARD = 1e-13   # rewards are read to 12 places at the most; lower ones are left out


def request_rewards(grids: DataFrame, shared: DataFrame, params: DataFrame, val: str = "r") -> DataFrame:
    """G6 + A26: (req_id, row, col, r) of every request from the grid it shares, values
    from ``LEAST_REWARD``.

    ``grids``: (sig, row, col, r); ``shared``: (req_id, sig).  A grid travels as one row,
    an array of tiles, and meets its requests in shares of ``REQUESTS_A_GRID``; cells are
    weighed there, once for the request's largest value and once for the result, so no
    cell of a request is shuffled.  A tile's largest reward and nearest point bound its
    cells, so only tiles that can hold the largest value, or one to be read, are opened."""
    cell, tile = F.struct("row", "col", F.col(val).alias("r")), [F.floor(F.col(c) / TILE).cast("int").alias(t) for c, t in (("row", "tr"), ("col", "tc"))]
    tiles = grids.groupBy("sig", *tile).agg(F.collect_list(cell).alias("cells"), F.max_by(cell, F.col(val)).alias("top"))
    held = cut_lineage(tiles.groupBy("sig").agg(F.collect_list(F.struct("tr", "tc", "top", "cells")).alias("tiles")))
    shares = shared.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / F.lit(REQUESTS_A_GRID)).cast("long").alias("shares"))
    asks = cut_lineage(params.select("req_id", "start_row", "start_col", "sigma_km").join(shared.select("req_id", "sig"), "req_id").join(shares, "sig")
                       .withColumn("share", F.pmod(F.xxhash64("req_id"), F.col("shares"))))
    spread = held.join(shares, "sig").select("sig", "tiles", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"))
    # a request costs far more than its bytes say, so the shares are dealt out by number
    n = 4 * int(grids.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def nearest(start: str, t: Column) -> Column:
        return F.least(F.greatest(F.col(start), t * TILE), t * TILE + (TILE - 1))

    def weighed(a: DataFrame, least: Column, *more: str) -> DataFrame:
        """The cells of the tiles that can reach ``least``."""
        met = a.repartition(n, "sig", "share").join(spread.repartition(n, "sig", "share"), ["sig", "share"]).withColumn("_least", least)
        at = ["req_id", "start_row", "start_col", "sigma_km", *more]
        t = met.select(*at, "_least", F.explode("tiles").alias("t"))
        bound = F.col("t.top.r") * proximity_of(nearest("start_row", F.col("t.tr")), nearest("start_col", F.col("t.tc")))
        cells = t.where(bound * (1 + 1e-9) >= F.col("_least")).select(*at, F.explode("t.cells").alias("c"))
        return cells.select("req_id", "c.row", "c.col", (F.col("c.r") * proximity_of(F.col("c.row"), F.col("c.col"))).alias(val), *more)

    reached = F.array_max(F.transform("tiles", lambda t: t["top"]["r"] * proximity_of(t["top"]["row"], t["top"]["col"])))
    largest = cut_lineage(weighed(asks, reached).groupBy("req_id").agg(F.max(val).alias("_most")))
    by = F.when(F.col("_most") > 1e-8, F.col("_most")).otherwise(F.lit(1.0))
    out = weighed(asks.join(largest, "req_id"), by * LEAST_REWARD, "_most")
    return out.select("req_id", "row", "col", (F.col(val) / by).alias(val)).where(F.col(val) >= LEAST_REWARD)


# --- G7 + G8 (+ G19 data) ----------------------------------------------------------------

REWARD_DIGITS = 12  # rewards are sums in any order; so rounded, equal cells stay equal and ties are ties


def plan_paths(reward: DataFrame, params: DataFrame, heat: bool = False) -> DataFrame:
    """G7 + G8: value propagation and the greedy walk of every request.

    ``reward``: (req_id, row, col, r) normalised; ``params`` carries gamma,
    max_steps, start_row, start_col.  Output rows of kind 'path' (step order)
    and, with ``heat``, 'heat' (every second cell), each with the grid's largest and,
    with ``heat``, least value (else null).  The rounds run in the box around reward and
    walk; what lies outside follows from its sides (``value_at``).  Walks and paths are
    checkpointed: later steps read them several times, and the rounds run once.  The heat
    rows are made from a request's array of values where they are read.
    """
    params = cut_lineage(params.select("req_id", "gamma", "max_steps", "start_row", "start_col"))
    reward = reward.withColumn("r", F.round("r", REWARD_DIGITS)).where(F.col("r") != 0)
    walk = greedy_walk(value_boxes(reward, params, edges=heat), params)
    rows, cols = (F.array(*[F.lit(i) for i in range(0, n, 2)]) for n in (K.GRID_ROWS, K.GRID_COLS))
    sampled = F.flatten(F.transform(rows, lambda i: F.transform(cols, lambda j: value_at(i, j)))) if heat else F.lit(None)
    walk = cut_lineage(walk.select(
        "req_id", "path", F.transform("path", lambda i: F.col("g")[
            (F.floor(i / K.GRID_COLS).cast("int") - F.col("r0")) * F.col("width") + i % K.GRID_COLS - F.col("c0")]).alias("pv"),
        (least_value() if heat else F.lit(None).cast("double")).alias("vmin"), F.array_max("g").alias("vmax"), *([sampled.alias("cells")] if heat else [])))
    step = walk.select("req_id", "vmin", "vmax", F.posexplode(F.arrays_zip("path", "pv")).alias("step", "p"))
    out = cut_lineage(step.select("req_id", F.lit("path").alias("kind"), "step",
                                  F.floor(F.col("p.path") / K.GRID_COLS).cast("int").alias("row"),
                                  (F.col("p.path") % K.GRID_COLS).cast("int").alias("col"), F.col("p.pv").alias("v"), "vmin", "vmax"))
    if not heat:
        return out
    cells = walk.select("req_id", "vmin", "vmax", F.posexplode("cells").alias("at", "v"))
    n = len(range(0, K.GRID_COLS, 2))
    return out.unionByName(cells.select(
        "req_id", F.lit("heat").alias("kind"), F.lit(-1).alias("step"), (F.floor(F.col("at") / n) * 2).cast("int").alias("row"),
        (F.col("at") % n * 2).cast("int").alias("col"), "v", "vmin", "vmax"))


# --- path metrics (G9, G10, G2) ---------------------------------------------------------

def path_summary(plan: DataFrame) -> DataFrame:
    """G9 + G10 + G2: per request the cell path, grid route with corners,
    destination centre, length (km, cell hops only) and walking minutes."""
    p = plan.where(F.col("kind") == "path")
    w = Window.partitionBy("req_id").orderBy("step")
    hops = p.select("req_id", "step", "row", "col",
                    hop_km(F.col("row") - F.lag("row").over(w),
                           F.col("col") - F.lag("col").over(w)).alias("hop"))
    agg = hops.groupBy("req_id").agg(
        F.sort_array(F.collect_list(F.struct("step", "row", "col"))).alias("cells"),
        F.coalesce(F.sum("hop"), F.lit(0.0)).alias("path_km"))
    pts = F.transform("cells", lambda s: F.struct(row_to_lat(s["row"]).alias("lat"),
                                                  col_to_lng(s["col"]).alias("lng")))
    out = agg.select("req_id", "cells", pts.alias("points"), "path_km")
    last = F.element_at("cells", -1)
    return out.select("req_id", F.transform("cells", lambda s: F.struct(s["row"].alias("row"),
                                                                        s["col"].alias("col")))
                      .alias("cell_path"),
                      corner_route(F.col("points")).alias("grid_route"),
                      last["row"].alias("dest_row"), last["col"].alias("dest_col"),
                      row_to_lat(last["row"]).alias("dest_lat"), col_to_lng(last["col"]).alias("dest_lng"),
                      "path_km", walk_minutes("path_km").alias("walk_minutes"))


def corner_route(points: Column) -> Column:
    """Insert a corner between diagonal hops — (lat1, lng2) on even hop
    index, (lat2, lng1) on odd; fewer than two points: unchanged."""
    n = F.size(points)
    hops = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.when(
        (F.abs(points[i + 1]["lat"] - points[i]["lat"]) > 1e-7)
        & (F.abs(points[i + 1]["lng"] - points[i]["lng"]) > 1e-7),
        F.array(F.when(i % 2 == 0, F.struct(points[i]["lat"].alias("lat"),
                                            points[i + 1]["lng"].alias("lng")))
                .otherwise(F.struct(points[i + 1]["lat"].alias("lat"),
                                    points[i]["lng"].alias("lng"))),
                points[i + 1]))
        .otherwise(F.array(points[i + 1])))
    return F.when(n < 2, points).otherwise(F.concat(F.array(points[0]), F.flatten(hops)))


# --- J8 / J9 / J12: Chebyshev windows as cell explosions -------------------------------------

def cell_window(df: DataFrame, row: str, col: str, radius: int) -> DataFrame:
    """Explode each row to every cell within Chebyshev ``radius`` (in-grid)."""
    offs = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"))
                     for dr in range(-radius, radius + 1) for dc in range(-radius, radius + 1)])
    x = df.select("*", F.explode(offs).alias("_o"))
    x = x.select("*", (F.col(row) + F.col("_o.dr")).alias("wrow"),
                 (F.col(col) + F.col("_o.dc")).alias("wcol")).drop("_o")
    return x.where((F.col("wrow") >= 0) & (F.col("wrow") < K.GRID_ROWS)
                   & (F.col("wcol") >= 0) & (F.col("wcol") < K.GRID_COLS))


def near_destination(dest: DataFrame, cells: DataFrame, radius: int = K.DESTINATION_RADIUS_CELLS):
    """Entities within Chebyshev ``radius`` of each request's destination."""
    win = cell_window(dest.select("req_id", "dest_row", "dest_col"), "dest_row", "dest_col", radius)
    return win.join(cells, (F.col("wrow") == F.col("grid_row")) & (F.col("wcol") == F.col("grid_col")))


def near_path(plan: DataFrame, cells: DataFrame, radius: int = K.WARNING_RADIUS_CELLS):
    """Entities within Chebyshev ``radius`` of any path cell (semi-join)."""
    p = plan.where(F.col("kind") == "path").select("req_id", "row", "col")
    win = cell_window(p, "row", "col", radius).select("req_id", "wrow", "wcol").distinct()
    return win.join(cells, (F.col("wrow") == F.col("grid_row")) & (F.col("wcol") == F.col("grid_col"))) \
              .drop("wrow", "wcol").dropDuplicates(["req_id", "camis"])


def near_path_counts(plan: DataFrame, cells: DataFrame, radius: int = K.WARNING_RADIUS_CELLS) -> DataFrame:
    """(req_id, n): how many entities J9 finds, from counts per cell."""
    p = plan.where(F.col("kind") == "path").select("req_id", "row", "col")
    win = cell_window(p, "row", "col", radius).select("req_id", "wrow", "wcol").distinct()
    per_cell = cells.groupBy(F.col("grid_row").alias("wrow"), F.col("grid_col").alias("wcol")).agg(F.count(F.lit(1)).alias("k"))
    return win.join(per_cell, ["wrow", "wcol"]).groupBy("req_id").agg(F.sum("k").alias("n"))


def neighbours8(cells: DataFrame) -> DataFrame:
    """Each cell with its 8 neighbours (outside the grid dropped = 0)."""
    x = cell_window(cells, "row", "col", 1)
    return x.where((F.col("wrow") != F.col("row")) | (F.col("wcol") != F.col("col")))


# --- G17 / G15 / G16: direct ranking ---------------------------------------------------------

def reach_cells(params: DataFrame) -> DataFrame:
    """Each request with every cell (wrow, wcol) of the bounding box of its reach,
    1.5 x walk_km: the box covers the circle, the exact distance decides later."""
    p = params.select("req_id", "lat", "lng", "walk_km", "sigma_km", "danger_filter")
    reach = F.col("walk_km") * 1.5
    # a hair wider than the circle
    dlat = reach * 1000.0 / K.METRES_PER_DEG_LAT + F.lit(1e-9)
    dlng = reach * 1000.0 / K.METRES_PER_DEG_LNG + F.lit(1e-9)
    r0 = F.greatest(lat_to_row(F.col("lat") - dlat), F.lit(0))
    r1 = F.least(lat_to_row(F.col("lat") + dlat), F.lit(K.GRID_ROWS - 1))
    c0 = F.greatest(lng_to_col(F.col("lng") - dlng), F.lit(0))
    c1 = F.least(lng_to_col(F.col("lng") + dlng), F.lit(K.GRID_COLS - 1))
    boxes = p.select("*", F.explode(F.sequence(r0, r1)).alias("wrow"), c0.alias("c0"), c1.alias("c1"))
    return boxes.select("*", F.explode(F.sequence("c0", "c1")).alias("wcol")).drop("c0", "c1")


def direct_candidates(params: DataFrame, cells: DataFrame, in_cells: DataFrame | None = None, lat="latitude", lng="longitude"):
    """Entities within 1.5 x walk_km (flat distance) of each request, by an
    equi-join on the cell; with ``in_cells`` (req_id, wrow, wcol, ...) only those
    cells, and with all columns of both tables."""
    boxes = reach_cells(params) if in_cells is None else in_cells.join(params, "req_id")
    e = cells.select("camis", "grid_row", "grid_col", F.col(lat).alias("elat"),
                     F.col(lng).alias("elng"), *[c for c in cells.columns
                                                 if c not in ("camis", "grid_row", "grid_col",
                                                              lat, lng)])
    j = boxes.join(e, (F.col("wrow") == F.col("grid_row")) & (F.col("wcol") == F.col("grid_col")))
    d = flat_distance_km("elat", "elng", "lat", "lng")
    return j.withColumn("dist_km", d).where(F.col("dist_km") <= F.col("walk_km") * 1.5).drop("wrow", "wcol")


def proximity_weight(dist_km: Column, walk_km: Column, sigma_km: Column) -> Column:
    """exp(-d^2/2 sigma^2) with sigma >= 0.1, 0 beyond 1.5 x walk."""
    sg = F.greatest(sigma_km, F.lit(0.1))
    return F.when(dist_km > walk_km * 1.5, F.lit(0.0)).otherwise(
        F.exp(-(dist_km * dist_km) / (F.lit(2.0) * sg * sg)))


def heat_extract(plan: DataFrame) -> DataFrame:
    """Every second cell, min-max scaled (+1e-8), kept above 0.08."""
    h = plan.where(F.col("kind") == "heat")
    v = (F.col("v") - F.col("vmin")) / (F.col("vmax") - F.col("vmin") + F.lit(1e-8))
    return h.select("req_id", "row", "col", v.alias("v")).where(F.col("v") > 0.08) \
            .select("req_id", "row", "col", row_to_lat("row").alias("lat"),
                    col_to_lng("col").alias("lng"), "v")


# --- J11 / G20: point in polygon ----------------------------------------------------------

def point_in_polygons(points: DataFrame, edges: DataFrame, id_col: str, lat: str, lng: str,
                      band: float = 0.01) -> DataFrame:
    """Even-odd ray casting; inside if inside any ring of any feature.

    An edge can only cross a point's horizontal ray when the point's
    latitude lies between the edge's end latitudes, so edges are exploded to
    the latitude bands they span and joined to points on the band (an
    equi-join); the crossing test is then exact.
    """
    e = edges.select("feature", "ring", "x1", "y1", "x2", "y2")
    lo = F.floor(F.least("y1", "y2") / F.lit(band)).cast("long")
    hi = F.floor(F.greatest("y1", "y2") / F.lit(band)).cast("long")
    eb = e.select("*", F.explode(F.sequence(lo, hi)).alias("band"))
    p = points.select(id_col, F.col(lat).alias("py"), F.col(lng).alias("px"),
                      F.floor(F.col(lat) / F.lit(band)).cast("long").alias("band"))
    j = p.join(eb, "band")
    crosses = ((F.col("y1") > F.col("py")) != (F.col("y2") > F.col("py"))) & (
        F.col("px") < (F.col("x2") - F.col("x1")) * (F.col("py") - F.col("y1"))
        / (F.col("y2") - F.col("y1") + F.lit(1e-12)) + F.col("x1"))
    per_ring = j.groupBy(id_col, "feature", "ring").agg(F.count_if(crosses).alias("k"))
    inside = per_ring.groupBy(id_col).agg(F.max((F.col("k") % 2 == 1).cast("int")).alias("_in"))
    return points.select(id_col).distinct().join(inside, id_col, "left").select(
        id_col, F.coalesce(F.col("_in") == 1, F.lit(False)).alias("inside"))

