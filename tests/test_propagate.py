"""Value propagation and walk equal a plain NumPy version."""
import numpy as np

from plumbline.functions import constants as K
from plumbline.operators import grid as G

ORDER = [(-1, 0), (1, 0), (0, -1), (0, 1), (-1, -1), (-1, 1), (1, -1), (1, 1)]


def plain(cells, gamma, steps, start):
    """Largest of nine shifted copies per round; then the walk, cell by cell."""
    h, w = K.GRID_ROWS, K.GRID_COLS
    reward = np.zeros((h, w))
    for r, c, x in cells:
        reward[r, c] = x
    v, change = reward, 1.0
    while change >= 1e-5:
        pad = np.pad(v, 1)
        near = np.stack([pad[1 + a:1 + a + h, 1 + b:1 + b + w] for a, b in ORDER])
        fresh = reward + gamma * near.max(axis=0)
        change = np.abs(fresh - v).max()
        v = fresh
    path = [start]
    while len(path) <= steps:
        r, c = path[-1]
        options = [(v[r + a, c + b], -k, (r + a, c + b)) for k, (a, b) in enumerate(ORDER)
                   if 0 <= r + a < h and 0 <= c + b < w and (r + a, c + b) not in path and v[r + a, c + b] > v[r, c]]
        if not options:
            break
        path.append(max(options)[2])
    return v, path


def test_plan_equals_plain_version(spark):
    cells = {1: [(10, 10, 1.0), (12, 14, 0.5)], 2: [(50, 50, 0.8), (52, 47, 1.0)], 3: [(0, 0, 1.0)], 4: []}
    setup = {1: (0.5, 8, 10, 12), 2: (0.65, 3, 49, 49), 3: (0.85, 2, 2, 2), 4: (0.5, 4, 110, 112), 5: (0.5, 0, 1, 1)}
    reward = spark.createDataFrame([(q, *c) for q, cs in cells.items() for c in cs], "req_id long, row int, col int, r double")
    params = spark.createDataFrame([(q, *p) for q, p in setup.items()],
                                   "req_id long, gamma double, max_steps int, start_row int, start_col int")
    rows = G.plan_paths(reward, params, heat=True).collect()
    for q, (gamma, steps, r, c) in setup.items():
        v, path = plain(cells.get(q, []), gamma, steps, (r, c))
        mine = sorted((x for x in rows if x.req_id == q and x.kind == "path"), key=lambda x: x.step)
        assert [(x.row, x.col) for x in mine] == path
        heat = [x for x in rows if x.req_id == q and x.kind == "heat"]
        assert len(heat) == 56 * 57
        assert max(abs(x.v - v[x.row, x.col]) for x in heat + mine) < 1e-12
        assert abs(mine[0].vmax - v.max()) < 1e-12 and abs(mine[0].vmin - v.min()) < 1e-12


def test_plan_is_native(spark):
    """No Python on the workers: nothing of the planner may be a function."""
    import inspect

    from plumbline.operators import grid, propagate
    for module in (grid, propagate):
        assert "InPandas" not in inspect.getsource(module) and "InArrow" not in inspect.getsource(module)


def test_boxes_equal_the_whole_grid(spark):
    """The walk's surroundings hold the values of the whole grid, bit for bit, and are smaller than it."""
    import random

    from plumbline.operators import propagate as P
    rng = random.Random(4)
    gammas = [0.5, 0.65, 0.7, 0.75, 0.8, 0.85]
    cells, setup = [], []
    for q in range(24):
        r, c, wide = rng.randint(0, 110), rng.randint(0, 112), rng.randint(0, 6)
        setup.append((q, gammas[q % 6], q % 9, r, c))
        if q % 5 == 0:
            r, c = rng.randint(0, 110), rng.randint(0, 112)
        found = {(min(110, max(0, r + rng.randint(-wide, wide))), min(112, max(0, c + rng.randint(-wide, wide)))) for _ in range(rng.randint(0, 20))}
        cells += [(q, a, b, 1.0 if i == 0 else rng.random()) for i, (a, b) in enumerate(sorted(found))]
    reward = spark.createDataFrame(cells, "req_id long, row int, col int, r double")
    params = spark.createDataFrame(setup, "req_id long, gamma double, max_steps int, start_row int, start_col int")
    whole = {r.req_id: np.array(r.v) for r in P.value_grids(reward, params).collect()}
    boxes = P.value_boxes(reward, params).collect()
    assert sorted(whole) == sorted(b.req_id for b in boxes) == list(range(24))
    for b in boxes:
        v = np.array(b.v)
        assert v.shape == (b.height, b.width)
        assert (v == whole[b.req_id][b.r0:b.r0 + b.height, b.c0:b.c0 + b.width]).all()
    assert sum(b.height * b.width < 2000 for b in boxes) > 8
    key = lambda x: (x.req_id, x.step, x.row, x.col, x.v, x.vmax)
    near = sorted(map(key, G.plan_paths(reward, params).collect()))
    assert near == sorted(key(x) for x in G.plan_paths(reward, params, heat=True).collect() if x.kind == "path")
