"""Near-duplicates against brute force over full shingle sets."""
import random

from plumbline.llm import near_dup as N
from tests.llm.fixtures import EDGE, LONG, docs_frame, prose


def brute(rows):
    """doc_id -> (set size, class) by comparing every pair of shingle sets."""
    sets = {}
    for d, t, _ in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {d: d for d in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in sets}


def mutated(text, r, share):
    words = text.split(" ")
    for _ in range(int(len(words) * share)):
        words[r.randrange(len(words))] = f"q{r.randint(0, 10 ** 6)}"
    return " ".join(words)


def corpus(seed):
    """Copies, near copies around the threshold, a shared passage, short texts."""
    r = random.Random(seed)
    rows, shared = [], prose(999, 60)
    base = [prose(s, r.randint(30, 200)) for s in range(12)]
    for i in range(260):
        b = r.choice(base[:4] if i % 3 else base)
        kind = i % 5
        text = (b if kind == 0 else mutated(b, r, r.uniform(0.005, 0.06)) if kind < 3 else
                prose(5000 + i, 40) + " " + shared if kind == 3 else prose(9000 + i, r.randint(1, 30)))
        rows.append((1000 - 3 * i, text.upper() if i % 7 == 0 else text, "en"))
    return rows


def test_equals_brute_force(spark):
    rows = corpus(4)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(docs_frame(spark, rows)).collect()}
    want = {d: (n, c, c == d) for d, (n, c) in brute(rows).items()}
    assert got == want
    assert len({c for _, c, _ in got.values()}) < len(rows)


def test_blocks_and_members_split(spark, monkeypatch):
    """The rest step gives the same classes when hot buckets and large
    components are cut into many blocks and stars confirm little."""
    monkeypatch.setattr(N, "BLOCK", 7)
    monkeypatch.setattr(N, "MEMBER_BLOCK", 5)
    monkeypatch.setattr(N, "TRIES", 1)
    rows = corpus(8)
    got = {r.doc_id: r.component_id for r in N.near_duplicates(docs_frame(spark, rows)).collect()}
    assert got == {d: c for d, (_, c) in brute(rows).items()}


def test_index_guarantee():
    """Signatures that differ in RADIUS slots always share a key."""
    r = random.Random(1)
    import numpy as np
    for _ in range(300):
        a = np.array([r.randrange(1 << 16) for _ in range(N.SLOTS)], np.uint16)
        b = a.copy()
        for s in r.sample(range(N.SLOTS), N.RADIUS):
            b[s] ^= 1
        x, y = N.chunk_keys(np.stack([a, b])).tolist()
        assert set(x) & set(y)


def test_edges(spark):
    out = N.near_duplicates(docs_frame(spark, EDGE)).collect()
    assert len(out) == len(EDGE)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id, r.kept))
    assert got[1] == {(0, 1, True)} and got[2] == {(0, 2, True)} and got[3] == {(0, 3, True)}
    assert got[6] == {(76, 6, True)} and got[7] == {(76, 6, False)}
    assert got[9] == {(1, 9, True)} and got[10] == {(1, 9, False)}
    assert got[5] == {(len(N.shingle_set(LONG)), 5, True)}
    assert all(c is None and kept for _, c, kept in got[None])
    kept = N.drop_near_duplicates(docs_frame(spark, EDGE))
    assert kept.columns == docs_frame(spark, EDGE).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 8, 9, 11]
    assert kept.filter("doc_id is null").count() == 2


def test_empty(spark):
    assert N.near_duplicates(docs_frame(spark, [])).count() == 0
