"""Vector codes, phrase collocations and repeat removal against plain versions."""
import hashlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from plumbline.llm import collocations as L
from plumbline.llm import repeats as R
from plumbline.llm import vector_codes as V
from tests.llm.fixtures import EDGE, LONG, docs_frame, prose

SF0001 = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


# -- vector codes ------------------------------------------------------------------

def plain_codes(rows):
    """rows of (vec_id, vector, label): codes, errors and codebooks, by loops over Python integers."""
    kept = [(i, [math.floor(x * 4096) if abs(x) < 1e200 else int(x) * 4096 for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dim = len(kept[0][1])
    cuts = V.cuts(dim)
    first = {}
    for i, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(i, v)
    books = [[v[a:b] for v in list(first.values())[:16]] for a, b in cuts]
    dist = lambda x, y: sum((p - q) ** 2 for p, q in zip(x, y, strict=True))
    own = lambda v: [min((dist(v[a:b], e), j) for j, e in enumerate(books[p])) for p, (a, b) in enumerate(cuts)]
    for _ in range(6):
        at = [own(v) for _, v, _ in kept]
        for p, (a, b) in enumerate(cuts):
            for j in range(len(books[p])):
                mine = [v[a:b] for (_, v, _), w in zip(kept, at, strict=True) if w[p][1] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = [(i, "".join(f"{j:02x}" for _, j in own(v)), sum(d for d, _ in own(v)), lab) for i, v, lab in kept]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vec_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "vec_id long, embedding array<double>, label string, vec string, body string")


@pytest.mark.parametrize("chunk", [4096, 37])
def test_codes_equal_plain_version(spark, monkeypatch, chunk):
    monkeypatch.setattr(V, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(V, "LEAF_ROWS", 4)
    r = random.Random(3)
    centres = [[r.gauss(0, 1) for _ in range(20)] for _ in range(9)]
    rows = [(i * 3, [c + r.gauss(0, 0.1) for c in r.choice(centres)], r.choice(["a", "b", None])) for i in range(300)]
    rows += [rows[5], rows[5], (None, rows[9][1], "a"), (1000, None, "a"), (1001, [float("nan")] * 20, "a"),
             (1002, [None] + [0.0] * 19, "b"), (1003, [0.0] * 20, None), (1004, [float("inf")] * 20, "a"), (1005, [1.0], "a"), (1006, [], "a")]
    want, digest = plain_codes([x for x in rows if x[1] is None or len(x[1]) == 20])
    coded, books = V.product_codes(vec_frame(spark, rows).repartition(3))
    assert rows_of(coded.select("vec_id", "code", "error", "label")) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert V.codebooks_digest(books) == digest


def test_codes_of_huge_and_few_vectors(spark):
    rows = [(i, [(-1) ** i * 10.0 ** (i + k) for k in range(8)], "a") for i in range(30)] + [(40, [1e300] * 8, None), (41, [-1.7e308] * 8, None)]
    want, digest = plain_codes(rows)
    coded, books = V.product_codes(vec_frame(spark, rows))
    got = {r.vec_id: (r.code, r.error) for r in coded.collect()}
    assert got == {i: (c, e if e < 1 << 63 else None) for i, c, e, _ in want} and V.codebooks_digest(books) == digest
    few, _ = V.product_codes(vec_frame(spark, rows[:3]))
    assert sorted(r.code for r in few.collect()) == ["0" * 16, "01" * 8, "02" * 8]
    assert V.product_codes(vec_frame(spark, []))[0].collect() == []
    assert V.product_codes(vec_frame(spark, [(None, [1.0] * 8, "a")]))[0].collect() == []


def test_cover_tree_covers_and_prunes():
    r = np.random.default_rng(2)
    x = (r.normal(size=(9, 6))[r.integers(0, 9, 3000)] * 4096 + r.normal(size=(3000, 6)) * 40).astype(np.int64)
    tree = V.CoverTree(x)
    assert sorted(tree.order.tolist()) == list(range(3000))
    for node in range(len(tree.centre)):
        own = x[tree.order[tree.lo[node]:tree.hi[node]]] - x[tree.centre[node]]
        assert np.sqrt((own.astype(float) ** 2).sum(axis=1)).max() <= tree.radius[node] + 1e-9
        kids = range(tree.kid[node], tree.kid_end[node])
        assert not kids or [tree.lo[node], tree.hi[node]] == [tree.lo[kids[0]], tree.hi[kids[-1]]]
    book = x[r.permutation(3000)[:16]]
    whole, rows, which = V.assign(x, tree, book)
    full = np.full(3000, -1)
    for lo, hi, e in whole:
        full[tree.order[lo:hi]] = e
    full[rows] = which
    assert (full == V.squared(x, book).argmin(axis=1)).all()
    assert len(rows) < 1500                      # most rows are assigned with their subtree


# -- collocations -----------------------------------------------------------------

def plain_phrases(rows, least=10, covered=50, top=2000):
    import re
    count, n = {}, Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            c = count.setdefault(lang, Counter())
            for k in (1, 2, 3):
                c.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in count.items():
        inside = {}
        for p, f in c.items():
            if len(p) == 3 and f >= least:
                for q in (p[:2], p[1:]):
                    inside[q] = max(inside.get(q, 0), f)
        found = []
        for p, a in c.items():
            if len(p) > 1 and a >= least and 100 * inside.get(p, 0) < covered * a:
                score, _, left, right = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def phrase_rows():
    r = random.Random(7)
    words = [*"alpha beta Gamma delta eins zwei été ΣΑΣ x y".split(" "), "new york", "new york city", "a\x00b"]
    rows = [(i, "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(r.randint(1, 90))),
             r.choice(["en", "de", None, "und"])) for i in range(150)]
    return rows + rows[:4] + EDGE


@pytest.mark.parametrize("small", [False, True])
def test_collocations_equal_plain_version(spark, monkeypatch, small):
    rows = phrase_rows() + [(900, "hot word " * 3000, "en")]
    if small:                                   # many blocks, many groups, words and pairs split
        monkeypatch.setattr(L, "RUN_BYTES", 2000)
        monkeypatch.setattr(L, "BLOCK_WORDS", 256)
        monkeypatch.setattr(L, "MAX_PREFIXES", 10 ** 6)
    got = L.collocations(docs_frame(spark, rows).repartition(4), group_rows=64 if small else 1 << 20)
    want = plain_phrases(rows)
    assert rows_of(got) == want and len(want) > 20


def test_prefixes_are_split_and_add_up(spark, monkeypatch):
    monkeypatch.setattr(L, "BLOCK_WORDS", 512)
    rows = [(i, " ".join(f"the w{random.Random(i * 999 + k).randint(0, 50)} of" for k in range(200)), "en") for i in range(20)]
    docs = docs_frame(spark, rows)
    blocks = docs.select("lang", "text").transform(
        L.in_arrow, L._blocks, "lang string, n long, rows long, words binary, body binary").cache()
    total, n = blocks.selectExpr("sum(rows)", "count(*)").first()
    words, _pairs = L.split_prefixes(blocks, total, n, 64)
    assert len(words) > 0
    counts, totals = L.phrase_counts(docs, 10, 512)
    f = {(r.size, r.phrase): r.f for r in counts.collect()}
    assert f[(1, "the")] == f[(1, "of")] == 4000 and totals.first().n == 12000
    assert rows_of(L.collocations(docs, group_rows=512)) == plain_phrases(rows)


def test_phrase_edges(spark):
    assert L.collocations(docs_frame(spark, [])).collect() == []
    assert L.collocations(docs_frame(spark, [(1, None, "en"), (2, "", None), (3, " .\n", "en")])).collect() == []


# -- repeats ---------------------------------------------------------------------

def plain_removed(rows, size=100):
    """(doc_id, text) -> row, by a set of all strings of ``size`` bytes seen so far."""
    import xxhash
    seen, out = set(), {}
    key = lambda r: ((1 << 63) - 1 if r[0] is None else r[0], xxhash.xxh64_intdigest((r[1] or "").encode()))
    for r in sorted({(d, t or "") for d, t, _ in rows}, key=key):
        b = r[1].encode()
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if b[s:s + size] in seen:
                gone[s:s + size] = b"\1" * size
            else:
                seen.add(b[s:s + size])
        spans = [(i, j) for i, j in zip([i for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])],
                                        [i + 1 for i in range(len(b)) if gone[i] and (i + 1 == len(b) or not gone[i + 1])], strict=True)]
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[r] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def repeat_rows(seed=5):
    r = random.Random(seed)
    shared = [prose(70 + i, 40) for i in range(6)] + ["été ñandú — " * 30, "ab" * 150, "\x00" * 180]
    rows = []
    for i in range(160):
        parts = [prose(1000 + i * 7 + k, r.randint(0, 40)) for k in range(3)]
        for _ in range(r.randint(0, 3)):
            s = r.choice(shared)
            a = r.randint(0, len(s) // 3)
            parts.insert(r.randint(0, 3), s[a:len(s) - r.randint(0, len(s) // 3)])
        rows.append((5000 - 3 * i, r.choice([" ", "\n", ""]).join(parts), "en"))
    rows += [(r.randint(0, 9000), rows[k][1], "de") for k in range(12)] + EDGE
    return rows + [(20000, "x" * 3000, "en"), (20001, "x" * 99, "en"), (20002, "x" * 100, "en"), (6, prose(1, 81), "en")]


@pytest.mark.parametrize("small", [False, True])
def test_repeats_equal_plain_version(spark, monkeypatch, small):
    if small:                                   # many pieces and parts, trees of few contexts, frequent grams string by string
        for k, v in {"PIECE_BYTES": 3000, "RUN_BYTES": 1 << 15, "PART_BYTES": 1 << 15, "TEXT_PART_BYTES": 1 << 15, "HOT": 5, "TREE_BYTES": 2000}.items():
            monkeypatch.setattr(R, k, v)
    rows = repeat_rows()
    want = plain_removed(rows)
    got = R.remove_repeats(docs_frame(spark, rows).repartition(5)).collect()
    assert len(got) == len(rows)
    by = {}
    for (d, t), v in want.items():
        by.setdefault(d, []).append(v)
    for r in got:
        assert (r.n_bytes, r.n_removed, [(s.start, s.start + s.length) for s in r.spans], r.kept_sha256, bytes(r.kept)) in by[r.doc_id]
        assert r.n_spans == len(r.spans)
    assert sum(r.n_removed for r in got) > 10_000
    assert R.remove_repeats(docs_frame(spark, [])).collect() == []


def test_scan_finds_maximal_repeats():
    """The stack scan over a suffix array against all pairs of positions."""
    r = random.Random(1)
    for _ in range(30):
        text = "".join(r.choice("ab") for _ in range(60))
        order = sorted(range(60), key=lambda i: text[i:])
        def common(i, j):
            return next((k for k in range(60 - max(i, j)) if text[i + k] != text[j + k]), 60 - max(i, j))
        lcp = [0] + [common(i, j) for i, j in zip(order, order[1:], strict=False)]
        lcp = [x if x >= 4 else 0 for x in lcp]
        at, n = R.scan(order, order, [ord(text[i - 1]) if i else 256 for i in order], lcp)
        gone = {p + k for p, m in zip(at, n, strict=True) for k in range(m)}
        want = {p + k for p in range(57) for k in range(4) if text.find(text[p:p + 4]) < p}
        assert gone == want


def test_one_string_in_very_many_documents(spark, monkeypatch):
    """A passage with another neighbour in every document: dealt string by string."""
    monkeypatch.setattr(R, "HOT", 50)
    passage = prose(3, 30)
    rows = [(i, f"{hashlib.md5(str(i).encode()).hexdigest() * 4} {passage} {hashlib.md5(str(-i).encode()).hexdigest() * 4}", "en") for i in range(400)]
    got = {r.doc_id: r.n_removed for r in R.remove_repeats(docs_frame(spark, rows), with_text=False).collect()}
    want = plain_removed(rows)
    assert got == {d: v[1] for (d, _), v in want.items()}


@pytest.mark.parametrize("module,name", [(V, "op11"), (L, "op12"), (R, "op13")])
def test_twin(spark, module, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = module.query(spark, SF0001)
    res = con.execute(module.ORACLE_SQL)
    cols = [d[0] for d in res.description]
    want = [tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()]
    assert rows_of(df) == sorted(want, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_long_text(spark):
    rows = [(1, LONG, "en"), (2, LONG[1000:200_000], "en")]
    got = {r.doc_id: r.n_removed for r in R.remove_repeats(docs_frame(spark, rows), with_text=False).collect()}
    assert got[2] == 199_000
