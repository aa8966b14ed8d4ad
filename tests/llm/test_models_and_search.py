"""Quality classifier, WARC archives and nearest neighbours."""
import base64
import glob
import hashlib
import tempfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import ann, quality_model, warc
from plumbline.llm.common import table
from tests.conftest import SF001
from tests.llm.fixtures import DOCS, EDGE, docs_frame, prose

# -------------------------------------------------------------- classifier


def test_gradient_is_right():
    r = np.random.default_rng(0)
    bags = [r.random((n, quality_model.FEATURES)) for n in (1, 3, 5)]
    sizes = np.array([len(b) for b in bags])
    x, cuts, y = np.concatenate(bags), np.cumsum(sizes) - sizes, np.array([0.0, 1.0, 1.0])
    m = quality_model.Attention.fresh()
    g = m.gradient(x, cuts, y)

    def loss():
        z = m.forward(x, cuts)[0]
        return np.mean(np.log1p(np.exp(z)) - y * z)

    for k, p in m.p.items():
        flat = p.reshape(-1)
        for i in r.integers(0, flat.size, 4):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g[k].reshape(-1)[i]) < 1e-6, k


def test_attention_finds_the_passage():
    """A bag is bad by one passage alone; attention must weigh that one."""
    good, bad = quality_model.features(prose(1, 640)), quality_model.features("$$$ ### " * 32)
    bags, y = [], []
    for i in range(120):
        rows = good[[(i + k) % len(good) for k in range(4)]].copy()
        if i % 2:
            rows[i % 4] = bad[0]
        bags.append(rows)
        y.append(1.0 - i % 2)
    m = quality_model.train(bags, np.array(y))
    score = m.score(bags)
    assert ((score >= 0.5) == np.array(y, bool)).all()
    _, _, _, _, weight, _, _ = m.forward(bags[1].astype(float), np.array([0]))
    assert weight.argmax() == 1


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in quality_model.query(spark, SF001).collect()}
    assert len(got) == table(spark, SF001, "documents").count()
    labels = {r.doc_id: r.quality for r in table(spark, SF001, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [d for d in labels if got[d].held_out]
    assert sum(got[d].predicted == labels[d] for d in held) >= 0.93 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())


def test_classifier_edges(spark):
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")
    rows = [*EDGE, *[(100 + i, prose(i, 70) if i % 2 else "$$$ ### " * 40, "en") for i in range(40)]]
    marks = labels([(100 + i, i % 2, 0, "x") for i in range(40)] + [(None, 1, 0, "x"), (101, 1, 0, "x"), (6, None, 0, "x")])
    out = quality_model.predict(docs_frame(spark, rows), marks).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.predicted == r.doc_id % 2 for r in out if (r.doc_id or 0) >= 100)
    assert len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in out if r.doc_id == 6}) == 1
    kept = quality_model.keep_good(docs_frame(spark, rows), marks)
    assert kept.columns == DOCS.names
    assert {r.score for r in quality_model.predict(docs_frame(spark, EDGE), labels([])).collect()} == {0.5}
    assert quality_model.predict(docs_frame(spark, []), marks).count() == 0


# -------------------------------------------------------------------- WARC

def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows],
                                 "page_id long, url string, html string, record string, sha string")


def round_trip(spark, df, **kw):
    path = tempfile.mkdtemp(prefix="plumbline-warc-") + "/a"
    warc.write_archives(df, path, **kw)
    return path, warc.read_archives(spark, path).collect()


BIG = "".join(f"<p>é中😀{i}</p>\r\n\r\n" for i in range(9000))
FORGED = "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (9, None, "same"), (3, "u", None), (4, "u", ""), (5, "u", BIG),
            (6, "u", BIG), (7, "u", FORGED), (8, "line\r\nbreak: x", "one"), (None, "u", "same"), (10, "u", "dup"), (10, "u", "dup")]
    path, out = round_trip(spark, pages_frame(spark, rows))
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r.page_id, []).append(r)
    response = {"same": 9, "": 4, BIG: 6, FORGED: 7, "one": 8, "dup": 10}
    for page, _, html in rows:
        raw = (html or "").encode()
        for r in got[page]:
            assert r.payload_bytes == len(raw)
            assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
            first = response[html or ""]
            if page is None or page == first:
                assert (r.record_type, r.refers_to) == ("response", None)
            else:
                assert (r.record_type, r.refers_to) == ("revisit", first)
    # the archives are plain WARC: read them without Spark, join segments
    text = {}
    for f in sorted(glob.glob(f"{path}/part-*")):
        for head, block in warc.parse(memoryview(open(f, "rb").read())):
            assert len(block) <= warc.CHUNK + 200
            if head["warc-type"] != "revisit" and head["x-page-id"] == "6":
                data = bytes(block)
                no = int(head["warc-record-id"].rpartition("-")[2][:-1])
                text[no] = data.split(b"\r\n\r\n", 1)[1] if head["warc-type"] == "response" else data
    assert len(text) > 2 and b"".join(text[k] for k in sorted(text)).decode() == BIG


def test_warc_small_payloads_are_responses(spark):
    _, out = round_trip(spark, pages_frame(spark, [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")]), min_bytes=5)
    assert {r.page_id: r.refers_to for r in out} == {1: None, 2: None, 3: 4, 4: None}


def test_warc_damage_is_seen(spark):
    path, _ = round_trip(spark, pages_frame(spark, [(1, "u", "payload here")]))
    f = [x for x in glob.glob(f"{path}/part-*") if open(x, "rb").read()][0]
    raw = open(f, "rb").read()
    open(f, "wb").write(raw.replace(b"payload here", b"payload hurt"))
    for crc in glob.glob(f"{path}/.part-*.crc"):
        open(crc, "wb").close()
    with pytest.raises(Exception, match="digest|checksum|Checksum"):
        warc.read_archives(spark, path).collect()


def test_warc_empty_and_query(spark):
    assert round_trip(spark, pages_frame(spark, []))[1] == []
    pages = {r.page_id: r.html for r in table(spark, SF001, "pages").collect()}
    out = warc.query(spark, SF001).collect()
    assert {r.page_id: r.payload_digest for r in out} == {
        p: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for p, h in pages.items()}


# ------------------------------------------------------ nearest neighbours

def brute(vectors, queries, k):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], float)
    out = {}
    for q in queries:
        s = x @ np.array(vectors[q], float)
        order = sorted((-round(v, 12), i) for v, i in zip(s.tolist(), ids, strict=True) if i != q)[:k]
        out[q] = [i for _, i in order]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, list string, unit int")


def test_recall(spark):
    rows = table(spark, SF001, "embeddings").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    out = ann.query(spark, SF001).collect()
    want = brute(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
        exact = sum(np.float64(a) * np.float64(b) for a, b in zip(vectors[r.query_id], vectors[r.vec_id], strict=True))
        assert abs(r.score - exact) < 1e-12
    assert got.keys() == want.keys()
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_lists_parts_and_graph(spark, monkeypatch):
    """Many lists, split into parts, with copies of one vector: recall stays high."""
    for name, value in (("LISTS", 2.0), ("PART_ROWS", 16), ("QUERY_PART", 8), ("DEGREE", 6)):
        monkeypatch.setattr(ann, name, value)
    r = np.random.default_rng(4)
    centres = r.standard_normal((12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * r.standard_normal(16)).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, [1.0] * 16) for i in range(300)]
    got = {}
    for x in ann.nearest(frame(spark, rows), F.col("vec_id") % 10 == 0, k=10).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id))
    want = brute(dict(rows), [i for i, _ in rows if i % 10 == 0], 10)
    assert got.keys() == want.keys()
    hits = sum(len({v for _, v in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [v for _, v in sorted(got[1100])] == want[1100]  # ties among copies go to the smaller ids


@pytest.mark.parametrize("spread, share", [(None, 1.0), (0.15, 0.15)])
def test_recall_with_many_lists(spark, monkeypatch, spread, share):
    """Hundreds of lists: vectors without any structure need many of them,
    clustered ones a small share, and both find their neighbours."""
    monkeypatch.setattr(ann, "LISTS", 15.0)
    r = np.random.default_rng(6)
    x = r.standard_normal((4000, 32))
    if spread:
        x = r.standard_normal((200, 32))[np.arange(4000) % 200] + spread * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    index, seen = ann.build(ann.vectors(frame(spark, rows))), []
    assert len(index.c) > 900
    visits = ann.visits
    monkeypatch.setattr(ann, "visits", lambda *a: seen.append(visits(*a)) or seen[0])
    got = {}
    for y in ann.nearest(frame(spark, rows), F.col("vec_id") % 13 == 0, k=10).collect():
        got.setdefault(y.query_id, set()).add(y.vec_id)
    want = brute(dict(rows), [i for i, _ in rows if i % 13 == 0], 10)
    assert sum(len(got[q] & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))
    assert 1 <= seen[0][1] <= share * len(index.c)
    posted = sum(len(index.lists_of(x[at:at + 500])[0]) for at in range(0, 4000, 500))
    assert 4000 < posted < 1.5 * 4000  # only boundary vectors are copied


def test_graph_search_finds_the_nearest_centroids():
    r = np.random.default_rng(8)
    index = ann.Index(r.standard_normal((700, 17)), 1.0)
    q = r.standard_normal((60, 16))
    for index.least in (1, 40, 700):
        row, at = index.search(q)
        d = index.distances(np.concatenate([q, np.zeros((60, 1))], axis=1))
        near = np.argsort(d, axis=1)[:, :index.least]
        hits = sum(len(set(at[row == i]) & set(near[i])) for i in range(60))
        assert len(at) == 60 * index.least and hits >= 0.95 * len(at)


def test_ann_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (40, [-1.0, 0.0])]
    out = sorted(map(tuple, ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()))
    assert out == [(0, 1, 8, 2.0), (0, 2, 9, 2.0), (0, 3, 20, 0.5), (0, 4, 40, -1.0),
                   (20, 1, 8, 1.0), (20, 2, 9, 1.0), (20, 3, 0, 0.5), (20, 4, 40, -0.5),
                   (40, 1, 20, -0.5), (40, 2, 0, -1.0), (40, 3, 8, -2.0), (40, 4, 9, -2.0)]
    assert ann.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
