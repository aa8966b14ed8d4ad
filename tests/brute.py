"""Brute-force single-machine versions of the operators, for tests only.

small fixtures; the Spark operators must give the same answers.
"""
from __future__ import annotations

import numpy as np


def tree_fit(X, y, max_depth=10, min_split=10, min_leaf=5, n_thr=50, balanced=True):
    """Recursive weighted-Gini tree; returns {node_id: dict}."""
    classes = sorted(set(y))
    y = np.asarray(y)
    n = len(y)
    if balanced:
        w_of = {c: n / (len(classes) * int((y == c).sum())) for c in classes}
    else:
        w_of = {c: 1.0 for c in classes}
    qs = np.linspace(0.01, 0.99, n_thr)
    out = {}

    def cls_counts(idx):
        return np.array([int((y[idx] == c).sum()) for c in classes])

    def build(idx, nid, depth):
        cnt = cls_counts(idx)
        cw = np.array([cnt[k] * w_of[c] for k, c in enumerate(classes)])
        tw = cw.sum()
        g = 0.0 if tw <= 0 else 1.0 - ((cw / tw) ** 2).sum()
        node = dict(depth=depth, n=len(idx), gini=g, cw=cw)
        out[nid] = node
        if depth >= max_depth or len(idx) < min_split or g <= 1e-12:
            return
        best = (-np.inf, None, None)
        for f in range(X.shape[1]):
            col = X[idx, f]
            if col.min() == col.max():
                continue
            thr = np.unique(np.quantile(col, qs))
            for t in thr:
                left = col <= t
                ln, rn = left.sum(), (~left).sum()
                if ln < min_leaf or rn < min_leaf:
                    continue
                lc = cls_counts(idx[left])
                lcw = np.array([lc[k] * w_of[c] for k, c in enumerate(classes)])
                lw = lcw.sum()
                rw = tw - lw
                if lw <= 0 or rw <= 0:
                    continue
                rcw = cw - lcw
                lg = 1 - ((lcw / (lw + 1e-12)) ** 2).sum()
                rg = 1 - ((rcw / (rw + 1e-12)) ** 2).sum()
                dec = g - (lw * lg + rw * rg) / tw
                if dec > best[0] + 1e-12:
                    best = (dec, f, t)
        if best[1] is None or best[0] <= 1e-12:
            return
        node.update(feature=best[1], threshold=best[2], gain=best[0])
        left = X[idx, best[1]] <= best[2]
        build(idx[left], 2 * nid, depth + 1)
        build(idx[~left], 2 * nid + 1, depth + 1)

    build(np.arange(n), 1, 0)
    return out, classes


def char_wb(text, n_min=2, n_max=4):
    grams = []
    for w in text.lower().split():
        w = " " + w + " "
        for n in range(n_min, n_max + 1):
            if len(w) < n:
                if n == n_min:
                    grams.append(w)
                break
            for i in range(len(w) - n + 1):
                grams.append(w[i:i + n])
    return grams


def knn_top(Xtr, ytr, tid, Xq, k):
    mean, std = Xtr.mean(axis=0), Xtr.std(axis=0)
    zt = (Xtr - mean) / (std + 1e-8)
    zq = (Xq - mean) / (std + 1e-8)
    nt = np.linalg.norm(zt, axis=1) + 1e-10
    nq = np.linalg.norm(zq, axis=1) + 1e-10
    sims = np.round((zq @ zt.T) / (nq[:, None] * nt[None, :]), 10)
    out = []
    for i in range(len(Xq)):
        order = sorted(range(len(tid)), key=lambda j: (-sims[i, j], tid[j]))[:k]
        labs = [ytr[j] for j in order]
        u, c = np.unique(labs, return_counts=True)
        out.append(str(u[np.argmax(c)]))
    return out
