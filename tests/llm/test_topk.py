import math

from pyspark.sql import functions as F

from farelane.llm.topk import search, top_k
import numpy as np


def brute(rows, k):
    good = {}
    for i, e in rows:
        if i is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        good.setdefault(i, []).append([math.floor(64 * x) for x in e])
    good = {i: min(v) for i, v in good.items()}
    out = []
    for q, v in good.items():
        if q % 20:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def answer(df, k):
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0, k).collect())


def test_nulls_ties_repeats_and_lengths(frame):
    rows = [(i, [math.sin(i * j + 1) * (1 + i % 7) for j in range(6)]) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(40)] + [(300, None), (301, [None, 1.0]), (302, [float("nan")]), (303, [float("inf")])]
    rows += [(None, [1.0] * 6), (304, []), (305, [2.0]), (320, [0.0] * 6), (20, [math.sin(20 * j + 1) * 7 for j in range(6)])]
    df = frame(rows, "vec_id long, embedding array<double>")
    assert answer(df, 20) == brute(rows, 20)


def test_few_rows_and_none(frame):
    assert answer(frame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>"), 20) == [(0, 1, 1, 64 * 128)]
    assert answer(frame([], "vec_id long, embedding array<double>"), 20) == []


def test_pruned_search_is_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 16))
    v = np.floor(64 * (centres[rng.integers(0, 30, 9000)] + 0.1 * rng.normal(size=(9000, 16))) * rng.uniform(0.2, 3, (9000, 1))).astype(np.int64)
    norms = np.sqrt((v**2).sum(1))
    order = np.argsort(-norms, kind="stable")
    v, norms, ids = v[order], norms[order], order.astype(np.int64)
    found = {}
    for q, i, s in search(v[:50], norms[:50], ids[:50], [None] * 50, v, norms, ids, 20):
        found.setdefault(q, []).append((-s, i))
    for j in range(50):
        scores = v @ v[j]
        keep = ids != ids[j]
        top = np.lexsort((ids[keep], -scores[keep]))[:20]
        assert sorted(found[ids[j]]) == [(-int(scores[keep][t]), int(ids[keep][t])) for t in top]


def test_huge_components_stay_exact():
    v = np.array([[2**40, 3], [2**40, 5], [1, 1]], np.int64)
    norms = np.sqrt((v.astype(float) ** 2).sum(1))
    got = list(search(v[:1], norms[:1], np.array([0]), [None], v, norms, np.arange(3), 2))
    assert got == [(0, 1, 2**63 - 1), (0, 2, 2**40 + 3)]
