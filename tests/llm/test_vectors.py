"""Vector operators against brute force, with cells and chunks small enough to be cut."""

import math
from collections import Counter

import numpy as np
import pytest

from stepforge.llm import cells, topk, vector_dedup
from stepforge.llm.topk import top_products
from stepforge.llm.vector_dedup import vector_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int, row long, side int"


def made(n, label_of, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, 8))
    x = centers[rng.integers(0, 6, n)] + 0.12 * rng.normal(size=(n, 8))
    x[n // 2:n // 2 + 20] = x[0]
    return [(i, x[i].astype(np.float32).tolist(), label_of(i), 1, 2) for i in range(n)]


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [(None, [1.0] * 8, 0, 0, 0), (1001, None, 0, 0, 0), (1050, [], 0, 0, 0), (1002, [0.0] * 8, 0, 0, 0), (1100, [1.0, None] * 4, 0, 0, 0),
            (1003, [nan] * 8, 0, 0, 0), (1004, [inf] * 8, 0, 0, 0), (1005, [1.0] * 8, None, 0, 0), (1006, [1.0, 2.0], 0, 0, 0),
            (1007, [2.0, 4.0], 0, 0, 0), (1150, [1.0, 2.0], 1, 0, 0)]


@pytest.fixture(params=["cut", "whole"])
def small(request, monkeypatch):
    if request.param == "cut":
        monkeypatch.setattr(vector_dedup, "CELL", 60)
        monkeypatch.setattr(vector_dedup, "MEMBERS", 25)
        monkeypatch.setattr(vector_dedup, "VISITORS", 20)
        monkeypatch.setattr(topk, "CELL", 60)
        monkeypatch.setattr(topk, "MEMBERS", 40)
        monkeypatch.setattr(topk, "GUESTS", 3)
        monkeypatch.setattr(cells, "SAMPLE", 120)
        monkeypatch.setattr(topk, "SAMPLE", 120)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def test_vector_duplicates(spark, small):
    rows = made(400, lambda i: 0 if i % 3 else i % 2, 5) + odd_rows()
    got = Counter(map(tuple, vector_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()))
    n, par, links = len(rows), list(range(len(rows))), [0] * len(rows)

    def root(x):
        while par[x] != x:
            x = par[x]
        return x

    ok = [usable(v) and any(v) and lab is not None for _, v, lab, *_ in rows]
    unit = [np.array(v, float) / np.linalg.norm(v) if o else None for o, (_, v, *_) in zip(ok, rows)]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98 - 1e-12:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                par[max(a, b)] = min(a, b)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), math.inf), r[0])
    expected = Counter((r[0], links[i], least.get(root(i)), r[0] is not None and r[0] == least.get(root(i))) for i, r in enumerate(rows))
    assert got == expected
    assert vector_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_top_products(spark, small):
    rows = made(400, lambda i: 0, 6) + odd_rows() + [(0, [9.0] * 8, 0, 0, 0)]
    got = Counter(map(tuple, top_products(spark.createDataFrame(rows, SCHEMA)).collect()))
    by_id = {}
    for i, v, *_ in rows:
        if i is not None and usable(v):
            by_id[i] = min(by_id.get(i, v), v)
    ints = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in by_id.items()}
    expected = Counter()
    for q in ints:
        if q % 50 == 0:
            best = sorted((-int(ints[q] @ x), i) for i, x in ints.items() if i != q and len(x) == len(ints[q]))[:5]
            expected.update((q, rank + 1, i, -s) for rank, (s, i) in enumerate(best))
    assert got == expected
    assert top_products(spark.createDataFrame([], SCHEMA)).count() == 0
