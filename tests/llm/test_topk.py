import random

import numpy as np
import pytest

from millrace.llm import topk as K
from millrace.llm.common import ship


def by_brute_force(rows, k):
    usable = {}
    vectors = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(64 * float(x))) for x in v]
        vectors.append((i, q))
        usable[i] = min(usable.get(i, q), q)
    found = []
    for i, q in usable.items():
        if i % 3 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in vectors if j != i and len(c) == len(q))
            found += [(i, n, j, -s) for n, (s, j) in enumerate(scores[:k], 1)]
    return sorted(found)


def searched(spark, rows, k, kind="double"):
    ship(spark)
    df = K.quantised(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3))
    return sorted(tuple(r) for r in K.top_k(df.where("vec_id % 3 = 0"), df, k).collect())


def test_against_brute_force_with_ties(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(-2, 3) / 64 + 0.001 for _ in range(3)]) for i in range(300)]
    assert searched(spark, rows, 7) == by_brute_force(rows, 7)


def test_small_tiles_and_branches_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(K, "TILE", 7)
    monkeypatch.setattr(K, "BRANCH", 40)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    assert searched(spark, rows, 5) == by_brute_force(rows, 5)


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1e7, 1e7) for _ in range(5)]) for i in range(40)]
    assert searched(spark, rows, 4) == by_brute_force(rows, 4)


def test_components_and_sums_beyond_doubles(spark):
    rows = [(20, [1.0, 2.0]), (1, [4e7, 1.0]), (2, [1.0, 1.0]), (4, [1e15, -5e14 + 1]), (60, [0.5, 1.0]), (7, [-(2.0**50), 2.0**49])]
    assert searched(spark, rows, 5) == by_brute_force(rows, 5)
    with pytest.raises(Exception, match="beyond 64 bits"):
        searched(spark, [(3, [1e15]), (1, [1e15])], 3)
    with pytest.raises(Exception, match="beyond 64 bits"):
        searched(spark, [(3, [1e300]), (1, [1.0])], 3)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, None), (7, []), (None, [1.0, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-1.0, 0.5]), (12, [2.0, 1.0]), (15, [0.0, 0.0])]
    assert searched(spark, rows, 3) == by_brute_force(rows, 3)
    assert searched(spark, [(9, [1.0]), (None, None)], 3) == []
    assert searched(spark, [], 3) == []


def test_best_of_breaks_ties_by_id():
    scores, ids = np.array([[5, 7, 5, 7, 5], [1, 1, 1, 1, 1]]), np.array([9, 4, 3, 2, 1])
    row, col = K.best_of(scores, ids, 3)
    assert [(r, int(ids[c])) for r, c in zip(row.tolist(), col.tolist())] == [(0, 2), (0, 4), (0, 1), (1, 1), (1, 2), (1, 3)]
