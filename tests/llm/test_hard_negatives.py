"""Hard negatives against brute force, and what the segment filter drops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from quillspark.llm import hard_negatives as H

VECTOR = "vec_id long, label int, embedding array<double>, score string, place int, rank int"


def brute(rows, is_anchor, k=5):
    """Expected rows in order, by Python's integers."""
    good = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in rows
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, l, v in sorted(good, key=lambda r: (r[0], r[1], r[2])):
        if is_anchor(i):
            anchors.setdefault(i, (l, v))
    out = []
    for a, (label, v) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, l) for i, l, w in good if i != a and len(w) == len(v))
        for s, i, _ in [r for r in scored if r[2] == label][:k]:
            window = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:k]
            out += [(a, i, n, j, -s, -t) for n, (t, j, _) in enumerate(window, 1)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        near = [rng.gauss(0, 1) for _ in range(3)]
        rows.append((i, rng.choice([0, 0, 0, 1, 2, None]), [near[j // 3] + rng.gauss(0, .3) for j in range(9)]))
    rows += [(301, 1, None), (400, 1, []), (401, 1, []), (402, 0, []), (500, 0, [1.0, None]), (501, 0, [float("nan")] * 9), (502, 0, [float("inf")] * 9), (None, 0, [1.0] * 9),
             (600, 2, [0.0] * 9), (601, 2, [0.0] * 9), (602, 1, [0.0] * 9), (700, 1, [3e6] * 9), (701, 1, [3e6 + 1 / 256] * 9), (702, 0, [2.9e6] * 9), (703, 0, [2.8e6] * 9)]
    rows += [rows[10], rows[20], rows[20], (20, 1, rows[21][2])]
    rows += [(1000 + i, i % 2, [float(i % 3), 1.0]) for i in range(40)]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], VECTOR).repartition(3)
    want = brute(rows, lambda i: i % 10 == 0)
    for size in (1 << 20, 2000):
        got = H.mine(table, F.col("vec_id") % 10 == 0, round_bytes=size).collect()
        assert sorted(map(tuple, got)) == want
    assert H.mine(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_summaries_bound_the_score_and_drop_pairs():
    rng = np.random.default_rng(4)
    walk = lambda n: np.floor(256 * np.repeat(rng.normal(size=(n, 8)), 8, axis=1) + rng.normal(size=(n, 64)) * 16)
    a, x = walk(50), walk(4000)
    exact = a @ x.T
    for n in H.LEVELS:
        (am, ad), (xm, xd) = H.segments(a, n), H.segments(x, n)
        assert (am @ xm.T + ad @ xd.T >= exact - 1e-6).all() and (am @ xm.T - ad @ xd.T <= exact + 1e-6).all()
    sides = [H.Side(np.arange(len(v)), np.zeros(len(v)), v).summarised() for v in (a, x)]
    low, high = np.sort(exact, axis=1)[:, -20].astype(float), np.sort(exact, axis=1)[:, -5].astype(float)
    sift = H.Filter()
    r, c, s = sift(*sides, np.ones(exact.shape, dtype=bool), low, high)
    assert set(zip(r, c)) == set(zip(*np.nonzero((exact >= low[:, None]) & (exact <= high[:, None])))) and (s == exact[r, c]).all()
    assert sift.seen == exact.size and sift.scored < 0.02 * sift.seen
