"""Hard negatives against plain loops over all rows, with blocks small enough that every round and split runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from retail_marts.llm import hard_negatives as H


def brute(rows, every):
    ok = {(i, y, tuple(int(np.floor(256 * x)) for x in v)) for i, v, y in rows
          if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for i, y, v in ok:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z == y) for j, z, w in ok if j != i)
        for s, j, _ in [x for x in scored if x[2]][:5]:
            hard = [(-t, k) for t, k, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(i, j, r + 1, k, -s, t) for r, (t, k) in enumerate(hard)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def mined(df, every):
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % every == 0).collect())


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 64)
    monkeypatch.setattr(H, "MEMBERS", 8)


def test_equals_loops_with_ties_copies_and_odd_rows(spark, small):
    rng = np.random.default_rng(1)
    base, rows = rng.integers(-120, 120, size=(40, 4)) / 256, []
    for i in range(400):
        v = [float(x) for x in (base[rng.integers(0, 40)] if rng.random() < 0.7 else rng.normal(size=4) * 0.3)]
        y, r = int(rng.integers(0, 4)), rng.random()
        if r < 0.02:
            v = None
        elif r < 0.04:
            v[1] = float("nan")
        elif r < 0.06:
            v[2] = None
        elif r < 0.08:
            y = None
        elif r < 0.4:
            v = [float(x) for x in base[0]]  # a third of all rows hold one vector
        elif r < 0.42:
            v = [0.0] * 4
        rows.append((i if rng.random() > 0.02 else None, v, y))
    rows += rows[:20]
    assert mined(table(spark, rows), 5) == brute(rows, 5)


def test_lists_end_early_where_directions_differ(spark, small):
    """Two far groups: the bound of the far group's entries ends the walk, and nothing is lost by it."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in (rng.normal(size=3) * 0.02 + ([1, 0, 0] if i % 2 else [0, 0, 1]))], i // 2 % 3) for i in range(300)]
    assert mined(table(spark, rows), 10) == brute(rows, 10)


def test_empty_and_few(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.7, 0.0], 2)]
    assert mined(table(spark, rows), 50) == [(0, 1, 1, 2, 65536, 45824)]
    assert mined(table(spark, rows).limit(0), 50) == [] and mined(table(spark, rows[1:]), 50) == []
    assert mined(table(spark, rows).withColumn("score", F.lit("x")).withColumn("first", F.lit(1)), 50) == [(0, 1, 1, 2, 65536, 45824)]


def test_bounds_hold():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 5))
    c = H.centres(x, 4)
    size, angle = H._angles(x, c)
    near = angle.argmin(axis=1)
    for k in range(len(c)):
        t = angle[near == k, k].max()
        up = size * np.cos(np.maximum(angle[:, k] - t, 0))
        assert (x[near == k] @ x.T <= size[near == k][:, None] * up[None, :] + 1e-9).all()
