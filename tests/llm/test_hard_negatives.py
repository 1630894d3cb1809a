"""Hard negatives against all scores."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm.hard_negatives import DEPTHS, hard_negatives, summaries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every, k=5):
    clean = sorted(
        {
            (-(2**63) if i is None else i, y, tuple(math.floor(256 * float(np.float32(x))) for x in v))
            for i, v, y in rows
            if y is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)
        }
    )
    out = []
    for i, y, v in clean:
        if i == -(2**63) or i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w)), j, z)  # noqa: B905  the shorter ends in zeros
            for j, z, w in clean
            if (j, z, w) != (i, y, v)
        )
        known = lambda j: None if j == -(2**63) else j
        for minus, j, _ in [s for s in scored if s[2] == y][:k]:
            ps = -minus
            hard = [s for s in scored if s[2] != y and 80 * ps <= -100 * s[0] <= 100 * ps][:k]
            out += [(i, known(j), r, known(s[1]), ps, -s[0]) for r, s in enumerate(hard, 1)]
    return sorted(out, key=repr)


def _rows(seed, n, size, spread):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, size))
    rows = []
    for i in range(n):
        v = centres[r.integers(6)] + spread * r.normal(size=size)
        rows.append((i, [float(x) for x in np.float32(v)], int(r.integers(4))))
    return rows


@pytest.mark.parametrize("size, spread, block", [(64, 0.3, 4096), (64, 0.02, 3), (5, 0.5, 4)])
def test_against_brute_force(spark, size, spread, block):
    rows = _rows(size, 260, size, spread)
    rows += [(i + 300, rows[7][1], i % 3) for i in range(30)]  # ties
    rows += [rows[20], (20, rows[20][1], 3), (20, rows[21][1], 1)]  # repeated, and differing
    rows += [(None, rows[20][1], rows[20][2]), (None, rows[20][1], 3), (400, None, 1), (420, rows[0][1], None)]
    rows += [(440, [float("nan")] * size, 1), (460, [float("inf")] + [0.0] * (size - 1), 1)]
    rows += [(480, [None] * size, 1), (500, [], 1), (520, rows[1][1][:3], 2)]
    got = hard_negatives(
        spark.createDataFrame(rows, SCHEMA).repartition(4), None, F.col("id") % 20 == 0,
        block_anchors=block,
    )
    want = brute(rows, 20)
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 40


def test_bounds_hold_at_every_depth_and_tighten():
    r = np.random.default_rng(1)
    # neighbouring components alike, as the summaries presume
    x, y = (np.floor(256 * np.cumsum(r.normal(size=(40, 64)), 1)) for _ in range(2))
    exact, widths = x @ y.T, []
    for (length, mx, dx), (_, my, dy) in zip(summaries(x), summaries(y), strict=True):
        centre, radius = length * mx @ my.T, dx @ dy.T
        assert (np.abs(exact - centre) <= radius * (1 + 1e-9) + 1e-6).all()
        widths.append(radius.mean())
    assert len(widths) == len(DEPTHS) and widths[0] > 2 * widths[1] > 4 * widths[2]


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 9.9], 2), (3, [-1.0, 0.0], 2)]
    frame = spark.createDataFrame(rows, SCHEMA)
    clash = frame.withColumn("id", F.lit(5)).withColumn("score", F.lit("x"))
    assert [tuple(r) for r in hard_negatives(clash).filter("anchor_id = 0").collect()] == [
        (0, 1, 1, 2, 65536, 58880)
    ]
    assert hard_negatives(frame.limit(0)).count() == 0
    assert hard_negatives(frame, None, F.col("id") > 9).count() == 0
    lone = spark.createDataFrame(rows[:1], SCHEMA)
    assert hard_negatives(lone).count() == 0
    huge = spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1), (2, [1e30], 2)], SCHEMA)
    assert {r.negative_score for r in hard_negatives(huge).collect()} == {2**44}
