"""Hard negatives against a plain loop over all pairs."""

import math
import random

import numpy as np
import pytest

from millrace.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, block string, stripe string, key string, n string, kind string"


def brute(rows):
    """All pairs, in Python's whole numbers; rows are told apart by their place."""
    used = []
    for place, (vec_id, embedding, label) in enumerate(rows):
        if vec_id is None or label is None or embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        used.append((vec_id, place, label, [math.floor(256 * float(np.float32(x))) for x in embedding]))
    out = []
    for a in used:
        if a[0] % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[3], r[3])), r[0], r[2] == a[2]) for r in used if r[1] != a[1] and len(r[3]) == len(a[3]))
        scored = [(max(-(2**63), min(2**63 - 1, -s)), i, same) for s, i, same in scored]
        scored.sort(key=lambda x: (-x[0], x[1]))
        for p, positive, _ in [x for x in scored if x[2]][:5]:
            inside = [(n, i) for n, i, same in scored if not same and 50 * p <= 100 * n <= 95 * p][:3]
            out += [(a[0], positive, k + 1, i, p, n) for k, (n, i) in enumerate(inside)]
    return sorted(out)


def vectors(seed, n, dim, labels, step=1.0):
    r = random.Random(seed)
    return [(i, [round(r.gauss(0, 1) / step) * step for _ in range(dim)], r.randrange(labels)) for i in range(n)]


def mined(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(parts)
    got = hard_negatives.mine(hard_negatives.stirred_labels(df))
    return sorted(tuple(r) for r in got.collect())


def test_small_blocks_with_ties(spark, monkeypatch):
    """Whole-number components make many equal scores; blocks and tiles are cut often."""
    rows = vectors(1, 400, 6, 3)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 11)
    want = brute(rows)
    assert len(want) > 50 and mined(spark, rows) == want


def test_a_label_of_a_third_of_all_rows(spark):
    rows = [(i, v, 0 if i % 3 else label) for i, v, label in vectors(2, 500, 16, 9, 0.01)]
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = vectors(3, 120, 4, 2) + [
        (None, [1.0] * 4, 1), (200, None, 1), (250, [1.0, None, 0.0, 0.0], 1), (300, [float("nan")] * 4, 1),
        (350, [float("inf")] * 4, 0), (400, [1.0] * 4, None), (450, [], 0), (451, [], 1), (500, [0.0] * 4, 0), (501, [0.0] * 4, 1),
        (550, [1.0, 2.0], 1), (552, [1.0, 2.0], 1), (553, [1.0, 1.0], 0), (-50, [2.0] * 4, 1), (-7, [2.0] * 4, 1),
        (100, [1.0] * 4, 0), (100, [1.0] * 4, 0), (0, [3.0] * 4, 1), (600, [0.5, -0.5, 0.001, -0.001], 1),
    ]
    got = mined(spark, rows)
    assert got == brute(rows) and {r[0] for r in got} >= {100, -50, 500}


def test_scores_beyond_exact_doubles(spark):
    rows = [(i, [x * 2.0**k for x in v], label) for k in (20, 40) for i, v, label in vectors(4 + k, 60, 3, 2)]
    assert mined(spark, rows) == brute(rows)


def test_empty_and_single(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(50, [1.0], 1)]) == []
    assert mined(spark, [(50, [1.0], 1), (51, [1.0], 1)]) == []


@pytest.mark.parametrize("score,want", [(10, (5, 9)), (0, (0, 0)), (3, (2, 2)), (-10, (-5, -10))])
def test_window(score, want):
    assert hard_negatives.window(score) == want


def test_setting_is_put_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    mined(spark, vectors(9, 10, 2, 2))
    assert spark.conf.get(name) == before
