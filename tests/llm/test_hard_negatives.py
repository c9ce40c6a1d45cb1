import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, id string, score string, anchor string, slot string, vector string"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def vectors(n, seed, dim=8, labels=4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(labels)]
    out = []
    for i in range(n):
        label = rng.randrange(labels)
        if rng.random() < 0.3:  # a third are one vector
            out.append((i, label, [0.5] * dim))
        else:
            out.append((i, label, [rng.choice((0.25, 0.5, 1.0)) * (c + rng.gauss(0, 0.3)) for c in centres[label]]))
    return out


def whole(rows):
    """Rows that take part, with integer vectors."""
    out = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        out.append((i, label, [math.floor(256 * float(__import__("numpy").float32(x))) for x in v]))
    return out


def plain(rows, every, k=5, m=5, low=80, high=100):
    rows, out = whole(rows), []
    for n, (a, label, v) in enumerate(rows):
        if a % every:
            continue
        told = [(-sum(x * y for x, y in zip(v, w)), i, lab) for j, (i, lab, w) in enumerate(rows) if j != n]
        near = sorted((s, i) for s, i, lab in told if lab == label)[:k]
        far = sorted((s, i) for s, i, lab in told if lab != label)
        for s, i in near:
            hits = [(x, j) for x, j in far if low * -s <= 100 * -x <= high * -s][:m]
            out += [(a, i, r, j, -s, -x) for r, (x, j) in enumerate(hits, 1)]
    return sorted(out)


def mined(spark, rows, every, **options):
    got = H.hard_negatives(frame(spark, rows), F.col("vec_id") % every == 0, **options)
    assert got.columns == NAMES
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("options", [{}, {"positives": 3, "negatives": 2, "low": 50, "high": 95}, {"low": 0, "high": 100}, {"low": 100, "high": 130}])
def test_against_plain_search(spark, options):
    rows = vectors(400, 2)
    want = plain(rows, 20, options.get("positives", 5), options.get("negatives", 5), options.get("low", 80), options.get("high", 100))
    assert want and mined(spark, rows, 20, **options) == want


def test_small_tiles_blocks_and_combiners_change_nothing(spark, monkeypatch):
    rows = vectors(300, 7)
    want = plain(rows, 10)
    monkeypatch.setattr(H, "BLOCK_BYTES", 8 * 8 * 7)  # blocks of seven anchors: several rounds
    assert mined(spark, rows, 10) == want
    best = H.Best(3, 2)
    monkeypatch.setattr(H, "PENDING", 2)
    import numpy as np
    for group, score, row in [(0, 5, 9), (0, 5, 3), (0, 5, 4), (2, -1, 0), (0, 7, 1), (2, -1, 8), (2, 0, 5)]:
        best.add(np.array([group]), np.array([score]), np.array([row]))
    assert list(zip(*(x.tolist() for x in best.kept()))) == [(0, 7, 1), (0, 5, 3), (2, 0, 5), (2, -1, 0)]


def test_odd_rows(spark):
    rows = vectors(60, 4) + [(None, 1, [0.1] * 8), (70, None, [0.1] * 8), (80, 1, None), (90, 1, [0.1, None] + [0.2] * 6),
                             (100, 1, [float("nan")] * 8), (110, 1, [float("inf")] * 8), (20, 1, [0.5] * 8), (20, 1, [0.5] * 8),
                             (120, 2, []), (130, 3, [0.7, 0.7]), (140, 9, [-0.5] * 8), (150, 1, [1e-30] * 8)]
    assert mined(spark, rows, 10) == plain(rows, 10)
    assert mined(spark, rows[:0], 10) == [] and mined(spark, [(1, 1, [0.5])], 10) == [] and mined(spark, [(10, 1, [0.5])], 10) == []
    assert mined(spark, [(10, 1, []), (11, 1, []), (12, 2, [])], 10) == [(10, 11, 1, 12, 0, 0)]
    with pytest.raises(ValueError, match="exact"):
        mined(spark, [(10, 1, [3e7]), (11, 1, [1.0])], 10)
