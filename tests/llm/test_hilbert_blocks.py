"""Hard negatives from Hilbert blocks against scoring every pair."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordloom.llm import hilbert_blocks as hb


def by_every_pair(rows, which, positives=5, negatives=5, share=(80, 100), scale=256):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(scale * x) for x in v], label))
    out = []
    for a, (i, v, label) in enumerate(kept):
        if not which(i):
            continue
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), j, lab) for b, (j, w, lab) in enumerate(kept) if b != a), key=lambda r: r[:2])
        near = [r for r in scored if r[2] == label][:positives]
        for minus, j, _ in near:
            fits = [r for r in scored if r[2] != label and share[0] * -minus <= share[1] * -r[0] <= share[1] * -minus][:negatives]
            out += [(i, j, k, n, -minus, -m) for k, (m, n, _) in enumerate(fits, 1)]
    return sorted(out)


def made(spark, rows, parts=3, **more):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(parts)
    return sorted(tuple(r) for r in hb.mine(df, **more).collect())


def test_curve_visits_neighbours_once():
    for dims, bits in [(2, 4), (3, 3), (4, 2), (1, 5)]:
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1).T
        key = hb.hilbert_key(cells, bits)
        assert sorted(key.tolist()) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    q, x = rng.integers(-300, 300, (20, 6)), rng.integers(-300, 300, (50, 6))
    least, most = hb.bounds(q, x.min(axis=0)[None], x.max(axis=0)[None])
    scores = hb.product(q, x)
    assert (scores == q @ x.T).all() and (least <= scores).all() and (scores <= most).all()
    big = np.full((1, 4), 1 << 29)
    assert hb.product(big, big)[0, 0] == 4 << 58


@pytest.fixture(scope="module")
def some_rows():
    rng = random.Random(4)
    centres = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(700):
        label = rng.randrange(4)
        mixed = centres[label if rng.random() < 0.7 else rng.randrange(4)]
        rows.append((i, [float(np.float32(c + rng.gauss(0, 0.2))) for c in mixed], label))
    return rows


def test_equal_to_every_pair(spark, some_rows, monkeypatch):
    monkeypatch.setattr(hb, "BLOCK", 16)
    monkeypatch.setattr(hb, "BUNDLE", 3)
    monkeypatch.setattr(hb, "PACK", 2)
    got = made(spark, some_rows, anchors=F.col("vec_id") % 50 == 0)
    assert got == by_every_pair(some_rows, lambda i: i % 50 == 0) and len(got) > 100
    got = made(spark, some_rows, parts=1, anchors=F.col("vec_id") % 70 == 0, positives=2, negatives=3, share=(1, 3), scale=10)
    assert got == by_every_pair(some_rows, lambda i: i % 70 == 0, 2, 3, (1, 3), 10)


def test_only_blocks_that_meet_a_window_are_chosen(spark, some_rows, monkeypatch):
    monkeypatch.setattr(hb, "BLOCK", 8)
    seen = []
    real = hb.read_blocks
    monkeypatch.setattr(hb, "read_blocks", lambda chosen, *more: (seen.append(chosen.count()), real(chosen, *more))[1])
    far = [(i, [x + 3.0 * (lab == 1) for x in v], lab) for i, v, lab in some_rows]
    got = made(spark, far, anchors=F.col("vec_id") == 0)
    blocks = math.ceil(700 / 8)
    assert got == by_every_pair(far, lambda i: i == 0)
    assert seen[0] == 1 and seen[2] <= 1 and max(seen) < 0.7 * blocks


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100 * k, [0.5, 0.25], 1) for k in range(3)] + [(0, [0.5, 0.25], 1)]  # ties, and an id twice
    rows += [(k, [0.5, 0.25], 2) for k in range(1, 9)] + [(9, [0.4, 0.2], 2), (10, [0.5], 2), (11, [], 2), (12, [0.5, 0.25, 9.0], 2)]
    rows += [(200, None, 1), (300, [0.5, None], 1), (400, [0.5, nan], 1), (500, [inf, 0.1], 2), (600, [0.5, 0.5], None), (None, [0.5, 0.25], 2)]
    rows += [(700, [-0.5, -0.25], 3), (800, [0.5, 0.25], 3), (900, [0.1, 0.1], 4)]
    assert made(spark, rows) == by_every_pair(rows, lambda i: i % 100 == 0)
    wide = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumns({c: F.lit(1) for c in ("n", "v", "x", "key", "rows", "at", "pack", "rank")})
    assert sorted(tuple(r) for r in hb.mine(wide).collect()) == made(spark, rows)
    assert made(spark, rows, anchors=F.lit(False)) == []
    assert hb.mine(wide.limit(0)).count() == 0
    with pytest.raises(ValueError):
        hb.mine(wide, positives=0)
