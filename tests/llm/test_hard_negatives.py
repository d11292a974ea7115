"""Hard negatives against brute force, the Hilbert order and the bounds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

KIND = "vec_id long, embedding array<float>, label int, id string, block string"


def brute(rows, k=5, n=3):
    rows = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), lab) for i, v, lab in rows
            if None not in (i, v, lab) and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, lab in rows:
        if i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows if j != i and len(v) == len(w)]
        for s, j, _ in sorted(x for x in scored if x[2] == lab)[:k]:
            near = sorted(x for x in scored if x[2] != lab and -50 * s <= -100 * x[0] <= -95 * s)
            out += [(i, j, r + 1, m, -s, -t) for r, (t, m, _) in enumerate(near[:n])]
    return sorted(out)


def found(spark, rows, **options):
    from marquee.llm.hard_negatives import hard_negatives
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], KIND).repartition(3)
    got = hard_negatives(df, F.col("label"), F.col("vec_id") % 50 == 0, **options)
    return sorted(tuple(r) for r in got.collect())


def vectors(seed, n, d, spread=1.0):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    return [(i, [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(middle)], rng.randint(0, 3)) for i in range(n)]


@pytest.mark.parametrize("d,spread,block_rows", [(6, 0.2, 16), (20, 1.0, 64)])
def test_equals_brute_force(spark, d, spread, block_rows):
    rows = vectors(d, 400, d, spread)
    assert found(spark, rows, block_rows=block_rows, page_zones=4) == brute(rows)


def test_edge_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.0], 2), (3, [0.9, 1.5], 2), (4, None, 1), (5, [], 1), (6, [1.0, None], 2),
            (7, [float("nan"), 1.0], 2), (8, [1.0, 2.0, 3.0], 1), (9, [1.0, 2.0], None), (None, [1.0, 2.0], 1), (50, [-1.0, -1.0], 3),
            (100, [0.5, 0.5], 2), (11, [1.0, 1.0], 2), (12, [1e20, 1.0], 7), (150, [0.0, 0.0], 4), (13, [0.0, 1.0], 4)]
    got = found(spark, rows)
    assert got == brute(rows) and len({r[0] for r in got}) >= 3
    assert found(spark, []) == []


def test_copies_of_one_vector(spark):
    rows = [(i, [1.0, 1.0, 0.5], i % 2) for i in range(300)] + [(1000 + i, [0.8, 0.9, 0.3 + i / 1000], i % 2) for i in range(300)]
    assert found(spark, rows, block_rows=32) == brute(rows)


def test_curve_visits_neighbours():
    from marquee.llm.hard_negatives import hilbert_keys
    for d, bits in ((2, 4), (3, 3)):
        points = np.stack([x.ravel() for x in np.meshgrid(*[np.arange(2**bits)] * d)], axis=1)
        keys = hilbert_keys(points, bits)
        order = sorted(range(len(points)), key=lambda i: keys[i])
        steps = np.abs(np.diff(points[order], axis=0)).sum(axis=1)
        assert len(set(keys)) == len(points) and (steps == 1).all()


def test_bounds_hold_and_skip():
    from marquee.llm.hard_negatives import bounds
    rng = np.random.default_rng(3)
    lo = rng.integers(-50, 50, (20, 8)).astype(float)
    hi = lo + rng.integers(0, 30, lo.shape)
    w = rng.integers(-40, 40, (15, 8)).astype(float)
    least, most = bounds(w, lo, hi)
    for _ in range(50):
        score = w @ np.floor(lo + rng.random(lo.shape) * (hi - lo + 1) * 0.999).T
        assert (least <= score).all() and (score <= most).all()


def test_blocks_that_cannot_matter_are_not_read(spark):
    from marquee.llm import hard_negatives as hn
    rows = vectors(5, 600, 4, 0.05)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], KIND)
    blocks = hn.hilbert_blocks(hn.quantised(df, F.col("label"), F.col("vec_id") % 50 == 0, "vec_id", "embedding", 256), 16)
    pages, n = hn._pages(blocks, 512)
    groups = hn._groups(hn.anchors_of(blocks, 5).withColumn("scores", F.array().cast("array<long>")), 5)
    needed = hn._needed(groups, pages, n, 5, None)
    assert 0 < needed.count() < blocks.count() * groups.count()
