"""Hard negatives against a plain search of every window."""

import math
import random

import numpy as np
import pytest

from vaani.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, v int, slot int"


def plain(rows, k=5, low=80, every=100):
    fine = []
    for i, e, label, *_ in rows:
        if i is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        fine.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in e)))
    out = []
    for a in sorted({r for r in fine if r[0] % every == 0}):
        # a row's own length says how far a product goes
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r) for r in fine]
        ordered = sorted(scored, key=lambda s: (-s[0], s[1][0]))
        for p, r in [s for s in ordered if s[1][1] == a[1] and s[1][0] != a[0]][:k]:
            window = [s for s in ordered if s[1][1] != a[1] and low * p <= 100 * s[0] <= 100 * p][:k]
            out += [(a[0], r[0], j, s[1][0], p, s[0]) for j, s in enumerate(window, 1)]
    return sorted(out)


def found(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def rows_of(rng, n, ties):
    """Vectors near a few centres; with ties many rows have equal vectors."""
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        e = [x + (0 if rng.random() < ties else rng.gauss(0, 0.3)) for x in c] if rng.random() > ties / 2 else centres[0]
        out.append((i, e, rng.randint(0, 9) if rng.random() > 0.4 else 1, "k", 1, 2))
    return out


@pytest.mark.parametrize("seed,ties", [(1, 0.0), (2, 0.7), (3, 1.0)])
def test_every_window(spark, seed, ties, monkeypatch):
    rows = rows_of(random.Random(seed), 900, ties)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = plain(rows)
    assert want and found(negatives.mined(df)) == want
    monkeypatch.setattr(negatives, "TILE", 64)                     # many tiles a task
    assert found(negatives.mined(df, block_values=18)) == want     # a few anchors a block
    assert found(negatives.mined(df, positives_of=3, negatives_of=2)) == sorted(
        plain_k(rows, 3, 2))


def plain_k(rows, kp, kn):
    """As plain, with numbers of positives and negatives of their own."""
    keep = {}
    for a, p, j, n, ps, ns in plain(rows, kp):
        if j <= kn:
            keep[a, p, j, n, ps, ns] = True
    return keep


def test_hard_rows(spark):
    rng = random.Random(9)
    rows = rows_of(rng, 300, 0.5)
    rows += [(None, [1.0] * 6, 1, None, None, None), (400, None, 1, "", 0, 0), (500, [None] * 6, 1, "", 0, 0), (600, [float("nan")] * 6, 1, "", 0, 0),
             (601, [float("inf")] + [1.0] * 5, 2, "", 0, 0), (700, [1.0] * 6, None, "", 0, 0), (800, [], 3, "", 0, 0), (801, [2.0, 1.0], 3, "", 0, 0),
             rows[0], rows[100], (200, rows[7][1], 5, "", 0, 0), (900, [-1.0] * 6, 8, "", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(negatives.mined(df)) == plain(rows)
    assert found(negatives.mined(df.limit(0))) == []
    assert found(negatives.mined(df.where("vec_id % 100 <> 0"))) == []


def test_products_stay_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-2**30, 2**30, (5, 7)), rng.integers(-2**30, 2**30, (6, 7))
    want = [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]
    assert negatives.products(a, b).tolist() == want
    big = np.full((1, 4), 2**62)
    assert negatives.products(big, big).tolist() == [[2**63 - 1]]
