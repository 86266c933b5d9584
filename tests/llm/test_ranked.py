"""Ranked search against scoring every document with every item."""

import collections
import math
import random
import re

import numpy as np
import pytest
from conftest_rows import SCHEMA, hard_rows

from vaani.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(docs, items, k=20):
    """(item, rank, doc_id, score); docs and items are (id, text)."""
    held = [(i, collections.Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, all_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // all_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def topics(rng, n):
    """Texts of a few topics with shared words, so that blocks differ and bounds fail."""
    common = [f"c{i}" for i in range(30)]
    words = [[f"t{t}w{i}" for i in range(60)] for t in range(6)]
    return [(i, " ".join(rng.choice(common if rng.random() < 0.4 else words[rng.randrange(6) if rng.random() < 0.1 else i % 6]) for _ in range(rng.randint(1, 90)))) for i in range(n)]


@pytest.mark.parametrize("limits", [{}, {"SHARD": 2000, "LEAST_BLOCK": 8, "SMALL": 4}, {"SHARD": 300, "LEAST_BLOCK": 2, "SMALL": 2, "DENSE": 0, "EXACT": 1}])
def test_every_document_and_item(spark, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(ranked, name, value)
    rng = random.Random(6)
    docs = topics(rng, 700)
    items = [(j, " ".join(t.split()[:rng.randint(1, 25)])) for j, (_, t) in enumerate(rng.sample(docs, 25))]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = plain(docs, items)
    assert found(ranked.ranked(d, i)) == want
    if limits:
        assert found(ranked.ranked(d, i, k=3, block_terms=60)) == plain(docs, items, 3)


def test_hard_rows(spark):
    rows, items = hard_rows()
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain([r[:2] for r in rows], items)
    assert found(ranked.ranked(d, spark.createDataFrame(items, "item_id long, text string"))) == want
    assert {r[0] for r in want} >= {1, 5, None}
    none = spark.createDataFrame([], "item_id long, text string, n int")
    assert found(ranked.ranked(d, none)) == [] and found(ranked.ranked(d.limit(0), spark.createDataFrame(items, "item_id long, text string"))) == []


def test_blocks_are_skipped_and_bounds_hold(monkeypatch):
    monkeypatch.setattr(ranked, "SMALL", 4)
    rng = np.random.default_rng(2)
    n, size = 400, 200
    # four topics: only one of them can answer
    vectors = [sorted({int(x) for x in rng.integers(0, 50, 12) + 50 * (d % 4)}) for d in range(n)]
    ends = np.append(0, np.cumsum([len(v) for v in vectors]))
    parts = rng.integers(1, 1000, ends[-1])
    made = ranked.shard(np.arange(n), ends, np.concatenate(vectors), parts, size, least=8)
    exact = np.zeros((n, size), np.int64)
    for d, v in enumerate(vectors):
        exact[d, v] = parts[ends[d]:ends[d + 1]]
    weights = np.zeros(size, np.int64)
    weights[:60] = rng.integers(1, 50, 60)
    scores = exact @ weights
    mine = np.flatnonzero(weights[made["list_terms"]])
    for worst in (1, int(np.sort(scores)[-20]), int(scores.max())):
        may = ranked.candidates(made, mine, weights[made["list_terms"][mine]], worst)
        assert may[scores >= worst].all()
    assert may.sum() < (scores > 0).sum()
