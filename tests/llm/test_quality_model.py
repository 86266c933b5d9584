"""The quality model against a plain one: counts in dictionaries, hashes from the public xxHash library."""

import collections
import math
import random
import re
import struct

import xxhash

from vaani.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_hash(w):
    return xxhash.xxh64(w.encode(), seed=42).intdigest()


def buckets(text):
    hs = [word_hash(w) for w in WORD.findall(text or "")]
    pairs = [xxhash.xxh64(struct.pack("<Q", b), seed=xxhash.xxh64(struct.pack("<Q", a), seed=42).intdigest()).intdigest() for a, b in zip(hs, hs[1:])]
    return [h % 65536 for h in hs + pairs]


def plain_scores(rows, good):
    raw, trusted = collections.Counter(), collections.Counter()
    for i, t in rows:
        raw.update(buckets(t))
        if i in good:
            trusted.update(buckets(t))
    n, all_raw, all_trusted = len(raw), sum(raw.values()), sum(trusted.values())
    shift = math.log((all_raw * 1.1) / (all_trusted * 1.1))
    ratio = {b: math.log((trusted[b] + 0.1 * all_trusted / n) / (raw[b] + 0.1 * all_raw / n)) + shift for b in raw}
    return [(i, sum(ratio[b] for b in buckets(t)) / len(buckets(t)) if buckets(t) else 0.0) for i, t in rows]


def plain_cut(scored, marks):
    """The multiple of 0.01 with the best sum of bad below and good not below it; the lowest of equal ones."""
    good = [math.floor(s / 0.01) for i, s in scored if marks.get(i) == 1]
    bad = [math.floor(s / 0.01) for i, s in scored if marks.get(i) == 0]
    gains = [(sum(x < e for x in bad) / len(bad) - sum(x < e for x in good) / len(good), -e) for e in sorted(set(good + bad))]
    gain, e = max(gains)
    return -e * 0.01 if gain > 0 else None


def texts(rng, n):
    fine, junk = [f"w{i}" for i in range(300)], [f"z{i}" for i in range(300)]
    return [(i, " ".join(rng.choice(fine if rng.random() < (0.9 if i % 2 else 0.4) else junk) for _ in range(rng.randint(12, 80)))) for i in range(n)]


def test_scores_and_verdicts_of_a_plain_model(spark):
    rng = random.Random(3)
    rows = texts(rng, 120) + [(200, None), (201, ""), (202, "é ü ñ " * 5), (7, "w1 w2 w3")]
    marks = {i: i % 2 for i in range(0, 120, 2)} | {i: 1 for i in range(1, 60, 2)} | {202: 0}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks.items()], "doc_id long, quality int, toxic int")
    want = plain_scores(rows, {i for i, q in marks.items() if q == 1})
    got = quality.verdicts(docs, labels).collect()
    seen = collections.defaultdict(list)
    for i, s in want:
        seen[i].append(s)
    for r in got:
        assert min(abs(r.score - s) for s in seen[r.doc_id]) < 2e-6, r
    failed = {(r.doc_id, round(r.score, 6)) for r in got if r.base_failed}
    edge = plain_cut([(i, s) for i, s in want if (i, round(s, 6)) not in failed], marks)
    assert edge is not None
    assert all(r.kept == (not r.base_failed and r.score >= edge) for r in got if abs(r.score - edge) > 1e-5)
    assert any(r.kept for r in got) and any(not r.kept and not r.base_failed for r in got)


def test_trusted_sample_is_bounded_and_repeats(spark):
    labels = spark.createDataFrame([(i % 500, int(i % 500 % 3 > 0), 0) for i in range(1000)] + [(None, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int").repartition(4)
    some = {r.doc_id for r in quality.trusted_ids(labels, 50).collect()}
    every = {r.doc_id for r in quality.trusted_ids(labels).collect()}
    assert len(some) == 50 and some < every and 1 not in every and None not in every and len(every) == 332
    assert some == {r.doc_id for r in quality.trusted_ids(labels.repartition(2), 50).collect()}
