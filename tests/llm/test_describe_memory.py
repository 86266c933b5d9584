"""Describing texts for the near-duplicate search takes memory by its step, not by the batch."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from conftest_rows import prose
from vaani.llm import jaccard, words


def _batch():
    rng = random.Random(3)
    parts = [prose(rng, 400) for _ in range(40)]
    texts = [" ".join(rng.sample(parts, 4)) for _ in range(1500)]
    return pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc", "text"])


def test_describing_takes_memory_by_its_step(monkeypatch):
    batch = _batch()
    assert batch.column(1).nbytes > 2 * words.SLICE_BYTES
    monkeypatch.setattr(words, "_POWERS", {})
    tracemalloc.start()
    rows = sum(out.num_rows for out in jaccard._describe(5, 0.8, 0.999)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == batch.num_rows
    assert peak < 80 << 20


def test_hashes_do_not_depend_on_the_slice(monkeypatch):
    batch = _batch()
    found = {}
    for step in (64 << 10, 1 << 20, 16 << 20):
        monkeypatch.setattr(words, "_POWERS", {})
        monkeypatch.setattr(jaccard, "STEP_BYTES", step)
        found[step] = pa.Table.from_batches(jaccard._describe(5, 0.8, 0.999)(iter([batch]))).to_pylist()
    assert found[64 << 10] == found[1 << 20] == found[16 << 20]


def test_word_hashes_are_the_polynomial_of_their_bytes():
    given = ["a", "ab", "é", "x" * 300]
    values, base = [int(x) for x in words._BYTE_VALUES], words._BASE
    wanted = [(sum(values[b] * pow(base, i, 2**64) for i, b in enumerate(w.encode())) + len(w.encode())) % 2**64 for w in given]
    assert words.word_hashes(pa.array(given)).tolist() == words.mix(np.array(wanted, np.uint64)).tolist()
