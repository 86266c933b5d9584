"""Vectorised words, word hashes and word n-grams of Arrow string columns.

Everything here works on one slice of a batch inside a task; a slice holds
about ``SLICE_BYTES`` of text, or one row if that is longer, so that memory
does not depend on how many rows a batch has.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_BYTE_VALUES = np.random.default_rng(20_23).integers(0, 2**64, 256, dtype=np.uint64)
_POWERS: dict[int, np.ndarray] = {}

#: A-Z to a-z; all other ASCII but digits and letters to a space.
ALNUM_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """Cut a batch so that each piece has at most ``limit`` bytes of text."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64))
    start, n = 0, batch.num_rows
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _mapped(col: pa.Array, table: bytes) -> pa.Array:
    """The column with every byte replaced by ``table``; UTF-8 sequences stay whole."""
    wide = pa.types.is_large_string(col.type)
    offsets = np.frombuffer(col.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = b"" if data is None else memoryview(data)[offsets[0]:offsets[-1]].tobytes()
    out = (offsets - offsets[0]).tobytes()
    cls = pa.LargeStringArray if wide else pa.StringArray
    return cls.from_buffers(len(col), pa.py_buffer(out), pa.py_buffer(data.translate(table)))


def split_words(col: pa.Array, table: bytes | None = None) -> tuple[pa.Array, np.ndarray]:
    """All words of a column, and where each row's words start (n + 1 offsets).

    Words are runs without ASCII white space (0x20, 0x09-0x0D), after the
    byte map ``table`` if given.  A null has no words.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    if len(col) == 0:
        return pa.array([], pa.string()), np.zeros(1, np.int64)
    lists = pc.ascii_split_whitespace(_mapped(col, table) if table else col)
    flat, offs = lists.flatten(), np.asarray(lists.offsets, dtype=np.int64)
    offs = offs - offs[0]
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(full)])
    if not full.all():
        flat = flat.filter(pa.array(full))
    return flat, at[offs]


def coded(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct words and the index of each word among them."""
    enc = flat.dictionary_encode()
    return enc.dictionary, enc.indices.to_numpy(zero_copy_only=False)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1), modulo 2**64; those of the largest usual slice so far are kept for the next one."""
    usual = SLICE_BYTES + (64 << 10)
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        # an eighth more, so that slices of about one length don't grow it again and again
        have = np.full(n if n > usual else min(usual, n + n // 8 + 1024), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= usual:
            _POWERS[base] = have
    return have[:n]


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over random values of its
    bytes, taken for all words at once from one running sum."""
    n = len(flat)
    if n == 0:
        return np.zeros(0, np.uint64)
    wide = pa.types.is_large_string(flat.type)
    offs = np.frombuffer(flat.buffers()[1], dtype=np.int64 if wide else np.int32)
    offs = offs[flat.offset:flat.offset + n + 1].astype(np.int64)
    data = np.frombuffer(flat.buffers()[2], dtype=np.uint8)[offs[0]:offs[-1]]
    offs -= offs[0]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.take(_BYTE_VALUES, data, out=sums[1:], mode="clip")      # in place: this is eight times the text already
    sums[1:] *= _powers(_BASE, len(data))
    np.cumsum(sums[1:], out=sums[1:])
    h = (sums[offs[1:]] - sums[offs[:-1]]) * _powers(_BASE_INVERSE, len(data) + 1)[offs[:-1]]
    return mix(h + (offs[1:] - offs[:-1]).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of ``words[i:i + k]`` for every i, row boundaries ignored."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, k):
        out *= _MUL
        out += words[j:j + n]
    return mix(out)


def long_column(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def list_column(values: pa.Array, offsets) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.asarray(offsets, dtype=np.int32)), values)


def whole_groups(batches, key: int = 0):
    """Regroup sorted batches so that each table yielded holds whole runs of the key column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(key)
        last = col[batch.num_rows - 1]
        if held and held[-1].column(key)[held[-1].num_rows - 1] != col[0]:
            yield pa.Table.from_batches(held)
            held = []
        differs = pc.fill_null(pc.not_equal(col, last), True).to_numpy(zero_copy_only=False)
        cut = int(differs.nonzero()[0][-1]) + 1 if differs.any() else 0
        if cut:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each ``words[start:end]``, independent of :func:`gram_hashes`."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(_BASE, len(words)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(words) + 1)[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * _MUL))


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the first smallest of ``values[i:i + width]``."""
    n = max(0, len(values) - width + 1)
    best, at = values[:n].copy(), np.arange(n)
    for j in range(1, width):
        less = values[j:j + n] < best
        best[less] = values[j:j + n][less]
        at[less] = np.flatnonzero(less) + j
    return at


def packed(columns: int):
    """A ``mapInArrow`` function that compresses the text in the last of ``columns`` columns.

    Texts that have to be shuffled travel as zstd frames, a third of their size.
    """
    def pack(batches):
        import zstandard
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for part in slices(batch, columns - 1):
                texts = part.column(columns - 1).to_pylist()
                yield pa.record_batch([*(part.column(i) for i in range(columns - 1)),
                                       pa.array([None if t is None else squeeze(t.encode()) for t in texts], pa.binary())],
                                      names=part.schema.names)
    return pack


def unpacked(col: pa.Array) -> list[str | None]:
    import zstandard
    open_ = zstandard.ZstdDecompressor().decompress
    return [None if z is None else open_(z).decode() for z in col.to_pylist()]


def frames(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES // 3):
    """Slices of a batch whose text is packed, with the texts as an Arrow column."""
    for part in slices(batch, column, limit):
        yield part, pa.array(unpacked(part.column(column)), pa.string())
