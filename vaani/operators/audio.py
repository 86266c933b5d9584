"""Audio as Spark jobs.

Audio is ``BINARY`` (WAV) at rest.  Decoding, down-mixing, resampling,
cutting and featurizing run in ``mapInPandas`` over Arrow batches with the
standard-library ``wave`` module and numpy; each recording is decoded once
and emits one row per clip.  Arrow batches are kept small (audio rows are
large) by ``spark.sql.execution.arrow.maxBytesPerBatch``.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Arrow batches are capped by size, so batches of large audio rows stay
# small while batches of short text rows keep their usual row count.
ARROW_BATCH_BYTES = str(64 * 1024 * 1024)


def small_batches(spark) -> None:
    """Cap Arrow batch bytes unless the session already chose a cap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    cur = spark.conf.get(key, None)
    if cur is None or int(str(cur).rstrip("bB") or 0) > int(ARROW_BATCH_BYTES):
        spark.conf.set(key, ARROW_BATCH_BYTES)


# ---------------------------------------------------------------- codecs (per-row helpers)

def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """PCM WAV -> mono float32 in [-1, 1] (channels averaged), rate."""
    with wave.open(io.BytesIO(data), "rb") as w:
        ch, width, sr, n = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.getnframes()
        raw = w.readframes(n)
    if width == 2:
        x = np.frombuffer(raw, dtype="<i2").astype(np.float32) / 32768.0
    elif width == 4:
        x = np.frombuffer(raw, dtype="<i4").astype(np.float32) / 2147483648.0
    elif width == 1:
        x = (np.frombuffer(raw, dtype=np.uint8).astype(np.float32) - 128.0) / 128.0
    else:
        raise ValueError(f"unsupported sample width {width}")
    if ch > 1:
        x = x.reshape(-1, ch).mean(axis=1)
    return x, sr


def encode_wav(x: np.ndarray, sr: int) -> bytes:
    """Mono float -> 16-bit PCM WAV bytes."""
    pcm = (np.clip(x, -1.0, 1.0) * 32767.0).astype("<i2")
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes(pcm.tobytes())
    return buf.getvalue()


def sample_range(start: float, end: float, sr: int, n: int, rounding: str) -> tuple[int, int]:
    """P10: start/end sample, truncated (preparation) or rounded half-even
    (disfluency clips), clamped to the audio."""
    if rounding == "truncate":
        s, e = int(start * sr), int(end * sr)
    else:
        s, e = int(round(start * sr)), int(round(end * sr))
    return max(0, s), min(n, e)


# ---------------------------------------------------------------- Spark jobs

# Output batches are cut by size: input batches are small rows (segment
# lists, paths, text) but each may expand into megabytes of audio.
OUT_BATCH_BYTES = 32 * 1024 * 1024


def chunked_frames(rows, columns, max_bytes: int = OUT_BATCH_BYTES):
    """Group ``(row, nbytes)`` pairs into DataFrames of about ``max_bytes``."""
    buf, size = [], 0
    for row, nbytes in rows:
        buf.append(row)
        size += nbytes
        if size >= max_bytes:
            yield pd.DataFrame(buf, columns=columns)
            buf, size = [], 0
    if buf:
        yield pd.DataFrame(buf, columns=columns)

def _task_count(df: DataFrame) -> int:
    """Tasks for CPU-heavy audio stages: twice the cluster's cores."""
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, 1)


CLIP_SCHEMA = ("id string, recording_id string, sample_rate int, n_samples long, "
               "clip binary, error string")


def cut_clips(segments: DataFrame, audio: DataFrame, rounding: str = "truncate",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per clip at the recording's own rate.  Segments (``id, recording_id, start,
    end``) are grouped per recording -- a recording's segments already form
    one transcript array -- and joined to its audio (``recording_id,
    content``): the only shuffle that carries audio bytes.  A recording
    that fails to decode yields one row with ``error`` set (E1).  ``carry``
    names string columns of ``segments`` passed through to each clip row, so
    callers need no second pass over the segments."""
    small_batches(segments.sparkSession)
    n = _task_count(segments)
    per_rec = segments.groupBy("recording_id").agg(
        F.collect_list(F.struct("id", "start", "end", *carry)).alias("segs"))
    # both sides explicitly hash-partitioned by recording with a fixed count:
    # the join reuses that partitioning (audio bytes move once) and AQE does
    # not coalesce the small but CPU-heavy groups into a single task
    j = per_rec.repartition(n, "recording_id").join(
        audio.select("recording_id", "content").repartition(n, "recording_id"), "recording_id")

    cols = ["id", "recording_id", "sample_rate", "n_samples", "clip", "error", *carry]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for b in batches:
                for rec, segs, content in zip(b["recording_id"], b["segs"], b["content"]):
                    try:
                        x, sr = decode_wav(bytes(content))
                    except Exception as exc:  # noqa: BLE001 - isolate the recording
                        yield (None, rec, None, None, None, f"recording_id={rec}: {str(exc) or type(exc).__name__}", *[None] * len(carry)), 0
                        continue
                    for s in segs:
                        lo, hi = sample_range(s["start"], s["end"], sr, len(x), rounding)
                        if hi <= lo:
                            continue
                        w = encode_wav(x[lo:hi], sr)
                        yield (s["id"], rec, sr, hi - lo, w, None, *[s[c] for c in carry]), len(w)
        yield from chunked_frames(rows(), cols)

    schema = CLIP_SCHEMA + "".join(f", {c} string" for c in carry)
    return j.mapInPandas(run, schema)


def segment_clips(detected: DataFrame, audio: DataFrame) -> DataFrame:
    # ``audio``: ``recording_id, content`` (in-table WAV) or ``recording_id,
    # path`` (files read from storage by window)
    """Disfluency clips: one clip per segment with at least one hit, cut with
    half-even rounding of the sample index at the recording's own rate
.  Every hit of a segment refers to the same audio, so it
    is stored once per segment rather than once per hit."""
    seg = (detected.where((F.col("end") > F.col("start")) & (F.size("hits") > 0))
           .select(F.format_string("%s_%04d", F.col("recording_id"), F.col("segment_idx")).alias("id"),
                   "recording_id", "start", "end"))
    if "content" in audio.columns:
        return cut_clips(seg, audio, rounding="round")
    return cut_clips_from_storage(seg, audio, rounding="round")


# ---------------------------------------------------------------- windowed cutting from storage

WINDOW_SEC = 600.0
PATH_CLIP_SCHEMA = ("id string, recording_id string, sample_rate int, n_samples long, clip binary, "
                    "error string")


def _open(path: str):
    """Random-access reader for a local or remote path (Hadoop-style
    ``file:`` URIs included)."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = path[5:].lstrip("/")
        path = "/" + path
    filesystem, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return filesystem.open_input_file(inner)


def _read_window(f, first: int, last: int) -> tuple[np.ndarray, int, int]:
    """Frames [first, last) of a PCM WAV as mono float32, plus rate and
    total frame count; only those frames are read."""
    with wave.open(f, "rb") as w:
        ch, width, sr, n = w.getnchannels(), w.getsampwidth(), w.getframerate(), w.getnframes()
        first, last = max(0, min(first, n)), max(0, min(last, n))
        w.setpos(first)
        raw = w.readframes(last - first)
    dtype = {2: "<i2", 4: "<i4", 1: np.uint8}[width]
    x = np.frombuffer(raw, dtype=dtype).astype(np.float32)
    x = (x - 128.0) / 128.0 if width == 1 else x / float(2 ** (8 * width - 1))
    if ch > 1:
        x = x.reshape(-1, ch).mean(axis=1)
    return x, sr, n


def cut_clips_from_storage(segments: DataFrame, audio_index: DataFrame, rounding: str = "truncate",
                           window_sec: float = WINDOW_SEC) -> DataFrame:
    """U3 at scale: segments (``id, recording_id, start, end``) are grouped
    by recording *and* a ``window_sec`` window of their start time, so no
    group grows with the recording's length (a recording with a third of
    all segments becomes many small groups).  Only the audio path travels
    through the shuffle; each task seeks into the file and reads the frames
    its segments need, at the recording's own rate."""
    per = segments.groupBy("recording_id", F.floor(F.col("start") / window_sec).alias("_w")).agg(
        F.collect_list(F.struct("id", "start", "end")).alias("segs"))
    # groups are small in bytes but heavy in CPU: spread them round-robin
    # over a fixed task count (never coalesced by AQE), which also spreads
    # the windows of one long recording
    j = per.join(audio_index.select("recording_id", "path"), "recording_id").repartition(_task_count(segments))

    def run(batches):
        def rows():
            for b in batches:
                for rec, segs, path in zip(b["recording_id"], b["segs"], b["path"]):
                    try:
                        with _open(path) as f:
                            with wave.open(f, "rb") as w:
                                sr, n = w.getframerate(), w.getnframes()
                            for s in segs:
                                lo, hi = sample_range(s["start"], s["end"], sr, n, rounding)
                                if hi <= lo:
                                    continue
                                f.seek(0)
                                x, _, _ = _read_window(f, lo, hi)
                                w = encode_wav(x, sr)
                                yield (s["id"], rec, sr, hi - lo, w, None), len(w)
                    except Exception as exc:  # noqa: BLE001 - isolate the recording
                        yield (None, rec, None, None, None, f"recording_id={rec}: {str(exc) or type(exc).__name__}"), 0
        yield from chunked_frames(rows(), ["id", "recording_id", "sample_rate", "n_samples", "clip", "error"])

    return j.mapInPandas(run, PATH_CLIP_SCHEMA)

