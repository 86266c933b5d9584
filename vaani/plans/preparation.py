"""Segment-level data-set preparation and disfluency extraction
(SURVEY 3.2) as Spark plans.

Shuffles: the transcript join on URL (both sides keyed by object), and the
per-recording candidate resolution (a handful of rows per recording).  All
parsing, validation, normalization and detection is row-local.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import disfluency as D
from ..operators import transcripts as T
from ..operators import urls as U
from ..operators.scoring import require_columns


@dataclass
class Prepared:
    segments: DataFrame
    failures: DataFrame
    input_rows: DataFrame


def language_filter(recordings: DataFrame, language: str = "hi", ignore_case: bool = False) -> DataFrame:
    """Exact (data-set preparation) or case-insensitive (disfluency)."""
    c = F.col("language").cast("string")
    return recordings.where(F.lower(c) == language.lower() if ignore_case else c == language)


def cap_rows(df: DataFrame, max_rows: int | None, key: str = "recording_id") -> DataFrame:
    """Optional debug cap, deterministic (first ``max_rows`` by id)."""
    return df.orderBy(key).limit(max_rows) if max_rows else df


def prepare_segments(recordings: DataFrame, transcripts: DataFrame, language: str = "hi",
                     min_sec: float = 0.4, max_sec: float = 30.0, join_on: str = "url",
                     max_rows: int | None = None, storage: U.Storage = U.Storage(), stage: bool = False) -> Prepared:
    """``transcripts`` is ``(url, payload)`` joined on the canonical
    transcript URL, or ``(recording_id, payload)`` for files staged by
    recording id (``join_on="recording_id"``).  ``stage`` parses them once
    for all outputs (:func:`~vaani.operators.transcripts.valid_segments`)."""
    require_columns(recordings, ["user_id", "recording_id", "language"])
    filtered = cap_rows(language_filter(recordings, language), max_rows)
    r = filtered.withColumn("folder_id", storage.folder(filtered, U.PREPARE_URL_COLUMNS))
    no_folder = r.where(F.col("folder_id").isNull()).select(
        "recording_id", F.concat(F.lit("Could not infer folder id for recording_id="),
                                 F.col("recording_id")).alias("error"))
    b = storage.urls(F.col("folder_id"), F.col("recording_id"))
    r = r.where(F.col("folder_id").isNotNull()).select(
        "recording_id", F.col("user_id").cast("string").alias("user_id"),
        F.col("language").cast("string").alias("language"), b["audio_url"].alias("audio_url"),
        b["transcription_url"].alias("transcription_url"))
    if join_on == "url":
        j = r.join(transcripts.select(F.col("url").alias("transcription_url"), "payload"), "transcription_url", "left")
    else:
        j = r.join(transcripts.select("recording_id", "payload"), "recording_id", "left")
    segs, bad = T.valid_segments(T.parse_payload(j), "prepare",
                                 ["recording_id", "user_id", "language", "audio_url", "transcription_url"], stage)
    prepared = T.prepared_segments(segs, min_sec, max_sec)
    return Prepared(prepared, no_folder.unionByName(bad), filtered)


@dataclass
class Extracted:
    detected: DataFrame
    occurrences: DataFrame
    failures: DataFrame
    input_rows: DataFrame


def extract_disfluencies(recordings: DataFrame, transcripts: DataFrame, manifest: DataFrame,
                         audio_listing: DataFrame, lexicon: DataFrame, language: str = "hi",
                         mode: str = "parity", clips_root: str = "clips", join_on: str = "url",
                         max_rows: int | None = None, storage: U.Storage = U.Storage()) -> Extracted:
    """``manifest`` lists the transcript objects that exist and parse; with
    files staged by recording id (``join_on="recording_id"``) the staged
    transcript is used whatever URL the resolution chose."""
    require_columns(recordings, ["recording_id", "language"])
    r = cap_rows(language_filter(recordings, language, ignore_case=True), max_rows)
    no_audio = U.missing_audio(r, audio_listing)
    with_audio = r.join(audio_listing.select("recording_id"), "recording_id", "left_semi")
    resolved, unresolved = U.resolve_candidates(with_audio, manifest, storage)
    uid = F.col("user_id").cast("string") if "user_id" in with_audio.columns else F.lit(None).cast("string")
    meta = with_audio.select("recording_id", F.coalesce(uid, F.lit("")).alias("user_id"),
                             F.col("language").cast("string").alias("language"))
    j = resolved.join(meta, "recording_id")
    if join_on == "url":
        j = j.join(transcripts.select(F.col("url").alias("transcription_url"), "payload"), "transcription_url", "left")
    else:
        j = j.join(transcripts.select("recording_id", "payload"), "recording_id", "left")
    segs, bad = T.valid_segments(T.parse_payload(j), "disfluency",
                                 ["recording_id", "user_id", "language", "audio_url", "transcription_url"])
    detected = D.detect(segs, lexicon, mode=mode)
    occ = D.occurrences(detected, clips_root)
    failures = no_audio.unionByName(unresolved).unionByName(bad)
    return Extracted(detected, occ, failures, r)
