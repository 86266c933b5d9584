"""Recording URL handling.

Network probing in the source pipeline is re-aimed: which objects exist and
parse as JSON comes from an object manifest ``(url, ok, is_json)``, and
candidate resolution is an explode + join + per-recording ``min_by``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Folder id patterns tried in order within each URL column.  The second one
# names the upload bucket and is a parameter of the deployment.
DEFAULT_FOLDER_PATTERNS = (r"/hi/([^/]+)/", r"uploads/([^/]+)/")
DEFAULT_BASE = "https://storage.example.com/uploads"
PREPARE_URL_COLUMNS = ("rec_url_gcp", "transcription_url_gcp", "metadata_url_gcp")
DISFLUENCY_URL_COLUMNS = ("rec_url_gcp", "transcription_url_gcp", "metadata_url_gcp",
                          "audio_url", "transcription_url")


@dataclass(frozen=True)
class Storage:
    """Where a deployment keeps its objects.

    ``patterns`` find the folder in the sheet's URLs, each with one group;
    ``folder_column`` names a sheet column that holds the folder instead.
    ``marker`` in a transcript's URL means that the audio lies under ``base`` too."""
    base: str = DEFAULT_BASE
    patterns: tuple[str, ...] = DEFAULT_FOLDER_PATTERNS
    folder_column: str | None = None
    marker: str = "uploads"
    audio_suffix: str = "_audio.wav"
    transcription_suffix: str = "_transcription.json"
    metadata_suffix: str = "_metadata.json"

    def folder(self, df: DataFrame, columns: Sequence[str]) -> Column:
        """The folder id; blank and absent ones are null."""
        if self.folder_column is None:
            return folder_id(df, columns, self.patterns)
        if self.folder_column not in df.columns:
            return F.lit(None).cast("string")
        return F.nullif(F.trim(F.col(self.folder_column).cast("string")), F.lit(""))

    def urls(self, folder: Column, recording_id: Column) -> dict[str, Column]:
        """The three canonical object URLs of a recording."""
        stem = F.concat(F.lit(self.base.rstrip("/") + "/"), folder, F.lit("/"), recording_id)
        return {"audio_url": F.concat(stem, F.lit(self.audio_suffix)),
                "transcription_url": F.concat(stem, F.lit(self.transcription_suffix)),
                "metadata_url": F.concat(stem, F.lit(self.metadata_suffix))}


def folder_id(df: DataFrame, columns: Sequence[str] = PREPARE_URL_COLUMNS,
              patterns: Sequence[str] = DEFAULT_FOLDER_PATTERNS) -> Column:
    """First non-empty capture over columns (outer) and patterns (inner);
    columns absent from the frame are skipped; null when nothing matches."""
    tries = []
    for c in columns:
        if c not in df.columns:
            continue
        for p in patterns:
            tries.append(F.nullif(F.regexp_extract(F.trim(F.col(c)), p, 1), F.lit("")))
    return F.coalesce(*tries) if tries else F.lit(None).cast("string")


def built_urls(folder: Column, recording_id: Column, base: str = DEFAULT_BASE) -> dict[str, Column]:
    """The three canonical object URLs of a recording (P5)."""
    return Storage(base=base).urls(folder, recording_id)


def transcript_candidates(df: DataFrame, folder: Column, storage: Storage) -> list[Column]:
    """The URLs under which a recording's transcript may lie, the preferred one first; null where the sheet has none."""
    def cell(c):
        return F.nullif(F.trim(F.col(c)), F.lit("")) if c in df.columns else F.lit(None).cast("string")

    return [cell("transcription_url"), cell("transcription_url_gcp"), storage.urls(folder, F.col("recording_id"))["transcription_url"]]


def resolve_candidates(recordings: DataFrame, manifest: DataFrame, storage: Storage = Storage(),
                       columns: Sequence[str] = DISFLUENCY_URL_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(resolved ``recording_id, folder_id, transcription_url, audio_url``, failures).

    Transcript = first candidate (sheet ``transcription_url``, then
    ``transcription_url_gcp``, then the built URL) that the manifest lists as
    present and JSON.  Audio = first non-empty candidate, replaced by the
    built audio URL when the chosen transcript lives in the upload bucket.
    """
    r = recordings.withColumn("folder_id", storage.folder(recordings, columns))
    no_folder = r.where(F.col("folder_id").isNull()).select(
        "recording_id", F.concat(F.lit("Unable to infer folder_id for recording_id="),
                                 F.col("recording_id")).alias("error"))
    r = r.where(F.col("folder_id").isNotNull())
    b = storage.urls(F.col("folder_id"), F.col("recording_id"))

    def col_or_null(c):
        return F.nullif(F.trim(F.col(c)), F.lit("")) if c in r.columns else F.lit(None).cast("string")

    t_cands = F.array(*[F.struct(F.lit(i).alias("prio"), u.alias("url")) for i, u in enumerate(
        transcript_candidates(r, F.col("folder_id"), storage))])
    audio = F.coalesce(col_or_null("audio_url"), col_or_null("rec_url_gcp"), b["audio_url"])
    r = r.select("recording_id", "folder_id", audio.alias("_audio"), b["audio_url"].alias("_built_audio"),
                 F.inline(t_cands)).where(F.col("url").isNotNull())
    # a semi join ignores duplicate manifest rows: no distinct (and no
    # shuffle of the whole object listing) is needed before it
    good = manifest.where(F.col("ok") & F.col("is_json")).select("url")
    hit = r.join(good, "url", "left_semi")
    best = hit.groupBy("recording_id", "folder_id", "_audio", "_built_audio").agg(
        F.min_by("url", "prio").alias("transcription_url"))
    resolved = best.select(
        "recording_id", "folder_id", "transcription_url",
        F.when(F.col("transcription_url").contains(storage.marker), F.col("_built_audio"))
         .otherwise(F.col("_audio")).alias("audio_url"))
    unresolved = (r.select("recording_id").distinct()
                  .join(best.select("recording_id"), "recording_id", "left_anti")
                  .select("recording_id", F.concat(F.lit("Cannot resolve transcription URL for "),
                                                   F.col("recording_id")).alias("error")))
    return resolved, no_folder.unionByName(unresolved)


def missing_audio(recordings: DataFrame, audio_files: DataFrame) -> DataFrame:
    """Recordings whose raw audio object is absent (anti-join on id)."""
    return recordings.join(audio_files.select("recording_id"), "recording_id", "left_anti").select(
        "recording_id", F.concat(F.lit("Missing raw audio: "), F.col("recording_id"), F.lit(".wav")).alias("error"))
