"""Transcript payloads -> validated, exploded segments.

A transcript is a JSON array of ``{start, end, text}`` objects with loose
typing: keys may be missing (defaults 0.0 / 0.0 / ""), numbers may be
strings.  One bad entry fails the whole recording, as in the source
pipeline, so validity is decided per recording with ``exists`` over the
parsed array (row-local: a recording's array is one row) before anything is
exploded.  ``VARIANT`` tells an explicit JSON null from a missing key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import norm_asr_basic
from ..sources.tables import staged
from .partitioning import where_after

SEGMENT_FIELDS = ("start", "end", "text")


def _get(seg: Column, key: str, typ: str) -> Column:
    return F.try_variant_get(seg, f"$.{key}", typ)


def _present(seg: Column, key: str) -> Column:
    return F.try_variant_get(seg, f"$.{key}", "variant").isNotNull()


def _explicit_null(seg: Column, key: str) -> Column:
    return F.coalesce(F.is_variant_null(F.try_variant_get(seg, f"$.{key}", "variant")), F.lit(False))


def _is_object(seg: Column) -> Column:
    return F.schema_of_variant(seg).startswith("OBJECT")


def _bad_time(seg: Column, key: str) -> Column:
    """A present time that is null or does not parse as a number."""
    return _present(seg, key) & (_explicit_null(seg, key) | _get(seg, key, "double").isNull())


def parse_payload(df: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Add ``_segs`` (array<variant>, null when the payload is not a JSON list)
    and ``payload_error``.  The payload is parsed once, into its own column;
    the projection using it twice is kept separate so the parse is not
    duplicated when Catalyst collapses projections."""
    d = df.withColumn("_v", F.try_parse_json(F.col(payload_col)))
    v = F.col("_v")
    arr = F.try_variant_get(v, "$", "array<variant>")
    err = (F.when(F.col(payload_col).isNull(), "missing transcript")
           .when(v.isNull(), "transcript is not valid JSON")
           .when(arr.isNull(), F.concat(F.lit("unexpected transcript payload type: "),
                                        F.split(F.schema_of_variant(v), "<")[0])))
    return d.select("*", arr.alias("_segs"), err.alias("payload_error")).drop("_v")


def recording_error(mode: str) -> Column:
    """First reason a parsed recording fails, or null.

    ``mode="prepare"``: any entry that is not an object, a null/unparsable
    time, or a text that is null or not a string fails the recording.
    ``mode="disfluency"``: text is read leniently (null becomes ""); times
    are still required to parse.
    """
    segs = F.col("_segs")
    not_obj = F.exists(segs, lambda s: ~_is_object(s))
    bad_time = F.exists(segs, lambda s: _is_object(s) & (_bad_time(s, "start") | _bad_time(s, "end")))
    err = (F.when(F.col("payload_error").isNotNull(), F.col("payload_error"))
           .when(not_obj, "segment is not an object")
           .when(bad_time, "segment time is null or not a number"))
    if mode == "prepare":
        bad_text = F.exists(segs, lambda s: _explicit_null(s, "text") |
                            (_present(s, "text") & ~F.schema_of_variant(
                                F.try_variant_get(s, "$.text", "variant")).isin("STRING", "VOID")))
        err = err.when(bad_text, "segment text is null or not a string")
    return err


def _segment(s: Column) -> list[Column]:
    """Times and text of an entry, with defaults for missing keys."""
    return [F.coalesce(_get(s, "start", "double"), F.lit(0.0)).alias("start"),
            F.coalesce(_get(s, "end", "double"), F.lit(0.0)).alias("end"),
            F.coalesce(_get(s, "text", "string"), F.lit("")).alias("raw_text")]


def explode_segments(ok: DataFrame, keep: list[str]) -> DataFrame:
    """One row per array entry with its original index (X1) and defaults
    for missing keys (P8).  Index counts entries that are later rejected."""
    # outer form + null filter: a plain posexplode would make Catalyst infer
    # size(_segs) > 0 and push it below the projection, parsing JSON twice
    e = ok.select(*keep, F.posexplode_outer("_segs").alias("segment_idx", "_seg"))
    e = e.where(F.col("segment_idx").isNotNull())
    return e.select(*keep, "segment_idx", *_segment(F.col("_seg")))


def valid_segments(parsed: DataFrame, mode: str, keep: list[str], stage: bool = False) -> tuple[DataFrame, DataFrame]:
    """(segments of valid recordings, failures) in one pass over the parse.

    Only valid recordings' arrays are exploded (``when(error is null)``) and
    the filter is on the generated index.  A filter on the error column
    itself would be pushed below the projection and parse every payload
    twice.  ``stage`` writes the parsed recordings once in the shared folder,
    for plans that read more than one of the outputs, or one of them more
    than once; without it each reading joins and parses again."""
    d = parsed.withColumn("_error", recording_error(mode))
    if stage:
        times = F.when(F.col("_error").isNull(), F.transform("_segs", lambda s: F.struct(*_segment(s))))
        d = staged(d.select(*keep, "_error", times.alias("_segs")), "parsed")
        failures = d.where(F.col("_error").isNotNull()).select("recording_id", F.col("_error").alias("error"))
        segs = d.select(*keep, F.posexplode_outer("_segs").alias("segment_idx", "_seg")).where(F.col("segment_idx").isNotNull())
        return segs.select(*keep, "segment_idx", "_seg.start", "_seg.end", "_seg.raw_text"), failures
    failures = where_after(d, F.col("_error").isNotNull()).select("recording_id", F.col("_error").alias("error"))
    g = d.select(*keep, F.posexplode_outer(F.when(F.col("_error").isNull(), F.col("_segs")))
                 .alias("segment_idx", "_seg")).where(F.col("segment_idx").isNotNull())
    return g.select(*keep, "segment_idx", *_segment(F.col("_seg"))), failures


def split_valid(df: DataFrame, mode: str) -> tuple[DataFrame, DataFrame]:
    """(ok recordings with ``_segs``, failures ``recording_id, error``)."""
    df = df.withColumn("_error", recording_error(mode))
    failures = df.where(F.col("_error").isNotNull()).select("recording_id", F.col("_error").alias("error"))
    return df.where(F.col("_error").isNull()).drop("_error", "payload_error"), failures


def prepared_segments(segments: DataFrame, min_sec: float = 0.4, max_sec: float = 30.0,
                      sample_rate: int = 16000) -> DataFrame:
    """Segment-level training rows (P7, P9-P11): normalized non-empty text,
    ``end > start``, duration within [min_sec, max_sec] inclusive, id
    ``{recording}_{idx:04d}``, duration rounded to 3 places, and the sample
    range (start truncated; the end is clamped to the audio length when the
    audio is cut)."""
    t = segments.withColumn("sentence", norm_asr_basic(F.col("raw_text")))
    dur = F.col("end") - F.col("start")
    t = t.where((F.col("sentence") != "") & (F.col("end") > F.col("start"))
                & (dur >= min_sec) & (dur <= max_sec))
    return t.select(
        F.format_string("%s_%04d", F.col("recording_id"), F.col("segment_idx")).alias("id"),
        "*",
        F.round(dur, 3).alias("duration_sec"),
        F.greatest(F.lit(0), (F.col("start") * sample_rate).cast("long")).alias("start_sample"),
        (F.col("end") * sample_rate).cast("long").alias("end_sample"),
    ).drop("raw_text")
