"""User-facing jobs over files: the four batch entry points of the source
pipeline (data-set preparation, disfluency extraction, spelling
classification, multi-model evaluation), each reading its inputs with
explicit schemas and writing Parquet/CSV/JSON outputs.

Each job writes its main outputs first and computes its summary from what
it wrote, so the expensive plan runs once and later reads start from
storage rather than from lineage.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audio as A
from ..operators import disfluency as D
from ..operators import scoring as S
from ..operators import spelling as O
from ..operators import urls as U
from ..operators.split import exact_split
from ..operators.summary import document_metrics
from ..sources import files as IO
from ..sources.clips import write_clip_files
from . import preparation as PR
from .evaluation import evaluate_models


def _summary(spark: SparkSession, path: str, values: dict) -> dict:
    """K4: the run summary as one JSON document (a few dozen values, built
    on the driver from counts that were computed on the cluster)."""
    text = json.dumps(values, ensure_ascii=False, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return values


def _examples(failures: DataFrame, k: int) -> list[str]:
    return [f"{r['recording_id']}: {r['error']}" for r in failures.orderBy("recording_id").limit(k).collect()]


def _sound(clips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clips of recordings that could be read throughout, and one failure for
    each of the others (E1: a recording is kept whole or not at all)."""
    failed = clips.where(F.col("error").isNotNull()).groupBy("recording_id").agg(F.min("error").alias("error"))
    return clips.where(F.col("error").isNull()).join(failed.select("recording_id"), "recording_id", "left_anti"), failed


def run_prepare(spark: SparkSession, metadata_csv: str, transcripts_dir: str, audio_dir: str, output_dir: str,
                language: str = "hi", val_ratio: float = 0.1, seed: int = 42, max_rows: int | None = None,
                min_segment_sec: float = 0.4, max_segment_sec: float = 30.0, storage: U.Storage = U.Storage()) -> dict:
    """Segment-level training set with clips at the recordings' rates, split exactly, written
    ``partitionBy("split")``; recordings whose audio is absent or whose
    transcript is invalid are reported as failures."""
    recs = IO.read_csv(spark, metadata_csv, IO.RECORDINGS_SCHEMA, required=["recording_id", "language"], splittable=True)
    transcripts = IO.read_transcripts(spark, transcripts_dir)
    audio = IO.read_audio(spark, audio_dir)
    p = PR.prepare_segments(recs, transcripts, language, min_segment_sec, max_segment_sec,
                            join_on="recording_id", max_rows=max_rows, storage=storage)
    # segments are staged first; clip cutting and the final join read them
    # from storage instead of re-running the transcript plan
    staged_path = os.path.join(output_dir, "_segments")
    p.segments.drop("raw_text").write.mode("overwrite").parquet(staged_path)
    staged = spark.read.parquet(staged_path)
    # audio bytes never enter a shuffle: clips are read from the files by
    # (recording, time window) groups
    clips = A.cut_clips_from_storage(staged.select("id", "recording_id", "start", "end"),
                                     audio.select("recording_id", "path"))
    no_audio = (staged.select("recording_id").distinct()
                .join(audio.select("recording_id"), "recording_id", "left_anti")
                .select("recording_id", F.concat(F.lit("Missing raw audio: "), F.col("recording_id"),
                                                 F.lit(".wav")).alias("error")))
    clips_path = os.path.join(output_dir, "_clips")
    clips.write.mode("overwrite").parquet(clips_path)
    cut, bad_audio = _sound(spark.read.parquet(clips_path))
    written = staged.join(cut.select("id", F.col("clip").alias("audio")), "id")
    if written.isEmpty():                                  # S9
        raise RuntimeError("No valid segment records were prepared.")
    # the cut needs the ids alone: those of stored clips that have a stored segment
    ids = cut.select("id").join(staged.select("id"), "id", "left_semi")
    IO.write_dataset(exact_split(written, "id", val_ratio, seed, ids=ids), os.path.join(output_dir, "dataset"))
    failures = p.failures.unionByName(no_audio).unionByName(bad_audio)
    failures.write.mode("overwrite").parquet(os.path.join(output_dir, "failures"))
    fails = spark.read.parquet(os.path.join(output_dir, "failures"))
    ds = spark.read.parquet(os.path.join(output_dir, "dataset"))
    counts = {r["split"]: r["count"] for r in ds.groupBy("split").count().collect()}
    return _summary(spark, os.path.join(output_dir, "prepare_summary"), {
        "input_rows_hi": p.input_rows.count(), "prepared_rows": sum(counts.values()),
        "train_rows": counts.get("train", 0), "validation_rows": counts.get("validation", 0),
        "failures": fails.count(), "failure_examples": _examples(fails, 10)})


def run_disfluency(spark: SparkSession, metadata_csv: str, lexicon_csv: str, transcripts_dir: str, audio_dir: str,
                   output_dir: str, language: str = "hi", mode: str = "parity", max_rows: int | None = None,
                   export_clips: bool = True, storage: U.Storage = U.Storage(), manifest_csv: str | None = None) -> dict:
    """Occurrence sheet (CSV + Parquet), one clip per segment with hits and
    (``export_clips``) a file for each occurrence, and the run summary.  ``manifest_csv`` lists the objects that
    exist and are JSON; without it, every candidate URL of a recording with a staged transcript file counts as such."""
    recs = IO.read_csv(spark, metadata_csv, IO.RECORDINGS_SCHEMA, required=["recording_id", "language"], splittable=True)
    transcripts = IO.read_transcripts(spark, transcripts_dir)
    audio = IO.read_audio(spark, audio_dir)
    lexicon = D.build_lexicon(D.wide_lexicon_to_long(IO.read_lexicon_sheet(spark, lexicon_csv)))
    if lexicon.isEmpty():                                  # S9
        raise ValueError(f"Lexicon load failed: no usable entries in {lexicon_csv}")
    if manifest_csv:
        manifest = IO.read_manifest(spark, manifest_csv)
    else:
        urls = F.array(*U.transcript_candidates(recs, storage.folder(recs, U.DISFLUENCY_URL_COLUMNS), storage))
        manifest = (recs.join(transcripts.select("recording_id"), "recording_id").select(F.explode(urls).alias("url"))
                    .select("url", F.lit(True).alias("ok"), F.lit(True).alias("is_json")))
    clips_root = os.path.join(output_dir, "clips")
    e = PR.extract_disfluencies(recs, transcripts, manifest, audio.select("recording_id"), lexicon, language,
                                mode, clips_root, join_on="recording_id", max_rows=max_rows, storage=storage)
    # clips first (one per segment with hits); as in the source, a segment
    # whose clip is empty yields no rows, and a recording whose audio cannot
    # be decoded yields no rows and one failure
    e.detected.write.mode("overwrite").parquet(os.path.join(output_dir, "_detected"))
    detected = spark.read.parquet(os.path.join(output_dir, "_detected"))
    A.segment_clips(detected, audio.select("recording_id", "path")).write.mode("overwrite").parquet(
        os.path.join(output_dir, "segment_clips"))
    clips, bad_audio = _sound(spark.read.parquet(os.path.join(output_dir, "segment_clips")))
    good = clips.select("recording_id", F.regexp_extract("id", r"_(\d+)$", 1).cast("int").alias("segment_idx"))
    occ_all = D.occurrences(detected, clips_root)
    occ_all.join(good, ["recording_id", "segment_idx"], "left_semi").write.mode("overwrite").parquet(
        os.path.join(output_dir, "occurrences"))
    occ = spark.read.parquet(os.path.join(output_dir, "occurrences"))
    if export_clips:
        # a file for each row of the sheet, under the path that the sheet gives
        segment = F.format_string("%s_%04d", F.col("recording_id"), F.col("segment_idx"))
        write_clip_files(occ.select("occurrence_id", "recording_id", segment.alias("segment")).join(
            clips.select(F.col("id").alias("segment"), "clip"), "segment").select(F.col("occurrence_id").alias("id"), "recording_id", "clip"), clips_root)
    IO.write_sheet(occ.select(*D.OUTPUT_COLUMNS), os.path.join(output_dir, "occurrences_csv"))
    e.failures.unionByName(bad_audio).write.mode("overwrite").parquet(os.path.join(output_dir, "failures"))
    fails = spark.read.parquet(os.path.join(output_dir, "failures"))
    types = {r["disfluency_type"]: r["occurrences"] for r in D.type_counts(occ).collect()}
    return _summary(spark, os.path.join(output_dir, "disfluency_summary"), {
        "input_rows_hi": e.input_rows.count(), "detected_disfluency_rows": occ.count(),
        "unique_recordings_with_hits": occ.select("recording_id").distinct().count(),
        "disfluency_type_counts": types, "failures": fails.count(), "failure_examples": _examples(fails, 20)})


def run_spelling(spark: SparkSession, words_csv: str, output_dir: str, na_values: bool = False) -> dict:
    """Unique-word labels (CSV + Parquet) and the reason breakdown."""
    words = IO.read_csv(spark, words_csv, na_values=na_values, splittable=True)
    S.require_columns(words, ["word"])
    labeled = O.label_words(O.distinct_words(words))
    labeled.write.mode("overwrite").parquet(os.path.join(output_dir, "labels"))
    out = spark.read.parquet(os.path.join(output_dir, "labels"))
    IO.write_sheet(out.select("word", "spelling_label"), os.path.join(output_dir, "labels_csv"))
    reasons = {r["reason"]: r["words"] for r in O.reason_counts(out).collect()}
    t = O.spelling_summary(out).first()
    return _summary(spark, os.path.join(output_dir, "spelling_summary"), {
        "total_unique_words": t["total_unique_words"], "correct_spelling_words": t["correct_spelling_words"],
        "incorrect_spelling_words": t["incorrect_spelling_words"], "reason_breakdown": reasons})


def row_numbers(df: DataFrame, name: str = "segment_idx") -> DataFrame:
    """Dense numbers in reading order: the place in the partition (the low bits
    of the generated id) plus the sizes of the partitions before it."""
    ids = df.withColumn("_id", F.monotonically_increasing_id())
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # one row per partition
    counts = sorted((r["p"], r["n"]) for r in ids.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    base, total = {}, 0
    for p, n in counts:
        base[p], total = total, total + n
    if not base:
        return df.withColumn(name, F.lit(None).cast("int"))
    before = F.element_at(F.create_map(*[F.lit(x) for kv in base.items() for x in kv]), part)
    return ids.withColumn(name, (before + place).cast("int")).drop("_id")


def run_evaluation(spark: SparkSession, sheet_csv: str, output_dir: str, null_policy: str = "empty") -> dict:
    """Model ranking, per-segment analysis (CSV + Parquet) and summary."""
    sheet = row_numbers(IO.read_csv(spark, sheet_csv, IO.MODEL_SHEET_SCHEMA, required=[S.REFERENCE_COLUMN, *S.MODEL_COLUMNS]))
    ev = evaluate_models(sheet, ["segment_idx", "segment_url_link"], null_policy=null_policy)
    ev.scored.drop("ref_norm").write.mode("overwrite").parquet(os.path.join(output_dir, "scored"))
    scored = spark.read.parquet(os.path.join(output_dir, "scored"))
    metrics = S.rank_models(S.corpus_metrics(scored))
    analysis = S.segment_analysis(scored, keys=["segment_idx", "segment_url_link"])
    IO.write_sheet(metrics.select("rank", "model", "wer", "cer"), os.path.join(output_dir, "model_metrics"))
    IO.write_sheet(analysis, os.path.join(output_dir, "segment_analysis"))
    ranking = [r.asDict() for r in metrics.orderBy("rank").select("rank", "model", "wer", "cer").collect()]
    wins = S.win_counts(analysis).collect()
    best = ranking[0]
    return _summary(spark, os.path.join(output_dir, "evaluation_summary"), {
        "input_rows": scored.count(), "best_model": best["model"], "best_model_wer": best["wer"],
        "best_model_cer": best["cer"], "model_ranking": ranking,
        "per_segment_best_model_counts": {w["model"]: w["wins"] for w in wins if w["wins"]},
        "per_segment_unique_best_model_counts": {w["model"]: w["unique_wins"] for w in wins if w["unique_wins"]}})


def run_report(spark: SparkSession, summaries: dict[str, str], output_dir: str, baseline_wer: float | None = None,
               tuned_wer: float | None = None, tuned_cer: float | None = None) -> dict:
    """The written summaries of other jobs side by side, as ``task, metric, value, number`` rows
    (Parquet + CSV); metrics of nested documents have dotted names, so new ones need no schema.

    With ``baseline_wer`` (a ratio) and ``tuned_wer`` (in percent, as trainers print it) the relative improvement is added."""
    docs = None
    for task, path in summaries.items():
        d = spark.read.option("wholetext", True).text(path).select(F.lit(task).alias("task"), F.try_parse_json("value").alias("doc"))
        docs = d if docs is None else docs.unionByName(d)
    if docs is None:                                       # S9
        raise ValueError("No summaries were given.")
    rows = document_metrics(docs, ["task"])
    given = {"baseline_wer": baseline_wer, "tuned_wer": tuned_wer and tuned_wer / 100, "tuned_cer": tuned_cer and tuned_cer / 100}
    if baseline_wer and tuned_wer is not None:
        given["relative_improvement"] = (baseline_wer - tuned_wer / 100) / baseline_wer
    extra = [("asr", k, repr(float(v)), float(v)) for k, v in given.items() if v is not None]
    if extra:
        rows = rows.unionByName(spark.createDataFrame(extra, "task string, metric string, value string, number double"))
    rows.write.mode("overwrite").parquet(os.path.join(output_dir, "report"))
    report = spark.read.parquet(os.path.join(output_dir, "report"))
    IO.write_sheet(report.orderBy("task", "metric"), os.path.join(output_dir, "report_csv"))
    per_task = {r["task"]: r["count"] for r in report.groupBy("task").count().collect()}
    return _summary(spark, os.path.join(output_dir, "report_summary"), {
        "metrics": per_task, "tasks_without_metrics": sorted(set(summaries) - set(per_task)), **{k: v for k, v in given.items() if v is not None}})
