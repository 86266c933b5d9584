"""Command line: ``python -m vaani <job> [options]``.

Jobs: ``prepare``, ``disfluency``, ``spelling``, ``evaluate``, ``report``.  The session comes from the launcher (``spark-submit``); ``--master`` is for
local runs only.
"""

from __future__ import annotations

import argparse
import json


def _storage_options(p):
    from .operators.urls import Storage
    d = Storage()
    p.add_argument("--storage_base", default=d.base, help="what canonical object URLs begin with")
    p.add_argument("--folder_pattern", action="append", help="regular expression with one group for the folder in a URL; may be repeated")
    p.add_argument("--folder_column", default=None, help="sheet column that holds the folder, such as user_id")
    p.add_argument("--bucket_marker", default=d.marker, help="text in a transcript's URL that puts its audio under the base")
    p.add_argument("--audio_suffix", default=d.audio_suffix)
    p.add_argument("--transcription_suffix", default=d.transcription_suffix)
    p.add_argument("--metadata_suffix", default=d.metadata_suffix)


def _storage(a):
    from .operators.urls import Storage
    return Storage(a.storage_base, tuple(a.folder_pattern or Storage().patterns), a.folder_column, a.bucket_marker,
                   a.audio_suffix, a.transcription_suffix, a.metadata_suffix)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="vaani")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="job", required=True)

    p = sub.add_parser("prepare", help="segment-level ASR data set")
    p.add_argument("--metadata_csv", required=True)
    p.add_argument("--transcripts_dir", required=True)
    p.add_argument("--audio_dir", required=True)
    p.add_argument("--output_dir", required=True)
    p.add_argument("--language", default="hi")
    p.add_argument("--val_ratio", type=float, default=0.1)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--max_rows", type=int, default=None)
    p.add_argument("--min_segment_sec", type=float, default=0.4)
    p.add_argument("--max_segment_sec", type=float, default=30.0)
    _storage_options(p)

    d = sub.add_parser("disfluency", help="disfluency occurrences and clips")
    d.add_argument("--metadata_csv", required=True)
    d.add_argument("--disfluency_csv", required=True)
    d.add_argument("--transcripts_dir", required=True)
    d.add_argument("--raw_audio_dir", required=True)
    d.add_argument("--output_dir", required=True)
    d.add_argument("--language", default="hi")
    d.add_argument("--mode", choices=["parity", "strict_tokens"], default="parity")
    d.add_argument("--max_rows", type=int, default=None)
    d.add_argument("--export_clips", action=argparse.BooleanOptionalAction, default=True)
    d.add_argument("--manifest_csv", default=None, help="object listing with url, ok, is_json; default: the staged transcripts")
    _storage_options(d)

    s = sub.add_parser("spelling", help="unique-word spelling labels")
    s.add_argument("--input_csv", required=True)
    s.add_argument("--output_dir", required=True)
    s.add_argument("--na_values", action="store_true")

    e = sub.add_parser("evaluate", help="multi-model WER/CER evaluation")
    e.add_argument("--input_csv", required=True)
    e.add_argument("--output_dir", required=True)
    e.add_argument("--null_policy", choices=["empty", "nan_literal"], default="empty")

    r = sub.add_parser("report", help="written summaries side by side")
    r.add_argument("--summary", action="append", required=True, metavar="TASK=PATH", help="may be repeated")
    r.add_argument("--output_dir", required=True)
    r.add_argument("--baseline_wer", type=float, default=None, help="ratio")
    r.add_argument("--tuned_wer", type=float, default=None, help="percent")
    r.add_argument("--tuned_cer", type=float, default=None, help="percent")

    a = ap.parse_args(argv)
    from .plans import jobs
    from .session import get_spark
    spark = get_spark(f"vaani-{a.job}", master=a.master)
    if a.job == "prepare":
        out = jobs.run_prepare(spark, a.metadata_csv, a.transcripts_dir, a.audio_dir, a.output_dir, a.language,
                               a.val_ratio, a.seed, a.max_rows, a.min_segment_sec, a.max_segment_sec, _storage(a))
    elif a.job == "disfluency":
        out = jobs.run_disfluency(spark, a.metadata_csv, a.disfluency_csv, a.transcripts_dir, a.raw_audio_dir,
                                  a.output_dir, a.language, a.mode, a.max_rows, a.export_clips, _storage(a), a.manifest_csv)
    elif a.job == "spelling":
        out = jobs.run_spelling(spark, a.input_csv, a.output_dir, a.na_values)
    elif a.job == "report":
        out = jobs.run_report(spark, dict(x.split("=", 1) for x in a.summary), a.output_dir, a.baseline_wer, a.tuned_wer, a.tuned_cer)
    else:
        out = jobs.run_evaluation(spark, a.input_csv, a.output_dir, a.null_policy)
    print(json.dumps(out, ensure_ascii=False, indent=2))


if __name__ == "__main__":
    main()
