"""End-to-end jobs over files laid out like the source pipeline's inputs."""

import csv
import json
import os
import tempfile

import numpy as np
import pytest

from vaani.operators.audio import encode_wav
from vaani.plans import jobs


def _wav(path, seconds, sr=8000, channels=1):
    import wave
    x = 0.3 * np.sin(2 * np.pi * 300 * np.arange(int(seconds * sr)) / sr)
    pcm = (np.repeat(x[:, None], channels, axis=1) * 32767).astype("<i2")
    with wave.open(path, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes(pcm.tobytes())


@pytest.fixture(scope="module")
def inputs():
    d = tempfile.mkdtemp(prefix="vaani-jobs-")
    rows = [
        ("u1", "101", "hi", "https://x.example/hi/f1/101.wav", "", ""),
        ("u2", "102", "hi", "", "https://storage.example.com/uploads/f2/102_transcription.json", ""),
        ("u3", "103", "hi", "", "", ""),                      # no folder id
        ("u4", "104", "en", "https://x.example/hi/f4/104.wav", "", ""),
        ("u5", "105", "hi", "https://x.example/hi/f5/105.wav", "", ""),   # transcript is not a list
        ("u6", "106", "HI", "https://x.example/hi/f6/106.wav", "", ""),   # no audio
    ]
    with open(os.path.join(d, "meta.csv"), "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(["user_id", "recording_id", "language", "rec_url_gcp", "transcription_url_gcp", "metadata_url_gcp"])
        w.writerows(rows)
    os.makedirs(os.path.join(d, "t"))
    os.makedirs(os.path.join(d, "a"))
    seg = lambda s, e, t: {"start": s, "end": e, "text": t}
    payloads = {
        "101": [seg(0.0, 1.0, "मैं घर घर जाना"), seg(1.0, 1.2, "छोटा"), seg(2.0, 3.5, "अच्छााा हाँ"), seg(3.0, 2.0, "x")],
        "102": [seg(0.5, 2.0, "um  the\nstart"), {"end": 4.0, "text": "re-do"}, seg(9.0, 9.5, "um um")],
        "104": [seg(0.0, 1.0, "english")],
        "105": {"segments": []},
        "106": [seg(0.0, 1.0, "घर घर")],
    }
    for rid, p in payloads.items():
        with open(os.path.join(d, "t", f"{rid}_transcription.json"), "w", encoding="utf-8") as f:
            json.dump(p, f, ensure_ascii=False)
    _wav(os.path.join(d, "a", "101.wav"), 4.0, channels=2)
    _wav(os.path.join(d, "a", "102.wav"), 5.0)
    _wav(os.path.join(d, "a", "104.wav"), 2.0)
    _wav(os.path.join(d, "a", "105.wav"), 2.0)
    with open(os.path.join(d, "lex.csv"), "w", encoding="utf-8-sig") as f:
        f.write("Filler ,Hesitation\num,हाँ\n,the\n")
    with open(os.path.join(d, "words.csv"), "w", encoding="utf-8-sig") as f:
        f.write("word\nघर\nघर \nhello\nक्\nNA\n")
    with open(os.path.join(d, "sheet.csv"), "w", encoding="utf-8-sig", newline="") as f:
        w = csv.writer(f)
        w.writerow(["segment_url_link", "Human", "Model H", "Model i", "Model k", "Model l", "Model m", "Model n"])
        w.writerow(["s1", "the cat sat on mat", "the cat sat on mat", "the cat sit on the mat", "", "the cat",
                    "cat", "the cat sat on mat"])
        w.writerow(["s2", "मैं घर जाना", "मैं घर जाना", "मैं घर", "मैं", "घर", "", "मैं घर जाना"])
    return d


def test_prepare_job(spark, inputs):
    out = os.path.join(inputs, "out_prepare")
    s = jobs.run_prepare(spark, os.path.join(inputs, "meta.csv"), os.path.join(inputs, "t"),
                         os.path.join(inputs, "a"), out)
    # 101: segs 0 (1.0 s) and 2 (1.5 s) pass, seg 1 is 0.2 s, seg 3 ends before it starts
    # 102: seg 0 passes, seg 1 starts at the default 0.0 and lasts 4 s
    assert s["prepared_rows"] == 4 and s["input_rows_hi"] == 4
    assert s["train_rows"] + s["validation_rows"] == 4 and s["validation_rows"] == 1
    errs = "\n".join(s["failure_examples"])
    assert "103" in errs and "105" in errs and s["failures"] == 2
    from vaani.sources.files import read_summaries
    back = read_summaries(spark, os.path.join(out, "prepare_summary")).first()
    assert back["prepared_rows"] == 4 and back["failures"] == 2
    ds = spark.read.parquet(os.path.join(out, "dataset"))
    r = ds.where("id = '101_0002'").first()
    assert r["sentence"] == "अच्छााा हाँ" and r["duration_sec"] == 1.5 and len(r["audio"]) > 44


def test_disfluency_job(spark, inputs):
    out = os.path.join(inputs, "out_dis")
    s = jobs.run_disfluency(spark, os.path.join(inputs, "meta.csv"), os.path.join(inputs, "lex.csv"),
                            os.path.join(inputs, "t"), os.path.join(inputs, "a"), out)
    occ = spark.read.parquet(os.path.join(out, "occurrences")).orderBy("occurrence_id").collect()
    got = [(o["occurrence_id"], o["disfluency_type"], o["matched_text"]) for o in occ]
    assert ("101_0000_00", "Repetition", "घर घर") in got
    assert ("101_0002_00", "Hesitation", "हाँ") in got
    assert ("101_0002_01", "Prolongation", "ााा") in got
    assert ("102_0000_00", "Filler", "um") in got and ("102_0000_01", "Hesitation", "the") in got
    assert not any(o[0].startswith("102_0002") for o in got)      # starts after the 5 s of audio
    assert s["failures"] == 3            # 103 no folder, 105 not a list, 106 no audio
    assert all(os.path.exists(o["clip_path"]) for o in occ)      # a stored clip for every row of the sheet


def test_a_broken_recording_is_one_failure(spark):
    """The file ends early: a segment cut before the fault doesn't stay, and there is one failure with a message."""
    from pyspark.sql import functions as F
    cut = spark.createDataFrame([("a_0000", "a", b"x", None), (None, "a", None, "recording_id=a: EOFError"), (None, "a", None, "recording_id=a: later"),
                                 ("b_0000", "b", b"y", None)], "id string, recording_id string, clip binary, error string")
    good, bad = jobs._sound(cut)
    assert [r.id for r in good.collect()] == ["b_0000"]
    assert [(r.recording_id, r.error) for r in bad.collect()] == [("a", "recording_id=a: EOFError")]


def test_spelling_job(spark, inputs):
    s = jobs.run_spelling(spark, os.path.join(inputs, "words.csv"), os.path.join(inputs, "out_sp"))
    assert s["total_unique_words"] == 4 and s["correct_spelling_words"] == 1
    assert s["reason_breakdown"]["contains_non_devanagari"] == 2


def test_evaluation_job(spark, inputs):
    s = jobs.run_evaluation(spark, os.path.join(inputs, "sheet.csv"), os.path.join(inputs, "out_ev"))
    assert s["input_rows"] == 2 and s["best_model"] == "Model H" and s["best_model_wer"] == 0.0
    assert s["per_segment_best_model_counts"] == {"Model H": 2}
    rows = spark.read.option("header", True).csv(os.path.join(inputs, "out_ev", "segment_analysis")).collect()
    assert sorted((r["segment_idx"], r["segment_url_link"]) for r in rows) == [("0", "s1"), ("1", "s2")]


def test_report_job(spark, inputs):
    """Summaries written by two jobs; nested metrics come out by their paths."""
    ev, sp = os.path.join(inputs, "rep_ev"), os.path.join(inputs, "rep_sp")
    e = jobs.run_evaluation(spark, os.path.join(inputs, "sheet.csv"), ev)
    w = jobs.run_spelling(spark, os.path.join(inputs, "words.csv"), sp)
    broken = os.path.join(inputs, "broken.json")
    with open(broken, "w") as f:
        f.write("{not json")
    out = os.path.join(inputs, "out_report")
    s = jobs.run_report(spark, {"evaluation": os.path.join(ev, "evaluation_summary"), "spelling": os.path.join(sp, "spelling_summary"), "broken": broken},
                        out, baseline_wer=0.83, tuned_wer=41.885734, tuned_cer=20.908851)
    rows = {(r["task"], r["metric"]): (r["value"], r["number"]) for r in spark.read.parquet(os.path.join(out, "report")).collect()}
    assert len(rows) == sum(s["metrics"].values()) and s["tasks_without_metrics"] == ["broken"]
    assert len(e["model_ranking"]) == 6 and [m["rank"] for m in e["model_ranking"]] == [1, 2, 3, 4, 5, 6]
    for i, m in enumerate(e["model_ranking"]):
        assert rows["evaluation", f"model_ranking.{i}.model"] == (m["model"], None)
        assert rows["evaluation", f"model_ranking.{i}.wer"][1] == pytest.approx(m["wer"])
    assert rows["evaluation", "per_segment_best_model_counts.Model H"] == ("2", 2.0)
    for reason, n in w["reason_breakdown"].items():
        assert rows["spelling", f"reason_breakdown.{reason}"] == (str(n), n)
    assert rows["asr", "relative_improvement"][1] == pytest.approx(0.4953526, abs=1e-6)
    assert spark.read.option("header", True).csv(os.path.join(out, "report_csv")).count() == len(rows)
    with pytest.raises(ValueError):
        jobs.run_report(spark, {}, out)


def test_nested_documents_become_metrics(spark):
    from pyspark.sql import functions as F
    from vaani.operators.summary import document_metrics
    docs = ['{"a": 1, "b": {"c": [true, null, {"d": "x"}], "e": {}}, "f": 1.5}', "null", "[7, [8]]", "3", None, '{"p": {"q": {"r": {"s": 9}}}}']
    df = spark.createDataFrame(list(enumerate(docs)), "k int, j string").select("k", F.parse_json("j").alias("doc"))
    got = {(r["k"], r["metric"]): (r["value"], r["number"]) for r in document_metrics(df, ["k"]).collect()}
    assert got == {(0, "a"): ("1", 1.0), (0, "b.c.0"): ("true", None), (0, "b.c.1"): (None, None), (0, "b.c.2.d"): ("x", None), (0, "f"): ("1.5", 1.5),
                   (2, "0"): ("7", 7.0), (2, "1.0"): ("8", 8.0), (5, "p.q.r.s"): ("9", 9.0)}


def test_disfluency_job_on_another_storage(spark, inputs):
    """Folders by user id, other suffixes and base, and a manifest with objects that are absent or no JSON."""
    from vaani.operators.urls import Storage
    own = Storage(base="https://objects.example/bucket/", folder_column="user_id", marker="bucket", audio_suffix="_recording.wav")
    path = os.path.join(inputs, "manifest.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("url,ok,is_json,size\n"
                "https://objects.example/bucket/u1/101_transcription.json,true,True,10\n"
                "https://storage.example.com/uploads/f2/102_transcription.json,true,false,10\n"
                "https://objects.example/bucket/u2/102_transcription.json,false,true,0\n"
                "https://objects.example/bucket/u3/103_transcription.json,,yes,\n"
                "https://objects.example/bucket/u5/105_transcription.json,1,1,5\n")
    run = lambda out, **kw: jobs.run_disfluency(spark, os.path.join(inputs, "meta.csv"), os.path.join(inputs, "lex.csv"), os.path.join(inputs, "t"),
                                                os.path.join(inputs, "a"), os.path.join(inputs, out), storage=own, **kw)
    s = run("out_own", manifest_csv=path)
    occ = spark.read.parquet(os.path.join(inputs, "out_own", "occurrences")).collect()
    assert {o["recording_id"] for o in occ} == {"101"}
    assert {o["audio_url"] for o in occ} == {"https://objects.example/bucket/u1/101_recording.wav"}
    errs = {x.split(":")[0]: x for x in s["failure_examples"]}
    assert "Cannot resolve transcription URL" in errs["102"] and s["unique_recordings_with_hits"] == 1
    s = run("out_staged")
    assert s["unique_recordings_with_hits"] == 2


def test_storage_urls(spark):
    from pyspark.sql import functions as F
    from vaani.operators.urls import Storage
    df = spark.createDataFrame([("7", "1", "https://x/in/deep/f9/1.wav"), (" ", "2", ""), (None, "3", None)], "user_id string, recording_id string, rec_url_gcp string")
    by_user = Storage(base="s3://b", folder_column="user_id", audio_suffix="_recording.wav")
    by_url = Storage(patterns=(r"/deep/([^/]+)/",))
    rows = df.select(by_user.folder(df, ["rec_url_gcp"]).alias("u"), by_url.folder(df, ["rec_url_gcp"]).alias("p"),
                     by_user.urls(by_user.folder(df, []), F.col("recording_id"))["audio_url"].alias("a")).collect()
    assert [tuple(r) for r in rows] == [("7", "f9", "s3://b/7/1_recording.wav"), (None, None, None), (None, None, None)]
    assert df.select(Storage(folder_column="absent").folder(df, []).alias("f")).where("f IS NOT NULL").count() == 0


def test_cli_evaluate(inputs):
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(inputs, "out_cli")
    r = subprocess.run([sys.executable, "-m", "vaani", "--master", "local[2]", "evaluate",
                        "--input_csv", os.path.join(inputs, "sheet.csv"), "--output_dir", out],
                       cwd=repo, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    summary = json.loads(r.stdout[r.stdout.index("{"):])
    assert summary["best_model"] == "Model H" and summary["input_rows"] == 2
