"""Audio helpers, readers/writers and the streaming wrapper."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from vaani.operators import audio as A
from vaani.operators import disfluency as D
from vaani.sources import files as IO
from vaani.streaming import detect as S


def test_wav_roundtrip():
    x = (0.5 * np.sin(2 * np.pi * 440 * np.arange(8000) / 8000)).astype(np.float32)
    y, sr = A.decode_wav(A.encode_wav(x, 8000))
    assert sr == 8000 and np.max(np.abs(x - y)) < 1e-3


def test_sample_ranges():
    assert A.sample_range(0.5, 1.00005, 16000, 10**6, "truncate") == (8000, 16000)
    assert A.sample_range(-1.0, 2.0, 10, 15, "round") == (0, 15)
    assert A.sample_range(0.05, 0.15, 10, 100, "round") == (0, 2)   # half-even


def test_cut_clips(spark):
    x = (0.3 * np.sin(2 * np.pi * 500 * np.arange(16000 * 3) / 16000)).astype(np.float32)
    audio = spark.createDataFrame([("r1", A.encode_wav(x, 16000)), ("bad", b"not a wav")],
                                  "recording_id string, content binary")
    segs = spark.createDataFrame([("r1_0000", "r1", 0.0, 1.0), ("r1_0001", "r1", 2.5, 9.0),
                                  ("r1_0002", "r1", 5.0, 6.0), ("bad_0000", "bad", 0.0, 1.0)],
                                 "id string, recording_id string, start double, end double")
    clips = A.cut_clips(segs, audio)
    got = {r["id"] or r["recording_id"]: r for r in clips.collect()}
    assert got["r1_0000"]["n_samples"] == 16000 and got["r1_0001"]["n_samples"] == 8000
    assert "r1_0002" not in got and got["bad"]["error"].startswith("recording_id=bad")


def test_readers_writers(spark):
    d = tempfile.mkdtemp(prefix="vaani-io-")
    with open(os.path.join(d, "words.csv"), "w", encoding="utf-8-sig") as f:
        f.write('word\nघर\nNA\n"दो\nपंक्ति"\n')
    w = IO.read_csv(spark, os.path.join(d, "words.csv"), IO.WORDS_SCHEMA)
    assert [r["word"] for r in w.collect()] == ["घर", "NA", "दो\nपंक्ति"]
    assert IO.read_csv(spark, os.path.join(d, "words.csv"), IO.WORDS_SCHEMA, na_values=True).where("word is null").count() == 1
    os.makedirs(os.path.join(d, "t"))
    with open(os.path.join(d, "t", "rec9_transcription.json"), "w") as f:
        f.write('[{"start": 0, "end": 1, "text": "a"}]')
    t = IO.read_transcripts(spark, os.path.join(d, "t")).collect()
    assert t[0]["recording_id"] == "rec9" and t[0]["payload"].startswith("[")
    df = spark.createDataFrame([("a", "train"), ("b", "validation")], "id string, split string")
    IO.write_dataset(df, os.path.join(d, "ds"))
    assert [r["id"] for r in IO.read_prepared(spark, os.path.join(d, "ds"), "validation").collect()] == ["b"]


def test_streaming_detection(spark):
    d = tempfile.mkdtemp(prefix="vaani-stream-")
    src = os.path.join(d, "in")
    schema = ("recording_id string, segment_idx int, start double, end double, raw_text string, "
              "transcription_url string, audio_url string, user_id string, language string")
    spark.createDataFrame([("r1", 0, 0.0, 1.0, "um um yes", "t", "a", "u", "hi")], schema).write.parquet(src)
    lexicon = spark.createDataFrame([("Filler", 0, "um", 0)], "type string, type_ord int, phrase string, phrase_ord int")
    S.run_detection(S.segment_stream(spark, src, schema), lexicon, os.path.join(d, "out"), os.path.join(d, "ckpt"))
    out = spark.read.parquet(os.path.join(d, "out")).orderBy("occurrence_id").collect()
    assert [(r["disfluency_type"], r["matched_text"]) for r in out] == [("Filler", "um"), ("Repetition", "um um")]


def test_cut_from_storage_matches_in_memory(spark, tmp_path):
    from vaani.sources.files import read_audio
    x = (0.3 * np.sin(2 * np.pi * 250 * np.arange(8000 * 20) / 8000)).astype(np.float32)
    d = tmp_path / "a"
    d.mkdir()
    (d / "r1.wav").write_bytes(A.encode_wav(x, 8000))
    segs = spark.createDataFrame([(f"r1_{i:04d}", "r1", 1.5 * i, 1.5 * i + 1.25) for i in range(12)] +
                                 [("r1_9999", "r1", 19.5, 25.0)],
                                 "id string, recording_id string, start double, end double")
    audio = read_audio(spark, str(d))
    a = {r["id"]: r for r in A.cut_clips(segs, audio).collect()}
    b = {r["id"]: r for r in A.cut_clips_from_storage(segs, audio.drop("content"), window_sec=4.0).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k]["n_samples"] == b[k]["n_samples"]
        ya, yb = A.decode_wav(a[k]["clip"])[0], A.decode_wav(b[k]["clip"])[0]
        assert np.max(np.abs(ya - yb)) < 1e-3


def test_columns_are_bound_by_name(spark, tmp_path):
    p = tmp_path / "sheet.csv"
    p.write_text("recording_id,extra,language,user_id\n967179,x,hi,825780\n")
    r = IO.read_csv(spark, str(p), IO.RECORDINGS_SCHEMA, required=["recording_id", "language"]).first()
    assert (r["recording_id"], r["user_id"], r["language"], r["audio_url"]) == ("967179", "825780", "hi", None)
    assert IO.read_csv(spark, str(p), IO.RECORDINGS_SCHEMA, multiline=False).first()["user_id"] == "825780"
    with pytest.raises(ValueError, match="rec_url_gcp"):
        IO.read_csv(spark, str(p), IO.RECORDINGS_SCHEMA, required=["rec_url_gcp"])


def test_row_numbers_over_partitions(spark):
    from vaani.plans.jobs import row_numbers
    df = spark.range(100).repartitionByRange(7, "id").sortWithinPartitions("id")
    assert [r["segment_idx"] for r in row_numbers(df).orderBy("id").collect()] == list(range(100))
    assert row_numbers(spark.range(0)).count() == 0
