"""Property tests: distances, normalizers, conservation."""

import random
import unicodedata

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from frames import one_col, plain_distance
from vaani.functions.edit_distance import word_edits, words
from vaani.functions.normalize import norm_disfluency, norm_scoring, norm_word
from vaani.operators import disfluency as D
from vaani.operators import scoring as S

ALPHA = ["a", "b", "é", "क", "ि", "़", " ", "-", "–", ".", "\n", " "]


def test_distance_properties(spark):
    rng = random.Random(5)
    vocab = ["x", "y", "zz", "मैं", "é"]
    rows = [(" ".join(rng.choices(vocab, k=rng.randint(0, 9))), " ".join(rng.choices(vocab, k=rng.randint(0, 9))))
            for _ in range(300)]
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", word_edits(words("a"), words("b")).alias("ab"), word_edits(words("b"), words("a")).alias("ba"),
        word_edits(words("a"), words("a")).alias("aa")).collect()
    for r in got:
        assert r["ab"] == r["ba"] and r["aa"] == 0
        na, nb = len(r["a"].split()), len(r["b"].split())
        assert abs(na - nb) <= r["ab"] <= max(na, nb)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(ALPHA), max_size=12), min_size=1, max_size=20))
def test_normalizers_idempotent(spark, texts):
    df = one_col(spark, texts)
    for f in (norm_scoring, norm_word, norm_disfluency):
        once = df.select(f(F.col("s")).alias("s"))
        twice = once.select(f(F.col("s")).alias("t"), "s").collect()
        assert all(r["s"] == r["t"] for r in twice)


def test_segment_edits_sum_to_corpus(spark):
    rng = random.Random(9)
    vocab = ["the", "cat", "sat", "on", "mat", "a"]
    sent = lambda: " ".join(rng.choices(vocab, k=rng.randint(1, 8)))
    rows = [(f"s{i}", sent(), *[sent() for _ in S.MODEL_COLUMNS]) for i in range(60)]
    cols = ["segment_url_link", "Human", *S.MODEL_COLUMNS]
    sheet = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    scored = S.score_sheet(sheet)
    per = {r["model"]: r["e"] for r in S.pair_scores(scored, ["segment_url_link"]).groupBy("model")
           .agg(F.sum("word_edits").alias("e")).collect()}
    corpus = {r["model"]: r["word_edits"] for r in S.corpus_metrics(scored).collect()}
    assert per == corpus
    py = {m: sum(plain_distance(r[1].split(), r[2 + i].split()) for r in rows) for i, m in enumerate(S.MODEL_COLUMNS)}
    assert corpus == py


def test_nan_literal_policy(spark):
    cols = ["segment_url_link", "Human", *S.MODEL_COLUMNS]
    sheet = spark.createDataFrame([("s1", "nan", None, "x", "nan", "nan", "nan", "nan")],
                                  ", ".join(f"`{c}` string" for c in cols))
    empty = {r["model"]: r["word_edits"] for r in S.pair_scores(S.score_sheet(sheet), ["segment_url_link"]).collect()}
    parity = {r["model"]: r["word_edits"] for r in
              S.pair_scores(S.score_sheet(sheet, null_policy="nan_literal"), ["segment_url_link"]).collect()}
    assert empty["Model H"] == 1 and parity["Model H"] == 0


def test_duplicate_lexicon_headers_keep_last(spark):
    wide = spark.createDataFrame([(0, "um", "uh"), (1, None, "um")], "row_ord int, `Filler` string, `Filler ` string")
    lex = D.build_lexicon(D.wide_lexicon_to_long(wide)).orderBy("phrase_ord").collect()
    assert [(r["type"], r["phrase"]) for r in lex] == [("Filler", "uh"), ("Filler", "um")]


def test_recordings_are_conserved(spark):
    from vaani.plans import catalog as C
    sf = "/root/testdata/sf0.001"
    from vaani.operators import transcripts as T
    from vaani.plans import fixtures as X
    c = C._conv(spark, sf)
    p = C._prepared(spark, sf)
    inputs = {r["recording_id"] for r in p.input_rows.collect()}
    failed = {r["recording_id"] for r in p.failures.collect()}
    parsed = T.parse_payload(X.recordings(c).join(
        X.transcripts(c).withColumn("recording_id", F.regexp_extract("url", r"/(r[0-9]+_[0-9]+)_", 1)),
        "recording_id"))
    ok = {r["recording_id"] for r in parsed.where(T.recording_error("prepare").isNull()).collect()} & inputs
    # A recording without a folder in any URL fails whatever its transcript
    urls = ["rec_url_gcp", "transcription_url_gcp", "metadata_url_gcp"]
    ok -= {r["recording_id"] for r in X.recordings(c).where(F.coalesce(*urls).isNull()).collect()}
    assert failed.isdisjoint(ok) and (failed | ok) == inputs


def test_empty_later_header_does_not_replace(spark):
    wide = spark.createDataFrame([(0, "um", None, "x"), (1, "er", " ", None)],
                                 "row_ord int, `A` string, `A ` string, `B` string")
    lex = D.build_lexicon(D.wide_lexicon_to_long(wide)).orderBy("type_ord", "phrase_ord").collect()
    assert [(r["type"], r["type_ord"], r["phrase"]) for r in lex] == [("A", 0, "um"), ("A", 0, "er"), ("B", 2, "x")]


def test_char_distance_counts_code_points(spark):
    from vaani.functions.edit_distance import char_edits
    rng = random.Random(13)
    alphabet = ["a", "é", "क", "ि", "़", " ", "😀", "𐀀"]
    rows = [("".join(rng.choices(alphabet, k=rng.randint(0, 10))), "".join(rng.choices(alphabet, k=rng.randint(0, 10))))
            for _ in range(500)]
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", char_edits(F.col("a"), F.col("b")).alias("d"), F.length("a").alias("n")).collect()
    for r in got:
        assert r["d"] == plain_distance(list(r["a"]), list(r["b"])) and r["n"] == len(r["a"])
