"""Parity fixtures for the detection rules (FIXTURES.md 'Cases to write first')."""

import pytest
from pyspark.sql import functions as F

from frames import one_col
from vaani.functions.normalize import norm_disfluency
from vaani.operators import disfluency as D

# text -> (repetition, false start, prolongation); None = no hit
CASES = [
    ("मैं मैं", None, None, None),
    ("मैं-मैं", None, "मैं-", None),
    ("जी जी जी", None, None, None),
    ("घर घर जाना", "घर घर", None, None),
    ("जो जोर", "जो जो", None, None),
    ("का काम", "का का", None, None),
    ("राम राम राम।", "राम राम राम", None, None),
    ("मैं-तुम", None, "मैं-", None),
    ("घर-", None, None, None),
    ("a a-a b", "a a-a", "a-", None),
    ("sooo", None, None, "ooo"),
    ("अच्छााा", None, None, "ााा"),
]


@pytest.fixture(scope="module")
def matches(spark):
    df = one_col(spark, [c[0] for c in CASES]).select("s", norm_disfluency(F.col("s")).alias("t"))
    out = df.select(
        "s",
        F.regexp_extract_all("t", F.lit(D.REPETITION), 0).alias("rep"),
        F.regexp_extract_all("t", F.lit(D.FALSE_START), 1).alias("fs"),
        F.regexp_extract_all("t", F.lit(D.PROLONGATION), 0).alias("pro"),
    ).collect()
    return {r["s"]: r for r in out}


@pytest.mark.parametrize("text,rep,fs,pro", CASES)
def test_parity_rules(matches, text, rep, fs, pro):
    r = matches[text]
    assert r["rep"] == ([rep] if rep else [])
    assert r["fs"] == ([fs] if fs else [])
    assert r["pro"] == ([pro] if pro else [])


def test_strict_tokens_mode(spark):
    df = one_col(spark, ["मैं मैं", "जो जोर", "घर-"]).select(norm_disfluency(F.col("s")).alias("t"))
    got = df.select(F.regexp_extract_all("t", F.lit(D.STRICT_REPETITION), 0).alias("r"),
                    F.regexp_extract_all("t", F.lit(D.STRICT_FALSE_START), 1).alias("f")).collect()
    assert got[0]["r"] == ["मैं मैं"]
    assert got[1]["r"] == []
    assert got[2]["f"] == ["घर-"]


def test_hit_order_and_dedup(spark):
    seg = spark.createDataFrame([("r1", 0, 0.0, 1.0, "the the um um the")],
                                "recording_id string, segment_idx int, start double, end double, raw_text string")
    lex = spark.createDataFrame([("Filler", 0, "um", 0), ("Filler", 0, "the", 1)], "type string, type_ord int, phrase string, phrase_ord int")
    det = D.detect(seg, lex).select("hits").first()["hits"]
    got = [(h["disfluency_type"], h["matched_text"], h["match_rule"]) for h in det]
    assert got == [("Filler", "um", "lexicon"), ("Filler", "the", "lexicon"),
                   ("Repetition", "the the", "regex_repetition"), ("Repetition", "um um", "regex_repetition")]


def test_join_equals_one_pattern_per_phrase(spark):
    texts = ["and the re-do", "redo and  the", "the-end of it", "nothing here ?!", "re do", "and-the"]
    seg = spark.createDataFrame([(f"r{i}", i, 0.0, 1.0, t) for i, t in enumerate(texts)],
                                "recording_id string, segment_idx int, start double, end double, raw_text string")
    lex = spark.createDataFrame([("A", 0, "and the", 0), ("A", 0, "re-do", 1), ("B", 1, "the", 0), ("B", 1, "of it", 1),
                                 ("C", 2, "?!", 0)],
                                "type string, type_ord int, phrase string, phrase_ord int")
    a = {r["recording_id"]: [h for h in r["hits"] if h["match_rule"] == D.LEXICON_RULE] for r in D.detect(seg, lex).collect()}
    rows = lex.orderBy("type_ord", "phrase_ord").collect()
    for r in seg.select("recording_id", "raw_text", *[F.col("raw_text").rlike(D.phrase_pattern(p["phrase"])).alias(f"p{i}")
                                                    for i, p in enumerate(rows)]).collect():
        assert [h["matched_text"] for h in a[r["recording_id"]]] == [p["phrase"] for i, p in enumerate(rows) if r[f"p{i}"]]
    assert [h["matched_text"] for h in a["r1"]] == ["and the", "re-do", "the"]
    assert [h["matched_text"] for h in a["r3"]] == ["?!"]


def test_long_repetition_chains_do_not_exhaust_the_stack(spark):
    texts = ["ha " * 20000 + "x y y", "ab-" * 5000 + "c", "ok ok"]
    df = one_col(spark, texts, "t")
    got = [r["r"] for r in df.select(D.repetition_matches(F.col("t")).alias("r")).collect()]
    assert got == [[("ha " * 20000).strip(), "y y"], [("ab-" * 5000).strip("-")], ["ok ok"]]
