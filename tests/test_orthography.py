"""Reason codes (FIXTURES.md spelling table)."""

import pytest
from pyspark.sql import functions as F

from frames import one_col
from vaani.functions.orthography import classify
from vaani.operators.spelling import distinct_words, label_words

KA, HALANT, NUKTA, AA, I, SSA, LA = "क", "्", "़", "ा", "ि", "ष", "ल"
CASES = [
    ("घर", "valid_orthography"),
    ("hello", "contains_non_devanagari"),
    ("घर2", "contains_non_devanagari"),
    ("   ", "empty"),
    ("-", "empty_after_cleanup"),
    ("ाब", "invalid_start"),
    ("तेज़", "invalid_end"),
    ("क्", "invalid_end"),
    (KA + HALANT + HALANT + SSA, "double_halant"),
    (KA + NUKTA + NUKTA + LA, "double_nukta"),
    (KA + HALANT + AA, "matra_after_halant"),
    (KA + AA + I, "consecutive_matras"),
    ("बड़ा", "matra_after_nukta"),
    ("हहहह", "long_repetition_noise"),
]


@pytest.mark.parametrize("word,reason", CASES)
def test_reason(spark, word, reason):
    w, r = classify(F.col("s"))
    got = one_col(spark, [word]).select(r.alias("r")).first()["r"]
    assert got == reason


def test_first_position_wins(spark):
    # consecutive matras at position 2 precede halant+matra at position 4
    word = KA + AA + I + KA + HALANT + AA
    w, r = classify(F.col("s"))
    assert one_col(spark, [word]).select(r.alias("r")).first()["r"] == "consecutive_matras"


def test_distinct_and_labels(spark):
    df = one_col(spark, ["घर", " घर ", None, "hello", "घ र"], "word")
    out = {r["word"]: r["spelling_label"] for r in label_words(distinct_words(df)).collect()}
    assert out == {"घर": "correct spelling", "hello": "incorrect spelling"}


def test_signs_of_the_edge_do_not_change_the_label(spark):
    """Dandas, hyphens, quotes and spaces around a word are cleaned away."""
    w, r = classify(F.col("s"))
    words = [c for c, reason in CASES if c.strip() and reason not in ("contains_non_devanagari", "empty_after_cleanup")]
    rows = one_col(spark, [f" {x}\u0964" for x in words] + [f"-{x}'" for x in words]).select("s", r.alias("r")).collect()
    want = dict(CASES)
    assert all(x["r"] == want[x["s"].strip(" \u0964-'")] for x in rows) and len(rows) == 2 * len(words)


@pytest.mark.parametrize("fault,reason", [(HALANT + AA, "matra_after_halant"), (AA + I, "consecutive_matras"), (NUKTA + AA, "matra_after_nukta")])
@pytest.mark.parametrize("before", ["", LA, LA + AA + SSA])
@pytest.mark.parametrize("after", ["", LA, SSA + I])
def test_a_fault_is_found_wherever_it_stands(spark, fault, reason, before, after):
    w, r = classify(F.col("s"))
    assert one_col(spark, [before + SSA + fault + after]).select(r.alias("r")).first()["r"] == reason


def test_random_consonants_are_valid(spark):
    import random
    rng = random.Random(11)
    letters = "\u0915\u0916\u0917\u0928\u0930"
    words = ["".join(rng.sample(letters, rng.randint(1, 5))) for _ in range(200)]
    w, r = classify(F.col("s"))
    assert {x["r"] for x in one_col(spark, words).select(r.alias("r")).collect()} == {"valid_orthography"}
