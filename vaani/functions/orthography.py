"""Devanagari orthography rules as one CASE expression.

Rule order is significant and follows the source checker: empty word,
script check, cleanup, start/end signs, doubled signs, then the first
offending *position* among three sequence rules, then long runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .normalize import norm_word

# Fixed values (orthography sign sets):
VOWEL_SIGNS = "ािीुूृॄॅेैॉोौ"   # U+093E-0944, U+0945, U+0947-0949, U+094B, U+094C
NASAL_SIGNS = "ंँः"                  # U+0902, U+0901, U+0903
HALANT = "्"                              # U+094D
NUKTA = "़"                               # U+093C
# Characters allowed besides the Devanagari block, and removed
# before the structural checks: danda, double danda, apostrophe, right single
# quotation mark, hyphen.
EXTRA_ALLOWED = "।॥'’-"

DEV = r"\x{0900}-\x{097F}"
ALLOWED_CLASS = "[" + DEV + "।॥'’\\-]"
CLEANUP_CLASS = "[।॥'’\\-]"
MATRA_CLASS = "[" + VOWEL_SIGNS + NASAL_SIGNS + "]"
VOWEL_CLASS = "[" + VOWEL_SIGNS + "]"
START_BAD_CLASS = "[" + VOWEL_SIGNS + NASAL_SIGNS + HALANT + NUKTA + "]"
END_BAD_CLASS = "[" + HALANT + NUKTA + "]"
# the three sequence rules are told apart by the first character
SEQUENCE_RULES = HALANT + MATRA_CLASS + "|" + VOWEL_CLASS + VOWEL_CLASS + "|" + NUKTA + MATRA_CLASS

CORRECT = "correct spelling"
INCORRECT = "incorrect spelling"


def core_of(word: Column) -> Column:
    return F.regexp_replace(word, CLEANUP_CLASS, "")


def orthography_reason(word: Column) -> Column:
    """Reason code for an already word-normalized (N3) string."""
    core = core_of(word)
    seq = F.regexp_extract(core, SEQUENCE_RULES, 0)
    first = F.substring(seq, 1, 1)
    return (F.when(word == "", "empty")
            .when(~word.rlike("^" + ALLOWED_CLASS + r"+\z"), "contains_non_devanagari")
            .when(core == "", "empty_after_cleanup")
            .when(~core.rlike("^[" + DEV + r"]+\z"), "non_devanagari_chars")
            .when(core.rlike("^" + START_BAD_CLASS), "invalid_start")
            .when(core.rlike(END_BAD_CLASS + r"\z"), "invalid_end")
            .when(F.contains(core, F.lit(HALANT + HALANT)), "double_halant")
            .when(F.contains(core, F.lit(NUKTA + NUKTA)), "double_nukta")
            .when(first == HALANT, "matra_after_halant")
            .when(first == NUKTA, "matra_after_nukta")
            .when(seq != "", "consecutive_matras")
            .when(core.rlike(r"(.)\1{3,}"), "long_repetition_noise")
            .otherwise("valid_orthography"))


def spelling_label(reason: Column) -> Column:
    return F.when(reason == "valid_orthography", CORRECT).otherwise(INCORRECT)


def classify(raw_word: Column) -> tuple[Column, Column]:
    """(normalized word, reason) for a raw word."""
    w = norm_word(raw_word)
    return w, orthography_reason(w)
