"""Unique-word spelling classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import norm_word
from ..functions.orthography import orthography_reason, spelling_label, CORRECT, INCORRECT


def distinct_words(words: DataFrame, col: str = "word") -> DataFrame:
    """O1: drop nulls, normalize (N3), keep one row per normalized word.

    Equal normalized words always get equal labels and the normalized form
    is what is reported, so which raw spelling survives is immaterial; the
    distinct is a hash aggregate with map-side combine, so a word repeated
    in a third of all rows collapses to one row per task before the shuffle.
    """
    # raw spellings repeat far more than they vary: de-duplicate them first
    # (hash aggregate, map-side combine) so normalization runs once per
    # distinct raw word, then de-duplicate the normalized forms
    raw = words.where(F.col(col).isNotNull()).select(F.col(col).alias("_raw")).distinct()
    return raw.select(norm_word(F.col("_raw")).alias("word")).distinct()


def label_words(unique: DataFrame) -> DataFrame:
    """``word, spelling_label, reason`` (row-local)."""
    r = orthography_reason(F.col("word"))
    return unique.select("word", r.alias("reason")).select(
        "word", spelling_label(F.col("reason")).alias("spelling_label"), "reason")


def reason_counts(labeled: DataFrame) -> DataFrame:
    """Histogram of reasons."""
    return labeled.groupBy("reason", "spelling_label").agg(F.count(F.lit(1)).alias("words"))


def spelling_summary(labeled: DataFrame) -> DataFrame:
    """Totals (one row)."""
    return labeled.agg(
        F.count(F.lit(1)).alias("total_unique_words"),
        F.count_if(F.col("spelling_label") == CORRECT).alias("correct_spelling_words"),
        F.count_if(F.col("spelling_label") == INCORRECT).alias("incorrect_spelling_words"))
