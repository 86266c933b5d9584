"""Word/character error-rate scoring of many models against a reference
(SURVEY W1-W14).

Layout: one *scored* frame keeps the sheet wide and adds, per row, an
``array<struct>`` with one entry per model (normalized hypothesis, edit
counts, unit counts, per-row rates).  Everything per segment (best model,
ties, wide per-model columns) is a row-local projection of that array; the
corpus rates are one grouped sum over ``inline(scores)`` whose map-side
partial aggregation leaves one row per model per task, so the only shuffle
carries ``tasks x models`` rows no matter how large the sheet is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.edit_distance import banded, char_edits, encode_words, vocabulary, wer_words, words
from ..functions.normalize import norm_scoring, norm_strip, null_to_text

# The model columns of the evaluation sheet, in sheet order.
MODEL_COLUMNS = ["Model H", "Model i", "Model k", "Model l", "Model m", "Model n"]
REFERENCE_COLUMN = "Human"
TIE_TOLERANCE = 1e-12


def wide_name(model: str, suffix: str) -> str:
    """"Model H" -> "model_h_wer"."""
    return model.strip().lower().replace(" ", "_") + "_" + suffix


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    """Plan-time schema check; raises with the sorted missing names."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def _normalizer(profile: str, null_policy: str):
    """``scoring`` (N4, the multi-model sheet) or ``strip_only`` (N5, the
    public evaluation split); both turn missing cells into text first."""
    if profile == "scoring":
        return lambda c: norm_scoring(c, null_policy)
    return lambda c: norm_strip(null_to_text(c, null_policy))


def _rate(num: Column, den: Column, on_empty_ref: str) -> Column:
    if on_empty_ref == "error":
        return F.when(den == 0, F.raise_error(F.lit("empty reference"))).otherwise(num / den)
    # "count" / "skip": a rate over zero reference units is undefined
    return F.when(den > 0, num / den)


def score_sheet(sheet: DataFrame, models: Sequence[str] = MODEL_COLUMNS,
                ref_col: str = REFERENCE_COLUMN, null_policy: str = "empty",
                on_empty_ref: str = "count", profile: str = "scoring") -> DataFrame:
    """Add ``ref_norm`` and ``scores`` (one struct per model, in sheet order).

    ``null_policy``: ``"empty"`` treats a missing cell as "" (default);
    ``"nan_literal"`` reproduces the token ``nan``.  ``on_empty_ref``:
    ``"count"`` keeps rows whose normalized reference is empty (their edits
    still add to corpus numerators), ``"skip"`` drops them, ``"error"`` fails.
    """
    require_columns(sheet, [ref_col, *models])
    norm = _normalizer(profile, null_policy)
    # the scoring profile leaves single spaces alone, which is all that splitting needs
    split = words if profile == "scoring" else wer_words
    df = sheet.withColumn("ref_norm", norm(F.col(f"`{ref_col}`")))
    if on_empty_ref == "skip":
        df = df.where(F.col("ref_norm") != "")
    # one projection normalizes every hypothesis once ...
    n = len(models)
    df = df.select("*", *[norm(F.col(f"`{m}`")).alias(f"_h{i}") for i, m in enumerate(models)])
    # ... a hypothesis equal to the reference has no edits and isn't split ...
    differs = [F.col(f"_h{i}") != F.col("ref_norm") for i in range(n)]
    df = df.select("*", split("ref_norm").alias("_rw"),
                   *[F.when(d, split(F.col(f"_h{i}"))).alias(f"_hw{i}") for i, d in enumerate(differs)])
    # ... what the other texts of a row need to be coded is found once ...
    every = F.concat(F.col("_rw"), *[F.coalesce(F.col(f"_hw{i}"), F.array().cast("array<string>")) for i in range(n)])
    df = df.select("*", F.when(F.greatest(*[d.cast("int") for d in differs], F.lit(0)) == 1, vocabulary(every)).alias("_voc"))
    # ... each text is coded once (one code point per word) ...
    df = df.select("*", F.when(F.col("_voc").isNotNull(), encode_words(F.col("_rw"), F.col("_voc"))).alias("_rc"),
                   *[F.when(F.col(f"_hw{i}").isNotNull(), encode_words(F.col(f"_hw{i}"), F.col("_voc"))).alias(f"_hc{i}") for i in range(n)])
    # ... and the next computes edit counts once per (reference, hypothesis)
    # pair (a separate projection: CollapseProject will not duplicate them)
    df = df.select("*", *[F.when(F.col(f"_hc{i}").isNull(), F.lit(0)).otherwise(banded(F.col("_rc"), F.col(f"_hc{i}"))).cast("long").alias(f"_we{i}")
                          for i in range(n)],
                   *[char_edits(F.col("ref_norm"), F.col(f"_h{i}")).alias(f"_ce{i}") for i in range(n)])
    nw, nc = F.size("_rw"), F.length("ref_norm")
    entries = []
    for i, m in enumerate(models):
        we, ce = F.col(f"_we{i}"), F.col(f"_ce{i}")
        entries.append(F.struct(
            F.lit(m).alias("model"), F.lit(i).alias("model_ord"), F.col(f"_h{i}").alias("hyp_norm"),
            we.alias("word_edits"), nw.alias("ref_words"), ce.alias("char_edits"), nc.alias("ref_chars"),
            _rate(we, nw, on_empty_ref).alias("wer"), _rate(ce, nc, on_empty_ref).alias("cer")))
    df = df.withColumn("scores", F.array(*entries))
    tmp = [f"_{p}{i}" for p in ("h", "hw", "hc", "we", "ce") for i in range(n)]
    return df.drop("_rw", "_voc", "_rc", *tmp)


def pair_scores(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long form: one row per (segment, model)."""
    return scored.select(*keys, F.inline_outer("scores")).select(
        *keys, "model", "model_ord", "word_edits", "ref_words", "char_edits", "ref_chars", "wer", "cer")


def corpus_metrics(scored: DataFrame) -> DataFrame:
    """Micro-averaged WER/CER per model: sum of edits over sum of reference
    units, never the mean of row rates (SURVEY W3)."""
    return (scored.select(F.inline_outer("scores"))
            .groupBy("model", "model_ord")
            .agg(F.sum("word_edits").alias("word_edits"), F.sum("ref_words").alias("ref_words"),
                 F.sum("char_edits").alias("char_edits"), F.sum("ref_chars").alias("ref_chars"),
                 F.count(F.lit(1)).alias("segments"))
            # a corpus without reference units has no rate (null), not an error
            .withColumn("wer", F.try_divide(F.col("word_edits").cast("double"), F.col("ref_words")))
            .withColumn("cer", F.try_divide(F.col("char_edits").cast("double"), F.col("ref_chars"))))


def rank_models(metrics: DataFrame) -> DataFrame:
    """``rank, model, wer, cer`` ordered by (wer, cer), ties in sheet order
    (SURVEY W5).  The input has one row per model, so the global window is
    bounded by the model count."""
    w = Window.orderBy("wer", "cer", "model_ord")
    return metrics.select(F.row_number().over(w).alias("rank"), "model", "wer", "cer", "segments")


def segment_analysis(scored: DataFrame, models: Sequence[str] = MODEL_COLUMNS,
                     keys: Sequence[str] = ("segment_idx", "segment_url_link"),
                     ref_col: str = REFERENCE_COLUMN) -> DataFrame:
    """Per-segment best model, tie set and wide per-model WERs.

    Best = minimum of (wer, cer, sheet position); the tie set uses WER alone
    within ``TIE_TOLERANCE``, sorted by name and joined with "|".
    """
    s = F.col("scores")
    # array_min over structs orders by field order: wer, cer, model_ord
    ranked = F.transform(s, lambda x: F.struct(
        F.coalesce(x["wer"], F.lit(float("inf"))).alias("w"),
        F.coalesce(x["cer"], F.lit(float("inf"))).alias("c"),
        x["model_ord"].alias("o"), x["model"].alias("m"),
        x["wer"].alias("wer"), x["cer"].alias("cer")))
    best = F.array_min(ranked)
    tied = F.array_sort(F.transform(
        F.filter(ranked, lambda x: (x["w"] == best["w"]) | (F.abs(x["w"] - best["w"]) < TIE_TOLERANCE)), lambda x: x["m"]))
    out = scored.select(
        *keys, F.col(ref_col).alias("human_text"),
        best["m"].alias("best_model"), best["wer"].alias("best_model_wer"),
        best["cer"].alias("best_model_cer"),
        F.array_join(tied, "|").alias("best_tie_models"),
        F.size(tied).alias("best_tie_count"),
        *[s[i]["wer"].alias(wide_name(m, "wer")) for i, m in enumerate(models)])
    return out


def win_counts(analysis: DataFrame, models: Sequence[str] = MODEL_COLUMNS) -> DataFrame:
    """Per model: segments won (sheet-order tie-break) and unique wins
    (``best_tie_count == 1``), zero-filled over all models (SURVEY W8).

    The zero fill is a union with the (bounded) model list followed by a
    grouped sum, not an outer join: a join key derived from the scores
    would let Catalyst infer an ``isnotnull`` filter and push it below the
    projections, recomputing every edit distance."""
    spark = analysis.sparkSession
    zeros = spark.createDataFrame([(m, i, 0, 0) for i, m in enumerate(models)],
                                  "model string, model_ord int, w int, u int")
    order = F.create_map(*[x for i, m in enumerate(models) for x in (F.lit(m), F.lit(i))])
    won = analysis.select(F.col("best_model").alias("model"), order[F.col("best_model")].alias("model_ord"),
                          F.lit(1).alias("w"), (F.col("best_tie_count") == 1).cast("int").alias("u"))
    return (zeros.unionByName(won).groupBy("model", "model_ord")
            .agg(F.sum("w").cast("long").alias("wins"), F.sum("u").cast("long").alias("unique_wins")))


def evaluation_summary(ranked: DataFrame) -> DataFrame:
    """One-row summary: input rows, best model and its rates.
    Aggregates the per-model ranking (one row per model) only."""
    b = F.min_by(F.struct("model", "wer", "cer"), "rank")
    return ranked.agg(F.max("segments").alias("input_rows"), b.alias("b")).select(
        "input_rows", F.col("b.model").alias("best_model"),
        F.col("b.wer").alias("best_model_wer"), F.col("b.cer").alias("best_model_cer"))
