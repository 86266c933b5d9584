"""Multi-model evaluation job: sheet -> scored -> outputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import scoring as S


@dataclass
class Evaluation:
    scored: DataFrame
    metrics: DataFrame
    ranking: DataFrame
    analysis: DataFrame
    wins: DataFrame
    summary: DataFrame


def evaluate_models(sheet: DataFrame, keys, models=S.MODEL_COLUMNS, ref_col=S.REFERENCE_COLUMN,
                    null_policy: str = "empty", on_empty_ref: str = "count") -> Evaluation:
    scored = S.score_sheet(sheet, models, ref_col, null_policy, on_empty_ref)
    metrics = S.corpus_metrics(scored)
    ranking = S.rank_models(metrics)
    analysis = S.segment_analysis(scored, models, keys, ref_col)
    wins = S.win_counts(analysis, models)
    return Evaluation(scored, metrics, ranking, analysis, wins, S.evaluation_summary(ranking))
