"""Error-rate scoring (FIXTURES.md scoring cases) and the JVM word distance."""

import functools
import random

from pyspark.sql import functions as F

from vaani.functions.edit_distance import word_edits, words
from vaani.operators import scoring as S

MODELS = S.MODEL_COLUMNS


def sheet(spark, rows):
    cols = ["segment_url_link", "Human", *MODELS]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_identity_and_known_pair(spark):
    ref, hyp = "the cat sat on mat", "the cat sit on the mat"
    sh = sheet(spark, [("u1", ref, ref, hyp, ref, ref, ref, ref)])
    scored = S.score_sheet(sh)
    pairs = {r["model"]: r for r in S.pair_scores(scored, ["segment_url_link"]).collect()}
    assert pairs["Model H"]["word_edits"] == 0 and pairs["Model H"]["wer"] == 0.0
    assert pairs["Model i"]["word_edits"] == 2 and pairs["Model i"]["ref_words"] == 5
    assert abs(pairs["Model i"]["wer"] - 0.4) < 1e-12


def test_corpus_rate_is_micro_average(spark):
    sh = sheet(spark, [("u1", "a b", "a x", "a b", "a b", "a b", "a b", "a b"),
                       ("u2", "a b c d e f g h", "a b c d e f g h", "a b c d e f g h", "a b c d e f g h",
                        "a b c d e f g h", "a b c d e f g h", "a b c d e f g h")])
    m = {r["model"]: r for r in S.corpus_metrics(S.score_sheet(sh)).collect()}
    assert abs(m["Model H"]["wer"] - 1 / 10) < 1e-12        # not mean(0.5, 0) = 0.25


def test_all_tied(spark):
    sh = sheet(spark, [("u1", "same text", *(["same text"] * 6))])
    a = S.segment_analysis(S.score_sheet(sh), keys=["segment_url_link"]).first()
    assert a["best_tie_models"] == "Model H|Model i|Model k|Model l|Model m|Model n"
    assert a["best_tie_count"] == 6 and a["best_model"] == "Model H"


def test_ranking_and_wins(spark):
    sh = sheet(spark, [("u1", "a b c", "a b c", "a b", "x y z", "a b c", "a", "a b c")])
    ev_scored = S.score_sheet(sh)
    rank = [r["model"] for r in S.rank_models(S.corpus_metrics(ev_scored)).orderBy("rank").collect()]
    assert rank[:3] == ["Model H", "Model l", "Model n"]
    wins = {r["model"]: (r["wins"], r["unique_wins"]) for r in
            S.win_counts(S.segment_analysis(ev_scored, keys=["segment_url_link"])).collect()}
    assert wins["Model H"] == (1, 0) and wins["Model k"] == (0, 0)


@functools.lru_cache(None)
def _distance(a, b):
    """Edit distance by its definition on the first words."""
    if not a or not b:
        return len(a) + len(b)
    if a[0] == b[0]:
        return _distance(a[1:], b[1:])
    return 1 + min(_distance(a[1:], b), _distance(a, b[1:]), _distance(a[1:], b[1:]))


def test_word_distance_matches_dp(spark):
    rng = random.Random(7)
    vocab = ["a", "b", "c", "dd", "é", "मैं", "x"]
    pairs = [(" ".join(rng.choices(vocab, k=rng.randint(0, 12))), " ".join(rng.choices(vocab, k=rng.randint(0, 12))))
             for _ in range(300)]
    df = spark.createDataFrame(pairs, "r string, h string")
    got = df.select("r", "h", word_edits(words("r"), words("h")).alias("d")).collect()
    for row in got:
        assert row["d"] == _distance(tuple(row["r"].split()), tuple(row["h"].split()))


def test_empty_reference_ties(spark):
    """Without reference units no model has a rate, so all tie."""
    r = S.segment_analysis(S.score_sheet(sheet(spark, [("u1", "...", "a", "", "b", "c", "d", "e")])), keys=["segment_url_link"]).first()
    assert r["best_tie_count"] == 6 and r["best_model"] == "Model H" and r["best_model_wer"] is None
    assert S.score_sheet(sheet(spark, [("u1", "...", "a", "", "b", "c", "d", "e")]), on_empty_ref="skip").count() == 0
