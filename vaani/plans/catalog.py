"""The registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads whole driver tables (or what Spark derives from them) and
has, where SQL can express it, a restatement in :mod:`vaani.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import scoring as S
from ..sources.tables import table
from . import fixtures as X
from .evaluation import evaluate_models

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _evaluation(spark, sf_dir):
    sheet = X.model_sheet(_conv(spark, sf_dir))
    return evaluate_models(sheet, X.SHEET_KEYS)


# ---------------------------------------------------------------- scoring

@register
def q_model_rank(spark, sf_dir):
    """Models ranked by corpus WER then CER."""
    return _evaluation(spark, sf_dir).ranking.select("rank", "model", "wer", "cer")


@register
def q_model_metrics(spark, sf_dir):
    """Corpus edit and unit counts per model."""
    return _evaluation(spark, sf_dir).metrics.select(
        "model", "word_edits", "ref_words", "char_edits", "ref_chars", "segments", "wer", "cer")


@register
def q_segment_scores(spark, sf_dir):
    """Per (segment, model) edits and rates."""
    ev = _evaluation(spark, sf_dir)
    return S.pair_scores(ev.scored, X.SHEET_KEYS).drop("model_ord")


@register
def q_best_model(spark, sf_dir):
    """Per-segment best model, tie set, wide per-model WER."""
    return _evaluation(spark, sf_dir).analysis


@register
def q_win_counts(spark, sf_dir):
    """Wins and unique wins per model, zero-filled."""
    return _evaluation(spark, sf_dir).wins.select("model", "wins", "unique_wins")


@register
def q_eval_summary(spark, sf_dir):
    """Best model summary row."""
    return _evaluation(spark, sf_dir).summary


# ---------------------------------------------------------------- normalization

def _docs(spark, sf_dir):
    from ..operators.partitioning import spread
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _devanagari_docs(spark, sf_dir):
    """Every document transliterated letter by letter (a projection of its own: normalizing names its text several times)."""
    return _docs(spark, sf_dir).select("doc_id", F.translate(F.lower("text"), X.LATIN, X.DEVANAGARI_MAP).alias("text"))


def _norm_query(profile):
    from ..functions.normalize import normalize

    def q(spark, sf_dir):
        return _docs(spark, sf_dir).select("doc_id", normalize(F.col("text"), profile).alias("text_norm"))
    q.__name__ = f"q_norm_{profile}"
    q.__doc__ = f"N-profile {profile!r} over every document."
    return register(q)


for _p in ("asr_basic", "disfluency", "word", "scoring"):
    _norm_query(_p)


# ---------------------------------------------------------------- spelling

def _labels(spark, sf_dir):
    from ..operators import spelling as O
    words = X.hindi_words(_docs(spark, sf_dir))
    return O.label_words(O.distinct_words(words))


@register
def q_distinct_words(spark, sf_dir):
    """O1: unique normalized words."""
    from ..operators import spelling as O
    return O.distinct_words(X.hindi_words(_docs(spark, sf_dir)))


@register
def q_spelling_labels(spark, sf_dir):
    """Label and reason per unique word."""
    return _labels(spark, sf_dir)


@register
def q_reason_counts(spark, sf_dir):
    """Reason histogram."""
    from ..operators import spelling as O
    return O.reason_counts(_labels(spark, sf_dir))


@register
def q_spelling_summary(spark, sf_dir):
    """Totals."""
    from ..operators import spelling as O
    return O.spelling_summary(_labels(spark, sf_dir))


# ---------------------------------------------------------------- transcripts & segments

def _conv(spark, sf_dir):
    from ..operators.partitioning import spread
    return spread(table(spark, sf_dir, "conversations"))


def _prepared(spark, sf_dir, stage: bool = False):
    from .preparation import prepare_segments
    c = _conv(spark, sf_dir)
    return prepare_segments(X.recordings(c), X.transcripts(c), stage=stage)


def _extracted(spark, sf_dir, devanagari: bool = False, mode: str = "parity"):
    from ..operators import disfluency as D
    from .preparation import extract_disfluencies
    c = _conv(spark, sf_dir)
    lex = D.build_lexicon(D.wide_lexicon_to_long(X.lexicon_wide(spark, devanagari)))
    return extract_disfluencies(X.recordings(c), X.transcripts(c, devanagari), X.object_manifest(c),
                                X.audio_listing(c), lex, mode=mode)


@register
def q_language_filter(spark, sf_dir):
    """Exact and case-insensitive language filters side by side."""
    from .preparation import language_filter
    r = X.recordings(_conv(spark, sf_dir))
    exact = language_filter(r, "hi").select("recording_id", F.lit("exact").alias("filter"))
    ci = language_filter(r, "hi", ignore_case=True).select("recording_id", F.lit("ignore_case").alias("filter"))
    return exact.unionByName(ci)


@register
def q_folder_id(spark, sf_dir):
    """Folder id from the first URL column/pattern that matches."""
    from ..operators import urls as U
    r = X.recordings(_conv(spark, sf_dir))
    return r.select("recording_id", U.folder_id(r, U.DISFLUENCY_URL_COLUMNS).alias("folder_id"))


@register
def q_build_urls(spark, sf_dir):
    """Canonical URLs for recordings with a folder id."""
    from ..operators import urls as U
    r = X.recordings(_conv(spark, sf_dir))
    r = r.withColumn("folder_id", U.folder_id(r, U.PREPARE_URL_COLUMNS)).where(F.col("folder_id").isNotNull())
    b = U.built_urls(F.col("folder_id"), F.col("recording_id"))
    return r.select("recording_id", "folder_id", *[v.alias(k) for k, v in b.items()])


@register
def q_resolve_candidates(spark, sf_dir):
    """transcript/audio URL resolution against the object manifest."""
    from ..operators import urls as U
    c = _conv(spark, sf_dir)
    resolved, failures = U.resolve_candidates(X.recordings(c), X.object_manifest(c))
    return resolved


@register
def q_segments_valid(spark, sf_dir):
    """Prepared training segments."""
    return _prepared(spark, sf_dir).segments.select(
        "id", "recording_id", "user_id", "language", "segment_idx", "sentence", "start", "end",
        "duration_sec", "start_sample", "end_sample", "audio_url", "transcription_url")


@register
def q_failures(spark, sf_dir):
    """Recordings rejected by preparation, with the reason."""
    return _prepared(spark, sf_dir).failures


@register
def q_exact_split(spark, sf_dir):
    """Exact seeded split of the prepared segments."""
    from ..operators.split import exact_split
    return exact_split(_prepared(spark, sf_dir).segments.select("id"), "id", 0.1, 42)


@register
def q_split_counts(spark, sf_dir):
    """R2."""
    from ..operators.split import exact_split, split_counts
    return split_counts(exact_split(_prepared(spark, sf_dir).segments.select("id"), "id", 0.1, 42))


# ---------------------------------------------------------------- disfluency

@register
def q_lexicon_long(spark, sf_dir):
    """A wide lexicon sheet (derived from the benchmark table) made
    long, normalized and de-duplicated."""
    from ..operators import disfluency as D
    return D.build_lexicon(D.wide_lexicon_to_long(X.lexicon_sheet(table(spark, sf_dir, "benchmark"))))


def _doc_matches(spark, sf_dir, pattern, group):
    """Every non-overlapping match of one detection rule over every
    normalized (N2) document, with its ordinal."""
    from ..functions.normalize import norm_disfluency
    from ..operators import disfluency as D
    d = _docs(spark, sf_dir).select("doc_id", norm_disfluency(F.col("text")).alias("t"))
    found = (D.repetition_matches(F.col("t")) if pattern == D.REPETITION
             else F.regexp_extract_all("t", F.lit(pattern), group))
    m = d.select("doc_id", F.posexplode_outer(found).alias("match_idx", "matched_text"))
    return m.where(F.col("match_idx").isNotNull())


@register
def q_repetition(spark, sf_dir):
    """Repetition matches over whole documents."""
    from ..operators import disfluency as D
    return _doc_matches(spark, sf_dir, D.REPETITION, 0)


@register
def q_prolongation(spark, sf_dir):
    """Prolongation matches over whole documents."""
    from ..operators import disfluency as D
    return _doc_matches(spark, sf_dir, D.PROLONGATION, 0)


@register
def q_false_start(spark, sf_dir):
    """False-start matches over whole documents."""
    from ..operators import disfluency as D
    return _doc_matches(spark, sf_dir, D.FALSE_START, 1)


def _rule_hits(spark, sf_dir, rule):
    """Hits of one rule per segment, in hit order (after de-duplication)."""
    segs = _extracted(spark, sf_dir).detected
    hits = segs.select("recording_id", "segment_idx", F.posexplode_outer("hits").alias("hit_idx", "h"))
    hits = hits.where(F.col("hit_idx").isNotNull())
    return hits.where(F.col("h.match_rule") == rule).select(
        "recording_id", "segment_idx", "hit_idx", F.col("h.disfluency_type").alias("disfluency_type"),
        F.col("h.matched_text").alias("matched_text"))


@register
def q_lexicon_hits(spark, sf_dir):
    """Lexicon phrase hits."""
    return _rule_hits(spark, sf_dir, "lexicon")


@register
def q_occurrences(spark, sf_dir):
    """One row per occurrence, 16 columns."""
    return _extracted(spark, sf_dir).occurrences


@register
def q_type_counts(spark, sf_dir):
    """A3: occurrences per type."""
    from ..operators import disfluency as D
    return D.type_counts(_extracted(spark, sf_dir).occurrences)


@register
def q_disfluency_failures(spark, sf_dir):
    """Recordings the disfluency job could not process."""
    return _extracted(spark, sf_dir).failures


# ---------------------------------------------------------------- summaries, report, checkpoints

@register
def q_system_compare(spark, sf_dir):
    """Baseline ("Model k") vs tuned ("Model i") on the public-split
    path: strip-only normalization, empty references skipped, x100 rates."""
    from ..operators.summary import system_comparison
    sheet = X.model_sheet(_conv(spark, sf_dir))
    scored = S.score_sheet(sheet, on_empty_ref="skip", profile="strip_only")
    return system_comparison(S.corpus_metrics(scored), "Model k", "Model i")


@register
def q_best_checkpoint(spark, sf_dir):
    """Best (min WER) and latest checkpoint per run of a metrics log
    (events: run = event type, step = event id, WER = value)."""
    from ..operators.summary import best_checkpoints
    log = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run"), F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string")).alias("checkpoint"),
        F.col("event_id").alias("step"), F.col("value").alias("wer"))
    return best_checkpoints(log)


def _prepare_rows(spark, sf_dir):
    from ..operators.split import exact_split
    from ..operators.summary import count_of, metric_rows, unpivoted
    p = _prepared(spark, sf_dir, stage=True)
    # the staged split gives three counts in one pass
    split = exact_split(p.segments.select("id"), "id", 0.1, 42).agg(
        F.count(F.lit(1)).alias("prepared_rows"), F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "validation").alias("validation_rows"))
    return unpivoted("prepare", split).unionByName(metric_rows("prepare", [
        ("input_rows_hi", count_of(p.input_rows)), ("failures", count_of(p.failures))]))


def _disfluency_rows(spark, sf_dir):
    from ..operators.summary import count_of, metric_rows, unpivoted
    e = _extracted(spark, sf_dir)
    found = e.occurrences.agg(F.count(F.lit(1)).alias("detected_disfluency_rows"),
                              F.count_distinct("recording_id").alias("unique_recordings_with_hits"))
    return unpivoted("disfluency", found).unionByName(metric_rows("disfluency", [
        ("input_rows_hi", count_of(e.input_rows)), ("failures", count_of(e.failures))]))


@register
def q_prepare_summary(spark, sf_dir):
    """A1, R2: preparation run summary as metric rows."""
    return _prepare_rows(spark, sf_dir)


@register
def q_disfluency_summary(spark, sf_dir):
    """A1, A2: disfluency run summary as metric rows."""
    return _disfluency_rows(spark, sf_dir)


@register
def q_failure_examples(spark, sf_dir):
    """A4: first 20 disfluency failures by recording id."""
    from ..operators.summary import failure_examples
    return failure_examples(_extracted(spark, sf_dir).failures, 20)


@register
def q_report_table(spark, sf_dir):
    """A5: every task's headline numbers side by side."""
    from ..operators import spelling as O
    from ..operators.summary import unpivoted
    sp = O.spelling_summary(_labels(spark, sf_dir))
    ev = _evaluation(spark, sf_dir).summary
    spelling = unpivoted("spelling", sp)
    evaluation = unpivoted("evaluation", ev.select("input_rows", "best_model_wer", "best_model_cer"))
    return (_prepare_rows(spark, sf_dir).unionByName(_disfluency_rows(spark, sf_dir))
            .unionByName(spelling).unionByName(evaluation))


@register
def q_summary_documents(spark, sf_dir):
    """A5: one nested summary document per source of ``documents`` (texts, characters, texts by language), taken apart
    into metrics without a schema, as the report job does with the other jobs' summaries."""
    from ..operators.summary import document_metrics
    none = lambda c: F.coalesce(F.col(c), F.lit("none")).alias(c)        # noqa: E731
    parts = table(spark, sf_dir, "documents").groupBy(none("source"), none("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.length("text"), F.lit(0)).cast("long")).alias("chars"))
    docs = parts.groupBy("source").agg(F.to_json(F.struct(
        F.sum("n").alias("texts"), F.struct(F.sum("chars").alias("chars"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by_lang")).alias("of")
    )).alias("doc"))
    return document_metrics(docs.select("source", F.parse_json("doc").alias("doc")), ["source"])


# ---------------------------------------------------------------- audio (rows-only checks)

def _benchmark_postings(spark, sf_dir, positions):
    from ..functions.normalize import norm_disfluency
    from ..operators import disfluency as D
    lex = X.benchmark_bigram_lexicon(table(spark, sf_dir, "benchmark"))
    docs = _docs(spark, sf_dir).select("doc_id", norm_disfluency(F.col("text")).alias("text_norm"))
    return (D.phrase_postings(docs, lex, ["doc_id"], positions=True) if positions else D.lexicon_hits(docs, lex, ["doc_id"]))


@register
def q_benchmark_phrases(spark, sf_dir):
    """D3: a lexicon of every benchmark word bigram (thousands of phrases)
    matched over whole documents by their n-gram postings."""
    hits = _benchmark_postings(spark, sf_dir, False).select("doc_id", F.posexplode_outer("_lex").alias("hit_idx", "h"))
    return hits.select("doc_id", "hit_idx", F.col("h.phrase").alias("phrase"))


@register
def q_phrase_positions(spark, sf_dir):
    """D3: every place of every benchmark word bigram in whole documents:
    ``start`` words come before it."""
    return _benchmark_postings(spark, sf_dir, True).select("doc_id", "phrase", "start")


@register
def q_devanagari_rules(spark, sf_dir):
    """D4-D6 in parity mode over every document transliterated letter by
    letter into Devanagari (vowel signs, halant, nukta, nasal signs), where
    Python's \\w and \\b differ from a naive reading.  RE2 cannot restate
    these patterns; the test suite checks this query against Python's own
    regular expressions on the smallest tables."""
    from ..functions.normalize import norm_disfluency
    from ..operators import disfluency as D
    d = _devanagari_docs(spark, sf_dir).select("doc_id", norm_disfluency(F.col("text")).alias("t"))
    rules = F.array(
        F.struct(F.lit("repetition").alias("rule"), D.repetition_matches(F.col("t")).alias("m")),
        F.struct(F.lit("prolongation").alias("rule"), F.regexp_extract_all("t", F.lit(D.PROLONGATION), 0).alias("m")),
        F.struct(F.lit("false_start").alias("rule"), D.false_start_matches(F.col("t")).alias("m")))
    r = d.select("doc_id", F.inline_outer(rules))
    m = r.select("doc_id", "rule", F.posexplode_outer("m").alias("match_idx", "matched_text"))
    return m.where(F.col("match_idx").isNotNull())


@register
def q_strict_rules(spark, sf_dir):
    """D4-D6 in ``strict_tokens`` mode (whole tokens, as the rules'
    comments describe) over every document transliterated into
    Devanagari."""
    from ..functions.normalize import norm_disfluency
    from ..operators import disfluency as D
    d = _devanagari_docs(spark, sf_dir).select("doc_id", norm_disfluency(F.col("text")).alias("t"))
    rules = F.array(
        F.struct(F.lit("repetition").alias("rule"), D.repetition_matches(F.col("t"), "strict_tokens").alias("m")),
        F.struct(F.lit("prolongation").alias("rule"), F.regexp_extract_all("t", F.lit(D.PROLONGATION), 0).alias("m")),
        F.struct(F.lit("false_start").alias("rule"), D.false_start_matches(F.col("t"), "strict_tokens").alias("m")))
    m = d.select("doc_id", F.inline_outer(rules)).select(
        "doc_id", "rule", F.posexplode_outer("m").alias("match_idx", "matched_text"))
    return m.where(F.col("match_idx").isNotNull())


@register
def q_strict_occurrences(spark, sf_dir):
    """D1-D9 end to end in ``strict_tokens`` mode on Devanagari transcripts
    (conversation turns transliterated letter by letter) with the job
    lexicon transliterated the same way."""
    return _extracted(spark, sf_dir, devanagari=True, mode="strict_tokens").occurrences


@register
def q_model_rank_devanagari(spark, sf_dir):
    """W1-W5 on the evaluation sheet transliterated into Devanagari: NFC
    through ICU (nukta compositions), code-point distances on multi-byte
    text."""
    sheet = X.model_sheet(_conv(spark, sf_dir), devanagari=True)
    return evaluate_models(sheet, X.SHEET_KEYS).ranking.select("rank", "model", "wer", "cer")


@register
def q_norm_devanagari(spark, sf_dir):
    """N1-N4 on every document transliterated into Devanagari (NFC through
    ICU where nukta compositions occur)."""
    from ..functions.normalize import normalize
    return _devanagari_docs(spark, sf_dir).select(
        "doc_id", *[normalize(F.col("text"), p).alias(p) for p in ("asr_basic", "disfluency", "word", "scoring")])


# ---------------------------------------------------------------- focused views named in the survey

@register
def q_missing_audio(spark, sf_dir):
    """Hindi recordings whose raw audio object is absent (anti-join)."""
    from ..operators import urls as U
    from .preparation import language_filter
    c = _conv(spark, sf_dir)
    return U.missing_audio(language_filter(X.recordings(c), "hi", ignore_case=True), X.audio_listing(c))
