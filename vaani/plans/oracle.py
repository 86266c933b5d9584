"""DuckDB restatements of the registered queries (same output columns)."""

from __future__ import annotations

from .sqlparts import pairs_sql, sheet_sql

ORACLE: dict[str, str] = {}

_METRICS = (f"WITH pairs AS ({pairs_sql()}) SELECT model, model_ord, "
            "CAST(sum(word_edits) AS BIGINT) AS word_edits, CAST(sum(ref_words) AS BIGINT) AS ref_words, "
            "CAST(sum(char_edits) AS BIGINT) AS char_edits, CAST(sum(ref_chars) AS BIGINT) AS ref_chars, "
            "count(*) AS segments, sum(word_edits) / sum(ref_words) AS wer, "
            "sum(char_edits) / sum(ref_chars) AS cer FROM pairs GROUP BY model, model_ord")

ORACLE["q_model_rank"] = (
    f"WITH m AS ({_METRICS}) SELECT CAST(row_number() OVER (ORDER BY wer, cer, model_ord) AS INTEGER) AS rank, "
    "model, wer, cer FROM m")

ORACLE["q_model_metrics"] = (
    f"SELECT model, word_edits, ref_words, char_edits, ref_chars, segments, wer, cer FROM ({_METRICS})")

ORACLE["q_segment_scores"] = (
    f"WITH pairs AS ({pairs_sql()}) SELECT conv_id, turn, sent_idx, segment_url_link, model, "
    "CAST(word_edits AS BIGINT) AS word_edits, CAST(ref_words AS INTEGER) AS ref_words, "
    "CAST(char_edits AS INTEGER) AS char_edits, CAST(ref_chars AS INTEGER) AS ref_chars, "
    "CASE WHEN ref_words > 0 THEN word_edits / ref_words END AS wer, "
    "CASE WHEN ref_chars > 0 THEN char_edits / ref_chars END AS cer FROM pairs")

_SEG = (f"WITH pairs AS ({pairs_sql()}), s AS (SELECT *, "
        "CASE WHEN ref_words > 0 THEN word_edits / ref_words END AS wer, "
        "CASE WHEN ref_chars > 0 THEN char_edits / ref_chars END AS cer FROM pairs), "
        "b AS (SELECT conv_id, turn, sent_idx, segment_url_link, "
        "arg_min(model, (coalesce(wer, 'inf'::DOUBLE), coalesce(cer, 'inf'::DOUBLE), model_ord)) AS best_model, "
        "arg_min(wer, (coalesce(wer, 'inf'::DOUBLE), coalesce(cer, 'inf'::DOUBLE), model_ord)) AS best_model_wer, "
        "arg_min(cer, (coalesce(wer, 'inf'::DOUBLE), coalesce(cer, 'inf'::DOUBLE), model_ord)) AS best_model_cer, "
        "min(coalesce(wer, 'inf'::DOUBLE)) AS min_wer, "
        + ", ".join(f"max(CASE WHEN model_ord = {i} THEN wer END) AS {c}" for i, c in enumerate(
            ["model_h_wer", "model_i_wer", "model_k_wer", "model_l_wer", "model_m_wer", "model_n_wer"]))
        + " FROM s GROUP BY ALL), "
        "t AS (SELECT s.segment_url_link, list_sort(list(s.model)) AS tied FROM s JOIN b USING (segment_url_link) "
        "WHERE coalesce(s.wer, 'inf'::DOUBLE) = b.min_wer OR abs(coalesce(s.wer, 'inf'::DOUBLE) - b.min_wer) < 1e-12 GROUP BY s.segment_url_link), "
        "h AS (SELECT DISTINCT segment_url_link, \"Human\" AS human_text FROM (" )
ORACLE["q_best_model"] = (
    _SEG + sheet_sql() + ")) SELECT b.conv_id, b.turn, b.sent_idx, b.segment_url_link, h.human_text, "
    "b.best_model, b.best_model_wer, b.best_model_cer, array_to_string(t.tied, '|') AS best_tie_models, "
    "CAST(len(t.tied) AS INTEGER) AS best_tie_count, model_h_wer, model_i_wer, model_k_wer, model_l_wer, "
    "model_m_wer, model_n_wer FROM b JOIN t USING (segment_url_link) JOIN h USING (segment_url_link)")

ORACLE["q_win_counts"] = (
    f"WITH seg AS ({ORACLE['q_best_model']}), models(model) AS (VALUES ('Model H'), ('Model i'), ('Model k'), "
    "('Model l'), ('Model m'), ('Model n')) SELECT models.model, count(seg.best_model) AS wins, "
    "count(CASE WHEN seg.best_tie_count = 1 THEN 1 END) AS unique_wins FROM models "
    "LEFT JOIN seg ON seg.best_model = models.model GROUP BY models.model")

ORACLE["q_eval_summary"] = (
    f"WITH m AS ({_METRICS}), r AS (SELECT *, row_number() OVER (ORDER BY wer, cer, model_ord) AS rank FROM m) "
    "SELECT max(segments) AS input_rows, arg_min(model, rank) AS best_model, "
    "arg_min(wer, rank) AS best_model_wer, arg_min(cer, rank) AS best_model_cer FROM r")


# ---------------------------------------------------------------- normalization
from . import sqlparts as P  # noqa: E402

for _p, _f in (("asr_basic", P.norm_asr_basic), ("disfluency", P.norm_disfluency),
               ("word", P.norm_word), ("scoring", P.norm_scoring)):
    ORACLE[f"q_norm_{_p}"] = f"SELECT doc_id, {_f('text')} AS text_norm FROM documents"

# ---------------------------------------------------------------- spelling
_DISTINCT = f"SELECT DISTINCT {P.norm_word('word')} AS word FROM ({P.hindi_words_sql()}) WHERE word IS NOT NULL"
_LABELS = (f"SELECT word, CASE WHEN reason = 'valid_orthography' THEN 'correct spelling' "
           f"ELSE 'incorrect spelling' END AS spelling_label, reason FROM "
           f"(SELECT word, {P.orthography_reason_sql('word')} AS reason FROM ({_DISTINCT}))")
ORACLE["q_distinct_words"] = _DISTINCT
ORACLE["q_spelling_labels"] = _LABELS
ORACLE["q_reason_counts"] = f"SELECT reason, spelling_label, count(*) AS words FROM ({_LABELS}) GROUP BY ALL"
ORACLE["q_spelling_summary"] = (
    f"SELECT count(*) AS total_unique_words, "
    f"CAST(count_if(spelling_label = 'correct spelling') AS BIGINT) AS correct_spelling_words, "
    f"CAST(count_if(spelling_label = 'incorrect spelling') AS BIGINT) AS incorrect_spelling_words FROM ({_LABELS})")


# ---------------------------------------------------------------- recordings, urls, segments
from ..operators.urls import DISFLUENCY_URL_COLUMNS, PREPARE_URL_COLUMNS  # noqa: E402

ORACLE["q_language_filter"] = (
    f"SELECT recording_id, 'exact' AS filter FROM ({P.RECORDINGS}) WHERE language = 'hi' UNION ALL "
    f"SELECT recording_id, 'ignore_case' AS filter FROM ({P.RECORDINGS}) WHERE lower(language) = 'hi'")

ORACLE["q_folder_id"] = (
    f"SELECT recording_id, {P.folder_sql(['rec_url_gcp', 'transcription_url_gcp', 'metadata_url_gcp'])} "
    f"AS folder_id FROM ({P.RECORDINGS})")

_BUILT = (f"SELECT recording_id, folder_id, '{P.BASE}' || folder_id || '/' || recording_id || '_audio.wav' AS audio_url, "
          f"'{P.BASE}' || folder_id || '/' || recording_id || '_transcription.json' AS transcription_url, "
          f"'{P.BASE}' || folder_id || '/' || recording_id || '_metadata.json' AS metadata_url FROM "
          f"(SELECT *, {P.folder_sql(PREPARE_URL_COLUMNS)} AS folder_id FROM ({P.RECORDINGS})) "
          f"WHERE folder_id IS NOT NULL")
ORACLE["q_build_urls"] = _BUILT

# manifest = every canonical transcript URL; sheet candidates never point at
# a listed object except the built one, so the first listed candidate wins
_MANIFEST = f"SELECT '{P.BASE}u' || conv_id || '/' || {P.RID} || '_transcription.json' AS url FROM conversations"
ORACLE["q_resolve_candidates"] = (
    f"WITH r AS (SELECT *, {P.folder_sql(DISFLUENCY_URL_COLUMNS[:3])} AS folder_id FROM ({P.RECORDINGS})), "
    f"c AS (SELECT recording_id, folder_id, rec_url_gcp, 1 AS prio, nullif(trim(transcription_url_gcp), '') AS url FROM r "
    f"WHERE folder_id IS NOT NULL UNION ALL SELECT recording_id, folder_id, rec_url_gcp, 2 AS prio, "
    f"'{P.BASE}' || folder_id || '/' || recording_id || '_transcription.json' AS url FROM r WHERE folder_id IS NOT NULL), "
    f"h AS (SELECT c.* FROM c WHERE url IN ({_MANIFEST})) "
    f"SELECT recording_id, folder_id, arg_min(url, prio) AS transcription_url, "
    f"CASE WHEN contains(arg_min(url, prio), 'uploads') THEN '{P.BASE}' || folder_id || '/' || recording_id || '_audio.wav' "
    f"ELSE coalesce(nullif(trim(any_value(rec_url_gcp)), ''), '{P.BASE}' || folder_id || '/' || recording_id || '_audio.wav') END "
    f"AS audio_url FROM h GROUP BY recording_id, folder_id")

_PREP_REC = (f"SELECT r.*, b.audio_url, b.transcription_url, e.error FROM ({P.RECORDINGS}) r "
             f"JOIN ({_BUILT}) b USING (recording_id) JOIN ({P.recording_error_sql('prepare')}) e USING (recording_id) "
             f"WHERE r.language = 'hi'")
ORACLE["q_failures"] = (
    f"SELECT recording_id, 'Could not infer folder id for recording_id=' || recording_id AS error FROM "
    f"(SELECT *, {P.folder_sql(PREPARE_URL_COLUMNS)} AS folder_id FROM ({P.RECORDINGS})) "
    f"WHERE language = 'hi' AND folder_id IS NULL UNION ALL "
    f"SELECT recording_id, error FROM ({_PREP_REC}) WHERE error IS NOT NULL")

_SEGS = (f"SELECT printf('%s_%04d', s.recording_id, s.segment_idx) AS id, s.recording_id, r.user_id, r.language, "
         f"CAST(s.segment_idx AS INTEGER) AS segment_idx, {P.norm_asr_basic('s.text_v')} AS sentence, s.start_v AS start, "
         f"s.end_v AS \"end\", round(s.end_v - s.start_v, 3) AS duration_sec, "
         f"greatest(0, CAST(trunc(s.start_v * 16000) AS BIGINT)) AS start_sample, "
         f"CAST(trunc(s.end_v * 16000) AS BIGINT) AS end_sample, r.audio_url, r.transcription_url "
         f"FROM ({P.PIECES}) s JOIN ({_PREP_REC}) r USING (recording_id) WHERE r.error IS NULL "
         f"AND {P.norm_asr_basic('s.text_v')} <> '' AND s.end_v > s.start_v "
         f"AND s.end_v - s.start_v >= 0.4 AND s.end_v - s.start_v <= 30.0")
ORACLE["q_segments_valid"] = _SEGS

_SPLIT = (f"SELECT id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || id)) <= ceil(0.1 * count(*) OVER ()) "
          f"THEN 'validation' ELSE 'train' END AS split FROM ({_SEGS})")
ORACLE["q_exact_split"] = _SPLIT
ORACLE["q_split_counts"] = f"SELECT split, count(*) AS rows FROM ({_SPLIT}) GROUP BY split"

# ---------------------------------------------------------------- disfluency lexicon and rules
from ..plans.fixtures import DEVANAGARI_MAP, LATIN, LEXICON_WIDE  # noqa: E402


def _lexicon_sql() -> str:
    cells = [("Opener", 0, "w[1]"), ("Opener", 1, "array_to_string(w[1:2], ' ')"),
             ("Hedge", 2, "CASE WHEN length(w[3]) < 4 THEN w[3] END"), ("Joined", 3, "w[1] || '-' || w[2]"),
             ("Closer", 4, "w[-1]"), ("Blank", 5, "' '")]
    union = " UNION ALL ".join(f"SELECT '{t}' AS type, {i} AS col_idx, {e} AS raw, item_id FROM b" for t, i, e in cells)
    return (f"WITH b AS (SELECT item_id, string_split(text, ' ') AS w FROM benchmark), c AS ({union}), "
            f"f AS (SELECT type, col_idx, {P.norm_disfluency('raw')} AS phrase, item_id FROM c "
            f"WHERE raw IS NOT NULL AND {P.norm_disfluency('raw')} <> ''), "
            f"t AS (SELECT type, min(col_idx) AS first_idx, max(col_idx) AS last_idx FROM f GROUP BY type) "
            f"SELECT f.type, CAST(t.first_idx AS INTEGER) AS type_ord, f.phrase, CAST(min(f.item_id) AS INTEGER) "
            f"AS phrase_ord FROM f JOIN t ON f.type = t.type AND f.col_idx = t.last_idx "
            f"GROUP BY f.type, t.first_idx, f.phrase")


ORACLE["q_lexicon_long"] = _lexicon_sql()

_DOCS_T = P.with_tokens(f"SELECT doc_id, {P.norm_disfluency('text')} AS t FROM documents")


def _doc_rule(expr):
    return (f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS match_idx, m[i] AS matched_text FROM "
            f"(SELECT doc_id, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, {expr} AS m FROM ({_DOCS_T})))")


ORACLE["q_repetition"] = _doc_rule(P.repetition_list())
ORACLE["q_prolongation"] = _doc_rule(P.prolongation_list("t"))
ORACLE["q_false_start"] = _doc_rule(P.false_start_list())


def _py_norm_disfluency(s: str) -> str:
    """Normalized lexicon phrase, for writing the oracle's literal patterns."""
    import re as _re
    import unicodedata as _u
    t = _u.normalize("NFC", s).strip().lower().replace("\n", " ").replace("\r", " ")
    for d in "–—―‑":
        t = t.replace(d, "-")
    return _re.sub(r"\s+", " ", t)


def _lexicon_entries(devanagari: bool = False):
    """The job lexicon in hit order: a type keeps the position of its first
    non-empty column and the phrases of its last."""
    table = str.maketrans(LATIN, DEVANAGARI_MAP)
    order, content = [], {}
    for col, values in LEXICON_WIDE.items():
        seen = []
        for v in values:
            if v is not None and devanagari:
                v = v.lower().translate(table)
            p = _py_norm_disfluency(v) if v is not None else ""
            if p and p not in seen:
                seen.append(p)
        if seen:
            name = col.strip()
            if name not in content:
                order.append(name)
            content[name] = seen
    return [(name, p) for name in order for p in content[name]]


def _hit(t, text, rule):
    return f"{{'disfluency_type': {P.q(t)}, 'matched_text': {text}, 'match_rule': {P.q(rule)}}}"


def _hits_sql(t: str, devanagari: bool = False, mode: str = "parity") -> str:
    lex = ", ".join(f"CASE WHEN regexp_matches({t}, {P.q(P.phrase_regex_re2(p))}) THEN {_hit(ty, P.q(p), 'lexicon')} END"
                    for ty, p in _lexicon_entries(devanagari))
    fs = P.false_start_list() if mode == "parity" else P.strict_false_start_list()
    allh = (f"list_concat(list_filter([{lex}], lambda x: x IS NOT NULL), "
            f"list_transform({P.repetition_list()}, lambda m: {_hit('Repetition', 'm', 'regex_repetition')}), "
            f"list_transform({P.prolongation_list(t)}, lambda m: {_hit('Prolongation', 'm', 'regex_prolongation')}), "
            f"list_transform({fs}, lambda m: {_hit('False Start', 'm', 'regex_false_start')}))")
    return allh


_DIS_REC = (f"SELECT r.*, '{P.BASE}' || folder_id || '/' || recording_id || '_audio.wav' AS audio_url, "
            f"'{P.BASE}' || folder_id || '/' || recording_id || '_transcription.json' AS transcription_url, e.error "
            f"FROM (SELECT *, {P.folder_sql(DISFLUENCY_URL_COLUMNS[:3])} AS folder_id FROM ({P.RECORDINGS})) r "
            f"JOIN ({P.recording_error_sql('disfluency')}) e USING (recording_id) "
            f"WHERE lower(r.language) = 'hi' AND right(r.recording_id, 3) <> '7_1' AND r.folder_id IS NOT NULL")


def _hitrows_sql(devanagari: bool = False, mode: str = "parity") -> str:
    seg = (f"SELECT s.recording_id, s.segment_idx, coalesce(s.start_v, 0.0) AS start, s.end_v AS \"end\", "
           f"coalesce(s.text_v, '') AS raw_text, r.audio_url, r.transcription_url, r.user_id, r.language "
           f"FROM ({P.pieces_sql(devanagari)}) s JOIN ({_DIS_REC}) r USING (recording_id) WHERE r.error IS NULL")
    seg_t = P.with_tokens(f"SELECT *, {P.norm_disfluency('raw_text')} AS t FROM ({seg})")
    detected = (f"SELECT *, list_filter(h0, lambda x, i: list_position(h0, x) = i) AS hits FROM "
                f"(SELECT *, {_hits_sql('t', devanagari, mode)} AS h0 FROM ({seg_t}))")
    return (f"SELECT *, hits[i] AS h, CAST(i - 1 AS INTEGER) AS hit_idx FROM "
            f"(SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM ({detected}))")


def _occ_sql(devanagari: bool = False, mode: str = "parity") -> str:
    occ = "printf('%s_%04d_%02d', recording_id, segment_idx, hit_idx)"
    return (f"SELECT {occ} AS occurrence_id, recording_id, "
            f"CAST(segment_idx AS INTEGER) AS segment_idx, h.disfluency_type AS disfluency_type, "
            f"h.matched_text AS matched_text, h.match_rule AS match_rule, round(start, 3) AS segment_start_sec, "
            f"round(\"end\", 3) AS segment_end_sec, round(\"end\" - start, 3) AS clip_duration_sec, "
            f"'clips/' || recording_id || '/' || {occ} || '.wav' AS clip_path, "
            f"'clips/' || recording_id || '/' || {occ} || '.wav' AS clip_rel_path, "
            f"raw_text AS transcription_snippet, transcription_url, audio_url, user_id, language "
            f"FROM ({_hitrows_sql(devanagari, mode)}) WHERE \"end\" > start")


_HITROWS = _hitrows_sql()


def _rule_rows(rule):
    return (f"SELECT recording_id, segment_idx, hit_idx, h.disfluency_type AS disfluency_type, "
            f"h.matched_text AS matched_text FROM ({_HITROWS}) WHERE h.match_rule = {P.q(rule)}")


ORACLE["q_lexicon_hits"] = _rule_rows("lexicon")
_OCC = _occ_sql()
ORACLE["q_occurrences"] = _OCC
ORACLE["q_type_counts"] = f"SELECT disfluency_type, count(*) AS occurrences FROM ({_OCC}) GROUP BY ALL"
ORACLE["q_disfluency_failures"] = (
    f"SELECT recording_id, 'Missing raw audio: ' || recording_id || '.wav' AS error FROM ({P.RECORDINGS}) "
    f"WHERE lower(language) = 'hi' AND right(recording_id, 3) = '7_1' UNION ALL "
    f"SELECT recording_id, 'Unable to infer folder_id for recording_id=' || recording_id AS error FROM "
    f"(SELECT *, {P.folder_sql(DISFLUENCY_URL_COLUMNS[:3])} AS folder_id FROM ({P.RECORDINGS})) "
    f"WHERE lower(language) = 'hi' AND right(recording_id, 3) <> '7_1' AND folder_id IS NULL UNION ALL "
    f"SELECT recording_id, error FROM ({_DIS_REC}) WHERE error IS NOT NULL")

# ---------------------------------------------------------------- summaries, report, checkpoints
_CMP = (f"WITH pairs AS ({P.pairs_sql('strip_only', skip_empty=True)}), m AS (SELECT model, count(*) AS segments, "
        f"sum(word_edits) / sum(ref_words) AS wer, sum(char_edits) / sum(ref_chars) AS cer FROM pairs "
        f"WHERE model IN ('Model k', 'Model i') GROUP BY model), "
        f"x AS (SELECT *, (max(CASE WHEN model = 'Model k' THEN wer END) OVER () - "
        f"max(CASE WHEN model = 'Model i' THEN wer END) OVER ()) / max(CASE WHEN model = 'Model k' THEN wer END) OVER () "
        f"AS imp FROM m) "
        f"SELECT CASE WHEN model = 'Model k' THEN 'baseline' ELSE 'tuned' END AS system, model, "
        f"segments AS samples_evaluated, wer * 100.0 AS wer, cer * 100.0 AS cer, 1 - wer AS accuracy, "
        f"imp AS relative_improvement, printf('%.2f%%', imp * 100) AS improvement_pct FROM x")
ORACLE["q_system_compare"] = _CMP

ORACLE["q_best_checkpoint"] = (
    "SELECT event_type AS run, arg_min('checkpoint-' || event_id, (value, event_id)) AS best_checkpoint, "
    "min(value) AS best_wer, arg_max('checkpoint-' || event_id, event_id) AS latest_checkpoint, "
    "max(event_id) AS latest_step FROM events GROUP BY event_type")


def _rows(task, pairs):
    return " UNION ALL ".join(f"SELECT '{task}' AS task, '{m}' AS metric, CAST(({sql}) AS DOUBLE) AS value"
                              for m, sql in pairs)


_PREP_ROWS = _rows("prepare", [
    ("input_rows_hi", f"SELECT count(*) FROM ({P.RECORDINGS}) WHERE language = 'hi'"),
    ("prepared_rows", f"SELECT count(*) FROM ({_SEGS})"),
    ("train_rows", f"SELECT count(*) FROM ({_SPLIT}) WHERE split = 'train'"),
    ("validation_rows", f"SELECT count(*) FROM ({_SPLIT}) WHERE split = 'validation'"),
    ("failures", f"SELECT count(*) FROM ({ORACLE['q_failures']})")])
_DIS_ROWS = _rows("disfluency", [
    ("input_rows_hi", f"SELECT count(*) FROM ({P.RECORDINGS}) WHERE lower(language) = 'hi'"),
    ("detected_disfluency_rows", f"SELECT count(*) FROM ({_OCC})"),
    ("unique_recordings_with_hits", f"SELECT count(DISTINCT recording_id) FROM ({_OCC})"),
    ("failures", f"SELECT count(*) FROM ({ORACLE['q_disfluency_failures']})")])
ORACLE["q_prepare_summary"] = _PREP_ROWS
ORACLE["q_disfluency_summary"] = _DIS_ROWS
ORACLE["q_failure_examples"] = (f"SELECT * FROM ({ORACLE['q_disfluency_failures']}) "
                                f"ORDER BY recording_id, error LIMIT 20")
_SP = ORACLE["q_spelling_summary"]
_EV = ORACLE["q_eval_summary"]
ORACLE["q_summary_documents"] = (
    "WITH d AS (SELECT coalesce(source, 'none') AS source, coalesce(lang, 'none') AS lang, length(text) AS chars FROM documents), m AS ("
    "SELECT source, 'texts' AS metric, count(*) AS n FROM d GROUP BY source UNION ALL "
    "SELECT source, 'of.chars', CAST(sum(coalesce(chars, 0)) AS BIGINT) FROM d GROUP BY source UNION ALL "
    "SELECT source, 'of.by_lang.' || lang, count(*) FROM d GROUP BY source, lang) "
    "SELECT source, metric, CAST(n AS VARCHAR) AS value, CAST(n AS DOUBLE) AS number FROM m")

ORACLE["q_report_table"] = " UNION ALL ".join([
    _PREP_ROWS, _DIS_ROWS,
    _rows("spelling", [(c, f"SELECT {c} FROM ({_SP})") for c in
                       ("total_unique_words", "correct_spelling_words", "incorrect_spelling_words")]),
    _rows("evaluation", [(c, f"SELECT {c} FROM ({_EV})") for c in ("input_rows", "best_model_wer", "best_model_cer")]),
])

# benchmark bigram lexicon matched over documents: adjacent word runs joined
# by a whitespace-only gap, equi-joined with the lexicon
_BENCH_T = P.with_tokens(f"SELECT item_id, {P.norm_disfluency('text')} AS t FROM benchmark")
_BENCH_LEX = (f"SELECT DISTINCT tk[i] || ' ' || tk[i + 1] AS phrase FROM "
              f"(SELECT tk, unnest(range(1, len(tk))) AS i FROM ({_BENCH_T}))")
_DOC_BIGRAMS = (f"SELECT DISTINCT doc_id, tk[i] || ' ' || tk[i + 1] AS phrase FROM "
                f"(SELECT doc_id, tk, gp, unnest(range(1, len(tk))) AS i FROM ({_DOCS_T})) "
                f"WHERE regexp_full_match(gp[i + 1], {P.q(P.WS_RUN)})")
ORACLE["q_benchmark_phrases"] = (
    f"SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY phrase) - 1 AS INTEGER) AS hit_idx, phrase "
    f"FROM ({_DOC_BIGRAMS}) WHERE phrase IN ({_BENCH_LEX})")

ORACLE["q_phrase_positions"] = (
    f"SELECT doc_id, tk[i] || ' ' || tk[i + 1] AS phrase, CAST(i - 1 AS INTEGER) AS start FROM "
    f"(SELECT doc_id, tk, gp, unnest(range(1, len(tk))) AS i FROM ({_DOCS_T})) "
    f"WHERE regexp_full_match(gp[i + 1], {P.q(P.WS_RUN)}) AND tk[i] || ' ' || tk[i + 1] IN ({_BENCH_LEX})")

# strict_tokens mode over Devanagari-transliterated documents: whole word
# runs, so the chain restatement is exact for any script

_DEV_DOCS_T = P.with_tokens(
    f"SELECT doc_id, {P.norm_disfluency(f'translate(lower(text), {P.q(LATIN)}, {P.q(DEVANAGARI_MAP)})')} AS t "
    f"FROM documents")
_STRICT_FS = P.strict_false_start_list()


def _strict_rule(rule, expr):
    return (f"SELECT doc_id, '{rule}' AS rule, CAST(i - 1 AS INTEGER) AS match_idx, m[i] AS matched_text FROM "
            f"(SELECT doc_id, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, {expr} AS m FROM ({_DEV_DOCS_T})))")


ORACLE["q_strict_rules"] = " UNION ALL ".join([
    _strict_rule("repetition", P.repetition_list()),
    _strict_rule("prolongation", P.prolongation_list("t")),
    _strict_rule("false_start", _STRICT_FS)])

ORACLE["q_strict_occurrences"] = _occ_sql(devanagari=True, mode="strict_tokens")

_METRICS_DEV = (f"WITH pairs AS ({P.pairs_sql(devanagari=True)}) SELECT model, model_ord, "
                "sum(word_edits) / sum(ref_words) AS wer, sum(char_edits) / sum(ref_chars) AS cer "
                "FROM pairs GROUP BY model, model_ord")
ORACLE["q_model_rank_devanagari"] = (
    f"WITH m AS ({_METRICS_DEV}) SELECT CAST(row_number() OVER (ORDER BY wer, cer, model_ord) AS INTEGER) AS rank, "
    "model, wer, cer FROM m")

_DEV_TEXT = f"translate(lower(text), {P.q(LATIN)}, {P.q(DEVANAGARI_MAP)})"
ORACLE["q_norm_devanagari"] = (
    f"SELECT doc_id, {P.norm_asr_basic(_DEV_TEXT)} AS asr_basic, {P.norm_disfluency(_DEV_TEXT)} AS disfluency, "
    f"{P.norm_word(_DEV_TEXT)} AS word, {P.norm_scoring(_DEV_TEXT)} AS scoring FROM documents")

# focused views named in the survey
ORACLE["q_missing_audio"] = (
    f"SELECT recording_id, 'Missing raw audio: ' || recording_id || '.wav' AS error FROM ({P.RECORDINGS}) "
    f"WHERE lower(language) = 'hi' AND right(recording_id, 3) = '7_1'")
