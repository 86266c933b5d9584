"""SQL text shared by the DuckDB oracle queries.

The oracle restates each Spark query in plain SQL so an independent engine
can check it.  RE2 (DuckDB's regex library) has no look-arounds or
back-references, so the restatements use list functions instead where the
Spark side uses those features.
"""

from __future__ import annotations

from ..functions.pyregex import PY_WS_CLASS
from ..functions.normalize import DASHES_DISFLUENCY, DASHES_SCORING, DASHES_WORD, SCORING_PUNCT_CLASS
from ..operators.scoring import MODEL_COLUMNS


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS = PY_WS_CLASS
WS_RUN = WS + "+"
WS_EDGES = "^" + WS_RUN + "|" + WS_RUN + "$"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(WS_EDGES)}, '', 'g')"


def collapse(x: str, repl: str = " ") -> str:
    return f"regexp_replace({x}, {q(WS_RUN)}, {q(repl)}, 'g')"


def dashes(x: str, chars: str) -> str:
    return f"translate({x}, {q(chars)}, {q('-' * len(chars))})"


def norm_scoring(x: str) -> str:
    t = f"nfc_normalize(coalesce({x}, ''))"
    t = f"replace({t}, chr(10), ' ')"
    t = dashes(t, DASHES_SCORING)
    t = f"regexp_replace({t}, {q(SCORING_PUNCT_CLASS)}, ' ', 'g')"
    return f"lower({strip(collapse(t))})"


def norm_asr_basic(x: str) -> str:
    t = f"replace({x}, chr(10), ' ')"
    return collapse(strip(t))


def norm_disfluency(x: str) -> str:
    t = f"lower({strip(f'nfc_normalize({x})')})"
    t = f"regexp_replace({t}, '[\\n\\r]', ' ', 'g')"
    return collapse(dashes(t, DASHES_DISFLUENCY))


def norm_word(x: str) -> str:
    t = strip(f"nfc_normalize({x})")
    t = dashes(t, DASHES_WORD)
    return f"regexp_replace({t}, {q(WS)}, '', 'g')"


def words(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE string_split({x}, ' ') END)"


def chars(x: str) -> str:
    return f"(CASE WHEN {x} = '' THEN []::VARCHAR[] ELSE string_split({x}, '') END)"


def list_edit_distance(a: str, b: str) -> str:
    """Exact edit distance of two lists by a row-at-a-time dynamic programme."""
    return (f"list_reduce({a}, lambda prev, x: list_reduce(range(1, len({b}) + 1), "
            f"lambda cur, j: list_append(cur, least(prev[j + 1] + 1, cur[len(cur)] + 1, "
            f"prev[j] + (x IS DISTINCT FROM {b}[j])::INT)), [prev[1] + 1]), "
            f"range(0, len({b}) + 1))[-1]")


SENTENCES = r"""
  SELECT conv_id, turn, sent_idx, sentence FROM (
    SELECT conv_id, turn, unnest(p) AS sentence, CAST(unnest(range(0, len(p))) AS INTEGER) AS sent_idx
    FROM (SELECT conv_id, turn, regexp_split_to_array(text, '[.\n]') AS p FROM conversations)
  )
"""


def sheet_sql(devanagari: bool = False) -> str:
    hyps = [
        "sentence",
        "array_to_string(list_filter(string_split(sentence, ' '), lambda x, i: i % 5 <> 0), ' ')",
        "replace(sentence, 'e', 'a')",
        "string_split(sentence, ' ')[1] || ' ' || sentence",
        "array_to_string(list_slice(string_split(sentence, ' '), 1, len(string_split(sentence, ' ')) - 1), ' ')",
        "translate(sentence, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')",
    ]
    if devanagari:
        from .fixtures import DEVANAGARI_MAP, LATIN
        dev = lambda x: f"translate(lower({x}), {q(LATIN)}, {q(DEVANAGARI_MAP)})"
    else:
        dev = lambda x: x
    cols = ", ".join(f'{dev(h)} AS "{m}"' for h, m in zip(hyps, MODEL_COLUMNS))
    return (f"SELECT conv_id, turn, sent_idx, 'conv://' || conv_id || '/' || turn || '/' || sent_idx "
            f"AS segment_url_link, {dev('sentence')} AS \"Human\", {cols} FROM ({SENTENCES})")


def norm_strip_only(x: str) -> str:
    return strip(f"coalesce({x}, '')")


def wer_words(x: str) -> str:
    return words(strip(f"regexp_replace({x}, {q(WS + '{2,}')}, ' ', 'g')"))


def pairs_sql(profile: str = "scoring", skip_empty: bool = False, devanagari: bool = False) -> str:
    """One row per (segment, model) with normalized texts and edit counts.
    Word and character alphabets are columns, computed once per pair."""
    norm = norm_scoring if profile == "scoring" else norm_strip_only
    parts = []
    for i, m in enumerate(MODEL_COLUMNS):
        parts.append(f"SELECT conv_id, turn, sent_idx, segment_url_link, {q(m)} AS model, {i} AS model_ord, "
                     f"{norm('\"Human\"')} AS r, {norm(f'\"{m}\"')} AS h FROM sheet")
    union = " UNION ALL ".join(parts)
    if skip_empty:
        union = f"SELECT * FROM ({union}) WHERE r <> ''"
    lists = (f"SELECT *, {wer_words('r')} AS rw, {wer_words('h')} AS hw, {chars('r')} AS rc, {chars('h')} AS hc FROM p")
    alpha = "SELECT *, list_distinct(rw || hw) AS wa, list_distinct(rc || hc) AS ca FROM l"
    enc = lambda x, a: f"array_to_string(list_transform({x}, lambda w: chr(list_position({a}, w))), '')"
    wdist = (f"CASE WHEN len(wa) <= 127 THEN levenshtein({enc('rw', 'wa')}, {enc('hw', 'wa')}) "
             f"ELSE {list_edit_distance('rw', 'hw')} END")
    cdist = (f"CASE WHEN len(ca) <= 127 THEN levenshtein({enc('rc', 'ca')}, {enc('hc', 'ca')}) "
             f"ELSE {list_edit_distance('rc', 'hc')} END")
    return (f"WITH sheet AS ({sheet_sql(devanagari)}), p AS ({union}), l AS ({lists}), a AS ({alpha}) "
            f"SELECT conv_id, turn, sent_idx, segment_url_link, model, model_ord, r, h, "
            f"{wdist} AS word_edits, len(rw) AS ref_words, {cdist} AS char_edits, length(r) AS ref_chars FROM a")



def hindi_words_sql() -> str:
    from .fixtures import DEVANAGARI_MAP, LATIN
    return (f"SELECT doc_id, word_idx, translate(lower(token), {q(LATIN)}, {q(DEVANAGARI_MAP)}) AS word FROM ("
            f"SELECT doc_id, unnest(p) AS token, unnest(range(0, len(p))) AS word_idx FROM ("
            f"SELECT doc_id, regexp_split_to_array(text, {q(WS_RUN)}) AS p FROM documents)) WHERE token <> ''")


def orthography_reason_sql(w: str) -> str:
    from ..functions import orthography as O
    core = f"regexp_replace({w}, {q(O.CLEANUP_CLASS)}, '', 'g')"
    seq = f"regexp_extract({core}, {q(O.SEQUENCE_RULES)}, 0)"
    first = f"substring({seq}, 1, 1)"
    # a run of four equal characters, checked position by position
    run4 = (f"list_bool_or(list_transform(range(1, length({core}) - 2), lambda i: "
            f"substring({core}, i, 1) = substring({core}, i + 1, 1) AND substring({core}, i, 1) = substring({core}, i + 2, 1) "
            f"AND substring({core}, i, 1) = substring({core}, i + 3, 1)))")
    return (f"CASE WHEN {w} = '' THEN 'empty' "
            f"WHEN NOT regexp_full_match({w}, {q(O.ALLOWED_CLASS + '+')}) THEN 'contains_non_devanagari' "
            f"WHEN {core} = '' THEN 'empty_after_cleanup' "
            f"WHEN NOT regexp_full_match({core}, {q('[' + O.DEV + ']+')}) THEN 'non_devanagari_chars' "
            f"WHEN regexp_matches({core}, {q('^' + O.START_BAD_CLASS)}) THEN 'invalid_start' "
            f"WHEN regexp_matches({core}, {q(O.END_BAD_CLASS + '$')}) THEN 'invalid_end' "
            f"WHEN contains({core}, {q(O.HALANT * 2)}) THEN 'double_halant' "
            f"WHEN contains({core}, {q(O.NUKTA * 2)}) THEN 'double_nukta' "
            f"WHEN {first} = {q(O.HALANT)} THEN 'matra_after_halant' "
            f"WHEN {first} = {q(O.NUKTA)} THEN 'matra_after_nukta' "
            f"WHEN {seq} <> '' THEN 'consecutive_matras' "
            f"WHEN coalesce({run4}, false) THEN 'long_repetition_noise' "
            f"ELSE 'valid_orthography' END")


# ---------------------------------------------------------------- recordings and transcripts

RID = "('r' || conv_id || '_' || turn)"
RECORDINGS = f"""
  SELECT CAST(conv_id AS VARCHAR) AS user_id, {RID} AS recording_id,
    CASE WHEN (conv_id * 8 + turn) % 61 = 1 THEN 'HI' ELSE 'hi' END AS language,
    CASE WHEN role = 'user' AND (conv_id * 8 + turn) % 53 <> 1 THEN 'https://media.example.org/hi/u' || conv_id || '/' || {RID} || '.wav' END AS rec_url_gcp,
    CASE WHEN role = 'assistant' AND (conv_id * 8 + turn) % 53 <> 1 THEN 'https://storage.example.com/uploads/u' || conv_id || '/' || {RID}
         || '_transcription.json' END AS transcription_url_gcp,
    CASE WHEN role = 'system' AND (conv_id * 8 + turn) % 53 <> 1 THEN 'https://meta.example.org/hi/u' || conv_id || '/'
         || {RID} || '.json' END AS metadata_url_gcp,
    conv_id, turn, role, text
  FROM conversations
"""


def folder_sql(cols) -> str:
    from ..operators.urls import DEFAULT_FOLDER_PATTERNS
    tries = [f"nullif(regexp_extract(trim({c}), {q(p)}, 1), '')" for c in cols for p in DEFAULT_FOLDER_PATTERNS]
    return "coalesce(" + ", ".join(tries) + ")"


BASE = "https://storage.example.com/uploads/"

# one row per transcript piece with the parsed entry semantics:
# start null for one-character pieces, text missing for empty pieces,
# text null for blank pieces; one of 67 turns is not a list
PIECES = f"""
  SELECT recording_id, conv_id, turn, role, k AS segment_idx, p,
    CASE WHEN length(p) = 1 THEN NULL ELSE k * 2.0::DOUBLE END AS start_v,
    k * 2.0::DOUBLE + length(p) / 15.0::DOUBLE AS end_v,
    CASE WHEN p = '' THEN '' WHEN trim(p) = '' THEN NULL ELSE p END AS text_v,
    (trim(p) = '' AND p <> '') AS text_null
  FROM (SELECT {RID} AS recording_id, conv_id, turn, role, unnest(ps) AS p, CAST(unnest(range(0, len(ps))) AS INTEGER) AS k
        FROM (SELECT *, regexp_split_to_array(text, '[.\\n]') AS ps FROM conversations))
"""

def pieces_sql(devanagari: bool = False) -> str:
    """PIECES over the turn text, or over its letter-by-letter Devanagari
    transliteration (same lengths, so the same times and failures)."""
    if not devanagari:
        return PIECES
    from .fixtures import DEVANAGARI_MAP, LATIN
    text = f"translate(lower(text), {q(LATIN)}, {q(DEVANAGARI_MAP)})"
    return PIECES.replace("regexp_split_to_array(text,", f"regexp_split_to_array({text},")


# first error per recording for a given mode, null when the recording is fine
def recording_error_sql(mode: str) -> str:
    text_rule = ("WHEN bool_or(text_null) THEN 'segment text is null or not a string' " if mode == "prepare" else "")
    return (f"SELECT recording_id, CASE WHEN any_value((conv_id * 8 + turn) % 67) = 1 THEN "
            f"'unexpected transcript payload type: OBJECT' "
            f"WHEN bool_or(start_v IS NULL) THEN 'segment time is null or not a number' {text_rule}END AS error "
            f"FROM ({PIECES}) GROUP BY recording_id")


# ---------------------------------------------------------------- disfluency rules (RE2 restatements)
# RE2 has neither look-arounds nor back-references.  The restatements below
# work on the word runs of the text: they equal the Java patterns whenever
# every word character of the text is also a Python \w character (true for
# all Latin text; Devanagari signs are the exception the parity patterns
# exist for, and are covered by the unit fixtures instead).

DW = r"[\p{L}\p{N}_\x{0900}-\x{097F}]"
NOT_DW = r"[^\p{L}\p{N}_\x{0900}-\x{097F}]"
SEP_CLASS = WS[:-1] + r"\-]"


def with_tokens(sub: str, t: str = "t") -> str:
    """Wrap a query so each row also has its word runs ``tk``, the gaps
    around them ``gp`` (``gp[i]`` precedes ``tk[i]``) and ``lk[i]`` = token i
    repeats as token i+1 across a whitespace/hyphen gap."""
    inner = (f"SELECT *, regexp_extract_all({t}, {q(DW + '+')}) AS tk, "
             f"regexp_split_to_array({t}, {q(DW + '+')}) AS gp FROM ({sub})")
    return (f"SELECT *, list_transform(range(1, len(tk)), lambda i: tk[i] = tk[i + 1] "
            f"AND regexp_full_match(gp[i + 1], {q(SEP_CLASS + '+')})) AS lk FROM ({inner})")


def repetition_list() -> str:
    """List of repetition matches (chains of equal tokens joined by
    whitespace/hyphen runs), in text order; needs :func:`with_tokens`."""
    starts = "list_filter(range(1, len(tk)), lambda i: lk[i] AND (i = 1 OR NOT lk[i - 1]))"
    end = "(s + coalesce(list_position(list_slice(lk, s, len(tk) - 1), false), len(tk) - s + 1) - 1)"
    return (f"list_transform({starts}, lambda s: array_to_string(list_transform(range(s, {end} + 1), "
            f"lambda j: CASE WHEN j = s THEN tk[j] ELSE gp[j] || tk[j] END), ''))")


def prolongation_list(t: str) -> str:
    chars = [chr(c) for c in range(ord("a"), ord("z") + 1)] + [chr(c) for c in range(0x0900, 0x0980)]
    alt = "|".join(ch + "{3,}" for ch in chars)
    return f"regexp_extract_all({t}, {q(alt)})"


def strict_false_start_list() -> str:
    """Strict false starts: a word run followed by "-" and then whitespace
    or the end of the text; needs :func:`with_tokens`."""
    return (f"list_transform(list_filter(range(1, len(tk) + 1), lambda i: starts_with(gp[i + 1], '-') AND "
            f"(regexp_matches(substr(gp[i + 1], 2, 1), {q(WS)}) OR (gp[i + 1] = '-' AND i = len(tk)))), "
            f"lambda i: tk[i] || '-')")


def false_start_list() -> str:
    return "list_transform(list_filter(range(1, len(tk)), lambda i: gp[i + 1] = '-'), lambda i: tk[i] || '-')"


def phrase_regex_re2(phrase_norm: str) -> str:
    body = []
    for ch in phrase_norm:
        if ch == " ":
            body.append(WS_RUN)
        elif ch == "-":
            body.append(SEP_CLASS + "*")
        elif ch.isascii() and not ch.isalnum() and ch != "_":
            body.append("\\" + ch)
        else:
            body.append(ch)
    return "(?:^|" + NOT_DW + ")" + "".join(body) + "(?:" + NOT_DW + "|$)"
