"""Disfluency detection.

Per segment, hits are: lexicon phrases (lexicon column order, then row
order, each phrase at most once), then every repetition, prolongation and
false-start regex match, de-duplicated on (type, text, rule) keeping the
first.  All of it is one row-local projection building ``array<struct>``;
there is no shuffle.  Two modes:

* ``parity`` (default) reproduces the source patterns exactly, including
  how Python's ``\\b``/``\\w`` treat Devanagari signs (SURVEY T4, T5).
* ``strict_tokens`` matches what the patterns' comments describe: equal
  whole tokens for repetition, a token ending in "-" for a false start.
"""

from __future__ import annotations

import re
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import norm_disfluency
from ..functions.pyregex import (JVM_WORD_CLASS, JVM_WORD_OR_DEV_CLASS, JVM_WS_PARTS, PY_WS_CLASS, PY_WS_RUN,
                                 WORD_OR_DEV_CLASS, py_boundary)

W = WORD_OR_DEV_CLASS                       # [\wऀ-ॿ]
NOT_W = "[^" + W[1:]                        # its complement
SEP = PY_WS_CLASS[:-1] + r"\-]+"            # [\s\-]+
SIGNS = "[^" + PY_WS_CLASS[1:-1] + r"\-" + W[1:]   # neither word character, space nor hyphen

# The detection rules as Python regular expressions (matched
# on the normalized text; the false start reports group 1):
#   repetition    \b([\w\u0900-\u097f]+)(?:[\s\-]+\1){1,}\b
#   prolongation  ([\u0900-\u097fa-z])\1{2,}
#   false start   \b([\w\u0900-\u097f]+-)\b
# Restated below for the JVM with explicit classes for Python's \w, \s, \b.
# The repeated group is possessive, with its end condition inside: the JVM then
# walks a chain of any length in a loop instead of recursing for each word.
# Word characters and separators exclude each other, so a run of either never
# gives characters back (possessive).  A repetition first looks for its second
# occurrence, which nearly every place lacks, and only then for the boundary.
_W, _SEP, _B = JVM_WORD_OR_DEV_CLASS, "[" + r"\-" + JVM_WS_PARTS + "]++", py_boundary(JVM_WORD_CLASS)
REPETITION = "(?=(" + _W + "++)" + _SEP + r"\1)" + _B + r"\1(?:" + _SEP + r"\1(?=" + _SEP + r"\1|" + _B + "))++" + _B
PROLONGATION = r"([\x{0900}-\x{097F}a-z])\1{2,}"
# A hyphen is no word character, so one follows it (\b), and the first boundary
# in the run before it is at the run's first word character, after its leading
# signs: each run is tried once, from its beginning.
FALSE_START = ("(?<!" + _W + r")[\x{0900}-\x{097F}&&[^\p{L}\p{N}_]]*+(" + JVM_WORD_CLASS + _W + "*+-)(?=" + JVM_WORD_CLASS + ")")

# strict_tokens: a token is a maximal run of W; equal tokens separated by
# spaces/hyphens; a false start is a token followed by "-" and then a
# separator or the end of the text.
STRICT_REPETITION = "(?<!" + W + ")(" + W + "+)(?:" + SEP + r"\1(?!" + W + "))++"
STRICT_FALSE_START = "(?<!" + W + ")(" + W + "+-)(?=" + PY_WS_CLASS + "|$)"

# Hit types and rule names.
REPETITION_TYPE, REPETITION_RULE = "Repetition", "regex_repetition"
PROLONGATION_TYPE, PROLONGATION_RULE = "Prolongation", "regex_prolongation"
FALSE_START_TYPE, FALSE_START_RULE = "False Start", "regex_false_start"
LEXICON_RULE = "lexicon"

# The occurrence sheet's columns, in sheet order.
OUTPUT_COLUMNS = [
    "occurrence_id", "recording_id", "segment_idx", "disfluency_type", "matched_text", "match_rule",
    "segment_start_sec", "segment_end_sec", "clip_duration_sec", "clip_path", "clip_rel_path",
    "transcription_snippet", "transcription_url", "audio_url", "user_id", "language",
]


def _escape(ch: str) -> str:
    return "\\" + ch if (ch.isascii() and not ch.isalnum() and ch != "_") else ch


def _phrase_body(phrase_norm: str) -> str:
    body = []
    for ch in phrase_norm:
        if ch == " ":
            body.append(PY_WS_RUN)
        elif ch == "-":
            body.append(PY_WS_CLASS[:-1] + r"\-]*")
        else:
            body.append(_escape(ch))
    return "".join(body)


def phrase_pattern(phrase_norm: str) -> str:
    """Literal phrase; a space matches any whitespace run, a hyphen any
    run of hyphens/whitespace; guarded so it never starts or ends inside a
    word (word = Python word character or Devanagari).

    When the phrase starts with a word character the start guard is placed
    after that character (``c(?<!W.)`` instead of ``(?<!W)c``): the same
    condition, but the pattern then begins with a literal, which lets the
    regex engine skip ahead to occurrences of it instead of testing the
    guard at every position of the text."""
    guard_end = "(?!" + W + ")"
    if phrase_norm and re.match(r"[\w\u0900-\u097f]", phrase_norm[0]):
        return phrase_norm[0] + "(?<!" + W + ".)" + _phrase_body(phrase_norm[1:]) + guard_end
    return "(?<!" + W + ")" + _phrase_body(phrase_norm) + guard_end


def wide_lexicon_to_long(wide: DataFrame, order_col: str = "row_ord") -> DataFrame:
    """A wide sheet (one column per type) to ``type, col_idx, phrase_raw,
    phrase_ord``; headers are stripped, empty cells dropped."""
    cols = [c for c in wide.columns if c != order_col]
    stack = F.array(*[F.struct(F.lit(c.strip()).alias("type"), F.lit(i).alias("col_idx"),
                               F.col(f"`{c}`").cast("string").alias("phrase_raw"))
                      for i, c in enumerate(cols)])
    return (wide.select(F.col(order_col).alias("phrase_ord"), F.inline_outer(stack))
            .where(F.col("phrase_raw").isNotNull()))


def build_lexicon(long: DataFrame) -> DataFrame:
    """Normalize (N2), drop empty phrases, keep the first occurrence of a
    phrase within its type; types left without phrases disappear.

    Columns whose stripped headers coincide resolve like a dict keyed by
    type that is only assigned non-empty columns: the type keeps the
    position of its first non-empty column and the phrases of its last.
    The window spans one type's phrases, so it is bounded by the lexicon."""
    n = long.withColumn("phrase", norm_disfluency(F.col("phrase_raw"))).where(F.col("phrase") != "")
    by_type = Window.partitionBy("type")
    n = (n.withColumn("type_ord", F.min("col_idx").over(by_type))
          .withColumn("_last", F.max("col_idx").over(by_type))
          .where(F.col("col_idx") == F.col("_last")))
    return (n.groupBy("type", "type_ord", "phrase").agg(F.min("phrase_ord").alias("phrase_ord"))
            .select("type", F.col("type_ord").cast("int").alias("type_ord"), "phrase",
                    F.col("phrase_ord").cast("int").alias("phrase_ord")))


def _hit(t, text, rule) -> Column:
    return F.struct(F.lit(t).alias("disfluency_type"), text.alias("matched_text"), F.lit(rule).alias("match_rule"))


def repetition_matches(text_norm: Column, mode: str = "parity") -> Column:
    """Every non-overlapping repetition match, in one pass over the text."""
    return F.regexp_extract_all(text_norm, F.lit(REPETITION if mode == "parity" else STRICT_REPETITION), 0)


def false_start_matches(text_norm: Column, mode: str = "parity") -> Column:
    """Every non-overlapping false start; a text without a hyphen has none."""
    found = F.regexp_extract_all(text_norm, F.lit(FALSE_START if mode == "parity" else STRICT_FALSE_START), 1)
    return F.when(~F.contains(text_norm, F.lit("-")), F.array().cast("array<string>")).otherwise(found)


def regex_hits(text_norm: Column, mode: str = "parity") -> Column:
    """All non-overlapping matches, in rule order."""
    return F.concat(
        F.transform(repetition_matches(text_norm, mode), lambda m: _hit(REPETITION_TYPE, m, REPETITION_RULE)),
        F.transform(F.regexp_extract_all(text_norm, F.lit(PROLONGATION), 0),
                    lambda m: _hit(PROLONGATION_TYPE, m, PROLONGATION_RULE)),
        F.transform(false_start_matches(text_norm, mode), lambda m: _hit(FALSE_START_TYPE, m, FALSE_START_RULE)))


def occurrences(detected: DataFrame, clips_root: str = "clips") -> DataFrame:
    """One row per hit with the 16 output columns; ids
    ``{recording}_{segment:04d}_{hit:02d}``; times rounded to 3 places."""
    d = detected.where(F.col("end") > F.col("start"))
    # outer form + null filter on the generated index: a filter on ``hits``
    # itself would be pushed below the projection and re-run every regex
    e = d.select("*", F.posexplode_outer("hits").alias("hit_idx", "_h")).where(F.col("hit_idx").isNotNull())
    occ = F.format_string("%s_%04d_%02d", F.col("recording_id"), F.col("segment_idx"), F.col("hit_idx"))
    parent = clips_root.rstrip("/").rsplit("/", 1)[-1]
    rel = F.concat_ws("/", F.lit(parent), F.col("recording_id"), F.concat(occ, F.lit(".wav")))
    return e.select(
        occ.alias("occurrence_id"), "recording_id", F.col("segment_idx").cast("int").alias("segment_idx"),
        F.col("_h.disfluency_type").alias("disfluency_type"), F.col("_h.matched_text").alias("matched_text"),
        F.col("_h.match_rule").alias("match_rule"),
        F.round("start", 3).alias("segment_start_sec"), F.round("end", 3).alias("segment_end_sec"),
        F.round(F.col("end") - F.col("start"), 3).alias("clip_duration_sec"),
        F.concat_ws("/", F.lit(clips_root.rstrip("/")), F.col("recording_id"), F.concat(occ, F.lit(".wav"))).alias("clip_path"),
        rel.alias("clip_rel_path"),
        F.col("raw_text").alias("transcription_snippet"), "transcription_url", "audio_url", "user_id", "language")


def type_counts(occ: DataFrame) -> DataFrame:
    """A3: occurrences per disfluency type."""
    return occ.groupBy("disfluency_type").agg(F.count(F.lit(1)).alias("occurrences"))


#: Begins the keys of phrases that are more than words and plain separators, and those of signs; ends a posting's key.
_LOOSE, _SIGN, _MARK = "\x01", "\x00", "\x02"
#: A word character that stands for the neighbouring words of a piece of text.
_EDGE = "\u097f"
#: An n-gram found in nearly every segment is dealt over so many tasks.
SALTS = 16


def _words_of(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(W + "+"), 0)


def _is_plain(phrase: Column) -> Column:
    """Begins and ends with a word character and has no hyphen: in normalized
    text, whose spaces are single, such a phrase stands exactly as written."""
    return phrase.rlike("^" + W + "(?:.*" + W + ")?$") & ~F.contains(phrase, F.lit("-"))


def _phrase_key(phrase: Column) -> Column:
    """What a phrase is joined by: itself if plain; else its word characters
    (hyphens may glue or split words, so only these are invariant); without
    any, its first character that is neither space nor hyphen, if it has one."""
    word = F.array_join(_words_of(phrase), "")
    return (F.when(_is_plain(phrase), phrase).when(word != "", F.concat(F.lit(_LOOSE), word))
            .otherwise(F.concat(F.lit(_SIGN), F.substring(F.regexp_replace(phrase, SEP, ""), 1, 1))))


def phrase_postings(segments: DataFrame, lexicon: DataFrame, keys: list[str], text_col: str = "text_norm",
                    positions: bool = False) -> DataFrame:
    """D3: the lexicon phrases found in each normalized text: ``keys``, type,
    type_ord, phrase, phrase_ord, and with ``positions`` one row for each
    place, ``start`` being the number of words before it.

    A text is cut into words and the separators around them.  Its n-grams, of
    the sizes that occur in the lexicon, are postings (segment, n-gram with
    its separators, start) and are joined with the phrases by equality, which
    proves a plain phrase.  Phrases with hyphens, or signs at an end, are
    joined by their word characters and proved by the posting's own piece of
    text, so no text is sent.  Each n-gram of a segment is sent once, and dealt over
    ``SALTS`` tasks, so that one found everywhere has no task of its own.
    """
    lex = lexicon.withColumn("k", _phrase_key(F.col("phrase"))).withColumn("_n", F.size(_words_of(F.col("phrase"))))
    plain, sign = _is_plain(F.col("phrase")), F.col("k").startswith(_SIGN)
    # hyphens may glue, spaces never: a loose phrase is between (parts with words) and (words) n-grams long
    parts = F.size(F.filter(F.split(F.col("phrase"), " "), lambda x: x.rlike(W)))
    sizes = lex.agg(F.collect_set(F.when(plain, F.col("_n"))).alias("plain"), F.min(F.when(~plain & ~sign, parts)).alias("lo"),
                    F.max(F.when(~plain & ~sign, F.col("_n"))).alias("hi"), F.count_if(sign).alias("signs")).first()
    words, gaps = F.col("_w"), F.col("_g")
    edge = lambda there: F.when(there, F.lit(_EDGE)).otherwise(F.lit(""))

    def posting(k, piece, start):
        # one string, because equal strings of a long array are found by hashing; a piece stands behind a mark
        text = k if piece is None else F.concat(k, F.lit(_MARK), piece)
        return F.struct(text.alias("p"), start.cast("int").alias("start")) if positions else text

    def grams(n, of):
        places = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, of)          # ``of`` takes a place

    def core(i, n):
        return F.concat(F.get(words, i), *[x for j in range(1, n) for x in (F.get(gaps, i + j), F.get(words, i + j))])

    def loose(n):
        return grams(n, lambda i: posting(
            F.concat(F.lit(_LOOSE), *[F.get(words, i + j) for j in range(n)]),
            F.concat(edge(i > 0), F.get(gaps, i), core(i, n), F.get(gaps, i + n), edge(i + n < F.size(words))), i))

    def signs(gap, i):
        piece = F.concat(edge(i > 0), gap, edge(i < F.size(words)))
        found = F.filter(F.array_distinct(F.split(F.regexp_replace(gap, SEP, ""), "")), lambda c: c != "")
        return F.transform(F.concat(F.array(F.lit("")), found), lambda c: posting(F.concat(F.lit(_SIGN), c), piece, i))

    def exact(n):
        return grams(n, lambda i: posting(core(i, n), None, i))

    lists = [exact(n) for n in sorted(sizes["plain"])]
    lists += [loose(n) for n in range(max(sizes["lo"], 1), sizes["hi"] + 1)] if sizes["hi"] else []
    lists += [F.flatten(F.transform(gaps, signs))] if sizes["signs"] else []
    found = F.concat(*lists) if lists else F.array(posting(F.lit(""), None, F.lit(0)))
    cut = segments.select(*keys, _words_of(F.col(text_col)).alias("_w"), F.split(F.col(text_col), W + "+", -1).alias("_g"))
    # an outer explode keeps the filter off the projection that builds the list
    rows = cut.select(*keys, F.explode_outer(found if positions else F.array_distinct(found)).alias("_p"))
    text = F.col("_p.p") if positions else F.col("_p")
    mark = F.instr(text, _MARK)
    rows = rows.select(*keys, F.when(mark > 0, F.substring_index(text, _MARK, 1)).otherwise(text).alias("k"),
                       F.when(mark > 0, F.substring(text, mark + 1, F.char_length(text))).alias("_piece"),
                       *([F.col("_p.start").alias("start")] if positions else []), F.pmod(F.xxhash64(*keys), F.lit(SALTS)).alias("_salt"))
    salted = lex.select("k", "type", "type_ord", "phrase", "phrase_ord", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    hits = rows.join(salted, ["k", "_salt"]).where(F.col("_piece").isNull() | _stands(F.col("_piece"), F.col("phrase")))
    return hits.select(*keys, "type", "type_ord", "phrase", "phrase_ord", *(["start"] if positions else []))


def lexicon_hits(segments: DataFrame, lexicon: DataFrame, keys: list[str], text_col: str = "text_norm") -> DataFrame:
    """Per segment with hits: ``_lex``, its phrases in lexicon order (at most the lexicon)."""
    return phrase_postings(segments, lexicon, keys, text_col).groupBy(*keys).agg(
        F.array_sort(F.collect_set(F.struct("type_ord", "phrase_ord", "type", "phrase"))).alias("_lex"))


def detect(segments: DataFrame, lexicon: DataFrame, text_col: str = "raw_text",
           mode: str = "parity", seg_keys=("recording_id", "segment_idx")) -> DataFrame:
    """Add ``text_norm`` and ordered, de-duplicated ``hits``: the
    lexicon phrases in lexicon order, then the regex rules' matches."""
    keys = list(seg_keys)
    s = segments.withColumn("text_norm", norm_disfluency(F.coalesce(F.col(text_col), F.lit(""))))
    out = s.join(lexicon_hits(s, lexicon, keys), keys, "left")
    every = F.coalesce(F.col("_lex"), F.array().cast("array<struct<type_ord:int,phrase_ord:int,type:string,phrase:string>>"))
    lex_hits = F.transform(every, lambda h: _hit_col(h["type"], h["phrase"]))
    hits = F.concat(lex_hits, regex_hits(F.col("text_norm"), mode))
    return out.withColumn("hits", F.array_distinct(hits)).withColumn("has_disfluency", F.size("hits") > 0).drop("_lex")


def _hit_col(t: Column, text: Column) -> Column:
    return F.struct(t.alias("disfluency_type"), text.alias("matched_text"), F.lit(LEXICON_RULE).alias("match_rule"))


def _quote_repl(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def _stands(piece: Column, phrase: Column) -> Column:
    """Whether a phrase that isn't plain stands in a posting's piece of text:
    :func:`phrase_pattern` built from the phrase, over the whole piece if the
    phrase has words (they are the piece's words), anywhere in it if not."""
    def body(p):
        esc = F.regexp_replace(p, r"([!-,./:-@\[-^`{-~])", r"\\$1")
        b = F.regexp_replace(esc, "-", _quote_repl(PY_WS_CLASS[:-1] + r"\-]*"))
        return F.regexp_replace(b, " ", _quote_repl(PY_WS_RUN))
    guard_end = F.lit("(?!" + W + ")")
    pattern = F.concat(F.lit("(?<!" + W + ")"), body(phrase), guard_end)
    around = F.concat(F.lit("^" + _EDGE + "?" + NOT_W + "*"), pattern, F.lit(NOT_W + "*" + _EDGE + "?$"))
    return F.regexp_like(piece, F.when(phrase.rlike(W), around).otherwise(pattern))
