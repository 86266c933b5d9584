"""Stand-in inputs derived by Spark from the driver's tables.

The source pipeline's inputs (recording sheets, Hindi transcripts, audio)
are not shipped, so each job's input is derived row-locally from a test
table.  Every derivation here is a projection or explode of whole tables:
no sampling, no id subsets, and the same rules are restated in the oracle
SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scoring import MODEL_COLUMNS

# Sentence boundary for conversation turns: full stop or newline.
SENTENCE_SPLIT = "[.\n]"
# Of so many turns (told by conversation and turn) one has its language in
# capitals, one no folder in any URL, one its transcript wrapped in an object.
CAPITALS_EVERY, NO_FOLDER_EVERY, WRAPPED_EVERY = 61, 53, 67


def _one_of(every: int) -> Column:
    return (F.col("conv_id") * 8 + F.col("turn")) % every == 1


def sentences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, sent_idx, sentence) for every sentence of every turn, blank ones included."""
    s = conversations.select("conv_id", "turn", F.posexplode_outer(F.split("text", SENTENCE_SPLIT))
                             .alias("sent_idx", "sentence"))
    return s.where(F.col("sent_idx").isNotNull())


def model_sheet(conversations: DataFrame, devanagari: bool = False) -> DataFrame:
    """The multi-model evaluation sheet: ``segment_url_link, Human`` plus six
    hypotheses, each a deterministic edit of the human sentence:
    identity; every 5th word dropped; "e" swapped for "a"; first word
    repeated; last word dropped; ASCII upper case."""
    s = sentences(conversations)
    w = F.split("sentence", " ")
    hyps = [
        F.col("sentence"),
        F.array_join(F.filter(w, lambda x, i: (i + 1) % 5 != 0), " "),
        F.translate("sentence", "e", "a"),
        F.concat(F.element_at(w, 1), F.lit(" "), F.col("sentence")),
        F.array_join(F.slice(w, 1, F.size(w) - 1), " "),
        F.translate("sentence", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ]
    link = F.concat(F.lit("conv://"), F.col("conv_id").cast("string"), F.lit("/"),
                    F.col("turn").cast("string"), F.lit("/"), F.col("sent_idx").cast("string"))
    # devanagari: every column transliterated after the edits (lower-cased
    # letter by letter, so the upper-case model becomes a copy)
    dev = (lambda c: F.translate(F.lower(c), LATIN, DEVANAGARI_MAP)) if devanagari else (lambda c: c)
    return s.select("conv_id", "turn", "sent_idx", link.alias("segment_url_link"),
                    dev(F.col("sentence")).alias("Human"),
                    *[dev(h).alias(m) for h, m in zip(hyps, MODEL_COLUMNS)])


SHEET_KEYS = ["conv_id", "turn", "sent_idx", "segment_url_link"]


# Fixed transliteration used to turn Latin test text into Devanagari words so
# every orthography rule is reachable: consonants for most letters, vowel
# signs for a e i o u, halant for h, nukta for q, anusvara for w, visarga for x.
LATIN = "abcdefghijklmnopqrstuvwxyz"
DEVANAGARI_MAP = "ाबचदेफग्िजकलमनोप़रसतुवंःयह"


def hindi_words(documents: DataFrame) -> DataFrame:
    """(doc_id, word_idx, word): every whitespace-separated token of every
    document, lower-cased and transliterated letter by letter."""
    from ..functions.pyregex import PY_WS_RUN
    t = documents.select("doc_id", F.posexplode_outer(F.split("text", PY_WS_RUN)).alias("word_idx", "token"))
    t = t.where(F.col("word_idx").isNotNull() & (F.col("token") != ""))
    return t.select("doc_id", "word_idx",
                    F.translate(F.lower("token"), LATIN, DEVANAGARI_MAP).alias("word"))


# ---------------------------------------------------------------- recordings

def recordings(conversations: DataFrame) -> DataFrame:
    """One recording per conversation turn.  ``language`` is "HI" for one of
    ``CAPITALS_EVERY`` turns (exact vs case-insensitive filters), "hi" otherwise.
    User turns carry their folder in a media URL, assistant turns in an
    upload-bucket transcript URL, system turns in a metadata URL; one of
    ``NO_FOLDER_EVERY`` turns has none (no folder id)."""
    rid = F.concat(F.lit("r"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    folder = F.concat(F.lit("u"), F.col("conv_id").cast("string"))
    role = F.when(~_one_of(NO_FOLDER_EVERY), F.col("role"))
    return conversations.select(
        F.col("conv_id").cast("string").alias("user_id"), rid.alias("recording_id"),
        F.when(_one_of(CAPITALS_EVERY), "HI").otherwise("hi").alias("language"),
        F.when(role == "user", F.concat(F.lit("https://media.example.org/hi/"), folder, F.lit("/"), rid,
                                          F.lit(".wav"))).alias("rec_url_gcp"),
        F.when(role == "assistant", F.concat(F.lit("https://storage.example.com/uploads/"), folder, F.lit("/"),
                                               rid, F.lit("_transcription.json"))).alias("transcription_url_gcp"),
        F.when(role == "system", F.concat(F.lit("https://meta.example.org/hi/"), folder, F.lit("/"), rid, F.lit(".json")))
         .alias("metadata_url_gcp"))


def _json_string(c: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("t"))), r'^\{"t":(.*)\}$', 1)


def transcripts(conversations: DataFrame, devanagari: bool = False) -> DataFrame:
    """(recording_id, payload): the turn's text cut at full stops/newlines
    into timed entries, entry k spanning [2k, 2k + chars/15] seconds.
    Loose typing as found in real payloads: the second entry's start is a
    JSON string; an empty piece has no "text" key; a blank piece has
    "text": null; a piece of exactly one character has "start": null.
    One of ``WRAPPED_EVERY`` turns is wrapped in an object instead of a list.
    ``devanagari=True`` transliterates the lower-cased text letter by letter
    first (lengths, and so timings, are unchanged)."""
    text = F.translate(F.lower("text"), LATIN, DEVANAGARI_MAP) if devanagari else F.col("text")
    pieces = F.split(text, SENTENCE_SPLIT)

    def entry(p, k):
        start = k.cast("double") * 2.0
        end = start + F.length(p) / 15.0
        start_json = (F.when(F.length(p) == 1, F.lit("null"))
                      .when(k == 1, F.concat(F.lit('"'), start.cast("string"), F.lit('"')))
                      .otherwise(start.cast("string")))
        text_json = (F.when(p == "", F.lit(""))
                     .when(F.trim(p) == "", F.lit(',"text":null'))
                     .otherwise(F.concat(F.lit(',"text":'), _json_string(p))))
        return F.concat(F.lit('{"start":'), start_json, F.lit(',"end":'), end.cast("string"), text_json, F.lit("}"))

    arr = F.concat(F.lit("["), F.array_join(F.transform(pieces, entry), ","), F.lit("]"))
    payload = F.when(_one_of(WRAPPED_EVERY), F.concat(F.lit('{"segments":'), arr, F.lit("}"))).otherwise(arr)
    return conversations.select(transcript_url().alias("url"), payload.alias("payload"))


def transcript_url(base: str = "https://storage.example.com/uploads") -> Column:
    rid = F.concat(F.lit("r"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    return F.concat(F.lit(base + "/u"), F.col("conv_id").cast("string"), F.lit("/"), rid, F.lit("_transcription.json"))


def object_manifest(conversations: DataFrame, base: str = "https://storage.example.com/uploads") -> DataFrame:
    """(url, ok, is_json): the staged transcript objects, one per turn, stored
    under the canonical upload-bucket URL."""
    return conversations.select(transcript_url(base).alias("url"), F.lit(True).alias("ok"), F.lit(True).alias("is_json"))


def audio_listing(conversations: DataFrame) -> DataFrame:
    """(recording_id): recordings whose raw audio object exists -- all but those
    whose key ends in "7_1" (conversation ...7, turn 1: missing-audio failures)."""
    rid = F.concat(F.lit("r"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    return conversations.select(rid.alias("recording_id")).where(F.right("recording_id", F.lit(3)) != "7_1")


# A small disfluency lexicon (a parameter of the job, like the sheet it
# stands in for): wide, one column per type, ragged, with a duplicate after
# normalization and an all-empty column.
LEXICON_WIDE = {
    "Filler ": ["the", "and the", " The "],
    "Hesitation": ["er", "of", None],
    "Discourse Marker": ["und", "la", "de la"],
    "Hyphenated": ["re-do", "ing-the", None],
    "Unused": [None, None, None],
}


def lexicon_wide(spark, devanagari: bool = False) -> DataFrame:
    names = list(LEXICON_WIDE)
    conv = (lambda v: None if v is None else v.lower().translate(str.maketrans(LATIN, DEVANAGARI_MAP))) \
        if devanagari else (lambda v: v)
    rows = [tuple([i] + [conv(LEXICON_WIDE[n][i]) for n in names]) for i in range(3)]
    schema = "row_ord int, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(rows, schema)


def benchmark_bigram_lexicon(benchmark: DataFrame) -> DataFrame:
    """A large phrase lexicon derived from the benchmark table: every pair of
    adjacent word runs of every normalized passage, one type."""
    from ..functions.normalize import norm_disfluency
    from ..operators.disfluency import W
    toks = F.regexp_extract_all(norm_disfluency(F.col("text")), F.lit(W + "+"), 0)
    grams = benchmark.select(toks.alias("t")).where(F.size("t") > 1).select(F.explode(F.transform(
        F.sequence(F.lit(0), F.size("t") - 2), lambda i: F.concat(F.col("t")[i], F.lit(" "), F.col("t")[i + 1])))
        .alias("phrase")).where(F.col("phrase").isNotNull())
    return grams.distinct().select(F.lit("Benchmark").alias("type"), F.lit(0).alias("type_ord"), "phrase",
                                   F.lit(0).alias("phrase_ord"))


def lexicon_sheet(benchmark: DataFrame) -> DataFrame:
    """A wide lexicon sheet derived from the benchmark table, one row per
    item (``row_ord`` = item id): its first word ("Opener"), its first two
    words under a header that strips to the same name (the later column
    replaces the earlier), its third word when shorter than four characters
    (ragged), its first two words joined by a hyphen, its last word, and a
    blank column (dropped after normalization)."""
    w = F.split("text", " ")
    return benchmark.select(
        F.col("item_id").alias("row_ord"),
        F.get(w, 0).alias("Opener"),
        F.concat_ws(" ", F.slice(w, 1, 2)).alias("Opener "),
        F.when(F.length(F.get(w, 2)) < 4, F.get(w, 2)).alias("Hedge"),
        F.concat(F.get(w, 0), F.lit("-"), F.get(w, 1)).alias("Joined"),
        F.element_at(w, -1).alias("Closer"),
        F.lit(" ").alias("Blank"))
