"""Text normalization profiles, all JVM-side expressions.

Four normalizers exist in the source pipeline and they are not
interchangeable; each one is a named profile here with its exact step order.
Unicode NFC has no Spark built-in; ICU4J (shipped with Spark) exposes a
static ``Normalizer.compose(String, boolean)`` that ``reflect`` can call, so
no Python worker is involved.  Strings made only of code points below U+0300
are NFC already and skip the reflective call.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .pyregex import JVM_WS_PARTS, NFC_SAFE, PY_WS_CLASS, PY_WS_EDGES, PY_WS_RUN

# Dash characters folded to "-" by each profile.
DASHES_DISFLUENCY = "–—―‑"  # en dash, em dash, horizontal bar, non-breaking hyphen
DASHES_WORD = "–—―"             # en dash, em dash, horizontal bar
DASHES_SCORING = "–—"                # en dash, em dash

# Punctuation replaced by a space before scoring.
SCORING_PUNCT_CLASS = r"""[.,!?।;:'"()\[\]{}]"""


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nfc(col) -> Column:
    """Unicode NFC (N6), null-preserving."""
    c = _c(col)
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(c.isNull(), F.lit(None).cast("string")) \
            .when(F.octet_length(c) == F.char_length(c), c) \
            .when(c.rlike(NFC_SAFE), c) \
            .otherwise(composed)


def py_strip(col) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends."""
    return F.regexp_replace(_c(col), PY_WS_EDGES, "")


def collapse_ws(col, repl: str = " ") -> Column:
    """Python ``re.sub(r"\\s+", repl, s)``."""
    return F.regexp_replace(_c(col), PY_WS_RUN, repl)


def _dashes(col, chars: str, text) -> Column:
    """``col``, made from ``text`` by steps that neither add nor remove a dash:
    where the text's bytes hold none of ``chars``, it stays as it is."""
    c = _c(col)
    some = reduce(or_, (F.contains(_c(text), F.lit(d)) for d in chars))
    return F.when(some, F.translate(c, chars, "-" * len(chars))).otherwise(c)


def null_to_text(col, null_policy: str = "empty") -> Column:
    """Missing cells: ``"empty"`` gives "", ``"nan_literal"`` gives "nan"
    (what ``str(float('nan'))`` yields when a sheet cell is empty)."""
    fill = {"empty": "", "nan_literal": "nan"}[null_policy]
    return F.coalesce(_c(col), F.lit(fill))


def _collapse_trim(c: Column, extra_class: str = "") -> Column:
    """Every run of Python whitespace (and of ``extra_class`` characters)
    becomes one space, then the edge spaces go.  Equal to Python's
    ``strip`` followed by collapsing whitespace runs (or the reverse), because
    after the collapse the only whitespace left is single spaces."""
    # one character class (no alternation inside the repetition, which the
    # JVM engine would match recursively on long runs)
    run = "[" + extra_class[1:-1] + JVM_WS_PARTS + "]++"
    return F.trim(F.regexp_replace(c, run, " "))


def norm_asr_basic(col) -> Column:
    """Newline to space, strip, collapse whitespace.  No NFC, no lower."""
    return _collapse_trim(_c(col))


def norm_disfluency(col) -> Column:
    """NFC, strip, lower, CR/LF to space, dashes to "-", collapse."""
    return _dashes(F.lower(_collapse_trim(nfc(col))), DASHES_DISFLUENCY, col)


def norm_word(col) -> Column:
    """NFC, strip, dashes to "-", delete every whitespace character
    (the strip is implied by the deletion)."""
    return _dashes(F.regexp_replace(nfc(col), PY_WS_CLASS, ""), DASHES_WORD, col)


def norm_scoring(col, null_policy: str = "empty") -> Column:
    """NFC, LF to space, dashes, punctuation to space, collapse, strip,
    lower -- with punctuation and whitespace replaced in one pass."""
    text = null_to_text(col, null_policy)
    t = _dashes(nfc(text), DASHES_SCORING, text)
    return F.lower(_collapse_trim(t, SCORING_PUNCT_CLASS))


def norm_strip(col) -> Column:
    """Strip only (public evaluation split)."""
    return py_strip(col)


PROFILES = {
    "asr_basic": norm_asr_basic,
    "disfluency": norm_disfluency,
    "word": norm_word,
    "scoring": norm_scoring,
    "strip_only": norm_strip,
}


def normalize(col, profile: str) -> Column:
    return PROFILES[profile](col)
