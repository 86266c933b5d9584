"""Character classes that reproduce Python ``re`` semantics on the JVM.

Java's ``\\s``, ``\\w`` and ``\\b`` differ from Python's Unicode-aware
ones (Python ``\\s`` covers U+001C-001F, U+0085, U+00A0, U+2000-200A ...;
Python ``\\w`` excludes combining marks such as Devanagari vowel signs).
Every pattern in the engine is written with these constants instead of the
bare escapes.  The same class text is valid RE2 syntax, so oracle SQL for
DuckDB can reuse it.
"""

# The code points for which Python's str.isspace() is true
# (identical to Unicode ``re`` \s): TAB LF VT FF CR, U+001C-001F, SPACE,
# U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000.
PY_WS_CLASS = (r"[\t\n\x0B\x0C\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
PY_WS_RUN = PY_WS_CLASS + "+"
PY_WS_EDGES = "^" + PY_WS_RUN + "|" + PY_WS_RUN + "$"

# The same white space for the JVM's engine, which tests the parts of a class one
# after another: single low characters are one table, and what is left
# is behind one range, so a letter is refused after two tests.
JVM_WS_PARTS = (r"\t\n\x0B\x0C\r\x1C\x1D\x1E\x1F \x{85}\x{A0}"
                r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]")

# Python \w on str: letters, numbers, underscore.
PY_WORD_CLASS = r"[\p{L}\p{N}_]"
PY_NOT_WORD_CLASS = r"[^\p{L}\p{N}_]"

# Devanagari block.
DEVANAGARI_RANGE = r"\x{0900}-\x{097F}"
# "word or Devanagari" as used by the disfluency patterns.
WORD_OR_DEV_CLASS = r"[\p{L}\p{N}_" + DEVANAGARI_RANGE + "]"

# The same two classes for the JVM's engine: frequent ranges are tested first.
JVM_WORD_CLASS = r"[\x{0905}-\x{0939}[a-z0-9[\p{L}\p{N}_]]]"
JVM_WORD_OR_DEV_CLASS = "[" + DEVANAGARI_RANGE + r"[a-z0-9[\p{L}\p{N}_]]]"


def py_boundary(word_class: str = PY_WORD_CLASS) -> str:
    """Python ``\\b`` for a given word class, as explicit look-arounds."""
    w = word_class
    return f"(?:(?<={w})(?!{w})|(?<!{w})(?={w}))"


PY_B = py_boundary()

# Strings over this class are already in NFC, so the normalizer skips them:
# code points below U+0300 (NFC_Quick_Check=Yes, combining class 0) and the
# Devanagari block without the nukta (U+093C, composes with a preceding
# consonant), the stress signs (U+0951-0954, non-zero combining class) and
# the nukta letters U+0958-095F (excluded from composition).  The halant's
# non-zero class only matters next to another such mark, and all of those
# are outside the class.  Checked exhaustively on single characters and
# pairs against Python's unicodedata.
NFC_SAFE = (r"^[\x00-\x{2FF}\x{0900}-\x{093B}\x{093D}-\x{0950}\x{0955}-\x{0957}"
            r"\x{0960}-\x{097F}]*$")
