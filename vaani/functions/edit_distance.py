"""Word and character edit distances kept inside the JVM.

Character distance is Spark's built-in ``levenshtein`` (code-point based).
For the word distance every distinct word of one (reference, hypothesis) pair
becomes one code point and the same built-in runs over two strings, so the
dynamic programme runs in Java rather than in a Python worker.

A word's code point is its hash, so that coding takes time linear in the
text.  The few words of a row whose hashes meet another word's are found
first and numbered in a range of their own, so different words never share a
code point.  Distances are banded: the built-in stops at a threshold, which
starts a little above the difference in length and is quadrupled until the
distance lies below it, so two long texts that differ in a few words cost
their length times the band, not the product of their lengths.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points of words known by their hash, and of words whose hashes collide (no surrogates in either).
HASHED, COLLIDED, LAST = 0x10000, 0x100000, 0x10FFFF
#: The first band is wider than the difference in length by so much.
BAND = 8
#: So often a band is quadrupled before the whole table is computed.
WIDENINGS = 6


def words(col) -> Column:
    """Split an already-normalized text on single spaces; "" gives []."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))


def wer_words(col) -> Column:
    """Word list as the common WER tooling builds it: runs of two or more
    whitespace characters become one space, ends are stripped, then the text
    is split on single spaces."""
    from .normalize import py_strip
    from .pyregex import PY_WS_CLASS
    c = F.col(col) if isinstance(col, str) else col
    return words(py_strip(F.regexp_replace(c, PY_WS_CLASS + "{2,}", " ")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(COLLIDED - HASHED))


def vocabulary(arr: Column) -> Column:
    """What :func:`encode_words` needs to know of a row's words: the hashes that
    two of them share (``shared``), and the words with these hashes (``rest``)."""
    def collisions(distinct: Column) -> Column:
        return _let(F.array_sort(F.transform(distinct, _bucket)),
                    lambda h: F.array_distinct(F.filter(h, lambda x, i: (i > 0) & (x == F.get(h, i - 1)))))

    def known(distinct: Column) -> Column:
        return _let(collisions(distinct), lambda shared: F.struct(
            shared.alias("shared"),
            F.when(F.size(shared) == 0, F.array().cast("array<string>")).otherwise(
                F.filter(distinct, lambda w: F.array_contains(shared, _bucket(w)))).alias("rest")))

    return _let(F.array_distinct(arr), known)


def encode_words(arr: Column, known: Column) -> Column:
    """Each word as one code point; ``known`` is the :func:`vocabulary` of all texts to be compared."""
    def code(w: Column) -> Column:
        place = F.array_position(known["rest"], w)
        beyond = F.raise_error(F.lit(f"more than {LAST - COLLIDED} words of one row collide")).cast("long")
        numbered = F.when(place <= LAST - COLLIDED, place + (COLLIDED - 1)).otherwise(beyond)
        # eight digits: those of the two ranges have five and six
        return F.when(F.array_contains(known["shared"], _bucket(w)), F.concat(F.lit("00"), F.hex(numbered))).otherwise(
            F.concat(F.lit("000"), F.hex(_bucket(w) + HASHED)))

    # four bytes a word, decoded in one go; nearly always no hashes meet, and nothing is looked up
    plain = F.transform(arr, lambda w: F.hex(_bucket(w) + HASHED))
    digits = F.when(F.size(known["shared"]) > 0, F.array_join(F.transform(arr, code), "")).when(
        F.size(arr) > 0, F.concat(F.lit("000"), F.array_join(plain, "000"))).otherwise("")
    return F.decode(F.unhex(digits), "UTF-32")


def banded(a: Column, b: Column) -> Column:
    """``levenshtein(a, b)`` in bands: the first one that holds the distance gives it.

    A text that stands whole in the other differs by what is around it, as many edits as the lengths differ."""
    inside = F.contains(a, b) | F.contains(b, a)
    first = F.abs(F.char_length(a) - F.char_length(b)) + BAND
    # bound by a lambda, or a band that holds would be computed again for its value
    within = [_let(F.call_function("levenshtein", a, b, (first * 4**k).cast("int")), lambda d: F.when(d >= 0, d)) for k in range(WIDENINGS)]
    return F.when(a == b, F.lit(0)).when(inside, F.abs(F.char_length(a) - F.char_length(b))).otherwise(F.coalesce(*within, F.levenshtein(a, b)))


def word_edits(ref_words: Column, hyp_words: Column) -> Column:
    """Minimum substitutions + deletions + insertions between two word arrays."""
    def distance(known: Column) -> Column:
        return _let(F.struct(encode_words(ref_words, known).alias("a"), encode_words(hyp_words, known).alias("b")),
                    lambda c: banded(c["a"], c["b"]))

    return F.when(ref_words == hyp_words, F.lit(0)).otherwise(_let(vocabulary(F.concat(ref_words, hyp_words)), distance))


def char_edits(ref: Column, hyp: Column) -> Column:
    """Code-point edit distance; identical pairs (common when a model gets a
    segment right) skip the dynamic programme."""
    return banded(ref, hyp)
