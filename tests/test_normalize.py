"""Normalizers against Python's own string semantics on random strings."""

import random
import unicodedata

from pyspark.sql import functions as F

from frames import one_col
from vaani.functions.normalize import norm_asr_basic, norm_disfluency, norm_scoring, norm_word

ALPHABET = ["a", "B", "é", "é", "क", "़", "ड़", "क़", " ", "\t", "\n", " ", " ",
            "　", "\x1c", "-", "–", "—", "―", "‑", ".", "!", "।", "(", "'", "\u0085", "\r", "​"]


# text, then what each profile makes of it: asr, disfluency, word, scoring
TABLE = [
    ("", "", "", "", ""),
    (" \t\n", "", "", "", ""),
    ("  A  b\n\nC ", "A b C", "a b c", "AbC", "a b c"),
    ("x\u3000y\u00a0z", "x y z", "x y z", "xyz", "x y z"),
    ("e\u0301t\u00c9", "e\u0301t\u00c9", "\u00e9t\u00e9", "\u00e9t\u00c9", "\u00e9t\u00e9"),
    ("a\u2013b\u2014c", "a\u2013b\u2014c", "a-b-c", "a-b-c", "a-b-c"),
    ("a\u2015b", "a\u2015b", "a-b", "a-b", "a\u2015b"),
    ("a\u2011b", "a\u2011b", "a-b", "a\u2011b", "a\u2011b"),
    ("Hi, you! (ok)", "Hi, you! (ok)", "hi, you! (ok)", "Hi,you!(ok)", "hi you ok"),
    ("\u0915\u0964 'x'", "\u0915\u0964 'x'", "\u0915\u0964 'x'", "\u0915\u0964'x'", "\u0915 x"),
    ("\u0958", "\u0958", "\u0915\u093c", "\u0915\u093c", "\u0915\u093c"),
    ("a\x1cb\u0085c", "a b c", "a b c", "abc", "a b c"),
    ("a\u200bb", "a\u200bb", "a\u200bb", "a\u200bb", "a\u200bb"),
]


def _profiles(df):
    return df.select("s", norm_asr_basic(F.col("s")).alias("a"), norm_disfluency(F.col("s")).alias("d"),
                     norm_word(F.col("s")).alias("w"), norm_scoring(F.col("s")).alias("c"))


def test_profiles(spark):
    for r, want in zip(_profiles(one_col(spark, [t[0] for t in TABLE]).coalesce(1)).collect(), TABLE):
        assert tuple(r) == want


def test_profiles_of_random_strings(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 15))) for _ in range(400)]
    rows = _profiles(one_col(spark, texts)).collect()
    for r in rows:
        for k in "adwc":                    # no white space but single inner spaces
            assert r[k] == " ".join(r[k].split()), repr(r["s"])
        for k in "dwc":                     # composed
            assert unicodedata.is_normalized("NFC", r[k])
        assert not r["w"].split(" ")[1:] and r["d"] == r["d"].lower() and not set(r["c"]) & set(".!\u0964('")
    for k, f in zip("adwc", (norm_asr_basic, norm_disfluency, norm_word, norm_scoring)):    # once is enough
        again = one_col(spark, [r[k] for r in rows]).select("s", f(F.col("s")).alias("n")).collect()
        assert all(r["s"] == r["n"] for r in again)


def test_nfc_fast_path_is_exact(spark):
    from vaani.functions.normalize import nfc
    rng = random.Random(11)
    dev = [chr(c) for c in range(0x900, 0x980)] + ["a", "é", "é", "́", " "]
    texts = ["".join(rng.choices(dev, k=rng.randint(1, 10))) for _ in range(2000)]
    got = one_col(spark, texts).select("s", nfc(F.col("s")).alias("n")).collect()
    for r in got:
        assert r["n"] == unicodedata.normalize("NFC", r["s"]), repr(r["s"])


def test_long_whitespace_runs(spark):
    text = "a" + " \t.," * 20000 + "b" + "\n" * 50000
    got = one_col(spark, [text]).select(norm_scoring(F.col("s")).alias("c"), norm_asr_basic(F.col("s")).alias("a")).first()
    assert got["c"] == "a b" and got["a"].split(" ") == text.split()
