"""The JVM restatement of the detection rules against Python's own regular
expressions on every document of the smallest tables, transliterated into
Devanagari (brute force: Python evaluates the original patterns)."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

# The detection rules, as regular expressions of Python.
REPETITION = re.compile(r"\b([\wऀ-ॿ]+)(?:[\s\-]+\1){1,}\b")
PROLONGATION = re.compile(r"([ऀ-ॿa-z])\1{2,}")
FALSE_START = re.compile(r"\b([\wऀ-ॿ]+-)\b")


def test_devanagari_rules_match_python(spark):
    from pyspark.sql import functions as F
    from vaani.functions.normalize import norm_disfluency
    from vaani.plans import catalog as C
    from vaani.plans.fixtures import DEVANAGARI_MAP, LATIN
    from vaani.sources.tables import table
    got = sorted((r["doc_id"], r["rule"], r["match_idx"], r["matched_text"])
                 for r in C.q_devanagari_rules(spark, SF).collect())
    # the normalizer has tests of its own; here only the rules are Python's
    docs = table(spark, SF, "documents").select("doc_id", norm_disfluency(F.translate(F.lower("text"), LATIN, DEVANAGARI_MAP)).alias("t"))
    want = []
    for doc_id, t in docs.collect():
        for rule, pat, g in (("repetition", REPETITION, 0), ("prolongation", PROLONGATION, 0),
                             ("false_start", FALSE_START, 1)):
            want += [(doc_id, rule, i, m.group(g)) for i, m in enumerate(pat.finditer(t))]
    assert len(want) > 100
    assert got == sorted(want)


def _occurs(phrase, text):
    """Whether the phrase stands in the text and not within a word, by a scan:
    a space of the phrase eats white space (at least one), a hyphen eats any
    white space and hyphens; every way to eat is followed."""
    word = lambda c: c == "_" or c.isalnum() or "\u0900" <= c <= "\u097f"
    for start in range(len(text) + 1):
        if start and word(text[start - 1]):
            continue
        ends = {start}
        for c in phrase:
            eats = str.isspace if c == " " else (lambda x: x == "-" or x.isspace()) if c == "-" else None
            after = set()
            for e in ends:
                if eats is None:
                    if text[e:e + 1] == c:
                        after.add(e + 1)
                    continue
                if c == "-":
                    after.add(e)
                while e < len(text) and eats(text[e]):
                    e += 1
                    after.add(e)
            ends = after
        if any(e == len(text) or not word(text[e]) for e in ends):
            return True
    return False


def test_devanagari_phrase_join_matches_scan(spark):
    from pyspark.sql import functions as F
    from vaani.functions.normalize import norm_disfluency
    from vaani.operators import disfluency as D
    from vaani.plans import fixtures as X
    from vaani.sources.tables import table
    dev = lambda c: F.translate(F.lower(c), X.LATIN, X.DEVANAGARI_MAP)
    bench = table(spark, SF, "benchmark").select(dev(F.col("text")).alias("text"))
    lex = X.benchmark_bigram_lexicon(bench)
    docs = table(spark, SF, "documents").select("doc_id", dev(F.col("text")).alias("text"))
    det = D.detect(docs, lex, text_col="text", seg_keys=("doc_id",))
    got = {(r["doc_id"], h["matched_text"]) for r in det.select("doc_id", "hits").collect()
           for h in r["hits"] if h["match_rule"] == "lexicon"}
    texts = docs.select("doc_id", norm_disfluency(F.col("text")).alias("t")).collect()
    phrases = [r["phrase"] for r in lex.collect()]
    assert len(phrases) > 500
    want = {(r["doc_id"], p) for r in texts for p in phrases if p.split(" ")[0] in r["t"] and _occurs(p, r["t"])}
    assert len(want) > 100
    assert got == want


def test_random_strings_match_python(spark):
    """SURVEY 5.1: parity of the JVM patterns with Python's on random strings
    over Devanagari letters and signs, Latin, hyphen and whitespace."""
    import random
    from pyspark.sql import functions as F
    from vaani.operators import disfluency as D
    alphabet = ["क", "ख", "र", "ा", "ि", "ं", "्", "़", "ँ", "a", "b", "ab", " ", " ", "-", "--", " ", "x1", "_"]
    rng = random.Random(2024)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(4000)]
    phrases = ["a", "क-र", "ab b", "ि"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(
        "t", D.repetition_matches(F.col("t")).alias("rep"),
        F.regexp_extract_all("t", F.lit(D.PROLONGATION), 0).alias("pro"),
        F.regexp_extract_all("t", F.lit(D.FALSE_START), 1).alias("fs"),
        *[F.col("t").rlike(D.phrase_pattern(p)).alias(f"p{i}") for i, p in enumerate(phrases)]).collect()
    bad = []
    for r in got:
        t = r["t"]
        want = ([m.group(0) for m in REPETITION.finditer(t)], [m.group(0) for m in PROLONGATION.finditer(t)],
                [m.group(1) for m in FALSE_START.finditer(t)], [_occurs(p, t) for p in phrases])
        have = (r["rep"], r["pro"], r["fs"], [r[f"p{i}"] for i in range(len(phrases))])
        if want != have:
            bad.append((t, want, have))
    assert not bad, bad[:5]


def test_false_starts_take_linear_time(spark):
    """A long run of letters and signs is tried once, not from each of its boundaries."""
    import time
    from vaani.operators import disfluency as D
    run = "\u093e" + "\u0915\u093e" * 40000
    df = spark.createDataFrame([(f"{run} a-b {run}-c",), ("\u093e-a \u093e\u0915-\u093e",), ("no hyphen",), (None,)], "t string").coalesce(1)
    began = time.time()
    got = [r[0] for r in df.select(D.false_start_matches(df["t"])).collect()]
    assert time.time() - began < 8
    assert got == [["a-", run[1:] + "-"], [], [], None]


def test_every_character_as_space_dash_or_neither(spark):
    from vaani.functions.normalize import norm_disfluency
    chars = [chr(i) for i in range(1, 0xD800)]
    texts = ["a" + c * 2 + "b" for c in chars]
    df = spark.createDataFrame([(c, t) for c, t in zip(chars, texts)], "c string, t string")
    bad = []
    for r in df.select("c", "t", norm_disfluency(df["t"]).alias("n")).collect():
        if r.c.isspace():
            want = "a b"
        elif r.c in "\u2013\u2014\u2015\u2011":
            want = "a--b"
        else:
            continue
        if r.n != want:
            bad.append((hex(ord(r.c)), r.n))
    kept = {r.c for r in df.select("c", norm_disfluency(df["t"]).alias("n")).where("n = 'a b'").collect()}
    assert not bad and kept == {c for c in chars if c.isspace()}
