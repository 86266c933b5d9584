"""Word coding and banded distances."""

import random
import time

from frames import plain_distance
from pyspark.sql import functions as F

from vaani.functions import edit_distance as E


def test_words_whose_hashes_meet_keep_codes_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(E, "_bucket", lambda w: F.pmod(F.xxhash64(w), F.lit(7)))
    rng = random.Random(1)
    rows = [(" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 25))), " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 25)))) for _ in range(200)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", E.word_edits(E.words("a"), E.words("b")).alias("d")).collect()
    assert all(r.d == plain_distance(r.a.split(), r.b.split()) for r in got)


def test_bands_of_any_distance(spark, monkeypatch):
    monkeypatch.setattr(E, "BAND", 1)
    monkeypatch.setattr(E, "WIDENINGS", 2)
    rng = random.Random(2)
    rows = [("".join(rng.choice("abé\U0001F600") for _ in range(rng.randint(0, 40))), "".join(rng.choice("abé\U0001F600") for _ in range(rng.randint(0, 40)))) for _ in range(300)]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", E.banded(F.col("a"), F.col("b")).alias("d")).collect()
    assert all(r.d == plain_distance(r.a, r.b) for r in got)


def test_long_transcripts_that_differ_in_ten_words(spark):
    """20,000 words a side, thousands of distinct ones, hashes that meet among them; far from the full table's 400 million cells."""
    rng = random.Random(3)
    left = [f"word{rng.randrange(9000)}" for _ in range(20_000)]
    right = list(left)
    for at in sorted(rng.sample(range(20_000), 10), reverse=True):
        right[at:at + 1] = rng.choice([[], ["changed"], [right[at], "added"]])
    df = spark.createDataFrame([(" ".join(left), " ".join(right))], "a string, b string")
    query = df.select(E.word_edits(E.words("a"), E.words("b")).alias("d"), F.size(E.vocabulary(E.words("a"))["shared"]).alias("n"))
    query.collect()
    start = time.time()
    r = query.first()
    assert r.d == 10 and r.n > 0 and time.time() - start < 30


def test_vocabularies_beyond_any_code_table_are_scored(spark):
    """More distinct words than a per-row table of one position a word could look up in reasonable time."""
    n = 60_000
    df = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("w"), i)), " ").alias("a"))
    df = df.select("a", F.concat(F.lit("x "), F.col("a")).alias("b"))
    assert df.select(E.word_edits(E.words("a"), E.words("b")).alias("d")).first().d == 1


def test_text_within_the_other_needs_no_table(spark):
    """Its edits are the difference in length; a table of 40,000 by 80,000 would take minutes."""
    import time
    from pyspark.sql import functions as F
    from vaani.functions.edit_distance import char_edits
    rows = [("ab" * 40000, "ab" * 20000), ("xbcy", "bc"), ("bc", "xbcy"), ("", "abc"), ("", ""), ("कख", "ख"), ("abc", "axc"), (None, "a")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    began = time.time()
    got = [r[0] for r in df.select(char_edits(F.col("a"), F.col("b"))).collect()]
    assert time.time() - began < 8
    assert got == [40000, 2, 2, 3, 0, 1, 1, None]
