"""Phrase postings (D3) against a plain search with Python's ``re``, and the shape of their plan."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vaani.operators import disfluency as D

LEX = "type string, type_ord int, phrase string, phrase_ord int"
W = r"[\wऀ-ॿ]"


def stands(phrase, text):
    """Where the source's rule finds a phrase: spaces match any white space,
    hyphens any run of hyphens and white space, no word goes on at either end."""
    body = "".join(r"\s+" if c == " " else r"[\-\s]*" if c == "-" else re.escape(c) for c in phrase)
    return re.search(f"(?<!{W}){body}(?!{W})", text) is not None


def phrases_of(rng, n):
    words, seps = ["a", "b", "ab", "की", "न", "x1"], [" ", " ", "-", "--", " - ", "'", ". ", "-."]
    out = ["?!", "-", "'", "-a", "a-", "'ab", "b.", "a", "ab", "a b", "a-b", "की न"]
    while len(out) < n:
        out.append("".join(rng.choice(words) + (rng.choice(seps) if i < k else "") for k in [rng.randint(0, 3)] for i in range(k + 1)))
    return list(dict.fromkeys(p.strip() for p in out))


@pytest.mark.parametrize("seed", [1, 2])
def test_every_phrase_of_random_texts(spark, seed):
    rng = random.Random(seed)
    phrases = phrases_of(rng, 60)
    bits = ["a", "b", "ab", "की", "न", "x1", "q", " ", " ", " ", "-", "--", " - ", "'", ".", ". ", "?!"]
    texts = [re.sub(r"\s+", " ", "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))).strip() for _ in range(400)]
    lex = spark.createDataFrame([("T", 0, p, i) for i, p in enumerate(phrases)], LEX)
    seg = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text_norm string").repartition(3)
    got = {r.id: [x.phrase for x in r["_lex"]] for r in D.lexicon_hits(seg, lex, ["id"]).collect()}
    for i, t in enumerate(texts):
        assert got.get(i, []) == [p for p in phrases if stands(p, t)], t


def test_places_of_a_phrase(spark):
    lex = spark.createDataFrame([("T", 0, "a b", 0), ("T", 0, "b-a", 1), ("U", 1, "a b", 0)], LEX)
    seg = spark.createDataFrame([(1, "a b a b. ba"), (2, "a-b"), (3, "")], "id int, text_norm string")
    got = sorted((r.id, r.type, r.phrase, r.start) for r in D.phrase_postings(seg, lex, ["id"], positions=True).collect())
    assert got == [(1, "T", "a b", 0), (1, "T", "a b", 2), (1, "T", "b-a", 1), (1, "T", "b-a", 4), (1, "U", "a b", 0), (1, "U", "a b", 2)]


def test_empty_lexicon_and_texts(spark):
    seg = spark.createDataFrame([(1, "a"), (2, "")], "id int, text_norm string")
    assert D.lexicon_hits(seg, spark.createDataFrame([], LEX), ["id"]).count() == 0
    assert D.lexicon_hits(seg.limit(0), spark.createDataFrame([("T", 0, "a", 0)], LEX), ["id"]).count() == 0


def test_an_ngram_found_everywhere_is_dealt_out(spark):
    """One phrase in every segment: its postings meet the lexicon under many join keys."""
    seg = spark.range(4000).select(F.col("id"), F.lit("a b").alias("text_norm"))
    lex = spark.createDataFrame([("T", 0, "a b", 0)], LEX)
    plan = D.phrase_postings(seg, lex, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    salts = seg.select(F.pmod(F.xxhash64("id"), F.lit(D.SALTS)).alias("s")).groupBy("s").count().collect()
    assert len(salts) == D.SALTS and max(r["count"] for r in salts) < 4000 / D.SALTS * 1.5
    assert D.lexicon_hits(seg, lex, ["id"]).count() == 4000


def test_no_text_in_an_exchange(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"a b {i}") for i in range(50)], "doc_id int, text_norm string")
    docs.write.parquet(str(tmp_path / "d"))
    lex = spark.createDataFrame([("T", 0, "a b", 0), ("T", 0, "c d", 1)], LEX)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.lexicon_hits(spark.read.parquet(str(tmp_path / "d")), lex, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" in plan and below.count("FileScan") == 1
    # between the scan and the first exchange the text has become postings
    exchanged = below[:below.index("Generate")]
    assert "text_norm" not in exchanged
