"""Quality rules and a hashed n-gram likelihood ratio (built-in functions only).

Base rules count words, their code points, symbols, repeated lines and words
in repeated 5-word windows.  The model compares two multinomials over
``BUCKETS`` hashed word n-grams (one and two words): that of the trusted
texts (label ``quality`` = 1, at most ``MOST_TRUSTED`` of them) and that of
the whole raw corpus.  A document's score is the mean log ratio of its n-grams; the cut is the histogram edge
that tells the labelled good from the labelled bad best (balanced accuracy),
so every document is decided by one fixed number.

Defined results: null and empty texts have no words and fail the base rules;
the score of a text without words is 0; without labels of both kinds
nothing is rejected by the score; repeated rows are scored one by one; a
label row without a document counts for nothing, several labels of a
document count as good only if all are; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vaani.llm.shared import stored

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MOST_REPEATED = 20          # per cent
#: Buckets of the hashed n-grams; the model has a row for each, so its size is bounded.
BUCKETS = 1 << 16
#: Added to every bucket's count, as a share of the mean count of a bucket.
SMOOTHING = 0.1
#: Scores are cut at multiples of this.
GRAIN = 0.01
#: At most so many good documents make up the trusted counts (their ids, 16 bytes each, are broadcast).
MOST_TRUSTED = 20_000
MILLION = 1_000_000


def words_of(text: Column) -> Column:
    """The words, in order; the splitter's empty ends are no words."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), lambda w: w != "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _tail(values: Column, n: int) -> Column:
    """``values`` without its first ``n``."""
    return F.slice(values, n + 1, F.greatest(F.size(values) - n, F.lit(0)))


def _neighbours(values: Column, others: Column) -> Column:
    """Hash of each value and the other at its place; the last places, without another, mean nothing."""
    return F.zip_with(values, others, lambda a, b: F.xxhash64(a, b))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, words (their hashes), and the base counts of every document."""
    text = F.col("_text")
    df = docs.select(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select("doc_id", words_of(text).alias("words"), lines.alias("lines"),
                   (F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"))
    df = df.select("doc_id", hashes_of(F.col("words")).alias("words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
                   "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    # Windows of five grow from two words and four; each list is named twice, or the optimizer would build it anew for each step
    w = F.col("words")
    df = df.select("*", _neighbours(w, _tail(w, 1)).alias("two"))
    df = df.select("*", _neighbours(F.col("two"), _tail(F.col("two"), 2)).alias("four")).drop("two")
    df = df.select("*", F.size("words").cast("long").alias("n_words"),
                   F.slice(_neighbours(F.col("four"), _tail(w, 4)), 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))).alias("hashes")).drop("four")
    # only texts that repeat a window sort their windows: equal ones come together
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.select("*", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), F.sort_array(pairs)).otherwise(none).alias("grams")).drop("hashes")
    m = F.size("grams")

    def again(x: Column, k: Column) -> Column:
        g = F.col("grams")
        return ((k > 0) & (F.get(g, k - 1)["h"] == x["h"])) | ((k < m - 1) & (F.get(g, k + 1)["h"] == x["h"]))

    df = df.select("*", F.sort_array(F.transform(F.filter("grams", again), lambda x: x["i"])).alias("found"))
    k = F.size("found")
    steps = F.transform("found", lambda p, j: F.when(j == k - 1, WINDOW).otherwise(F.least(F.lit(WINDOW), F.get(F.col("found"), j + 1) - p)))
    repeated = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.select("doc_id", "words", "n_words", "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def buckets(words: Column) -> tuple[Column, Column]:
    """Buckets of all words, and of all pairs of neighbouring words."""
    def bucket(h: Column) -> Column:
        return h.bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int")

    left = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(words, bucket), F.zip_with(left, _tail(words, 1), lambda a, b: bucket(F.xxhash64(a, b)))


def trusted_ids(labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """(doc_id): at most ``most`` documents that are labelled good, by the smallest hashes of their ids."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good"))
    good = marks.where("good = 1 AND doc_id IS NOT NULL").select("doc_id")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def model(docs: DataFrame, labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """(bucket, ratio): log of the trusted over the raw share of each bucket that occurs, in millionths."""
    # both multinomials are counted in one pass; a task sends at most BUCKETS partial counts
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), hashes_of(words_of(F.col("text").cast("string"))).alias("words"))
    good = F.broadcast(stored(trusted_ids(labels, most), "trusted").withColumn("good", F.lit(True)))
    marked = words.join(good, "doc_id", "left").select(F.concat(*buckets(F.col("words"))).alias("buckets"), "good")
    both = (marked.select(F.explode("buckets").alias("bucket"), "good").groupBy("bucket")
            .agg(F.count("*").alias("raw"), F.count("good").alias("trusted")))
    both = stored(both, "ngrams")
    t = both.agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"), F.count("*").alias("n")).first()
    if not t.trusted:
        return both.select("bucket", F.lit(0).cast("long").alias("ratio"))
    add_raw, add_trusted = SMOOTHING * t.raw / t.n, SMOOTHING * t.trusted / t.n
    shift = math.log((t.raw + SMOOTHING * t.raw) / (t.trusted + SMOOTHING * t.trusted))
    ratio = F.log((F.col("trusted") + add_trusted) / (F.col("raw") + add_raw)) + shift
    return both.select("bucket", F.round(ratio * MILLION).cast("long").alias("ratio"))


def scores(docs: DataFrame, labels: DataFrame, most: int = MOST_TRUSTED) -> DataFrame:
    """Base counts and ``score`` of every document."""
    spark = docs.sparkSession
    # one array of BUCKETS numbers; a text's ratios are added up in its own row,
    # in whole millionths, so their order doesn't change a score
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(F.broadcast(model(docs, labels, most)), "bucket", "left")
    filled = F.struct("bucket", F.coalesce("ratio", F.lit(0).cast("long")).alias("ratio"))
    ratios = stored(every.agg(F.array_sort(F.collect_list(filled)).getField("ratio").alias("ratios")), "ratios")
    base = base_counts(docs).withColumn("_ratios", ratios.scalar())
    ones, pairs = buckets(F.col("words"))

    def total(found: Column) -> Column:
        return F.aggregate(found, F.lit(0).cast("long"), lambda a, b: a + F.get(F.col("_ratios"), b))

    n = 2 * F.col("n_words") - 1
    score = F.when(n > 0, (total(ones) + total(pairs)) / n / MILLION).otherwise(0.0)
    return base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", score.alias("score"))


def cut(scored: DataFrame, labels: DataFrame) -> float | None:
    """The score below which documents are rejected, from all labelled documents that pass the base rules."""
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("good")).where("good IS NOT NULL")
    seen = scored.where("NOT base_failed").select(F.col("doc_id").cast("long").alias("doc_id"), F.floor(F.col("score") / GRAIN).alias("step")).join(marks, "doc_id")
    by_step = seen.groupBy("step").agg(F.sum(F.expr("int(good = 1)")).alias("good"), F.sum(F.expr("int(good <> 1)")).alias("bad"))
    total = F.sum("good").over(W.partitionBy()), F.sum("bad").over(W.partitionBy())
    below = W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    best = (by_step.withColumn("gain", F.coalesce(F.sum("bad").over(below), F.lit(0)) / total[1] - F.coalesce(F.sum("good").over(below), F.lit(0)) / total[0])
            .where("gain IS NOT NULL").orderBy(F.desc("gain"), "step").select("step", "gain").first())
    return None if best is None or best.gain <= 0 else best.step * GRAIN


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = stored(scores(docs, labels), "scores")
    edge = cut(scored, labels)
    fine = F.lit(True) if edge is None else F.col("score") >= F.lit(edge)
    return scored.withColumn("kept", ~F.col("base_failed") & fine)
