"""Mixing sources to target weights with nested hash thresholds (built-in functions only).

A document's place in its source is fixed by the hexadecimal MD5 of its id
and text.  A source whose target is ``c`` whole copies of itself and a rest
takes every document ``c`` times and those below a hash threshold once
more, so a mix with a larger target contains the smaller one.  The threshold
is found without sorting: words are summed by source and leading hash
digits, the running sum names the bucket in which the target falls, and only
that bucket is summed again by its next digits, until it holds rows of one
hash, that is equal rows, which are numbered.

Defined results: null and empty texts have size 0; a null source is a source
of its own, ranked last; sources of size 0 have target 0; null ids are kept
and hashed as empty; equal rows are told apart by number only, so reruns
give the same rows; other columns are ignored (``mixed`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from vaani.llm.shared import fresh, same_columns, stored, text_of

#: Fixed values of the mix: weights by rank of the source, the share, most copies.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Hexadecimal digits of a hash and how many one pass refines.
DIGITS, STEP = 32, 3
#: Up to so many sources their thresholds are sent to all tasks (80 bytes each).
SENT_SOURCES = 50_000


def size_of(text: Column) -> Column:
    """Words, as runs without ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def hash_of(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) from rows (source, size).

    The share is dealt out by weight.  A source at its ceiling passes the
    excess on; with the sources in order of ceiling over weight, the first
    whose ceiling exceeds its part of what those before it leave fixes the
    level for it and all after it.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), F.pmod(rank - 1, F.lit(len(WEIGHTS))).cast("int") + 1)
    per = per.withColumn("weight", weight).withColumn("ceiling", F.col("source_size") * MOST)
    order = W.orderBy((F.col("ceiling") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(whole) * F.lit(SHARE) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))) / F.sum("weight").over(after)
    per = per.withColumn("level", level)
    met = F.when(F.col("ceiling") >= F.col("level") * F.col("weight"), F.col("level"))
    return per.withColumn("level", F.first(met, ignorenulls=True).over(whole)).select(
        "source", "source_size", "weight",
        F.coalesce(F.least(F.col("ceiling").cast("double"), F.col("level") * F.col("weight")), F.col("ceiling").cast("double")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, edge, left): documents whose hash is below ``edge`` are taken once
    more, ``left`` words are left for those of just this hash."""
    goals = goals.select("source", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("copies"),
                         "target", "source_size").select(
        "source", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("left"), F.lit("").alias("prefix"))
    goals = stored(goals, "thresholds")
    for done in range(0, DIGITS, STEP):
        # after the first pass, only the rows of one bucket of each source are read on
        inside = rows.join(goals.withColumnRenamed("source", "s"), _same(rows["source"], F.col("s"))
                           & (F.substring("hash", 1, done) == F.col("prefix")))
        sums = inside.where("size > 0").groupBy("s", "copies", "left", F.substring("hash", 1, done + STEP).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("first"), F.max("hash").alias("last"))
        run = F.sum("words").over(W.partitionBy("s").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow))
        # the bucket in which the target falls; none if all of the source is taken
        edge = sums.withColumn("upto", run).where(F.col("upto") > F.col("left")).groupBy("s", "copies").agg(F.min(F.struct(
            "bucket", (F.col("left") - F.col("upto") + F.col("words")).alias("left"), "first", "last")).alias("e"))
        goals = stored(edge.select(F.col("s").alias("source"), "copies", "e.left", F.col("e.bucket").alias("prefix"), "e.first", "e.last"), "thresholds")
        if goals.where("first <> last").isEmpty():      # each bucket is down to one hash
            break
        goals = goals.drop("first", "last")
    return goals.select("source", "left", F.col("first").alias("edge"))


def mix(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target of its source, taken, copies."""
    rows = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text").cast("string")).alias("size"),
                              hash_of(F.col("doc_id"), F.col("text").cast("string")).alias("hash")), "sizes")
    goals, cuts = _decide(rows)
    return _taken(rows, goals, cuts).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _decide(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    goals = stored(targets(rows.select("source", "size")), "targets")
    return goals, thresholds(rows, goals)


def _taken(rows: DataFrame, goals: DataFrame, cuts: DataFrame) -> DataFrame:
    """``rows`` (source, size, hash and others) with source_size, target and copies."""
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    g = goals.select(F.col("source").alias("g_source"), "source_size", "target", base.alias("base"))
    c = cuts.select(F.col("source").alias("c_source"), "edge", "left")
    small = g.join(c, _same(F.col("g_source"), F.col("c_source")), "left").drop("c_source")
    # sources are few; their number is checked before their thresholds are sent to all tasks
    small = F.broadcast(small) if goals.count() <= SENT_SOURCES else small
    out = rows.join(small, _same(rows["source"], F.col("g_source")), "left").drop("g_source")
    # equal rows at the threshold are numbered; all other rows are decided by their hash alone
    tied = F.col("hash").eqNullSafe(F.col("edge")) & (F.col("size") > 0)
    full = F.col("edge").isNull() & (F.col("target") > F.col("base") * F.col("source_size"))
    sure = out.where(~tied).withColumn("more", (F.col("size") > 0) & F.coalesce(F.col("hash") < F.col("edge"), full))
    before = (F.row_number().over(W.partitionBy("source", "hash").orderBy("hash")) - 1) * F.col("size")
    edge = out.where(tied).withColumn("more", 2 * before + F.col("size") <= 2 * F.col("left"))
    out = sure.unionByName(edge)
    return out.withColumn("copies", F.col("base") + F.col("more").cast("long")).drop("more", "edge", "left", "base")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all columns and ``mix_copies``, how often each is taken."""
    names, out = docs.columns, fresh(docs, "mix_copies")
    alone = docs.select(F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in names)).alias("doc"),
                        F.col("source").cast("string").alias("source"), size_of(F.col("text").cast("string")).alias("size"),
                        hash_of(F.col("doc_id"), F.col("text").cast("string")).alias("hash"))
    rows = stored(alone.select("source", "size", "hash"), "sizes")
    goals, cuts = _decide(rows)
    return (_taken(alone, goals, cuts).where((F.col("copies") > 0) | (F.col("size") == 0))
            .select("doc.*", F.col("copies").alias(out)))


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS h
  FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY encode(source) ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM rows GROUP BY source),
lev AS (
  SELECT *, 2 * source_size AS ceiling,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
          - CAST(coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM per WINDOW o AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, encode(source) NULLS LAST)),
one AS (
  SELECT arg_min(level, n) AS level FROM (
    SELECT *, row_number() OVER (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, encode(source) NULLS LAST) AS n FROM lev)
  WHERE CAST(ceiling AS DOUBLE) >= level * weight),
goal AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), one.level * weight) AS target FROM lev, one),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM goal),
run AS (
  SELECT r.doc_id, r.size, p.source_size, p.target, p.base, p.target - p.base * p.source_size AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM rows r JOIN parts p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (base + CASE WHEN size > 0 AND rest > 0
                                 AND (upto <= rest OR 2 * (upto - size) + size <= 2 * rest) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM run
"""
