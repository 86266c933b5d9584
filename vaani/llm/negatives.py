"""Hard-negative mining: the best negatives below each positive, by disjoint score slots.

An anchor's positives are its nearest rows of its own label.  Each positive
opens a window of scores, from ``LOW`` % of its own score up to that score,
and wants the first ``k`` rows of other labels in it.  The windows overlap,
so they are not searched one by one: the positives' scores, the upper limits,
split the scores into disjoint slots, (next lower limit, limit]; every task
keeps the ``k`` best rows of each slot, partial lists are merged slot by
slot, and one descending pass over the slots answers all windows: the first
``k`` rows at or below a limit are the first ``k`` of its slot and all lower
ones together, and those above the window's lower end are a prefix of them.

The anchors are the query set.  They are taken in blocks of at most about
``BLOCK_VALUES`` components, which is all that is broadcast; each block goes
over all rows twice, once for the positives and once for the slots.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; shorter vectors count as filled up with
zeros; rows that share an id are rows of their own, but none is a positive
of an anchor of its id; equal anchors are answered once; a positive below 0
has an empty window; scores beyond 64 bits are cut to that range; empty
tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from vaani.llm.shared import ready, scratch, stored

POSITIVES = NEGATIVES = 5
#: A window reaches from so many per cent of the positive's score up to the score itself.
LOW = 80
#: Every so manieth id is an anchor.
EVERY = 100
SCALE = 256
#: Components of the anchors that are broadcast at a time (8 bytes each).
BLOCK_VALUES = 1 << 20
#: Scores that a task holds at a time.
TILE = 1 << 21
#: Up to this size sums of products are exact in double precision.
EXACT = float(1 << 53)

LIST_SCHEMA = "anchor int, slot int, score long, vec_id long"


def prepared(embeddings: DataFrame, relabel: int | None = 7) -> DataFrame:
    """(vec_id, label, v): rows that take part, their components scaled to whole numbers."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    if relabel:
        label = F.when(F.pmod(F.col("vec_id").cast("long"), F.lit(relabel)) == 0, F.pmod(label + 1, F.lit(10))).otherwise(label)
    big = F.lit(float(1 << 62))
    whole = F.transform(v, lambda x: F.least(F.greatest(F.floor(x * SCALE), -big), big).cast("long"))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), whole.alias("v")))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled up with zeros to ``width``."""
    ends = vectors.offsets.to_numpy()
    flat, size = vectors.flatten().to_numpy(zero_copy_only=False), np.diff(ends)
    if len(size) and (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], size)] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices, as 64-bit numbers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -2**63, 2**63 - 1).astype(np.int64)


class Best:
    """The first ``k`` (highest score, then smallest id) of each of ``n`` lists, filled tile by tile."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.lists, self.scores, self.ids = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(n, np.iinfo(np.int64).min)      # the score that an entry of a full list must reach

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        near = scores >= self.least[lists]
        lists, scores, ids = (np.concatenate([x, y[near]]) for x, y in ((self.lists, lists), (self.scores, scores), (self.ids, ids)))
        order = np.lexsort((ids, ~scores, lists))                # ~ turns the order of the scores round
        lists, scores, ids = lists[order], scores[order], ids[order]
        place = np.arange(len(lists)) - np.searchsorted(lists, lists)
        keep = place < self.k
        self.lists, self.scores, self.ids = lists[keep], scores[keep], ids[keep]
        full = place[keep] == self.k - 1
        self.least[self.lists[full]] = self.scores[full]


def _tiles(batches, anchors: np.ndarray):
    """(ids, labels, scores of all anchors with these rows), at most ``TILE`` scores at a time."""
    step = max(1, TILE // max(1, len(anchors)))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield (part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False),
                   products(anchors, _matrix(part.column(2), anchors.shape[1])))


def _lists(best: Best, slots: int) -> pa.RecordBatch:
    return pa.record_batch([pa.array((best.lists // slots).astype(np.int32)), pa.array((best.lists % slots).astype(np.int32)),
                            pa.array(best.scores), pa.array(best.ids)], ["anchor", "slot", "score", "vec_id"])


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each slot over all tasks; each task sends at most ``k`` of a slot."""
    first = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def positives(rows: DataFrame, block, k: int = POSITIVES) -> DataFrame:
    """(anchor, rank, score, vec_id): the nearest rows of each anchor's own label."""
    def look(batches):
        ids, labels, vectors = block.value
        best = Best(len(ids), k)
        for row_ids, row_labels, scores in _tiles(batches, vectors):
            a, r = np.nonzero((labels[:, None] == row_labels) & (ids[:, None] != row_ids) & (scores >= best.least[:, None]))
            best.add(a, scores[a, r], row_ids[r])
        yield _lists(best, 1)

    return _merged(rows.mapInArrow(look, LIST_SCHEMA), k).drop("slot")


def slot_lists(rows: DataFrame, block, limits, k: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """(anchor, slot, score, vec_id): the first ``k`` rows of another label in each slot.

    ``limits`` has an anchor's distinct upper limits, falling, filled up with
    numbers below every score; a row's slot is that of the lowest limit it doesn't pass.
    """
    def look(batches):
        ids, labels, vectors = block.value
        ends = limits.value
        slots = ends.shape[1]
        used = ends >= 0
        last = np.where(used, ends, np.iinfo(np.int64).max).min(axis=1)
        floor_ = np.where(used.any(axis=1), [-(-low * int(x) // 100) for x in last], 1)    # below the lowest window
        top = np.where(used.any(axis=1), ends[:, 0], 0)
        best = Best(len(ids) * slots, k)
        for row_ids, row_labels, scores in _tiles(batches, vectors):
            a, r = np.nonzero((scores <= top[:, None]) & (scores >= floor_[:, None]) & (labels[:, None] != row_labels))
            s = scores[a, r]
            slot = (ends[a] >= s[:, None]).sum(axis=1) - 1
            best.add(a * slots + slot, s, row_ids[r])
        yield _lists(best, slots)

    return _merged(rows.mapInArrow(look, LIST_SCHEMA), k).drop("rank")


def windows(near: DataFrame, lists: DataFrame, k: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """The first ``k`` rows of each positive's window, from the slots at and below its limit.

    Slots fall with their number and each is sorted, so the rows of slots
    s, s + 1, ... in that order are a descending merge of the suffix.
    """
    slots = lists.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct(
        "slot", (-F.col("score")).alias("falling"), "vec_id"))).alias("rows"))          # k rows of each slot at most
    suffix = F.slice(F.filter("rows", lambda x: x["slot"] >= F.col("slot")), 1, k)
    within = F.filter(suffix, lambda x: F.lit(-100) * x["falling"] >= low * F.col("score"))
    return (near.where("score >= 0").join(slots, "anchor").select("anchor", "vec_id", "score", F.posexplode(within).alias("rank", "row"))
            .select("anchor", F.col("vec_id").alias("positive_id"), (F.col("rank") + 1).cast("int").alias("rank"),
                    F.col("row.vec_id").alias("negative_id"), F.col("score").alias("positive_score"), (-F.col("row.falling")).alias("negative_score")))


def mined(embeddings: DataFrame, every: int = EVERY, positives_of: int = POSITIVES, negatives_of: int = NEGATIVES,
          low: int = LOW, relabel: int | None = 7, block_values: int = BLOCK_VALUES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of all anchors."""
    spark = embeddings.sparkSession
    ready(spark)
    rows = stored(prepared(embeddings, relabel), "vectors")
    anchors = stored(rows.where(F.pmod("vec_id", F.lit(every)) == 0).distinct(), "anchors")
    size = anchors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = max(1, size.width or 0)
    blocks = max(1, -(-size.n * width // block_values))
    out = scratch(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(out)
    for b in range(blocks):
        # a block of anchors and their positives are bounded by block_values
        mine = anchors.where(F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(blocks)) == b).orderBy("vec_id", "label", "v").toArrow()
        if not mine.num_rows:
            continue
        ids, labels = (mine.column(i).to_numpy() for i in (0, 1))
        block = spark.sparkContext.broadcast((ids, labels, _matrix(mine.column(2).combine_chunks(), width)))
        near = positives(rows, block, positives_of).toPandas()
        limits = np.full((len(ids), positives_of), -1, np.int64)
        found = near[near.score >= 0][["anchor", "score"]].drop_duplicates().sort_values(["anchor", "score"], ascending=[True, False])
        found["slot"] = found.groupby("anchor").cumcount()
        limits[found.anchor, found.slot] = found.score
        near = near.merge(found, on=["anchor", "score"], how="inner")
        lists = slot_lists(rows, block, spark.sparkContext.broadcast(limits), negatives_of, low)
        answers = windows(spark.createDataFrame(near[["anchor", "slot", "score", "vec_id"]], "anchor int, slot int, score long, vec_id long"),
                          lists, negatives_of, low)
        names = spark.createDataFrame(list(enumerate(ids.tolist())), "anchor int, anchor_id long")
        answers.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.mode("append").parquet(out)
    return spark.read.schema(schema).parquet(out)


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM (SELECT * FROM rows WHERE vec_id % 100 = 0) a, rows r),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INT AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 5"""
