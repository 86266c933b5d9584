"""Substring deduplication on a compacted de Bruijn graph of words.

The edges of the graph are windows of ``k`` words, its nodes the shorter
grams in which neighbouring edges overlap.  Edges are never shuffled one by
one: as in minimizer-partitioned assemblers, a run of neighbouring windows of
a text that share their lowest-hashed ``m``-gram is an unbranched path that
is known without a join (about five windows); only (minimizer, hash of the
path's words, document) is shuffled, to the minimizer.  Equal windows have
equal minimizers, so all copies of an edge meet there:

* a path that a smaller document has word for word repeats whole; two
  hashes, of the minimizer and of all words of the path, agree;
* paths that share a minimizer but differ (a text enters or leaves the
  repeat there, the graph branches) are opened into their edges, and the
  edges are joined by window hash.

Going back to each document, neighbouring repeated paths are compacted along
its own walk to maximal spans with their word coordinates, and the spans are cut.

Defined results: null and empty texts have no words; texts of fewer than
``k`` words lose nothing; a null ``doc_id`` takes no part and keeps its text;
rows with one ``doc_id`` don't remove each other's words; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from vaani.llm.shared import ready, stored
from vaani.llm.words import frames, gram_hashes, list_column, long_column, lowest, mix, packed, slices, span_hashes, split_words, word_hashes

K = 13
M = 5


class Paths:
    """The windows of one slice and the unbranched paths that they form."""

    def __init__(self, col, k: int, m: int):
        self.flat, self.offs = split_words(col)
        words = word_hashes(self.flat)
        counts = np.diff(self.offs)
        per_row = np.maximum(counts - k + 1, 0)
        self.row = np.repeat(np.arange(len(counts)), per_row)
        first = np.cumsum(per_row) - per_row
        self.start = np.arange(per_row.sum()) - np.repeat(first, per_row) + np.repeat(self.offs[:-1], per_row)
        grams = gram_hashes(words, m)
        at = lowest(grams, k - m + 1)[self.start] if len(self.start) else np.zeros(0, np.int64)
        new = np.concatenate([[True], at[1:] != at[:-1]]) if len(at) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        self.path = np.cumsum(new) - 1              # of each window
        end = np.append(begin[1:], len(at))
        self.path_row = self.row[begin]
        self.minimizer = grams[at[begin]] if len(begin) else np.zeros(0, np.uint64)
        self.context = span_hashes(words, self.start[begin], self.start[end - 1] + k if len(begin) else begin)
        self.words, self.k = words, k

    def windows(self) -> np.ndarray:
        return gram_hashes(self.words, self.k)[self.start] if len(self.start) else np.zeros(0, np.uint64)


def _tag(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One value for each pair of a row and a value."""
    return mix(values + (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def _marked(rows: np.ndarray, values: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each value is in the list of its row."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    wanted = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return np.isin(_tag(rows, values), _tag(np.repeat(np.arange(len(lists)), lengths), wanted))


def _paths(k: int, m: int):
    def cut(batches):
        for batch in batches:
            for part in slices(batch, 1):
                p = Paths(part.column(1), k, m)
                # a path that a text repeats is sent once
                _, one = np.unique(_tag(p.path_row, p.context), return_index=True)
                yield pa.record_batch([long_column(p.minimizer[one]), long_column(p.context[one]), part.column(0).take(pa.array(p.path_row[one]))],
                                      ["minimizer", "context", "doc"])
    return cut


def _edges(k: int, m: int):
    def cut(batches):
        for batch in batches:
            for part, text in frames(batch, 1):
                p = Paths(text, k, m)
                keep = _marked(p.path_row, p.minimizer, part.column(2))[p.path] if len(p.path) else np.zeros(0, bool)
                yield pa.record_batch([long_column(p.windows()[keep]), long_column(p.minimizer[p.path[keep]]), part.column(0).take(pa.array(p.row[keep]))],
                                      ["edge", "minimizer", "doc"])
    return cut


def _spans(k: int, m: int):
    def cut(batches):
        for batch in batches:
            for part, text in frames(batch, 1):
                p = Paths(text, k, m)
                gone = np.zeros(len(p.words) + 1, np.int64)
                if len(p.path):
                    hit = _marked(p.path_row, p.context, part.column(2))[p.path]
                    hit |= _marked(p.row, p.windows(), part.column(3))
                    np.add.at(gone, p.start[hit], 1)
                    np.add.at(gone, p.start[hit] + k, -1)
                gone = np.cumsum(gone)[:-1] > 0
                before = np.concatenate([[0], np.cumsum(~gone)])[p.offs]
                kept = pc.binary_join(list_column(p.flat.filter(pa.array(~gone)), before), " ")
                n = np.diff(p.offs)
                row = np.repeat(np.arange(len(n)), n)
                first = np.flatnonzero(gone & ~np.concatenate([[False], gone[:-1] & (row[1:] == row[:-1])])) if len(gone) else np.zeros(0, np.int64)
                last = np.flatnonzero(gone & ~np.concatenate([gone[1:] & (row[1:] == row[:-1]), [False]])) + 1 if len(gone) else first
                at = np.searchsorted(row[first], np.arange(len(n) + 1))
                base = p.offs[row[first]]
                yield pa.record_batch([
                    part.column(0), pa.array(n), pa.array(n - np.diff(before)),
                    list_column(pa.array((first - base).astype(np.int32)), at), list_column(pa.array((last - base).astype(np.int32)), at),
                    kept], ["doc_id", "n_words", "n_removed", "starts", "ends", "kept"])
    return cut


def repeats(docs: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """(doc, whole, cut): for each document that loses words, the hashes of
    paths and of single windows that a document with a smaller id has too."""
    ready(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).where("doc IS NOT NULL")
    paths = texts.mapInArrow(_paths(k, m), "minimizer long, context long, doc long")
    same, all_ = W.partitionBy("minimizer", "context"), W.partitionBy("minimizer")
    paths = (paths.withColumn("first", F.min("doc").over(same))
             .withColumn("lo", F.min("doc").over(all_)).withColumn("hi", F.max("doc").over(all_))
             .withColumn("c0", F.min("context").over(all_)).withColumn("c1", F.max("context").over(all_))
             .where("lo < hi"))
    # whole: a smaller document has the same path; open: the first of several different paths
    known = (paths.where("first < doc OR c0 < c1")
             .groupBy("doc").agg(F.collect_set(F.expr("CASE WHEN first < doc THEN context END")).alias("whole"),
                                 F.collect_set(F.expr("CASE WHEN first = doc THEN minimizer END")).alias("open")))
    known = stored(known, "paths")
    packs = texts.mapInArrow(packed(2), "doc long, text binary")
    opened = packs.join(known.where(F.size("open") > 0).select("doc", "open"), "doc").select("doc", "text", "open")
    edges = opened.mapInArrow(_edges(k, m), "edge long, minimizer long, doc long")
    edges = edges.withColumn("first", F.min("doc").over(W.partitionBy("edge", "minimizer"))).where("first < doc")
    cut = edges.groupBy("doc").agg(F.collect_set("edge").alias("cut"))
    return known.where(F.size("whole") > 0).select("doc", "whole").join(cut, "doc", "full")


def deduplicated(docs: DataFrame, k: int = K, m: int = M) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, the removed spans (starts, ends) in words, the kept words."""
    lists = stored(repeats(docs, k, m), "repeats")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    joined = texts.mapInArrow(packed(2), "doc long, text binary").join(lists, "doc", "left").select("doc", "text", "whole", "cut")
    return joined.mapInArrow(_spans(k, m), "doc_id long, n_words long, n_removed long, starts array<int>, ends array<int>, kept string")
