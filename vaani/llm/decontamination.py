"""Benchmark decontamination with a positional inverted index.

``build_index`` stores, for every document, the postings of all terms that
the benchmark uses (term, position), as a Parquet table in the shared folder;
the index is partitioned by document, so queries need no shuffle.
``search`` gives every benchmark window to the postings: the lists of a
window are shifted by the term's offset and intersected, rarest term first,
so that most windows end after one missing term.  Term frequencies are those
of the whole corpus.  The benchmark is the query set: it is taken in blocks of
at most about ``block`` windows, the only data that is broadcast.  With
``slop``, a window also matches by proximity: all its terms, in any order,
within as many consecutive words as it has plus ``slop``.  Places of its rarest
term are kept while every other term, rarest first, has a posting near enough;
a sweep over the postings around the places left decides.

Words are runs of letters, digits and non-ASCII characters, A-Z in lower
case.  Defined results: a null or empty text has no words and no hits; a null
text of an item or one without words has no window; an item of fewer words than
the window is one window; an item without an id is searched like any other and
counts for the words hit, but has no id to list; repeated rows are answered one
by one; a null ``doc_id`` stays null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from vaani.llm.shared import fresh, id_key, ready, same_columns, stored, text_of
from vaani.llm.words import ALNUM_LOWER, list_column, slices, split_words

WINDOW = 10
#: Windows of the benchmark in one block (each about 200 bytes where broadcast).
BLOCK = 200_000
#: Words that a proximity match of the query may have between those of the window.
SLOP = 5

INDEX_SCHEMA = "row long, doc_id long, n_words long, terms array<int>, positions array<int>"
HITS_SCHEMA = "row long, doc_id long, n_words long, hits array<int>, items array<string>, near array<string>"


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, words): each run of ``window`` consecutive words of each item."""
    def cut(batches):
        for batch in batches:
            for part in slices(batch, 1):
                flat, offs = split_words(part.column(1), ALNUM_LOWER)
                flat, items = flat.to_pylist(), part.column(0).to_pylist()
                ids, grams = [], []
                for item, a, b in zip(items, offs[:-1], offs[1:]):
                    for i in range(a, max(b - window, a) + 1 if b > a else a):
                        ids.append(item)
                        grams.append(flat[i:min(i + window, b)])
                yield pa.record_batch([pa.array(ids, pa.string()), pa.array(grams, pa.list_(pa.string()))],
                                      ["item_id", "words"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return items.mapInArrow(cut, "item_id string, words array<string>").distinct()


def build_index(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Postings of ``terms`` in all documents: a stored table, one row a document."""
    wanted = docs.sparkSession.sparkContext.broadcast(terms)

    def post(batches):
        vocabulary = pa.array(wanted.value, pa.string())
        size = max(1, len(vocabulary))
        for batch in batches:
            for part in slices(batch, 2):
                flat, offs = split_words(part.column(2), ALNUM_LOWER)
                ids = pc.index_in(flat, value_set=vocabulary)
                at = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
                term = ids.drop_null().to_numpy(zero_copy_only=False)
                row = np.searchsorted(offs, at, side="right") - 1
                order = np.argsort(row * size + term, kind="stable")
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.record_batch([
                    part.column(0), part.column(1), pa.array(np.diff(offs)),
                    list_column(pa.array(term[order].astype(np.int32)), ends),
                    list_column(pa.array((at - offs[row])[order].astype(np.int32)), ends),
                ], ["row", "doc_id", "n_words", "terms", "positions"])

    return stored(docs.select("row", "doc_id", "text").mapInArrow(post, INDEX_SCHEMA), "postings")


def term_counts(index: DataFrame, size: int) -> dict[int, int]:
    """How often each indexed term occurs in the corpus."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["term", "n"])

    rows = index.select("terms").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    return {r.term: r.n for r in rows}          # at most one row for each benchmark term


def _plans(grams: dict[tuple, list[str]], code: dict[str, int], counts: dict[int, int]) -> dict:
    """Windows by their rarest term: (offset, the other (term, offset) by rarity, length, items)."""
    plans = defaultdict(list)
    for words, items in grams.items():
        probes = sorted(((code[w], i) for i, w in enumerate(words)), key=lambda p: (counts.get(p[0], 0), p))
        if counts.get(probes[0][0], 0):
            plans[probes[0][0]].append((probes[0][1], probes[1:], len(words), items))
    return dict(plans)


def _near(lists: list[list[int]], span: int) -> bool:
    """Whether some ``span`` consecutive positions hold a posting of every list (sorted; the rarest term's first)."""
    places = lists[0]
    for other in lists[1:]:
        places = [p for p in places if (k := bisect_left(other, p - span + 1)) < len(other) and other[k] < p + span]
        if not places:
            return False
    return any(_together([o[bisect_left(o, p - span + 1):bisect_left(o, p + span)] for o in lists], span) for p in places)


def _together(lists: list[list[int]], span: int) -> bool:
    """The same by a sweep over all postings."""
    merged = sorted((p, i) for i, ps in enumerate(lists) for p in ps)
    have, missing, left = [0] * len(lists), len(lists), 0
    for p, i in merged:
        missing -= have[i] == 0
        have[i] += 1
        while merged[left][0] <= p - span:
            j = merged[left][1]
            have[j] -= 1
            missing += have[j] == 0
            left += 1
        if not missing:
            return True
    return False


def match_document(terms: np.ndarray, positions: np.ndarray, plans: dict, slop: int | None = None):
    """Positions covered by phrase matches, items with one, items with a proximity match (each once; None: no id)."""
    if len(terms) == 0:
        return np.zeros(0, np.int32), [], []
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    ends = np.append(starts[1:], len(terms))
    where = {int(terms[s]): (s, e) for s, e in zip(starts, ends)}
    sets: dict[int, set] = {}
    lists: dict[int, list] = {}
    found, items, near = [], set(), set()
    for term in where.keys() & plans.keys():
        s, e = where[term]
        mine = positions[s:e].tolist()
        for offset, rest, length, ids in plans[term]:
            if not all(t in where for t, _ in rest):
                continue
            begin = [p - offset for p in mine]
            for t, o in rest:
                if t not in sets:
                    sets[t] = set(positions[slice(*where[t])].tolist())
                postings = sets[t]
                begin = [b for b in begin if b + o in postings]
                if not begin:
                    break
            if begin:
                items.update(ids)
                found.extend((b, length) for b in begin)
            if slop is None or near.issuperset(ids):
                continue
            for t, _ in rest:
                if t not in lists:
                    lists[t] = positions[slice(*where[t])].tolist()
            if begin or _near([mine, *(lists[t] for t in dict.fromkeys(t for t, _ in rest) if t != term)], length + slop):
                near.update(ids)
    hit = {p for b, n in found for p in range(b, b + n)}
    return np.array(sorted(hit), np.int32), sorted(items - {None}), sorted(near - {None})


def search(index: DataFrame, plans: dict, slop: int | None = None) -> DataFrame:
    """Phrase (and with ``slop`` proximity) matches of the windows in every document of the index."""
    given = index.sparkSession.sparkContext.broadcast(plans)

    def look(batches):
        wanted = given.value
        for batch in batches:
            terms, positions = batch.column(3), batch.column(4)
            out = []
            for i in range(batch.num_rows):
                t, p = terms[i].values, positions[i].values
                out.append(match_document(t.to_numpy(), p.to_numpy(), wanted, slop) if t is not None and len(t)
                           else (np.zeros(0, np.int32), [], []))
            yield pa.record_batch([
                *(batch.column(i) for i in range(3)),
                pa.array([x[0] for x in out], pa.list_(pa.int32())),
                *(pa.array([x[k] for x in out], pa.list_(pa.string())) for k in (1, 2)),
            ], ["row", "doc_id", "n_words", "hits", "items", "near"])

    return index.mapInArrow(look, HITS_SCHEMA)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = None,
            block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, hits (positions), items, near (items)."""
    spark = docs.sparkSession
    ready(spark)
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    cut = stored(windows(benchmark, window), "windows")
    blocks = max(1, -(-cut.count() // block))
    if blocks > 1:
        docs = stored(docs, "documents")        # the row numbers must be the same for each block
    parts = []
    for b in range(blocks):
        grams = defaultdict(list)
        for r in cut.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).toLocalIterator():
            grams[tuple(r.words)].append(r.item_id)
        terms = sorted({w for g in grams for w in g})
        index = build_index(docs, terms)
        plans = _plans(grams, {w: i for i, w in enumerate(terms)}, term_counts(index, max(1, len(terms))))
        parts.append(search(index, plans, slop))
    if blocks == 1:
        return parts[0].drop("row")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return (every.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("hits", "items", "near")))
        .drop("row"))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per document: counts of hit words and of items, a digest of the item ids, the verdict; items near by ``slop``."""
    def digest(batches):
        for batch in batches:
            items = batch.column(3).to_pylist()
            yield pa.record_batch([
                batch.column(0), batch.column(1), batch.column(2),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
                pc.greater(batch.column(2), 0),
                pa.array([",".join(x) for x in items], pa.string()),
                *(pa.array([f(x) for x in batch.column(4).to_pylist()], t) for f, t in ((len, pa.int64()), (",".join, pa.string()))),
            ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "n_near", "near_items"])

    found = matches(docs, benchmark, **options)
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), "items", "near").mapInArrow(
        digest, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items string, n_near long, near_items string")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, whole and with all their columns.

    A document is known by its id and text, so that rows sharing an id do
    not fall together.
    """
    names = docs.columns
    key = fresh(docs, "_doc_key")
    keyed = docs.withColumn(key, F.xxhash64(id_key("doc_id"), text_of("text")))
    probe = keyed.select(F.col(key).alias("doc_id"), "text")
    found = matches(probe, benchmark, **options).where(F.size("hits") > 0).select(F.col("doc_id").alias(key)).distinct()
    return same_columns(keyed.join(found, key, "left_anti"), names)
