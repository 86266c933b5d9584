"""Ranked lexical search over an index of geometric blocks.

The postings of the items' terms are stored by document with their counts
(``postings``; whole texts, all documents), so that one more pass knows the
corpus figures.  ``build_index`` then makes shards of at most ``SHARD``
postings.  In a shard each term's posting list is clustered by document
similarity, as the nearest of ``PIVOTS`` documents says, and cut into blocks
where the cluster changes; each block stores the coordinatewise maximum of
its documents' vectors.  A vector holds the whole number that one occurrence
weight is multiplied with, so weight times maximum, added up over an item's
terms, is an exact upper bound of every score in the block.

``search`` takes the items, the query set, to every shard: blocks are
skipped only if their bound is below the score of the worst of the best
``k`` found so far (and a document in a skipped block can't be an answer, so
it is left out of the other blocks, too); so are whole lists whose maxima
stay below it even together.  The documents left are scored in full.  Each task sends ``k`` documents an item.  Items come in blocks of at
most about ``BLOCK_TERMS`` terms, the only data that is broadcast.

Score (64-bit whole numbers): a term's weight is floor(1000 * ln((2N + 2) /
(2 df + 1))) and a document's m is 75 + (25 n N) div L; the score adds
weight * ((10**9 tf) div (1000 tf + 12 m)) over the item's terms, repeats
included.

Defined results: terms are runs of ASCII letters and digits and non-ASCII
characters, A-Z in lower case; a null or empty text has no terms, is never an
answer and doesn't count; an item without terms has no answers; repeated
documents and items are answered one by one; documents with equal scores are
ordered by id, a null id last; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from vaani.llm.shared import NULL_ID, ready, stored
from vaani.llm.words import ALNUM_LOWER, list_column, slices, split_words

K = 20
#: Postings of one shard, about (a document is never cut).
SHARD = 1 << 18
PIVOTS = 32
#: A block grows over cluster borders until it has so many documents.
LEAST_BLOCK = 256
#: Smaller blocks (ends of lists, short lists) have no maxima: looking at their documents costs no more.
SMALL = 64
#: A shard's vectors are spread out for the maxima up to so many cells of 4 bytes.
DENSE = 1 << 24
#: Up to this size sums of whole numbers are exact in double precision.
EXACT = 1 << 53
#: Terms (with repeats) of the items of one block.
BLOCK_TERMS = 1 << 20

POSTINGS_SCHEMA = "doc_id long, n long, terms array<int>, counts array<int>"
#: A shard: document ids; documents and parts of the posting lists, cut into blocks (``block_ends``), the lists'
#: terms, first blocks and highest parts; and for each list's term the blocks that hold it with their maxima.
INDEX = ["ids", "docs", "parts", "block_ends", "list_terms", "list_blocks", "list_most", "sum_ends", "sum_blocks", "sum_parts"]
INDEX_SCHEMA = "n_docs int, shard binary"
ANSWER_SCHEMA = "item int, doc_id long, score long"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, words): the terms of each item, in order."""
    def cut(batches):
        for batch in batches:
            for part in slices(batch, 1):
                flat, offs = split_words(part.column(1), ALNUM_LOWER)
                yield pa.record_batch([part.column(0), list_column(flat.cast(pa.string()), offs)], ["item_id", "words"])

    return items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(
        cut, f"item_id {items.schema['item_id'].dataType.simpleString()}, words array<string>")


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """One row for each document with terms: their number, and the wanted terms with their counts."""
    wanted = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def post(batches):
        values = pa.array(wanted.value, pa.string())
        size = max(1, len(values))
        for batch in batches:
            for part in slices(batch, 1):
                flat, offs = split_words(part.column(1), ALNUM_LOWER)
                code = pc.index_in(flat, value_set=values)
                at = np.flatnonzero(code.is_valid().to_numpy(zero_copy_only=False))
                row = np.searchsorted(offs, at, side="right") - 1
                key, count = np.unique(row * size + code.drop_null().to_numpy(zero_copy_only=False), return_counts=True)
                ends = np.searchsorted(key, np.arange(part.num_rows + 1) * size)
                out = pa.record_batch([part.column(0), pa.array(np.diff(offs)), list_column(pa.array((key % size).astype(np.int32)), ends),
                                       list_column(pa.array(count.astype(np.int32)), ends)], ["doc_id", "n", "terms", "counts"])
                yield out.filter(pc.greater(out.column(1), 0))

    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(post, POSTINGS_SCHEMA), "postings")


def document_counts(posted: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term."""
    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        seen = np.flatnonzero(total)
        yield pa.record_batch([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["term", "n"])

    out = np.zeros(size, np.int64)
    for r in posted.select("terms").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.term] = r.n                            # one row for each wanted term
    return out


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after the other."""
    size = ends - starts
    return np.repeat(starts - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def clusters(ends: np.ndarray, terms: np.ndarray, parts: np.ndarray, size: int, pivots: int = PIVOTS) -> np.ndarray:
    """For each document of a shard the place of its nearest pivot, similar pivots side by side."""
    n = len(ends) - 1
    length = np.sqrt(np.add.reduceat(np.append(parts, 0).astype(np.float64)**2, ends[:-1]) * (np.diff(ends) > 0)) + 1e-9
    chosen = np.unique(np.linspace(0, n - 1, min(pivots, n)).astype(np.int64))
    best, cluster, vectors = np.full(n, -1.0), np.zeros(n, np.int64), []
    for place, p in enumerate(chosen):
        vector = np.zeros(size)
        vector[terms[ends[p]:ends[p + 1]]] = parts[ends[p]:ends[p + 1]] / length[p]
        near = np.add.reduceat(np.append(vector[terms] * parts, 0), ends[:-1]) * (np.diff(ends) > 0) / length
        cluster[near > best] = place
        best = np.maximum(best, near)
        vectors.append(near[chosen])
    # a chain from pivot to the nearest one that is left
    alike, chain = np.array(vectors), [0]
    while len(chain) < len(chosen):
        row = alike[chain[-1]].copy()
        row[chain] = -1
        chain.append(int(row.argmax()))
    place = np.empty(len(chosen), np.int64)
    place[chain] = np.arange(len(chosen))
    return place[cluster]


def _maxima(doc: np.ndarray, ends: np.ndarray, column: np.ndarray, parts: np.ndarray, width: int):
    """A function from documents to the coordinatewise maximum of their vectors: its places and values."""
    n = len(ends) - 1
    if n * width <= DENSE:
        table = np.zeros((n, width), np.int32)
        table[doc, column] = parts

        def dense(members):
            top = table[members].max(axis=0)
            seen = np.flatnonzero(top)
            return seen, top[seen]
        return dense

    def sparse(members):
        at = _ranges(ends[members], ends[members + 1])
        order = np.lexsort((parts[at], column[at]))
        columns = column[at][order]
        last = np.flatnonzero(np.append(columns[1:] != columns[:-1], True))
        return columns[last], parts[at][order][last]
    return sparse


def shard(ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, parts: np.ndarray, size: int, least: int = LEAST_BLOCK) -> dict[str, np.ndarray]:
    """The index of some documents: the blocks of every posting list, and their maxima by term."""
    doc = np.repeat(np.arange(len(ids)), np.diff(ends))
    cluster = clusters(ends, terms, parts, size)
    order = np.lexsort((doc, cluster[doc], terms))
    docs, listed, group = doc[order], terms[order], cluster[doc[order]]
    new_list = np.append(True, listed[1:] != listed[:-1])
    lists = np.flatnonzero(new_list)
    # a block ends with its list, and at a border of clusters once it is large enough
    border = np.flatnonzero(new_list | np.append(True, group[1:] != group[:-1]))
    cut, since = [], 0
    for at, first in zip(border.tolist(), new_list[border].tolist()):
        if first or at - since >= least:
            cut.append(at)
            since = at
    cut = np.array(cut + [len(docs)], np.int64)
    most = _maxima(doc, ends, np.searchsorted(listed[lists], terms), parts, len(lists))
    large = np.flatnonzero(np.diff(cut) >= SMALL)
    found = [most(docs[cut[b]:cut[b + 1]]) for b in large]
    columns, values = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
    blocks = np.repeat(large, [len(x[0]) for x in found])
    by_term = np.argsort(columns, kind="stable")
    return dict(zip(INDEX, (ids, docs, parts[order], cut, listed[lists], np.append(np.searchsorted(cut, lists), len(cut) - 1),
                            np.maximum.reduceat(parts[order], lists), np.searchsorted(columns[by_term], np.arange(len(lists) + 1)),
                            blocks[by_term], values[by_term])))


def packed_shard(made: dict[str, np.ndarray]) -> bytes:
    """A shard's arrays as one compressed value: readers that hold many rows of a table hold a few MB."""
    row = pa.record_batch([list_column(pa.array(made[name].astype(np.int64 if name == "ids" else np.int32)), [0, len(made[name])]) for name in INDEX], INDEX)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


def unpacked_shard(value: pa.Buffer) -> dict[str, np.ndarray]:
    row = pa.ipc.open_stream(value).read_next_batch()
    return {name: row.column(i).flatten().to_numpy(zero_copy_only=False) for i, name in enumerate(INDEX)}


def build_index(posted: DataFrame, size: int, n_docs: int, n_terms: int) -> DataFrame:
    """A stored table with one row for each shard."""
    def row(kept: list[tuple]) -> pa.RecordBatch:
        ids, n, widths, terms, counts = (np.concatenate(x) for x in zip(*kept))
        tf = counts.astype(np.int64)
        m = 75 + (25 * n * n_docs) // n_terms
        parts = (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, widths))
        made = shard(ids, np.append(0, np.cumsum(widths)), terms.astype(np.int64), parts, size)
        return pa.record_batch([pa.array([len(ids)], pa.int32()), pa.array([packed_shard(made)], pa.binary())], ["n_docs", "shard"])

    def build(batches):
        kept, held = [], 0
        for batch in batches:
            ids, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            offs = batch.column(2).offsets.to_numpy().astype(np.int64)
            terms, counts = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (2, 3))
            offs = offs - offs[0]
            start = 0
            while start < len(ids):
                stop = max(start + 1, int(np.searchsorted(offs, offs[start] + SHARD - held, side="right")) - 1)
                kept.append((ids[start:stop], n[start:stop], np.diff(offs[start:stop + 1]), terms[offs[start]:offs[stop]], counts[offs[start]:offs[stop]]))
                held += int(offs[stop] - offs[start])
                if held >= SHARD or stop < len(ids):
                    yield row(kept)
                    kept, held = [], 0
                start = stop
        if kept:
            yield row(kept)

    return stored(posted.where(F.size("terms") > 0).mapInArrow(build, INDEX_SCHEMA), "shards")


def candidates(index: dict[str, np.ndarray], mine: np.ndarray, worth: np.ndarray, worst: int) -> np.ndarray:
    """Which documents may score ``worst`` or more, by the lists of an item and the terms' weights.

    Lists whose highest parts all together stay below ``worst`` open no block:
    a document of no other list can't reach it.  A document of the other
    lists is left if none of its blocks has a bound below ``worst``.
    """
    highest = worth * index["list_most"][mine]
    order = np.argsort(highest, kind="stable")
    opened = mine[order[np.cumsum(highest[order]) >= worst]]
    blocks = _ranges(index["list_blocks"][opened], index["list_blocks"][opened + 1])
    may, ends = np.zeros(len(index["ids"]), bool), index["block_ends"]
    may[index["docs"][_ranges(ends[blocks], ends[blocks + 1])]] = True
    if worst > 1:
        starts, stops = index["sum_ends"][mine], index["sum_ends"][mine + 1]
        at = _ranges(starts, stops)
        bound = added(index["sum_blocks"][at], np.repeat(worth, stops - starts) * index["sum_parts"][at], len(ends) - 1)
        poor = blocks[(bound[blocks] < worst) & (ends[blocks + 1] - ends[blocks] >= SMALL)]
        may[index["docs"][_ranges(ends[poor], ends[poor + 1])]] = False
    return may


def added(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by place."""
    if values.sum(dtype=np.float64) < EXACT:
        return np.bincount(places, weights=values, minlength=n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, places, values)
    return out


def best_of(index: dict[str, np.ndarray], weights: np.ndarray, have: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` (scores, ids) of those found so far and of a shard."""
    scores, ids = have
    mine = np.flatnonzero(weights[index["list_terms"]])
    worth = weights[index["list_terms"][mine]]
    may = candidates(index, mine, worth, int(scores[k - 1]) if len(scores) >= k else 1)
    starts, stops = (index["block_ends"][index["list_blocks"][mine + i]] for i in (0, 1))
    at = _ranges(starts, stops)
    docs = index["docs"][at]
    left = may[docs]
    new = added(docs[left], (np.repeat(worth, stops - starts) * index["parts"][at])[left], len(may))
    found = np.flatnonzero(new)
    if len(found):
        scores, ids = np.append(scores, new[found]), np.append(ids, index["ids"][found])
        first = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[first], ids[first]
    return scores, ids


def search(index: DataFrame, queries: list[list[tuple[int, int]]], size: int, k: int = K) -> DataFrame:
    """(item, doc_id, score): the first ``k`` documents of each query, a list of (term, weight times repeats)."""
    given = index.sparkSession.sparkContext.broadcast(queries)

    def look(batches):
        wanted = [(np.array([t for t, _ in q], np.int64), np.array([w for _, w in q], np.int64)) for q in given.value]
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(wanted)
        weights = np.zeros(size, np.int64)
        for batch in batches:
            for value in batch.column(0):
                made = unpacked_shard(value.as_buffer())
                for q, (terms, worth) in enumerate(wanted):
                    weights[terms] = worth
                    best[q] = best_of(made, weights, best[q], k)
                    weights[terms] = 0
        item = np.repeat(np.arange(len(best)), [len(s) for s, _ in best]).astype(np.int32)
        scores, ids = (np.concatenate([x[j] for x in best]) if best else np.zeros(0, np.int64) for j in (0, 1))
        yield pa.record_batch([pa.array(item), pa.array(ids), pa.array(scores)], ["item", "doc_id", "score"])

    first = W.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return index.select("shard").mapInArrow(look, ANSWER_SCHEMA).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ranked(docs: DataFrame, items: DataFrame, k: int = K, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the first ``k`` documents of each item."""
    spark = docs.sparkSession
    ready(spark)
    cut = stored(item_terms(items).where(F.size("words") > 0).withColumn("number", F.monotonically_increasing_id()), "items")
    total = cut.agg(F.sum(F.size("words")).alias("n")).first().n or 0
    blocks = max(1, -(-total // block_terms))
    out = None
    for b in range(blocks):
        mine = cut.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == b).orderBy("number").collect()      # bounded by block_terms
        vocabulary = sorted({w for r in mine for w in r.words})
        code = {w: i for i, w in enumerate(vocabulary)}
        posted = postings(docs, vocabulary)
        corpus = posted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        df = document_counts(posted, max(1, len(vocabulary)))
        worth = [weight(corpus.docs, int(x)) for x in df]
        queries = []
        for r in mine:
            repeats = {}
            for w in r.words:
                repeats[code[w]] = repeats.get(code[w], 0) + 1
            queries.append(sorted((t, worth[t] * n) for t, n in repeats.items() if df[t]))
        index = build_index(posted, max(1, len(vocabulary)), corpus.docs, corpus.terms or 1)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(mine)], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        got = search(index, queries, max(1, len(vocabulary)), k).join(names, "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), F.expr(f"nullif(doc_id, {NULL_ID}L)").alias("doc_id"), "score")
        out = got if out is None else out.unionByName(got)
    return out


ORACLE = r"""
WITH tokens AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
docs AS (SELECT row, doc_id, words, len(words) AS n FROM tokens WHERE len(words) > 0),
corpus AS (SELECT count(*)::BIGINT AS c, sum(n)::BIGINT AS l FROM docs),
tf AS (SELECT row, word, count(*) AS tf FROM (SELECT row, unnest(words) AS word FROM docs) GROUP BY ALL),
weights AS (SELECT word, floor(1000 * ln((2 * c + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY word, c),
items AS (
  SELECT row_number() OVER () AS item, item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
scores AS (
  SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * c) // l))))::BIGINT AS score
  FROM items JOIN tf USING (word) JOIN weights USING (word) JOIN docs USING (row), corpus
  GROUP BY item, item_id, row, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) <= 20"""
