"""N-gram Jaccard join by chosen paths.

A text is the set of its 5-word shingles.  Texts with equal sets are one
class and are joined through it.  For the classes, ``runs`` independent
trees are searched.  In a tree's node a set of n shingles chooses each
shingle with probability 1/(level factor * n), by a hash of the node, and goes
to the child of every shingle that it chose; two sets meet in a child if
both chose a shingle that they share.  Buckets of up to ``BUCKET`` classes are
compared by brute force, larger ones are split on by further tokens (of
each set's sketch); what is still large at the last level is compared block
by block, so no bucket is capped.  Runs are repeated until two sets at the
threshold meet with probability ``RECALL``, by the survival probability of the
branching process.

Brute force within buckets compares 64-byte sketches with four standard
errors of slack; classes that may be similar form families, and within a
family all pairs of sets are compared exactly, in blocks.  Links are counted
where they are found and passed on as stars, so the rows that leave a
task grow with the texts, not with their pairs.

Defined results: null, empty and blank texts have no shingles, are each a
class of their own and have no links; a text of one to four words has one
shingle; a null ``doc_id`` takes part, ranked last; equal rows are members of
one class; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window as W

from vaani.llm.components import components
from vaani.llm.shared import NULL_ID, fresh, id_key, ready, same_columns, stored
from vaani.llm.words import frames, gram_hashes, long_column, mix, packed, slices, split_words, whole_groups, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
#: Probability with which two sets just at the threshold meet in some run.
RECALL = 0.999
#: Level factors: the first two levels use the shingles themselves, later ones the sketch.
FACTORS = (0.8, 0.8, 0.5, 0.5, 0.5, 0.5)
#: Classes in a bucket or block that one task compares at once.
BUCKET = 2000
BLOCK = 256
BINS = 64
#: Text that a task describes at once: hashing holds some thirty bytes for each of its bytes.
STEP_BYTES = 1 << 20


def runs(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs after which two sets at the threshold have met with probability ``recall``."""
    alive = 1.0
    for factor in reversed(FACTORS):
        alive = 1 - math.exp(-threshold / factor * alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def shingles(col, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    flat, offs = split_words(col)
    words = word_hashes(flat)
    grams = gram_hashes(words, size)
    out = []
    for a, b in zip(offs[:-1], offs[1:]):
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        elif b > a:
            out.append(gram_hashes(words[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def sketch(tokens: np.ndarray) -> np.ndarray:
    """One byte for each of ``BINS`` ranges of hashes: of its smallest token, 0 if it has none."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)
    at = np.searchsorted(tokens, edges)
    first = tokens[np.minimum(at, len(tokens) - 1)]
    own = (at < len(tokens)) & ((first >> np.uint64(64 - BINS.bit_length() + 1)) == np.arange(BINS, dtype=np.uint64))
    return np.where(own, 1 + (mix(first) % np.uint64(255)), 0).astype(np.uint8)


def chosen(tokens: np.ndarray, nodes: np.ndarray, factor: float) -> np.ndarray:
    """Children of all ``nodes`` for one set: a node for each token that it chooses."""
    limit = np.uint64(min(2.0**64 - 2048, 2.0**64 / (factor * max(1, len(tokens)))))
    out = []
    for node in nodes:
        h = mix(tokens ^ node)
        picked = h[h < limit]
        if len(picked):
            out.append(mix(picked + node))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _describe(size: int, threshold: float, recall: float):
    roots = mix(np.arange(1, runs(threshold, recall) + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))

    def describe(batches):
        for batch in batches:
            for part in slices(batch, 1, STEP_BYTES):
                ids, prints, paths = [], [], []
                for tokens in shingles(part.column(1), size):
                    if not len(tokens):
                        ids.append(None), prints.append(None), paths.append(None)
                        continue
                    nodes = roots
                    for factor in FACTORS[:2]:
                        nodes = chosen(tokens, nodes, factor)
                    ids.append(set_id(tokens)), prints.append(sketch(tokens).tobytes()), paths.append(np.unique(nodes).view(np.int64))
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary()), pa.array(prints, pa.binary()),
                                       pa.array(paths, pa.list_(pa.int64()))], ["doc_id", "set_id", "sketch", "paths"])
    return describe


def _descend(factor: float):
    """Split large buckets: children of a path, by tokens of the sketch."""
    def descend(batches):
        for batch in batches:
            paths = batch.column(0).to_numpy().view(np.uint64)
            rows, out = [], []
            for i, (path, s) in enumerate(zip(paths, batch.column(2).to_pylist())):
                s = np.frombuffer(s, np.uint8).astype(np.uint64)
                tokens = mix((np.flatnonzero(s).astype(np.uint64) << np.uint64(8)) + s[s > 0])
                new = chosen(tokens, np.array([path]), factor)
                rows.append(np.full(len(new), i))
                out.append(new)
            rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            yield pa.record_batch([long_column(np.concatenate(out) if out else np.zeros(0, np.uint64)), batch.column(1).take(pa.array(rows))], ["path", "set_id"])
    return descend


def _alike(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether sketches allow similarity ``threshold``: four standard errors of slack."""
    used = ((a > 0) | (b > 0)).sum(-1)
    equal = ((a == b) & (a > 0)).sum(-1)
    used = np.maximum(used, 1)
    return equal / used >= threshold - 4 * np.sqrt(threshold * (1 - threshold) / used)


def _heads(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n items the first item that the pairs (i, j) connect it with."""
    head = np.arange(n)
    while len(i):
        low = np.minimum(head[i], head[j])
        before = head.copy()
        np.minimum.at(head, i, low)
        np.minimum.at(head, j, low)
        if (head == before).all():
            break
    return head


def _bucket_stars(threshold: float):
    """Brute force in buckets (rows: bucket, set_id, sketch): each family as a star around its first member."""
    def compare(batches):
        for table in whole_groups(batches):
            key, ids = table.column(0).to_numpy(), table.column(1).combine_chunks()
            prints = np.frombuffer(b"".join(table.column(2).to_pylist()), np.uint8).reshape(-1, BINS)
            n = len(key)
            bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.diff(np.append(bounds, n))
            small = np.repeat(sizes <= 16, sizes)
            left_, right_ = [], []
            for lag in range(1, min(16, n)):            # all small buckets at once
                i = np.flatnonzero(small[:-lag] & (key[:-lag] == key[lag:]))
                i = i[_alike(prints[i], prints[i + lag], threshold)]
                left_.append(i)
                right_.append(i + lag)
            head = _heads(n, np.concatenate(left_), np.concatenate(right_)) if left_ else np.arange(n)
            for at, size in zip(bounds[sizes > 16], sizes[sizes > 16]):
                left = np.arange(at, at + size)
                while len(left):                        # grow one family after another
                    seed, left = left[0], left[1:]
                    front = [seed]
                    while front and len(left):
                        near = _alike(prints[left], prints[front.pop()], threshold)
                        head[left[near]] = seed
                        front.extend(left[near].tolist())
                        left = left[~near]
            member = np.flatnonzero(head != np.arange(n))
            yield pa.record_batch([ids.take(pa.array(head[member])), ids.take(pa.array(member))], ["a", "b"])
    return compare


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all pairwise intersections."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    shared = (count > 1)[token]
    owner, token = owner[shared], number[token[shared]]
    out = np.zeros((m, m), np.float64)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    width = 4096
    for c in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [c, c + width])
        x = np.zeros((m, width), np.float32)
        x[owner[a:b], token[a:b] - c] = 1
        out += x @ x.T
    return out


def _verify(size: int, threshold: float):
    """Exact comparison in blocks (rows: key, cross, block, set_id, text): links of each member, and stars."""
    def verify(batches):
        for table in whole_groups(batches):
            key = table.column(0).to_numpy()
            bounds = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            ids, links, heads = [], [], []
            for at, end in zip(bounds[:-1], bounds[1:]):
                rows, cross = table.slice(at, end - at), table.column(1)[int(at)].as_py()
                found = {}
                for batch in rows.to_batches():
                    for part, text in frames(batch, 4):
                        for tokens, block, want in zip(shingles(text, size), part.column(2).to_pylist(), part.column(3).to_pylist()):
                            if want not in found and set_id(tokens) == want:    # else another text of the same doc_id
                                found[want] = (tokens, block)
                names = list(found)
                sets = [found[x][0] for x in names]
                if len(sets) < 2:
                    continue
                n = np.array([len(x) for x in sets], np.float64)
                inter = common(sets)
                near = inter >= threshold * (n[:, None] + n[None, :] - inter) - 1e-9
                np.fill_diagonal(near, False)
                if cross:
                    block = np.array([found[x][1] for x in names])
                    near &= block[:, None] != block[None, :]
                i, j = np.nonzero(np.triu(near))
                head = _heads(len(names), i, j)
                for x in np.flatnonzero(near.any(1)):
                    ids.append(names[x])
                    links.append(int(near[x].sum()))
                    heads.append(names[head[x]])
            yield pa.record_batch([pa.array(ids, pa.binary()), pa.array(links, pa.int64()), pa.array(heads, pa.binary())], ["set_id", "n_links", "head"])
    return verify


def _families(classes: DataFrame, threshold: float) -> DataFrame:
    """(set_id, family) of all classes that may be similar to another."""
    hops = classes.select(F.explode("paths").alias("path"), "set_id")
    prints = classes.select("set_id", "sketch")
    leaves = None
    for level in range(1, len(FACTORS)):
        met = hops.distinct() if level > 1 else hops
        met = stored(met.withColumn("n", F.count("*").over(W.partitionBy("path"))).where("n > 1"), "buckets")
        last = level == len(FACTORS) - 1
        small = met.where(F.col("n") <= BUCKET).select(F.col("path").alias("bucket"), "set_id")
        leaves = small if leaves is None else leaves.unionByName(small)
        large = met.where(F.col("n") > BUCKET)
        if large.isEmpty():
            break
        if last:
            # nothing is capped: what is still large is compared in pairs of blocks
            nb = F.ceil(F.col("n") / BUCKET)
            mine = F.pmod(F.xxhash64("set_id"), nb)
            parts = large.select("path", "set_id", mine.alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), nb - 1)).alias("j"))
            leaves = leaves.unionByName(parts.select(F.xxhash64("path", F.least("i", "j"), F.greatest("i", "j")).alias("bucket"), "set_id"))
        else:
            hops = large.join(prints, "set_id").select("path", "set_id", "sketch").mapInArrow(_descend(FACTORS[level + 1]), "path long, set_id binary")
    sides = leaves.join(prints, "set_id").select("bucket", "set_id", "sketch")
    edges = sides.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_bucket_stars(threshold), "a binary, b binary")
    return components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("family"))


def join(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Per row: doc, text_hash, class_id, class_size, n_links (similar classes), group_id, set_id.

    ``doc`` is the id (nulls as the largest), ``class_id`` the smallest id
    with the same shingles, ``group_id`` the smallest id that links lead to.
    """
    ready(docs.sparkSession)
    texts = docs.select(id_key("doc_id").alias("doc"), F.col("text").cast("string").alias("text"))
    described = texts.mapInArrow(_describe(size, threshold, recall), "doc long, set_id binary, sketch binary, paths array<long>")
    described = stored(described, "sets")
    classes = stored(described.where("set_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc").alias("class_id"), F.count("*").alias("class_size"), F.first("sketch").alias("sketch"), F.first("paths").alias("paths")), "classes")
    families = stored(_families(classes, threshold), "families")

    count = families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("nb"))
    members = families.join(count, "family").join(classes.select("set_id", "class_id"), "set_id")
    members = members.withColumn("i", F.pmod(F.xxhash64("set_id"), F.col("nb")))
    packs = texts.mapInArrow(packed(2), "doc long, text binary")
    members = packs.join(members, packs["doc"] == members["class_id"])
    sides = members.select("family", "set_id", "text", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("j"))
    sides = sides.select(F.xxhash64("family", F.least("i", "j"), F.greatest("i", "j")).alias("key"), (F.col("i") != F.col("j")).alias("cross"),
                         F.col("i").alias("block"), "set_id", "text")
    checked = stored(sides.repartition("key").sortWithinPartitions("key")
                     .mapInArrow(_verify(size, threshold), "set_id binary, n_links long, head binary"), "links")
    links = checked.groupBy("set_id").agg(F.sum("n_links").alias("n_links"))
    groups = components(checked.select(F.col("head").alias("a"), F.col("set_id").alias("b"))).withColumnRenamed("node", "set_id")
    per = (classes.select("set_id", "class_id", "class_size").join(links, "set_id", "left").join(groups, "set_id", "left"))
    least = per.where("component IS NOT NULL").groupBy("component").agg(F.min(F.struct("class_id", "set_id")).alias("first"))
    per = per.join(least, "component", "left").select(
        "set_id", "class_id", "class_size", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("first.class_id", "class_id").alias("group_id"), F.coalesce("first.set_id", "set_id").alias("group_set"))
    return described.select("doc", "set_id").join(per, "set_id", "left").select(
        "doc", "set_id", "group_set", F.coalesce("class_id", "doc").alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("group_id", "doc").alias("group_id"))


def classes_and_links(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, class_id, class_size, n_links, group_id."""
    shown = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))      # noqa: E731
    return join(docs, **options).select(shown("doc").alias("doc_id"), shown("class_id").alias("class_id"), "class_size", "n_links", shown("group_id").alias("group_id"))


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """One document of each group of similar texts, that of the smallest id, with all its columns.

    Texts without words stay.
    """
    names = docs.columns
    doc, tag, nth = fresh(docs, "_doc"), fresh(docs, "_set"), fresh(docs, "_nth")
    found = join(docs, **options)
    keep = found.where((F.col("set_id") == F.col("group_set")) & (F.col("doc") == F.col("class_id"))).select(F.col("doc").alias(doc), F.col("set_id").alias(tag)).distinct()
    keyed = docs.withColumn(doc, id_key("doc_id")).mapInArrow(_with_set(SHINGLE, names.index("text")), _plus(docs, doc, tag))
    kept = keyed.join(keep, [doc, tag], "left_semi").withColumn(nth, F.row_number().over(W.partitionBy(doc, tag).orderBy(doc))).where(F.col(nth) == 1).drop(nth)
    return same_columns(kept.unionByName(keyed.where(F.col(tag).isNull())), names)


def _plus(docs: DataFrame, doc: str, tag: str):
    from pyspark.sql import types as T
    return T.StructType([*docs.schema.fields, T.StructField(doc, T.LongType()), T.StructField(tag, T.BinaryType())])


def _with_set(size: int, column: int):
    def add(batches):
        for batch in batches:
            for part in slices(batch, column, STEP_BYTES):
                ids = [set_id(t) if len(t) else None for t in shingles(part.column(column), size)]
                yield pa.record_batch([*part.columns, pa.array(ids, pa.binary())], names=[*part.schema.names, "_"])
    return add
