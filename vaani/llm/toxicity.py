"""Toxicity by class-conditional Kneser-Ney models.

A word is a sequence of bytes between word ends.  Two models, of the toxic
and of the ordinary labelled texts, give each byte a probability after the
five before it; an expression that is rare in a class (an inflected form, a
spelling) is smoothed through the class's continuation counts of shorter
contexts (three bytes) and then through continuation counts that both classes
share and that are gathered from all documents (two bytes).  The ratio of
the two likelihoods, normalised by length, and how far single words stand
out in it, go into a logistic curve that is fitted to texts which the scoring
model has not seen (two folds score each other).

Labels of at most ``MAX_LABELLED`` documents are used, those of the lowest
hash, and never those held out (crc32 of the id modulo 3 is 1).  All counts
that leave Spark are hashed to tables of fixed size.

Defined results: a null text is scored as empty; without labels of both
kinds all scores are 0; several labels of a document count as toxic if one
is; null labels and ids count for nothing in training, a null id is not held
out; equal rows score alike; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vaani.llm.shared import ready, stored
from vaani.llm.words import ALNUM_LOWER, coded, long_column, mix, slices, split_words

MAX_LABELLED = 12_000
REJECT = 0.7
#: Bits of the hashed tables: counts, context totals, distinct followers; long and short order; shared.
BITS = {"c6": 19, "s6": 17, "t6": 17, "c4": 16, "s4": 15, "t4": 15, "c3": 16, "s3": 14}
TABLES = list(BITS)         # a table's number is its place here
BOTH = 9            # the set of both folds
#: Text that one step within a task takes at once: six numbers are held for each byte of its distinct words.
STEP_BYTES = 2 << 20
STANDS_OUT = 3.0
L2 = 1e-2


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bucket(x: np.ndarray, table: str) -> np.ndarray:
    return (mix(x + np.uint64(1)) >> np.uint64(64 - BITS[table])).astype(np.int64)


def sequences(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The six bytes up to each byte and to the end of each word, as one number, and its word."""
    n = len(words)
    offs = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + n + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offs[0]:offs[-1]] if n else np.zeros(0, np.uint8)
    offs = offs - offs[0]
    owner = np.repeat(np.arange(n), np.diff(offs))
    padded = np.zeros(len(data) + 6 * n + 6, np.uint64)
    padded[np.arange(len(data)) + 6 * owner + 5] = data
    ends = np.repeat(np.arange(n), np.diff(offs) + 1)
    at = np.arange(len(ends)) + 5 * ends + 5
    six = padded[at].copy()
    for j in range(1, 6):
        six |= padded[at - j] << np.uint64(8 * j)
    return six, ends


def _weighted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys, np.bincount(inverse, weights, minlength=len(keys)).astype(np.int64)


def _word_counts(col) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    flat, offs = split_words(col, ALNUM_LOWER)
    if not len(flat):
        return pa.array([], pa.string()), np.zeros(0, np.int64), offs, np.zeros(0, np.int64)
    words, codes = coded(flat)
    return words, codes, offs, np.bincount(codes, minlength=len(words))


def sample(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, toxic, fold) of at most ``limit`` labelled documents that are not held out."""
    one = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("int(toxic = 1)")).alias("toxic"))
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3).cast("int")
    return one.withColumn("fold", fold).where("fold <> 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def class_grams(texts: DataFrame) -> DataFrame:
    """(toxic, set, gram, n): six-byte sequences by class, in each fold and in both."""
    def count(batches):
        for batch in batches:
            for part in slices(batch, 2, STEP_BYTES):
                group = part.column(0).to_numpy() * 16 + part.column(1).to_numpy()
                for g in np.unique(group):
                    words, _, _, n = _word_counts(part.column(2).filter(pa.array(group == g)))
                    six, word = sequences(words)
                    keys, counts = _weighted(six, n[word]) if len(six) else (six, word)
                    for s in (g % 16, BOTH):
                        yield pa.record_batch([pa.array(np.full(len(keys), g // 16, np.int32)), pa.array(np.full(len(keys), s, np.int32)),
                                               long_column(keys), pa.array(counts)], ["toxic", "set", "gram", "n"])
    return texts.select("toxic", "fold", "text").mapInArrow(count, "toxic int, set int, gram long, n long").groupBy("toxic", "set", "gram").agg(F.sum("n").alias("n"))


def shared_grams(docs: DataFrame) -> DataFrame:
    """Distinct four-byte sequences of all documents."""
    def find(batches):
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for part in slices(batch, 0, STEP_BYTES):
                six, _ = sequences(_word_counts(part.column(0))[0])
                seen = np.union1d(seen, six & np.uint64(0xFFFFFFFF))
        yield pa.record_batch([long_column(seen)], ["gram"])
    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(find, "gram long").distinct()


def _tables(grams: DataFrame, parts, keys: list[str]) -> DataFrame:
    """Sums by (keys, table, bucket): ``parts`` lists (table, bytes kept, bytes dropped, the count or one)."""
    def add(batches):
        for batch in batches:
            group = [batch.column(i).to_numpy() for i in range(len(keys))]
            gram = batch.column(len(keys)).to_numpy().view(np.uint64)
            n = batch.column(len(keys) + 1).to_numpy()
            for table, kept, dropped, counted in parts:
                mask = np.uint64((1 << (8 * kept)) - 1)
                b = bucket((gram & mask) >> np.uint64(8 * dropped), table)
                yield pa.record_batch([*(pa.array(g) for g in group), pa.array(np.full(len(b), TABLES.index(table), np.int8)), pa.array(b),
                                       pa.array(n if counted else np.ones(len(b), np.int64))], [*keys, "table", "bucket", "n"])
    schema = ", ".join(f"{k} int" for k in keys) + ", table byte, bucket long, n long"
    return grams.select(*keys, "gram", "n").mapInArrow(add, schema.lstrip(", ")).groupBy(*keys, "table", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """The two class models of one set, in tables of fixed size."""

    def __init__(self, tables: dict, shared: dict, discounts: dict):
        self.tables, self.shared, self.discounts = tables, shared, discounts

    def word_ratios(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of each word: log likelihood in the toxic less that in the ordinary model, and its length with the end."""
        six, word = sequences(words)
        if not len(six):
            return np.zeros(len(words)), np.zeros(len(words))
        cut = lambda kept, dropped: (six & np.uint64((1 << (8 * kept)) - 1)) >> np.uint64(8 * dropped)      # noqa: E731
        base = (self.shared["c3"][bucket(cut(3, 0), "c3")] + 0.01) / (self.shared["s3"][bucket(cut(3, 1), "s3")] + 2.56)
        at = {t: bucket(cut(*x), t) for t, x in (("c6", (6, 0)), ("s6", (6, 1)), ("t6", (6, 1)), ("c4", (4, 0)), ("s4", (4, 1)), ("t4", (4, 1)))}
        logs = []
        for toxic in (1, 0):
            t, p = self.tables[toxic], base
            for order in ("4", "6"):
                d = self.discounts.get((toxic, order), 0.75)
                c, s, f = (t[k + order][at[k + order]] for k in "cst")
                p = np.where(s > 0, (np.maximum(c - d, 0) + d * f * p) / np.maximum(s, 1), p)
            logs.append(np.log(np.clip(p, 1e-12, 1)))
        return np.bincount(word, logs[0] - logs[1], minlength=len(words)), np.bincount(word, minlength=len(words)).astype(float)

    def features(self, col) -> np.ndarray:
        """A row for each text: the length-normalised ratio, the highest word, what stands out in all and by length, the length."""
        words, codes, offs, _ = _word_counts(col)
        ratio, length = self.word_ratios(words)
        n = np.diff(offs)
        row = np.repeat(np.arange(len(n)), n)
        x = np.clip(ratio, -20, 20)[codes] if len(codes) else np.zeros(0)
        out = np.zeros((len(n), 5))
        some = np.maximum(n, 1)
        total = np.bincount(row, x, minlength=len(n))
        out[:, 0] = total / np.maximum(np.bincount(row, length[codes] if len(codes) else None, minlength=len(n)), 1)
        if len(x):
            full = n > 0
            out[full, 1] = np.maximum.reduceat(x, offs[:-1][full])
        above = np.bincount(row, np.maximum(x - STANDS_OUT, 0), minlength=len(n))
        out[:, 2] = np.log1p(above)
        out[:, 3] = np.minimum(100 * above / some, 50)
        out[:, 4] = np.log1p(n)
        return out


def _dense(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, name, dense): tables of fixed size from rows (keys, table, bucket, n), each made by one task, all in one pass and stored."""
    def fill(table: pa.Table) -> pa.Table:
        name = TABLES[table.column("table")[0].as_py()]
        dense = np.zeros(1 << BITS[name], np.float32)       # at most 4 bytes for each of its buckets
        dense[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
        return pa.table({k: table.column(k).slice(0, 1) for k in keys} | {"name": [name], "dense": [dense.tobytes()]})

    schema = "".join(f"{k} int, " for k in keys) + "name string, dense binary"
    return stored(rows.select(*keys, "table", "bucket", "n").groupBy(*keys, "table").applyInArrow(fill, schema), "dense")


def _fetched(dense: DataFrame) -> dict[str, np.ndarray]:
    """The tables of one model, by one job however many partitions there are."""
    return {r.name: np.frombuffer(r.dense, np.float32) for r in dense.select("name", "dense").collect()}


def fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, spread and weights of a logistic curve, by Newton's method."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) / len(y) + L2 / 10 * w
        h = (z * (p * (1 - p))[:, None]).T @ z / len(y) + L2 / 10 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return mean, spread, np.round(w, 12)


class Scorer:
    """The models and the curve, trained on ``docs`` and ``labels``."""

    def __init__(self, docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED):
        spark = docs.sparkSession
        known = F.broadcast(stored(sample(labels, limit), "labelled"))      # at most ``limit`` rows of 16 bytes
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(known, "doc_id")
        texts = stored(texts.select("toxic", "fold", "text"), "texts")
        self.ready = len(texts.select("toxic").distinct().collect()) == 2
        if not self.ready:
            return
        grams = stored(class_grams(texts), "grams")
        keys = ["toxic", "set"]
        short = grams.select(*keys, F.expr("gram & 4294967295").alias("gram")).groupBy(*keys, "gram").agg(F.count("*").alias("n"))
        short = stored(short, "short")
        rows = _tables(grams, [("c6", 6, 0, True), ("s6", 6, 1, True), ("t6", 6, 1, False)], keys).unionByName(
            _tables(short, [("c4", 4, 0, True), ("s4", 4, 1, True), ("t4", 4, 1, False)], keys))
        rows = stored(rows, "tables")
        ones = lambda df: {(r.toxic, r.set): r for r in df.groupBy(*keys).agg(F.sum(F.expr("int(n = 1)")).alias("a"), F.sum(F.expr("int(n = 2)")).alias("b")).collect()}
        counts = {"6": ones(grams), "4": ones(short)}
        four = stored(shared_grams(docs).withColumn("n", F.lit(1).cast("long")), "shared")
        shared = _fetched(_dense(_tables(four, [("c3", 3, 0, True), ("s3", 3, 1, True)], []), []))
        dense = _dense(rows, keys)
        self.models = {}
        for s in (0, 2, BOTH):
            tables = {t: _fetched(dense.where((F.col("set") == s) & (F.col("toxic") == t))) for t in (0, 1)}
            for t in (0, 1):
                for name in ("c6", "s6", "t6", "c4", "s4", "t4"):
                    tables[t].setdefault(name, np.zeros(1 << BITS[name], np.float32))
            discount = {(t, o): c[t, s].a / (c[t, s].a + 2 * c[t, s].b) for t in (0, 1) for o, c in counts.items() if (t, s) in c and c[t, s].a}
            self.models[s] = Model(tables, shared, discount)
        # each fold is scored by the model of the other
        folds = spark.sparkContext.broadcast({0: self.models[2], 2: self.models[0]})

        def measure(batches):
            for batch in batches:
                for part in slices(batch, 2, STEP_BYTES):
                    fold = part.column(1).to_numpy()
                    for f, model in folds.value.items():
                        mine = pa.array(fold == f)
                        x = model.features(part.column(2).filter(mine))
                        yield pa.record_batch([part.column(0).filter(mine), *(pa.array(x[:, i]) for i in range(5))], ["toxic", "a", "b", "c", "d", "e"])

        seen = texts.select("toxic", "fold", "text").mapInArrow(measure, "toxic int, a double, b double, c double, d double, e double").collect()
        seen = np.array(sorted(tuple(r) for r in seen))         # at most ``limit`` rows
        folds.destroy()
        self.models = {BOTH: self.models[BOTH]}
        self.curve = fit(seen[:, 1:], seen[:, 0])
        self.given = spark.sparkContext.broadcast((self.models[BOTH], self.curve))

    def scores(self):
        """A function from an Arrow text column to scores, for use within tasks."""
        if not self.ready:
            return lambda col: np.zeros(len(col))
        given = self.given

        def score(col) -> np.ndarray:
            model, (mean, spread, w) = given.value
            x = model.features(col)
            z = (x - mean) / spread @ w[:-1] + w[-1]
            return np.round(1 / (1 + np.exp(-np.clip(z, -30, 30))), 9)
        return score


def scored(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    ready(docs.sparkSession)
    score = Scorer(docs, labels, **options).scores()

    def look(batches):
        for batch in batches:
            for part in slices(batch, 2, STEP_BYTES):
                yield pa.record_batch([part.column(0), part.column(1), pa.array(score(part.column(2)))], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(look, "doc_id long, held_out boolean, score double").withColumn("predicted", F.expr(f"int(score >= {REJECT})"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    ready(docs.sparkSession)
    score, at = Scorer(docs, labels, **options).scores(), docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            for part in slices(batch, at, STEP_BYTES):
                yield part.filter(pa.array(score(part.column(at)) < REJECT))

    return docs.mapInArrow(keep, docs.schema)
