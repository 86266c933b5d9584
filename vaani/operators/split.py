"""Exact, seeded train/validation split without a global sort.

Validation = the ``ceil(ratio * n)`` rows with the smallest key, where key =
``md5(seed:id)`` (16 bytes, compared as unsigned bytes -- the same order as
its hex text).  The cut is found top-down: a 65,536-bucket histogram of the
key's first two bytes (bounded, collected), then, only inside the boundary
bucket, a histogram of the next two bytes, and so on until the cut falls on a
bucket's end (at the latest, when a bucket is one key).  Every
other row is classified by one comparison.  Size is exact, membership is
repeatable for a seed, and no task holds more than one small bucket.

Copies of one id share a key, so they always land on the same side (no
train/validation leakage); when ids repeat, the validation part can exceed
``ceil(ratio * n)`` by the copies of the boundary id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import staged

LEVEL_BYTES = 2
_KEY = "_split_key"


def split_key(id_col: Column, seed: int) -> Column:
    """Hex key (what the DuckDB oracle restates)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))


def _binary_key(id_col: Column, seed: int) -> Column:
    return F.unhex(split_key(id_col, seed))


def exact_split(df: DataFrame, id_col: str = "id", ratio: float = 0.1, seed: int = 42,
                names=("train", "validation"), ids: DataFrame | None = None) -> DataFrame:
    """``df`` with a column ``split``.

    The rows are staged once, with their keys, in the shared folder, and both
    the histograms (which read the 16-byte keys alone) and the result come from
    there, so the upstream plan runs once and survives lost executors.  Give
    ``ids``, stored rows with the same ids, where ``df`` is wide and comes from
    storage itself: then only the ids are read for the cut.
    """
    key = _binary_key(F.col(id_col), seed)
    if ids is None:
        df = staged(df.withColumn(_KEY, key), "split")
        threshold, key = _threshold(df.select(F.col(_KEY).alias("_k")), ratio), F.col(_KEY)
    else:
        threshold = _threshold(ids.select(key.alias("_k")), ratio)
    side = F.lit(names[0]) if threshold is None else F.when(key <= F.lit(threshold), names[1]).otherwise(names[0])
    return df.withColumn("split", side).drop(_KEY)


def _threshold(keys: DataFrame, ratio: float):
    """Largest key in the validation part (None when it is empty)."""
    prefix, cum, n_total, k = b"", 0, None, None
    scope = keys
    for level in range(1, 16 // LEVEL_BYTES + 1):
        width = level * LEVEL_BYTES
        b = F.substring("_k", 1, width)
        hist = sorted((bytes(r[0]), r[1]) for r in scope.groupBy(b.alias("b")).count().collect())
        if n_total is None:
            n_total = sum(c for _, c in hist)
            k = math.ceil(ratio * n_total)
            if k <= 0 or n_total == 0:
                return None
            if k >= n_total:
                return b"\xff" * 16
        for bucket, c in hist:
            if cum + c >= k:
                prefix = bucket
                break
            cum += c
        scope = keys.where(F.substring("_k", 1, width) == F.lit(prefix))
        if cum + c == k:
            return prefix.ljust(16, b"\xff")
    # identical 16-byte keys only (duplicate ids): every row of the last
    # bucket shares the key, so the cut falls on it
    return prefix


def split_counts(split_df: DataFrame) -> DataFrame:
    """R2."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
