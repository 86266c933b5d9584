"""Partitioning helpers for CPU-heavy row-local work."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over as many partitions as the session's setting
    ``vaani.input.partitions`` names (for inputs of one small file, whose text
    work would run in one task); without the setting, as it was scanned."""
    n = df.sparkSession.conf.get("vaani.input.partitions", None)
    return df.repartition(int(n)) if n else df


def where_after(df: DataFrame, condition) -> DataFrame:
    """``df.where(condition)`` evaluated once, after ``df``'s projections.

    A plain filter on a computed column is pushed below the projection that
    computes it, with the expression substituted, so an expensive column
    (a JSON parse, a regex pass) would be evaluated by the filter and again
    by the projection.  A filter on a generated column cannot be pushed
    below its generator: ``condition`` becomes a one-element array that is
    exploded, and rows where it does not hold produce no element.
    """
    from pyspark.sql import functions as F
    g = df.withColumn("_keep", F.explode_outer(F.when(condition, F.array(F.lit(True)))))
    return g.where(F.col("_keep").isNotNull()).drop("_keep")
