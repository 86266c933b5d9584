"""Run summaries and cross-task report rows.

Summaries are long ``(metric, value)`` rows built by unioning one-row
aggregates, so no summary ever joins frames; example lists are a top-k by
id (the limit is the feature).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unpivoted(task: str, row: DataFrame) -> DataFrame:
    """A5: the columns of a one-row frame as ``(task, metric, value)`` rows, read in one pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in row.columns])
    return row.select(F.lit(task).alias("task"), F.inline(cells))


def document_metrics(docs: DataFrame, keys: list[str], depth: int = 4) -> DataFrame:
    """A5: every leaf of the VARIANT documents ``doc`` as ``keys, metric, value, number``.

    ``metric`` is the leaf's path (``counts.Filler``, ``ranking.0.wer``), ``value`` its text (null for a JSON null) and ``number``
    the text as a double where it is one.  What lies below ``depth`` levels stays one value, as JSON
    text; empty objects, empty lists and documents that are null or no object have no row."""
    spark = docs.sparkSession
    level = docs.select(*keys, F.lit("").alias("_path"), F.col("doc").alias("_v"))
    leaves = None
    for step in range(depth):
        below = level.alias("d").lateralJoin(spark.tvf.variant_explode(F.col("d._v").outer()).alias("x")).select(
            *keys, F.concat("_path", F.coalesce("x.key", F.col("x.pos").cast("string"))).alias("_path"), F.col("x.value").alias("_v"))
        nested = F.coalesce(F.schema_of_variant("_v").rlike("^(OBJECT|ARRAY)"), F.lit(False)) if step < depth - 1 else F.lit(False)
        found = below.where(~nested).select(*keys, F.col("_path").alias("metric"), F.when(~F.is_variant_null("_v"), F.col("_v").cast("string")).alias("value"))
        leaves = found if leaves is None else leaves.unionByName(found)
        level = below.where(nested).withColumn("_path", F.concat("_path", F.lit(".")))
    return leaves.withColumn("number", F.expr("try_cast(value AS double)"))


def metric_rows(task: str, pairs: list[tuple[str, DataFrame]]) -> DataFrame:
    """Union of single-value frames into ``task, metric, value`` rows."""
    out = None
    for name, df in pairs:
        row = df.select(F.lit(task).alias("task"), F.lit(name).alias("metric"),
                        F.col(df.columns[0]).cast("double").alias("value"))
        out = row if out is None else out.unionByName(row)
    return out


def count_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def failure_examples(failures: DataFrame, k: int) -> DataFrame:
    """A4: the first ``k`` failures by recording id (top-k, not a full sort)."""
    return failures.orderBy("recording_id", "error").limit(k)


def best_checkpoints(log: DataFrame) -> DataFrame:
    """Per run, the checkpoint with the lowest WER (ties: earliest step)
    and the latest checkpoint by step."""
    return log.groupBy("run").agg(
        F.min_by("checkpoint", F.struct("wer", "step")).alias("best_checkpoint"),
        F.min("wer").alias("best_wer"),
        F.max_by("checkpoint", "step").alias("latest_checkpoint"),
        F.max("step").alias("latest_step"))


def system_comparison(metrics: DataFrame, baseline: str, tuned: str, scale: float = 100.0) -> DataFrame:
    """Two systems on one reference set; WER/CER scaled (x100 as the
    public-split evaluator reports), pseudo-accuracy ``1 - WER``, relative
    improvement of the tuned system over the baseline and its percent text.
    The input has one row per system, so the key-less window spans two rows."""
    m = metrics.where(F.col("model").isin(baseline, tuned))
    allrows = Window.partitionBy()
    base = F.max(F.when(F.col("model") == baseline, F.col("wer"))).over(allrows)
    new = F.max(F.when(F.col("model") == tuned, F.col("wer"))).over(allrows)
    imp = F.try_divide(base - new, base)            # undefined (null) for a perfect baseline
    return m.select(
        F.when(F.col("model") == baseline, "baseline").otherwise("tuned").alias("system"),
        "model", F.col("segments").alias("samples_evaluated"),
        (F.col("wer") * scale).alias("wer"), (F.col("cer") * scale).alias("cer"),
        (1 - F.col("wer")).alias("accuracy"), imp.alias("relative_improvement"),
        F.when(imp.isNotNull(), F.format_string("%.2f%%", imp * 100)).alias("improvement_pct"))
