"""Incremental detection over newly arriving transcript segments.

Normalization, disfluency detection, orthography and per-pair scoring are
row-local projections, so the same expressions run unchanged on a file
stream in append mode.  ``availableNow`` processes whatever has arrived and
stops, which makes a scheduled incremental batch job; the checkpoint folder
(in shared storage) records which files were consumed, so a lost executor or
a restarted job neither drops nor repeats rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.orthography import classify, spelling_label
from ..operators import disfluency as D


def segment_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def run_detection(segments: DataFrame, lexicon: DataFrame, out_path: str, checkpoint: str, mode: str = "parity") -> None:
    """Detect disfluencies in everything available now (D2-D8), append them to ``out_path`` and stop."""
    def append(batch: DataFrame, _: int) -> None:
        D.occurrences(D.detect(batch, lexicon, mode=mode)).write.mode("append").parquet(out_path)

    segments.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
