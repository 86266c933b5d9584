"""Readers for the source pipeline's inputs and writers for
its outputs (K1-K4).  Schemas are explicit: nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .sheets import read_sheet

RECORDINGS_SCHEMA = ("user_id string, recording_id string, language string, rec_url_gcp string, "
                     "transcription_url_gcp string, metadata_url_gcp string, audio_url string, "
                     "transcription_url string")
MODEL_SHEET_SCHEMA = ("segment_url_link string, Human string, `Model H` string, `Model i` string, "
                      "`Model k` string, `Model l` string, `Model m` string, `Model n` string")
WORDS_SCHEMA = "word string"


#: What a pandas reader takes for a missing value.
NA_VALUES = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
             "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def read_csv(spark: SparkSession, path: str, schema: str | None = None, na_values: bool = False,
             multiline: bool = True, required: Sequence[str] = (), splittable: bool = False) -> DataFrame:
    """Header CSV, UTF-8 BOM stripped by the reader, columns bound by name.

    All columns are read as strings under the header's names; with ``schema``
    its columns are selected by name and cast, in any order, extra columns
    dropped, absent ones null.  ``required`` names must be in the header
    (S8).  ``multiline`` allows quoted newlines, at the price of one task per file;
    ``splittable`` allows them and reads a file in many tasks, in no fixed order.  ``na_values=True`` turns the usual
    missing-value spellings into nulls (what a pandas reader does); off by
    default so real words such as "NA" survive."""
    df = read_sheet(spark, path) if splittable else (
        spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("inferSchema", False).csv(path))
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    if na_values:
        df = df.select(*[F.when(F.col(f"`{c}`").isin(NA_VALUES), None).otherwise(F.col(f"`{c}`")).alias(c)
                         for c in df.columns])
    if schema is None:
        return df
    names = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in StructType.fromDDL(schema)])


def read_lexicon_sheet(spark: SparkSession, path: str) -> DataFrame:
    """X3 input: wide lexicon CSV, one partition per file, with a row
    ordinal (``row_ord``) taken from the file order."""
    df = read_csv(spark, path)
    return df.withColumn("row_ord", F.monotonically_increasing_id())


def read_transcripts(spark: SparkSession, path: str, glob: str = "*_transcription.json") -> DataFrame:
    """S3: one row per transcript file ``(url, payload)``; the recording id is
    the file name without the suffix."""
    df = spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path)
    p = F.col("_metadata.file_path")
    return df.select(p.alias("url"), F.col("value").alias("payload"),
                     F.regexp_extract(p, r"([^/]+)_transcription\.json$", 1).alias("recording_id"))


def read_audio(spark: SparkSession, path: str, glob: str = "*.wav") -> DataFrame:
    """Raw audio as ``(recording_id, path, content)``; ``content`` is only
    read when selected."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("recording_id"), "path", "content")


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Run-summary JSON documents."""
    return spark.read.option("multiLine", True).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The object listing ``(url, ok, is_json)``, one CSV row an object; what isn't a truth value counts as false."""
    df = read_csv(spark, path, "url string, ok string, is_json string", required=["url", "ok", "is_json"], splittable=True)
    true = lambda c: F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes"), F.lit(False)).alias(c)      # noqa: E731
    return df.select(F.trim("url").alias("url"), true("ok"), true("is_json"))


def read_prepared(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A prepared data set; the split filter prunes partitions."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df


def write_sheet(df: DataFrame, path: str) -> None:
    """K1: CSV with header (no BOM)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_dataset(df: DataFrame, path: str) -> None:
    """K2, K3: Parquet partitioned by split; clips travel as a BINARY column."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_summary(df: DataFrame, path: str) -> None:
    """K4: one-row summary as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
