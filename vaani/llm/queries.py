"""The operators applied to whole tables: one query each, with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vaani.llm import chat, decontamination, extraction, jaccard, licences, mixing, negatives, quality, ranked, secrets, substrings, toxicity, warc
from vaani.sources.tables import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=decontamination.SLOP)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes_and_links(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_licence_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.windows(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extracted(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.round_trip(table(spark, sf_dir, "conversations"))


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(table(spark, sf_dir, "embeddings"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_jaccard_join, op3_licences, op3_licence_windows, op4_warc, op5_secrets, op6_toxicity,
                                   op7_extraction, op8_quality, op9_mixing, op10_substrings, op11_chat, op12_negatives, op13_ranked, pipeline)}

#: The others need hashes, models or string edits that SQL lacks; brute-force tests stand for them.
ORACLE = {
    "op3_licences": licences.oracle(), "op4_warc": warc.ORACLE, "op9_mixing": mixing.ORACLE, "op11_chat": chat.ORACLE, "op12_negatives": negatives.ORACLE, "op13_ranked": ranked.ORACLE,
}
