"""A training corpus in five stages, each one operator of ``vaani.llm`` over all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; the last adds ``mix_copies``.

* toxicity: documents with a score of 0.7 or more go;
* near duplicates: of each group of similar documents that of the smallest id stays;
* decontamination: documents with a window of a benchmark item go;
* secrets: secret spans are replaced in the text and ``n_chars`` is counted anew;
* mixing: a document stays if the mix takes it (or has no words), with how often it is taken.

Empty tables pass through; how nulls, ties and repeated rows are treated is
said in the operators' modules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vaani.llm import decontamination, jaccard, mixing, secrets, toxicity
from vaani.llm.shared import ready, stored
from vaani.sources.tables import table


def keep_ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.distinct_documents(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", keep_ordinary),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_uncontaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: Learnt scores, sampled paths and string edits are not SQL; brute-force tests stand for it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
