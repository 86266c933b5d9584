"""Small helpers of the pipeline operators: tables in the shared folder, ids."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vaani.session import checkpoint_dir, ship_package

#: Stands for a null id inside the operators; nulls so rank last.
NULL_ID = 2**63 - 1


def ready(spark: SparkSession) -> None:
    """Ship the package to the Python workers of this session (once)."""
    ship_package(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/vaani-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, not a re-run.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def same_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*(F.col("`" + c.replace("`", "``") + "`") for c in names))
