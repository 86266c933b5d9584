"""Parquet tables of the driver's test-data layout: ``{dir}/{name}.parquet``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Columnar scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the cluster's shared folder and read
    back: the plan behind it runs once, and later readers start from storage."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/vaani-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
