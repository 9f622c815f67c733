"""The given tables, for jobs that run Python on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.session import reach


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, for jobs that run Python on it."""
    reach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
