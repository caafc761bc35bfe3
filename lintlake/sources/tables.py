"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as it is stored. How it is split is up to its row groups and ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(path)
