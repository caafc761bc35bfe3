"""Intermediate tables and balanced ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lintlake.functions.scale import scratch_path


def stage_compressed(df: DataFrame, name: str) -> DataFrame:
    """Write a table with long binary columns to the shared folder, and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class Ranges:
    """Ranges of a long column with about equal numbers of rows, as many as there are shuffle partitions.

    Only the bounds and the ranges' totals come to the driver, a few numbers per partition. A column that is unique, or
    made so by a hash in its low bits, splits whatever the data.
    """

    def __init__(self, df: DataFrame, key: str) -> None:
        self.key = key
        self.n = partitions(df)
        shares = [i / self.n for i in range(1, self.n)]
        cuts = df.agg(F.percentile_approx(key, shares, 100 * self.n).alias("cuts")).first()[0] if shares else []
        self.bounds = np.array(cuts or [], dtype=np.int64)

    def mark(self, df: DataFrame) -> DataFrame:
        """With the row's range as integer column ``range``; null keys are in the first."""
        key, bounds = self.key, self.bounds

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(key).fill_null(-(2**63)).to_numpy(zero_copy_only=False)
                found = np.searchsorted(bounds, values, side="right").astype(np.int32)
                yield batch.append_column("range", pa.array(found))

        return df.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField("range", T.IntegerType())]))

    def sort(self, df: DataFrame, *order: str) -> DataFrame:
        """The table in one partition per range, sorted within."""
        return self.mark(df).repartitionById(self.n, F.col("range")).sortWithinPartitions(*order)

    def offsets(self, df: DataFrame, weight: str) -> np.ndarray:
        """The sum of ``weight`` in all earlier ranges, by range."""
        rows = self.mark(df.select(self.key, weight)).groupBy("range").agg(F.sum(weight).alias("n")).collect()
        totals = np.zeros(self.n, dtype=np.int64)
        for row in rows:
            totals[row["range"]] = row["n"] or 0
        return np.cumsum(totals) - totals

