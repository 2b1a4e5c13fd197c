"""Distinct counts that add up (A3 and A5 for growing tables).

An exact distinct count reads all rows whenever a partition joins.  A ``SketchTable`` stores one
HyperLogLog sketch per partition value and group; sketches merge, so a new partition costs its own rows and any
set of partitions is estimated from its sketches alone.  Writing a partition again replaces its sketches.
The relative standard error is about 1.04 / sqrt(2 ** lg_config).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SketchTable:
    def __init__(self, spark: SparkSession, path: str, partition: str, group_by: Sequence[str] = (), lg_config: int = 14):
        self.spark, self.path, self.partition, self.group_by, self.lg = spark, path.rstrip("/"), partition, list(group_by), lg_config

    @property
    def error(self) -> float:
        """Relative standard error of an estimate."""
        return 1.04 / 2 ** (self.lg / 2)

    def add(self, df: DataFrame, value: str) -> None:
        """Sketch the partitions that ``df`` holds (whole partitions)."""
        kept = df.filter(F.col(value).isNotNull()).groupBy(self.partition, *self.group_by)
        sketches = kept.agg(F.hll_sketch_agg(value, self.lg).alias("sketch"))
        writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(self.partition).parquet(self.path)

    def estimate(self, by: Sequence[str] = ()) -> DataFrame:
        """(by..., n_distinct): distinct values over all partitions, for each value of ``by`` (the partition or group columns)."""
        merged = self.spark.read.parquet(self.path).groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
        return merged.select(*by, F.hll_sketch_estimate("sketch").alias("n_distinct"))
