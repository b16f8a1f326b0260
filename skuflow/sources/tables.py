"""Warehouse-table scans (S3) and snapshot-restricted scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """S3: one parquet table ``<base_dir>/<name>.parquet`` (or a directory of parts)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def snapshot(df: DataFrame, dt: str, column: str = "dt") -> DataFrame:
    """Restrict to one snapshot partition (``dt = '...'``).

    On a table partitioned by ``column`` this literal equality becomes a
    ``PartitionFilters`` entry of the scan; on a plain file it is a pushed
    row-group filter.
    """
    return df.where(F.col(column) == F.lit(dt))
