"""Full-refresh table builds (S5): ``DROP`` + ``CREATE TABLE AS`` becomes an
overwrite of a parquet directory or a catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rebuild_table(df: DataFrame, path: str | None = None, table: str | None = None,
                  fmt: str = "parquet", partition_by: list[str] | None = None,
                  bucket_by: tuple[list[str], int] | None = None) -> DataFrame:
    """Overwrite the target with ``df`` and return a DataFrame reading it back.

    ``partition_by`` (e.g. a snapshot day) makes later equality filters on
    those columns partition pruning (``PartitionFilters``) instead of scans.
    ``bucket_by=(columns, n)`` (catalog tables only; ``path`` then gives the
    location) stores the rows hashed into ``n`` buckets, so later joins and
    aggregations on those columns between tables bucketed alike need no
    shuffle (e.g. SKU x period facts read by several jobs, bucketed by SKU).
    """
    if table is None and (path is None or bucket_by):
        raise ValueError("give a path, or a table (with an optional path)")
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    if table is not None:
        if bucket_by:
            cols, n = bucket_by
            writer = writer.bucketBy(n, *cols).sortBy(*cols)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(table)
        return spark.table(table)
    writer.save(path)
    return spark.read.format(fmt).load(path)
