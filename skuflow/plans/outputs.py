"""Output normalisation for registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Cast DECIMAL columns to DOUBLE (exact sums are converted once, at the end)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name) for f in df.schema.fields])


def rounded(df: DataFrame, columns, places: int = 9) -> DataFrame:
    """Round the given double columns once, at output (sums of doubles only)."""
    cols = set(columns)
    return df.select(*[F.round(F.col(c), places).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
