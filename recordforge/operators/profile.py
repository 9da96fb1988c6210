"""Null profiles (S2, A2, A3): one aggregate pass, then unpivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def missing(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, (DoubleType, FloatType)) else c.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, computed in a single scan. A NaN counts
    as null, as it does where the table came from a text file."""
    counts = df.agg(*[F.count_if(missing(df, c)).cast("bigint").alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "nulls")


def null_profile(df: DataFrame) -> DataFrame:
    """Columns with at least one null."""
    return null_counts(df).filter(F.col("nulls") > 0)


def nulls_filled(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Per shared column: raw nulls minus clean nulls, where positive."""
    shared = [c for c in raw.columns if c in clean.columns]
    r = null_counts(raw.select(*shared)).withColumnRenamed("nulls", "raw_nulls")
    c = null_counts(clean.select(*shared)).withColumnRenamed("nulls", "clean_nulls")
    return (
        r.join(c, "column")
        .filter(F.col("raw_nulls") > F.col("clean_nulls"))
        .select("column", (F.col("raw_nulls") - F.col("clean_nulls")).alias("filled"))
    )
