"""Summary, distribution and top-k tables (A1-A8), each a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .profile import null_profile, nulls_filled


def pipeline_metrics(raw: DataFrame, clean: DataFrame, enriched: DataFrame) -> DataFrame:
    """A1: row counts per stage, duplicates removed and output column count.
    The later counts are scalar subqueries (one value each, no join)."""
    n = F.count(F.lit(1))
    return (
        raw.agg(n.alias("rows_in"))
        .select(
            "rows_in",
            clean.agg(n).scalar().alias("rows_clean"),
            enriched.agg(n).scalar().alias("rows_enriched"),
        )
        .select(
            "rows_in",
            "rows_clean",
            "rows_enriched",
            (F.col("rows_in") - F.col("rows_clean")).alias("duplicates_removed"),
            F.lit(len(enriched.columns)).cast("bigint").alias("columns"),
        )
    )


def score_summary(df: DataFrame, score: str = "romantic_score", digits: int = 6) -> DataFrame:
    """A4: mean, exact median (interpolated), sample std, min, max."""
    s = F.col(score)
    return df.agg(
        F.round(F.avg(s), digits).alias("mean"),
        F.round(F.median(s), digits).alias("median"),
        F.round(F.stddev_samp(s), digits).alias("std"),
        F.min(s).alias("min"),
        F.max(s).alias("max"),
    )


def value_distribution(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """A5: count and share (%) per value; the total is the sum of the counts,
    one row per value, so the input is read once."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(column, "count", F.round(F.lit(100.0) * F.col("count") / total, digits).alias("pct"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values (ties by value)."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(column).asc_nulls_first())
        .limit(k)
    )


#: Hash buckets that bound the counts of the values within.
BUCKETS = 65_536


def frequent_values(df: DataFrame, column: str, k: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """A6 for columns of many values: ``top_values``, exactly, without shuffling every value.

    Rows are counted by hash bucket (at most ``buckets`` rows from a task); a bucket's count bounds
    the count of each value in it. The values of the heaviest buckets are counted, their k-th
    count is a bar the k most frequent values reach, and only values of buckets that reach it are
    counted then. Where counts are so even that all buckets do, that is all of them. Reads ``column`` three
    times; the first two readings run at once."""
    values = df.select(column).withColumn("__b", F.pmod(F.xxhash64(column), F.lit(buckets)))
    summary = values.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    checkpoint_dir(df.sparkSession)
    summary = summary.checkpoint()  # one row a bucket

    def counted(chosen: DataFrame) -> DataFrame:
        return top_values(values.join(F.broadcast(chosen.select("__b")), "__b", "left_semi"), column, k)

    sure = counted(summary.orderBy(F.col("__n").desc(), "__b").limit(2 * k))
    bar = sure.agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("low")).head()
    return counted(summary.filter(F.col("__n") >= F.lit(bar.low if bar.n == k else 0)))


def top_distinct(
    df: DataFrame,
    k: int,
    by: str = "romantic_score",
    distinct_on: str = "name",
    columns=("name", "city", "cuisine_category", "romantic_score"),
    ascending: bool = False,
    tie: str = "id",
) -> DataFrame:
    """Best row per ``distinct_on`` value (null is one value), then
    the k best of those. Per-value winners come from a partial aggregate
    (``min_by``), the final cut is a top-k (no global sort)."""
    sign = 1 if ascending else -1
    order = F.struct((F.lit(sign) * F.col(by)).alias("s"), F.col(tie).alias("t"))
    best = df.groupBy(distinct_on).agg(F.min_by(F.struct(*[F.col(c) for c in columns]), order).alias("__w"))
    out = best.select("__w.*")
    first = F.col(by).asc() if ascending else F.col(by).desc()
    return out.orderBy(first, F.col(distinct_on).asc_nulls_first()).limit(k)


__all__ = [
    "pipeline_metrics", "score_summary", "value_distribution", "top_values", "frequent_values", "top_distinct",
    "null_profile", "nulls_filled",
]
