"""Scalar normalisers (O1-O10): one narrow projection each, no shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from .. import config
from ..functions.text import collapse_ws, match_key, py_rstrip_chars, py_strip, py_title, sql_lit, sql_ref


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def null_sentinels(df: DataFrame, sentinels=None, columns=None) -> DataFrame:
    """O1: exact-match sentinel strings become null (string columns only)."""
    sentinels = list(config.NULL_STRINGS if sentinels is None else sentinels)
    cols = set(columns or _string_columns(df))
    listed = ", ".join(sql_lit(v) for v in sentinels)

    def nulled(c):
        ref = sql_ref(c)
        return F.expr(f"CASE WHEN {ref} IN ({listed}) THEN NULL ELSE {ref} END").alias(c)

    return df.select(*[nulled(c) if c in cols else F.col(c) for c in df.columns])


def strip_columns(df: DataFrame, columns=None) -> DataFrame:
    """O2: Python ``strip`` on the text columns that are present."""
    cols = [c for c in (config.TEXT_COLUMNS if columns is None else columns) if c in df.columns]
    return df.withColumns({c: py_strip(c) for c in cols})


def name_case_expr(c: Column, short_len: int = 5) -> Column:
    """O3 rule: keep short all-caps (<= short_len letters without blanks);
    title-case other all-lower / all-upper names; keep mixed case."""
    s = py_strip(c)
    is_upper = F.upper(s) == s
    is_lower = F.lower(s) == s
    short = F.length(F.replace(s, F.lit(" "), F.lit(""))) <= short_len
    return (
        F.when(s.isNull(), s)
        .when(is_upper & short, s)
        .when(is_upper | is_lower, py_title(s))
        .otherwise(s)
    )


def name_case(df: DataFrame, column: str = "name", short_len: int = 5) -> DataFrame:
    """O3: name casing."""
    return df.withColumn(column, name_case_expr(F.col(column), short_len))


def lower_strip(df: DataFrame, columns=("price_point", "primary_type")) -> DataFrame:
    """Lower-case then strip."""
    return df.withColumns({c: py_strip(F.lower(F.col(c))) for c in columns if c in df.columns})


def url_expr(c: Column, min_length: int = config.MIN_URL_LENGTH) -> Column:
    u = py_rstrip_chars(py_strip(c), "/")
    return F.when(F.length(u) >= min_length, u)


def clean_url(df: DataFrame, column: str = "website", min_length: int = config.MIN_URL_LENGTH) -> DataFrame:
    """Strip, drop trailing '/', null when shorter than ``min_length``."""
    return df.withColumn(column, url_expr(F.col(column), min_length))


def composite_key_expr(*columns: str) -> Column:
    """Columns joined by one blank (nulls as '') and normalised as O7."""
    parts = []
    for i, c in enumerate(columns):
        if i:
            parts.append(F.lit(" "))
        parts.append(F.coalesce(F.col(c), F.lit("")))
    return match_key(F.concat(*parts))


def completeness_expr(columns, floats=()) -> Column:
    """Number of non-null cells across ``columns`` (blank counts; in the
    floating-point columns ``floats`` a NaN does not)."""
    return reduce(
        lambda a, b: a + b,
        [(F.col(c).isNotNull() & ~F.isnan(c) if c in floats else F.col(c).isNotNull()).cast("int") for c in columns],
    )


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]


def with_completeness(df: DataFrame, out: str = "completeness") -> DataFrame:
    return df.withColumn(out, completeness_expr(df.columns, float_columns(df)))


def normalise(df: DataFrame, text_columns=None) -> DataFrame:
    """O1..O6 in the reference order."""
    return (
        df.transform(null_sentinels)
        .transform(lambda d: strip_columns(d, text_columns))
        .transform(name_case)
        .transform(lower_strip)
        .transform(clean_url)
    )


__all__ = [
    "null_sentinels", "strip_columns", "name_case", "name_case_expr", "lower_strip",
    "clean_url", "url_expr", "composite_key_expr", "completeness_expr",
    "with_completeness", "normalise", "collapse_ws",
]
