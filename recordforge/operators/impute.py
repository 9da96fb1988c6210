"""Gap filling by priority chains (I1) and pattern extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import any_contains, map_lookup, py_strip, regex_literal


def price_chain_expr(
    price: Column,
    ptype: Column,
    url: Column,
    type_map: dict | None = None,
    url_tokens=None,
    url_value: str = "high",
) -> Column:
    """Keep a present value (even ''), else the type map, else a URL hit."""
    type_map = config.TYPE_PRICE_MAP if type_map is None else type_map
    url_tokens = config.URL_HIGH_TOKENS if url_tokens is None else url_tokens
    flat = F.regexp_replace(F.lower(url), "[^a-z0-9]", "")
    by_url = F.when(url.isNotNull() & any_contains(flat, url_tokens), F.lit(url_value))
    return F.coalesce(price, map_lookup(py_strip(ptype), type_map), by_url)


def impute_price(
    df: DataFrame,
    column: str = "price_point",
    type_column: str = "primary_type",
    url_column: str = "website",
    type_map: dict | None = None,
    url_tokens=None,
) -> DataFrame:
    return df.withColumn(
        column,
        price_chain_expr(F.col(column), F.col(type_column), F.col(url_column), type_map, url_tokens),
    )


def longest_first_alternation(names) -> str:
    """Names sorted by length, longest first (stable), as one alternation."""
    ordered = sorted(names, key=len, reverse=True)
    return "|".join(regex_literal(n) for n in ordered)


def extract_expr(source: Column, names=None) -> Column:
    """Leftmost case-insensitive hit of any name, as written in ``source``."""
    names = config.KNOWN_CITIES if names is None else names
    pattern = "(?iu)(" + longest_first_alternation(names) + ")"
    return F.nullif(F.regexp_extract(source, pattern, 1), F.lit(""))


def impute_city(df: DataFrame, column: str = "city", source: str = "display_address", names=None) -> DataFrame:
    """Keep a present value, else extract a known name from ``source``."""
    return df.withColumn(column, F.coalesce(F.col(column), extract_expr(F.col(source), names)))
