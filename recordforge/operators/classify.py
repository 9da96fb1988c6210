"""Rule-based classification (C1-C3): lookup, ordered keyword scans, waterfall.

All tiers are one CASE / map expression each, so the whole waterfall is a
single narrow projection inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import first_keyword, first_keyword_sql, lookup_sql, map_lookup, sql_lit, sql_ref


def _lower_sql(c: str) -> str:
    return f"lower({sql_ref(c)})"


def lookup_expr(c, mapping: dict | None = None) -> Column:
    """``mapping[lower(c)]``; unknown or null -> null. ``c`` is a column
    name (one SQL expression) or a Column."""
    mapping = config.PRIMARY_TYPE_TO_CUISINE if mapping is None else mapping
    if isinstance(c, str):
        return F.expr(lookup_sql(_lower_sql(c), mapping))
    return map_lookup(F.lower(c), mapping)


def keyword_expr(c, rules=None) -> Column:
    """First rule (in list order) whose keyword occurs in lower(c)."""
    rules = config.NAME_KEYWORDS_TO_CUISINE if rules is None else rules
    if isinstance(c, str):
        return F.expr(first_keyword_sql(f"coalesce({_lower_sql(c)}, '')", rules))
    return first_keyword(F.coalesce(F.lower(c), F.lit("")), rules)


def waterfall_expr(
    ptype: str,
    name: str,
    url: str,
    type_map: dict | None = None,
    name_rules=None,
    url_rules=None,
    fallback: str = config.FALLBACK_CUISINE,
) -> Column:
    """Lookup unless null or the fallback sentinel, then name scan, then
    URL scan, then the fallback value (column names in, one expression)."""
    type_map = config.PRIMARY_TYPE_TO_CUISINE if type_map is None else type_map
    name_rules = config.NAME_KEYWORDS_TO_CUISINE if name_rules is None else name_rules
    url_rules = config.WEBSITE_KEYWORDS_TO_CUISINE if url_rules is None else url_rules
    fb = sql_lit(fallback)
    lookup = lookup_sql(_lower_sql(ptype), type_map)
    by_name = first_keyword_sql(f"coalesce({_lower_sql(name)}, '')", name_rules)
    by_url = first_keyword_sql(f"coalesce({_lower_sql(url)}, '')", url_rules)
    return F.expr(f"coalesce(nullif({lookup}, {fb}), {by_name}, {by_url}, {fb})")


def classify(
    df: DataFrame,
    out: str = "cuisine_category",
    type_column: str = "primary_type",
    name_column: str = "name",
    url_column: str = "website",
    **rules,
) -> DataFrame:
    return df.withColumn(out, waterfall_expr(type_column, name_column, url_column, **rules))
