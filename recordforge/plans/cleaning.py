"""Cleaning stage (D6): normalise -> impute -> exact dedup -> fuzzy dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import merge_keyed, merge_pool
from ..operators.impute import impute_city, impute_price
from ..operators.normalise import normalise
from ..session import checkpoint_dir


def prepare(df: DataFrame) -> DataFrame:
    """One narrow projection (no shuffle)."""
    return df.transform(normalise).transform(impute_price).transform(impute_city)


def run_cleaning(df: DataFrame, order_by=("id",), key: str = "google_place_id", rules=None, **fuzzy) -> DataFrame:
    """The reference order: nulls, text, names, price, type, URL, price
    chain, city, exact-key dedup, fuzzy dedup.

    The input is prepared once and written to the checkpoint folder, then split
    by the key: exact dedup only touches rows that have it, fuzzy dedup only
    those that do not, so the two are planned side by side and united once.
    """
    checkpoint_dir(df.sparkSession)
    p = prepare(df).checkpoint()
    keyed = merge_keyed(p.filter(F.col(key).isNotNull()), key, order_by, rules, reuse=False)
    pooled = merge_pool(p.filter(F.col(key).isNull()), order_by, rules, **fuzzy)
    return keyed.unionByName(pooled)
