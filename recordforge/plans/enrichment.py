"""Enrichment stage (R9): classification waterfall then weighted score."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.classify import classify
from ..operators.score import add_scores


def run_enrichment(df: DataFrame, weights: dict | None = None) -> DataFrame:
    """Adds cuisine_category, six score_* columns, romantic_score and
    romantic_label. A single narrow projection: no shuffle."""
    return df.transform(classify).transform(lambda d: add_scores(d, weights))
