"""Row-wise stages on a stream.

The reference is a batch job with no streaming. Its row-wise stages
(normalise, impute, classify, score) are narrow projections, so the same
functions apply unchanged to a streaming DataFrame. Deduplication is a
global operation over the whole table and stays batch-only: run
:func:`recordforge.plans.cleaning.run_cleaning` on the accumulated table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.cleaning import prepare
from ..plans.enrichment import run_enrichment
from ..sources.csv import apply_load_types


def enrich_rows(stream: DataFrame, weights: dict | None = None) -> DataFrame:
    """Load typing, O1-O6, I1, I2, C1-C3 and R1-R8 on each micro-batch."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return run_enrichment(prepare(apply_load_types(stream)), weights)
