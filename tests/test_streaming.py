"""Row-wise stages give the same rows on a stream as in batch."""

import os
import tempfile

from recordforge.plans.catalog import loaded
from recordforge.plans.cleaning import prepare
from recordforge.plans.enrichment import run_enrichment
from recordforge.sources.fixture import venues_from_customer
from recordforge.streaming.enrich import enrich_rows


def test_stream_equals_batch(spark, sf_small):
    src = os.path.join(sf_small, "customer.parquet")
    schema = spark.read.parquet(src).schema
    # file streams watch a directory; pick the one table from it
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(sf_small)
    out = enrich_rows(venues_from_customer(spark, stream))
    q = (
        out.writeStream.format("memory")
        .queryName("enriched_stream")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="rf-stream-"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    got = sorted(tuple(r) for r in spark.table("enriched_stream").collect())
    exp = sorted(tuple(r) for r in run_enrichment(prepare(loaded(spark, sf_small))).collect())
    assert got == exp
