"""Registered queries against their DuckDB oracles on the smallest tables,
plus the driver entry point."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from recordforge.plans.catalog import QUERIES

CHECKED = [
    "csv_roundtrip", "null_profile", "norm_case", "norm_url_pages", "match_key", "impute_chain",
    "impute_extract", "merge_coords", "dedup_exact", "fuzzy_pairs", "fuzzy_clusters", "clean_pipeline",
    "fuzzy_pairs_name", "fuzzy_pairs_part", "merge_segment", "csv_job", "classify_keywords_part", "score_label", "enrich_pipeline", "report_summary", "report_top",
    "csv_split", "report_quantiles", "report_words", "report_items", "classify_rules_documents",
]


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return v

    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for name in ("customer", "pages", "part", "documents", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(sf_small, name)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(E.oracle_sql()) == {"order_part_components"}  # iterative, see test_order_part_components
    assert set(QUERIES) <= set(E.queries())


def test_order_part_components(spark, sf_small):
    items = duckdb.sql(f"SELECT l_orderkey * 2, l_partkey * 2 + 1 FROM '{sf_small}/lineitem.parquet'").fetchall()
    label = {x: x for e in items for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in items:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    got = {r.node: r.component for r in E.queries()["order_part_components"](spark, sf_small).collect()}
    assert got == label


def test_checked_pairs_are_not_empty(spark, sf_small):
    for name in ("fuzzy_pairs_part", "fuzzy_pairs_name"):
        assert not E.queries()[name](spark, sf_small).isEmpty(), name


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(srows, df.columns) == _canon(drows, dcols)


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["romantic_label", "count", "pct"]
    assert abs(sum(r.pct for r in rows) - 100.0) < 1e-6


def test_partition_count_invariance(spark, sf_small):
    """The cleaned table does not depend on the number of shuffle partitions."""
    from recordforge.plans.catalog import clean

    out = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(tuple(r) for r in clean(spark, sf_small).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert out[0] == out[1]


def test_exact_dedup_idempotent(spark, sf_small):
    from recordforge.operators.dedup import dedup_exact
    from recordforge.plans.catalog import prepared

    once = dedup_exact(prepared(spark, sf_small))
    twice = dedup_exact(once)
    assert sorted(tuple(r) for r in once.collect()) == sorted(tuple(r) for r in twice.collect())


def test_batch_job_writes_and_reports(spark, sf_small):
    from recordforge.plans.batch import run_job
    from recordforge.plans.catalog import loaded
    from recordforge.session import scratch_path

    stages = {}
    raw = loaded(spark, sf_small)
    reports = run_job(spark, raw, scratch_path(spark, "job-test"), stage_metrics=stages)
    m = reports["metrics"].first()
    assert m.rows_in == raw.count() and m.columns == 19
    assert stages["cleaning"]["rows"] == m.rows_clean == m.rows_enriched
    assert stages["enrichment"]["rows"] == m.rows_clean
    summary = reports["summary"].first()
    assert abs(stages["enrichment"]["mean"] - summary.mean) < 1e-6
    assert stages["enrichment"]["median"] == summary.median


def test_a_job_that_stops_leaves_the_tables_before_it(spark, sf_small, monkeypatch, tmp_path):
    from recordforge.plans import batch
    from recordforge.plans.catalog import loaded

    out = str(tmp_path / "job")
    raw = loaded(spark, sf_small).orderBy("id").limit(40).checkpoint()
    assert batch.job_tables(spark, out) == {}

    def rows(name):
        return sorted(map(repr, spark.read.parquet(batch.job_tables(spark, out)[name]).collect()))

    batch.run_job(spark, raw, out)
    first = batch.job_tables(spark, out)
    assert set(first) == {"clean", "enriched", "clean_csv", "enriched_csv"} and all(map(os.path.isdir, first.values()))
    before = rows("clean"), rows("enriched")

    def stop(*_, **__):
        raise RuntimeError("stopped")

    fewer = spark.read.parquet(first["clean"]).orderBy("id").limit(15).checkpoint()
    monkeypatch.setattr(batch, "run_cleaning", lambda _: fewer)
    # between the two writes, in a later one and before the end
    for name in ("run_enrichment", "write_csv", "publish"):
        with monkeypatch.context() as m:
            m.setattr(batch, name, stop)
            with pytest.raises(RuntimeError, match="stopped"):
                batch.run_job(spark, raw, out)
        assert batch.job_tables(spark, out) == first and (rows("clean"), rows("enriched")) == before

    batch.run_job(spark, raw, out, write_csv_outputs=False)
    second = batch.job_tables(spark, out)
    assert set(second) == {"clean", "enriched"} and len(rows("clean")) == len(rows("enriched")) == 15
    assert all(map(os.path.isdir, first.values()))  # for readers that began before
    batch.run_job(spark, raw, out, write_csv_outputs=False)
    assert not any(map(os.path.exists, first.values())) and all(map(os.path.isdir, second.values()))


def test_two_jobs_at_once_do_not_mix(spark, sf_small, monkeypatch, tmp_path):
    from recordforge.plans import batch
    from recordforge.plans.catalog import loaded, prepared

    out = str(tmp_path / "job")
    clean = prepared(spark, sf_small).orderBy("id").limit(20).checkpoint()
    raw = loaded(spark, sf_small)
    monkeypatch.setattr(batch, "run_cleaning", lambda _: clean)
    enrich = batch.run_enrichment

    def other_first(*args):
        monkeypatch.setattr(batch, "run_enrichment", enrich)
        batch.run_job(spark, raw, out, write_csv_outputs=False)
        return enrich(*args)

    monkeypatch.setattr(batch, "run_enrichment", other_first)
    with pytest.raises(RuntimeError, match="published meanwhile"):
        batch.run_job(spark, raw, out, write_csv_outputs=False)
    assert len(batch.job_tables(spark, out)) == 2
