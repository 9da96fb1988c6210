"""Registered queries: one per operator of the inventory, each reading the
driver tables at ``sf_dir`` (venues are derived from ``customer``).

Each callable is ``(spark, sf_dir) -> DataFrame``; column names equal the
DuckDB oracle's (:mod:`recordforge.plans.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.text import match_key, sorted_tokens
from ..operators import classify as C
from ..operators import normalise as N
from ..operators import score as R
from ..operators.automaton import first_rule
from ..operators.components import connected_components
from ..operators.dedup import dedup_exact, dedup_fuzzy, fuzzy_clusters, key_table, match_keys, pool_with_ids
from ..operators.merge import merge_groups
from ..operators.profile import null_profile, nulls_filled
from ..operators.quantiles import exact_quantiles
from ..operators.report import frequent_values, pipeline_metrics, score_summary, top_distinct, top_values, value_distribution
from ..operators.simjoin import similarity_join
from ..session import scratch_path
from ..sources.csv import apply_load_types, read_csv, write_csv
from ..sources.fixture import raw_venues, read_table
from .batch import job_tables, run_csv_job
from .cleaning import prepare, run_cleaning
from .enrichment import run_enrichment
from .incremental import add, clean_table

VENUE_COLUMNS = config.REQUIRED_COLUMNS

# An alternative weighting (the reference takes weights as a parameter for
# A/B comparisons); used by ``score_weighted_alt``.
ALT_WEIGHTS = {
    "price_point": 0.20,
    "address": 0.20,
    "fancy_type": 0.20,
    "name_keyword": 0.20,
    "cuisine": 0.10,
    "has_website": 0.10,
}


PART_THRESHOLD = 70


def loaded(spark, sf):
    """Raw venues as a CSV load delivers them (load sentinels are null)."""
    return apply_load_types(raw_venues(spark, sf))


def prepared(spark, sf):
    return prepare(loaded(spark, sf))


def clean(spark, sf):
    return run_cleaning(loaded(spark, sf))


def enriched(spark, sf):
    return run_enrichment(clean(spark, sf))


def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "venues-csv")
    write_csv(raw_venues(spark, sf), path)
    return read_csv(spark, path)


def q_csv_split(spark, sf):
    """All documents through CSV, whose quoted cells hold line breaks, read back in ranges."""
    path = scratch_path(spark, "documents-csv")
    write_csv(read_table(spark, sf, "documents").select("doc_id", "lang", "source", "text"), path)
    back = read_csv(spark, path, columns=["doc_id", "text"], numeric=(), split=True)
    text = [F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("text_md5")]
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", *text)


def q_null_profile(spark, sf):
    return null_profile(loaded(spark, sf))


def q_norm_nulls(spark, sf):
    return N.null_sentinels(raw_venues(spark, sf))


def q_norm_strip(spark, sf):
    return N.strip_columns(raw_venues(spark, sf)).select("id", *config.TEXT_COLUMNS)


def q_norm_case(spark, sf):
    d = N.null_sentinels(raw_venues(spark, sf)).transform(N.strip_columns)
    return N.name_case(d).select("id", "name")


def q_norm_lower(spark, sf):
    return N.lower_strip(N.null_sentinels(raw_venues(spark, sf))).select("id", "price_point", "primary_type")


def q_norm_url(spark, sf):
    return N.clean_url(N.null_sentinels(raw_venues(spark, sf))).select("id", "website")


def q_norm_url_pages(spark, sf):
    pages = read_table(spark, sf, "pages").select("page_id", "url")
    return N.clean_url(pages, "url")


def q_match_key(spark, sf):
    d = prepared(spark, sf)
    return d.select(
        "id",
        match_key(F.col("display_address")).alias("addr_key"),
        N.composite_key_expr("name", "city").alias("nc_key"),
    )


def q_completeness(spark, sf):
    d = loaded(spark, sf)
    return d.select("id", N.completeness_expr(d.columns, N.float_columns(d)).cast("bigint").alias("completeness"))


def q_impute_chain(spark, sf):
    from ..operators.impute import impute_price

    d = N.normalise(loaded(spark, sf))
    return impute_price(d).select("id", "price_point")


def q_impute_extract(spark, sf):
    from ..operators.impute import impute_city

    d = N.normalise(loaded(spark, sf))
    return impute_city(d).select("id", "city")


def q_merge_rules(spark, sf):
    d = prepared(spark, sf).filter(F.col("google_place_id").isNotNull())
    m = merge_groups(d, ["google_place_id"], columns=VENUE_COLUMNS)
    return m.drop("latitude", "longitude")


def q_merge_coords(spark, sf):
    d = prepared(spark, sf).filter(F.col("google_place_id").isNotNull())
    return merge_groups(d, ["google_place_id"], columns=VENUE_COLUMNS).select(
        "google_place_id", "latitude", "longitude"
    )


def q_dedup_exact(spark, sf):
    return dedup_exact(prepared(spark, sf))


def _pool(spark, sf):
    return pool_with_ids(prepared(spark, sf).filter(F.col("google_place_id").isNull()))


def _pairs(spark, sf, column, threshold):
    keys = match_keys(_pool(spark, sf))
    reps, _ = key_table(keys, column)
    return similarity_join(reps, threshold).select("cohort", "key_a", "key_b")


def q_fuzzy_pairs(spark, sf):
    return _pairs(spark, sf, "addr_key", config.FUZZY_ADDRESS_THRESHOLD)


def q_fuzzy_pairs_name(spark, sf):
    return _pairs(spark, sf, "nc_key", config.FUZZY_NAME_CITY_THRESHOLD)


def q_fuzzy_pairs_part(spark, sf):
    """Near part names of a brand: the join on given text, whole strings."""
    name = sorted_tokens(match_key(F.col("p_name")))
    parts = read_table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("cohort"), name.alias("key"))
    reps = parts.filter(F.length("key") > 0).groupBy("cohort", "key").agg(F.min("p_partkey").alias("node"))
    return similarity_join(reps, PART_THRESHOLD).select("cohort", "key_a", "key_b", "node_a", "node_b")


def q_order_part_components(spark, sf):
    """Connected orders and parts (an order is 2k, a part 2k + 1)."""
    items = read_table(spark, sf, "lineitem")
    edges = items.select((F.col("l_orderkey") * 2).alias("src"), (F.col("l_partkey") * 2 + 1).alias("dst"))
    return connected_components(edges)


def q_merge_segment(spark, sf):
    """Customers merged by market segment: groups of any size, the balances' running midpoint in key order."""
    rows = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name", "c_acctbal")
    rules = {"c_name": "longest", "c_acctbal": "midpoint"}
    out = merge_groups(rows, ["c_mktsegment"], order_by=("c_custkey",), columns=["c_custkey", "c_name", "c_acctbal"], rules=rules)
    return out.select("c_mktsegment", "c_custkey", "c_name", F.round("c_acctbal", 6).alias("c_acctbal"))


def q_csv_job(spark, sf):
    """The whole job from a CSV path to enriched CSV; the enriched table."""
    path, out = scratch_path(spark, "venues-csv"), scratch_path(spark, "csv-job")
    write_csv(raw_venues(spark, sf), path)
    run_csv_job(spark, path, out)
    return spark.read.parquet(job_tables(spark, out)["enriched"])


def q_fuzzy_clusters(spark, sf):
    pool = _pool(spark, sf)
    cl = fuzzy_clusters(pool).join(pool.select("_rid", "id"), "_rid")
    label = cl.groupBy("cluster").agg(F.min("id").alias("cluster_id"))
    return cl.join(label, "cluster").select("id", "cluster_id")


def q_dedup_fuzzy(spark, sf):
    d = prepared(spark, sf).filter(F.col("google_place_id").isNull())
    return dedup_fuzzy(d)


def q_clean_pipeline(spark, sf):
    return clean(spark, sf)


def _in_batches(spark, sf, batches):
    """The venues brought into a clean table batch by batch (by id modulo 3); the folder, and what the last one took."""
    folder = scratch_path(spark, "incremental")
    rows, took = loaded(spark, sf), {}
    for remainders in batches:
        took = add(spark, rows.filter((F.col("id").cast("bigint") % 3).isin(remainders)), folder)
    return folder, took


def q_incremental_clean(spark, sf):
    """All venues in two batches; most venues have records in both. Equal to one run over all."""
    return clean_table(spark, _in_batches(spark, sf, ([0, 1], [2]))[0])


def q_incremental_touched(spark, sf):
    """What the last batch took: its records, the groups it touched, and all records of those."""
    _, took = _in_batches(spark, sf, ([0, 1], [2]))
    names = ["rows_added", "groups_merged", "rows_merged"]
    return spark.createDataFrame([tuple(took[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def q_classify_lookup(spark, sf):
    d = prepared(spark, sf)
    return d.select("id", "primary_type", C.lookup_expr("primary_type").alias("cuisine"))


def q_classify_keywords(spark, sf):
    d = prepared(spark, sf)
    return d.select("id", "name", C.keyword_expr("name").alias("cuisine"))


def q_classify_keywords_part(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_name")
    return p.select("p_partkey", "p_name", C.keyword_expr("p_name").alias("cuisine"))


def q_classify_waterfall(spark, sf):
    return C.classify(prepared(spark, sf)).select("id", "cuisine_category")


def q_score_signals(spark, sf):
    d = run_enrichment(prepared(spark, sf))
    return d.select("id", *[name for _, name in R.SIGNALS])


def q_score_weighted(spark, sf):
    return run_enrichment(prepared(spark, sf)).select("id", "romantic_score")


def q_score_weighted_alt(spark, sf):
    return run_enrichment(prepared(spark, sf), ALT_WEIGHTS).select("id", "romantic_score")


def q_score_label(spark, sf):
    return run_enrichment(prepared(spark, sf)).select("id", "romantic_score", "romantic_label")


def q_enrich_pipeline(spark, sf):
    return enriched(spark, sf)


def q_report_metrics(spark, sf):
    c = clean(spark, sf)
    return pipeline_metrics(loaded(spark, sf), c, run_enrichment(c))


def q_report_null_filled(spark, sf):
    return nulls_filled(loaded(spark, sf), clean(spark, sf))


def q_report_null_left(spark, sf):
    return null_profile(clean(spark, sf))


def q_report_summary(spark, sf):
    return score_summary(enriched(spark, sf))


def q_report_labels(spark, sf):
    return value_distribution(enriched(spark, sf), "romantic_label")


def q_report_categories(spark, sf):
    return top_values(enriched(spark, sf), "cuisine_category", 10)


def q_report_top(spark, sf):
    return top_distinct(enriched(spark, sf), 10, ascending=False)


def q_report_bottom(spark, sf):
    return top_distinct(enriched(spark, sf), 5, ascending=True)


QUANTILE_COLUMNS = ("l_extendedprice", "l_quantity", "l_discount")
QUANTILE_PROBS = (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)


def q_report_quantiles(spark, sf):
    """Exact quantiles of the line items' figures; nearly every price is a value of its own."""
    out = exact_quantiles(read_table(spark, sf, "lineitem"), QUANTILE_COLUMNS, QUANTILE_PROBS)
    return out.withColumn("value", F.round("value", 6))


def _words(spark, sf):
    text = F.regexp_replace("text", "\n", " ")
    words = read_table(spark, sf, "documents").select(F.explode(F.split(text, " ")).alias("word"))
    return words.filter(F.col("word") != "")


def q_report_words(spark, sf):
    """The 20 most frequent words of all documents, of many thousand."""
    return frequent_values(_words(spark, sf), "word", 20)


def q_report_items(spark, sf):
    """The 10 parts with most line items: even counts, where no bucket can be left out."""
    return frequent_values(read_table(spark, sf, "lineitem"), "l_partkey", 10)


def q_classify_rules_documents(spark, sf):
    """Documents by a table of rules: a word start of three letters (at most 26^3) is a rule, rarest first."""
    start = F.substring(F.lower("word"), 1, 3).alias("keyword")
    rules = _words(spark, sf).select(start).filter(F.col("keyword").rlike("^[a-z]{3}$"))
    rules = rules.groupBy("keyword").agg(F.count(F.lit(1)).alias("priority"))
    rules = rules.withColumn("value", F.concat_ws("/", "keyword", F.col("priority").cast("string")))
    return read_table(spark, sf, "documents").select("doc_id", first_rule(F.col("text"), rules).alias("rule"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_roundtrip": q_csv_roundtrip,
    "csv_split": q_csv_split,
    "null_profile": q_null_profile,
    "norm_nulls": q_norm_nulls,
    "norm_strip": q_norm_strip,
    "norm_case": q_norm_case,
    "norm_lower": q_norm_lower,
    "norm_url": q_norm_url,
    "norm_url_pages": q_norm_url_pages,
    "match_key": q_match_key,
    "completeness": q_completeness,
    "impute_chain": q_impute_chain,
    "impute_extract": q_impute_extract,
    "merge_rules": q_merge_rules,
    "merge_coords": q_merge_coords,
    "dedup_exact": q_dedup_exact,
    "fuzzy_pairs": q_fuzzy_pairs,
    "fuzzy_pairs_name": q_fuzzy_pairs_name,
    "fuzzy_pairs_part": q_fuzzy_pairs_part,
    "order_part_components": q_order_part_components,
    "merge_segment": q_merge_segment,
    "csv_job": q_csv_job,
    "fuzzy_clusters": q_fuzzy_clusters,
    "dedup_fuzzy": q_dedup_fuzzy,
    "clean_pipeline": q_clean_pipeline,
    "incremental_clean": q_incremental_clean,
    "incremental_touched": q_incremental_touched,
    "classify_lookup": q_classify_lookup,
    "classify_keywords": q_classify_keywords,
    "classify_keywords_part": q_classify_keywords_part,
    "classify_waterfall": q_classify_waterfall,
    "score_signals": q_score_signals,
    "score_weighted": q_score_weighted,
    "score_weighted_alt": q_score_weighted_alt,
    "score_label": q_score_label,
    "enrich_pipeline": q_enrich_pipeline,
    "report_metrics": q_report_metrics,
    "report_null_filled": q_report_null_filled,
    "report_null_left": q_report_null_left,
    "report_summary": q_report_summary,
    "report_labels": q_report_labels,
    "report_categories": q_report_categories,
    "report_top": q_report_top,
    "report_quantiles": q_report_quantiles,
    "report_words": q_report_words,
    "report_items": q_report_items,
    "classify_rules_documents": q_classify_rules_documents,
    "report_bottom": q_report_bottom,
}
