"""The whole job: load -> clean -> write -> enrich -> write -> report tables.

Both outputs are written once as Parquet and read back (S5): the fuzzy
dedup DAG runs once, and enrichment, the CSV sinks and every report read
the written tables (column-pruned scans) instead of recomputing lineage.

A run writes folders of its own and names them all in one manifest at the end
(:mod:`recordforge.sources.publish`): a run that stops anywhere leaves the tables of
the run before it in force, and readers never see clean records of one run
beside enriched ones of another. ``job_tables`` gives the paths in force.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import null_profile, nulls_filled
from ..operators.report import pipeline_metrics, score_summary, top_distinct, top_values, value_distribution
from ..sources.csv import read_csv, validate_schema, write_csv
from ..sources.publish import expire, publish, published, version
from .cleaning import run_cleaning
from .enrichment import run_enrichment


def run_job(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    weights: dict | None = None,
    write_csv_outputs: bool = True,
    stage_metrics: dict | None = None,
    keep: int = 2,
) -> dict[str, DataFrame]:
    """Writes ``clean`` and ``enriched`` under ``out_dir`` and publishes them together;
    returns the report tables (lazy DataFrames over the written outputs).

    The tables of the last ``keep`` runs stay, for readers that began before this one
    was published; older ones are deleted. If another run published to ``out_dir``
    meanwhile, this one raises and publishes nothing.

    If ``stage_metrics`` is a dict it receives the stage log figures of the
    reference (rows out of cleaning; rows, mean and median score out of
    enrichment), gathered by ``observe`` during the two writes: no extra job.
    """
    validate_schema(raw)
    began = version(spark, out_dir)
    run = uuid.uuid4().hex
    folders = {"clean": f"clean-{run}.parquet", "enriched": f"enriched-{run}.parquet"}
    if write_csv_outputs:
        folders |= {"clean_csv": f"clean-{run}.csv", "enriched_csv": f"enriched-{run}.csv"}
    paths = {name: os.path.join(out_dir, folder) for name, folder in folders.items()}
    n = F.count(F.lit(1)).alias("rows")
    clean_obs, enrich_obs = Observation("cleaning"), Observation("enrichment")
    run_cleaning(raw).observe(clean_obs, n).write.parquet(paths["clean"])
    clean = spark.read.parquet(paths["clean"])
    score = F.col("romantic_score")
    (
        run_enrichment(clean, weights)
        .observe(enrich_obs, n, F.avg(score).alias("mean"), F.median(score).alias("median"))
        .write.parquet(paths["enriched"])
    )
    enriched = spark.read.parquet(paths["enriched"])
    if stage_metrics is not None:
        stage_metrics["cleaning"] = clean_obs.get
        stage_metrics["enrichment"] = enrich_obs.get
    if write_csv_outputs:
        write_csv(clean, paths["clean_csv"])
        write_csv(enriched, paths["enriched_csv"])
    publish(spark, out_dir, folders, expected=began)
    expire(spark, out_dir, keep)
    return {
        "metrics": pipeline_metrics(raw, clean, enriched),
        "nulls_loaded": null_profile(raw),
        "nulls_filled": nulls_filled(raw, clean),
        "nulls_left": null_profile(clean),
        "summary": score_summary(enriched),
        "labels": value_distribution(enriched, "romantic_label"),
        "categories": top_values(enriched, "cuisine_category", 10),
        "top": top_distinct(enriched, 10, ascending=False),
        "bottom": top_distinct(enriched, 5, ascending=True),
    }


def job_tables(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """The paths of the tables in force under ``out_dir``: ``clean``, ``enriched`` and, if
    written, ``clean_csv`` and ``enriched_csv``. Empty where no run was published."""
    return {name: os.path.join(out_dir, folder) for name, folder in (published(spark, out_dir) or {}).items()}


def run_csv_job(spark: SparkSession, path: str, out_dir: str, multi_line: bool = True, **options) -> dict[str, DataFrame]:
    """The job from a CSV path to clean and enriched CSV (and Parquet) under ``out_dir``."""
    return run_job(spark, read_csv(spark, path, multi_line=multi_line), out_dir, **options)
