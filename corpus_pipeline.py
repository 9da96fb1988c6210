"""Corpus pipeline: documents -> identified language -> one of each near-duplicate
group -> mix of sources -> packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage's result as Parquet in
the shared folder and hands the reread table to the next.

Null ids, empty texts and empty tables pass through as each operator's docstring
says. Rows that repeat (equal id and text) are one document after the join stage;
different texts that share an id, or have none, stay documents of their own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.functions.text import py_strip
from recordforge.llm import language_id, lsh_forest, packing, source_mixing
from recordforge.llm.common import materialise, table
from recordforge.session import scratch_path


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be identified; null texts and texts without letters go, and
    nothing else, also where there is no labelled text to learn from."""
    model = language_id.fit(docs.select("doc_id", "text", "lang").filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a unique ``_row`` and ``_order``, a hash of the row, written once so that no later scan renumbers a row.

    Ids may be null or shared by different texts; copies and removals are joined on ``_row`` alone."""
    path = scratch_path(docs.sparkSession, "numbered")
    hashed = [f.name for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    rows = docs.withColumns({"_row": F.monotonically_increasing_id(), "_order": F.xxhash64(*[f"`{c}`" for c in hashed])})
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def stage_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (a missing id is larger than
    any), of those the first by a hash of the row.

    Every row is a document of its own, whatever its id, also without one. Texts without words are
    near copies of nothing; rows that repeat id and such a text are one document."""
    rows = numbered(docs)
    found = lsh_forest.jaccard_join(rows, doc_id="_row")
    linked = materialise(found.filter("n_links > 0").select(F.col("doc_id").alias("_row"), F.col("class_id").alias("_class")))
    nameless = F.col("doc_id").isNull().alias("_nameless")
    members = rows.select("_row", "doc_id", nameless, "_order").join(linked, "_row")
    first = members.groupBy("_class").agg(F.min(F.struct("_nameless", "doc_id", "_order", "_row")).alias("_first"))

    wordless = rows.filter(F.col("text").isNull() | (py_strip(F.col("text")) == ""))
    wordless = materialise(wordless.select("_row", "doc_id", "_order", F.sha2("text", 256).alias("_text")))
    once = wordless.groupBy("doc_id", "_text").agg(F.min(F.struct("_order", "_row")).alias("_first"))

    stay = first.select("_first._row").unionByName(once.select("_first._row"))
    gone = materialise(linked.select("_row").unionByName(wordless.select("_row")).join(stay, "_row", "left_anti"))
    return rows.join(gone, "_row", "left_anti").select(*docs.columns)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents in as many copies as the mix takes, none of those it leaves.

    Every row has copies of its own, whatever its id; rows that tie in the ranking go by a hash of the row."""
    rows = numbered(docs)
    mixed = source_mixing.mix(rows, ties=("_order", "_row"))
    taken = materialise(mixed.filter("copies > 0").select("_row", F.col("copies").alias("_copies")))
    rows = rows.join(taken, "_row")
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
    return rows.select(*docs.columns)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", stage_language),
    ("n-gram Jaccard join", stage_near_duplicates),
    ("source mix", stage_mix),
    ("best-fit packing", stage_pack),
]

#: The language and tokenizer stages have no SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
