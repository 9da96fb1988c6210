"""Incremental cleaning (D1, D5, D6): a new batch meets the records before it.

``add(spark, raw, folder)`` brings a batch into a clean table that lives in ``folder``;
``add`` of A and then of B gives the clean table of A and B together. What a batch
costs goes by what it touches:

* Prepared records are kept, batch by batch, with their match keys and their cluster's
  label, in buckets of the exact key or of the cohort. A batch reads the buckets that its
  own keys and cohorts fall into, no others.
* Exact groups: only keys of the batch are merged again, from all their records.
* Fuzzy pairs: keys that no record before had are *fresh*; the similarity join compares
  fresh keys with all of their cohort and never two old ones.
* Components: old records are contracted to their cluster's label, so the graph holds the
  new edges only. Clusters that these touch are merged again, from all their records, and
  those that grow together are relabelled by a map, not by rewriting records.
* The clean table is a series of segments. A batch writes the merged rows of what it
  touched, and the names of the groups that these replace; a reader leaves replaced rows out.

Everything a batch writes goes to new folders, and a manifest names them at the end
(:mod:`recordforge.sources.publish`): a job that fails leaves the table as it was.

The order of a merge goes by completeness and ``order_by``, as in one run over all
records; the columns of every batch must be those of the first. An empty batch adds nothing
and publishes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions.text import match_key, sorted_tokens
from ..operators.components import connected_components
from ..operators.dedup import KEY_SALTS
from ..operators.merge import merge_groups
from ..operators.normalise import composite_key_expr
from ..operators.simjoin import similarity_join
from ..session import checkpoint_dir
from ..sources.publish import publish, published, version
from .cleaning import prepare

#: Folders that the records of a batch are dealt into, and the most that a batch's list of touched ones can hold.
BUCKETS = 64
_OWN = ["_rid", "_label", "_cohort", "_addr", "_nc", "_bucket"]


def _match_keys(cohort: str, address: str, name: str) -> dict:
    """D2, O7 and O8 as expressions of the record itself."""
    return {
        "_cohort": F.coalesce(F.col(cohort), F.lit(config.UNKNOWN_COHORT)),
        "_addr": sorted_tokens(match_key(F.col(address))),
        "_nc": sorted_tokens(composite_key_expr(name, cohort)),
    }


def _bucket(column: str):
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BUCKETS)).cast("int")


def _tables(spark: SparkSession, state: dict, name: str) -> DataFrame | None:
    """All segments of a table as one, with the number of the batch that wrote each row."""
    out = None
    for n, path in enumerate(state["batches"]):
        part = spark.read.parquet(f"{path}/{name}").withColumn("_batch", F.lit(n))
        out = part if out is None else out.unionByName(part)
    return out


def _before(spark: SparkSession, state: dict, touched: DataFrame) -> DataFrame:
    """The records of earlier batches in the buckets of ``touched``, with the label that holds now."""
    buckets = [r[0] for r in touched.select("_bucket").distinct().collect()]  # at most BUCKETS numbers
    rows = _tables(spark, state, "records").filter(F.col("_bucket").isin(buckets)).drop("_batch")
    labels = spark.read.parquet(state["labels"]) if state["labels"] else None
    if labels is None:
        return rows
    columns = rows.columns
    met = rows.join(labels, rows["_label"] == labels["label"], "left")
    return met.withColumn("_label", F.coalesce("current", "_label")).select(*columns)


def _edges(old: DataFrame, new: DataFrame, column: str, threshold: int) -> DataFrame:
    """(cohort, src, dst): new records with the first record of an equal key, and fresh keys with all that match."""

    def keys(rows, fresh):
        return rows.select(F.col("_rid").alias("node"), F.col("_cohort").alias("cohort"), F.col(column).alias("key"), F.lit(fresh).alias("fresh")).filter(F.length("key") > 0)

    added = keys(new, True)
    reps = keys(old, False).unionByName(added).groupBy("cohort", "key").agg(F.min("node").alias("node"), F.bool_and("fresh").alias("fresh"))
    spread = reps.select("cohort", "key", F.col("node").alias("rep")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(KEY_SALTS - 1))))
    dealt = added.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(KEY_SALTS)).cast("int"))
    star = dealt.join(spread, ["cohort", "key", "salt"]).select("cohort", F.col("node").alias("src"), F.col("rep").alias("dst"))
    near = similarity_join(reps, threshold, fresh="fresh").select("cohort", F.col("node_a").alias("src"), F.col("node_b").alias("dst"))
    return star.unionByName(near).filter(F.col("src") != F.col("dst"))


def _labelled(edges: DataFrame, old: DataFrame) -> DataFrame:
    """``edges`` between labels: an earlier record stands for its cluster."""
    labels = old.select(F.col("_rid").alias("node"), F.col("_label").alias("as"))
    for end in ("src", "dst"):
        edges = edges.join(labels.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("as", end)).drop("as")
    return edges.filter(F.col("src") != F.col("dst"))


def add(
    spark: SparkSession,
    raw: DataFrame,
    folder: str,
    order_by=("id",),
    key: str = "google_place_id",
    rules: dict | None = None,
    address: str = "display_address",
    name: str = "name",
    cohort: str = "city",
    address_threshold: int = config.FUZZY_ADDRESS_THRESHOLD,
    name_threshold: int = config.FUZZY_NAME_CITY_THRESHOLD,
) -> dict[str, int]:
    """Bring the rows of ``raw`` into the clean table at ``folder``.

    Returns what it took: rows_added, groups_merged (exact keys and clusters merged again)
    and rows_merged (the records in them, earlier ones included)."""
    checkpoint_dir(spark)
    began = version(spark, folder)
    state = published(spark, folder) or {"batches": [], "labels": None, "next_id": 0}
    columns = raw.columns
    numbered = prepare(raw).withColumn("_rid", F.monotonically_increasing_id() + F.lit(state["next_id"]))
    pooled = F.col(key).isNull()
    numbered = numbered.withColumns({c: F.when(pooled, e) for c, e in _match_keys(cohort, address, name).items()})
    new = numbered.withColumn("_bucket", F.when(pooled, _bucket("_cohort")).otherwise(_bucket(key))).checkpoint()
    got = new.agg(F.count(F.lit(1)).alias("n"), F.max("_rid").alias("last")).first()
    if not got["n"]:
        return {"rows_added": 0, "groups_merged": 0, "rows_merged": 0}
    old = _before(spark, state, new) if state["batches"] else new.limit(0).withColumn("_label", F.lit(None).cast("bigint")).select(*columns, *_OWN)
    old = old.checkpoint()

    # exact keys of the batch, with all their records
    keyed = new.filter(~pooled)
    keyed_all = old.filter(~pooled).join(keyed.select(key).distinct(), key, "left_semi").select(*columns).unionByName(keyed.select(*columns)).checkpoint()

    # clusters that the new edges touch, with all their records
    pool, pool_before = new.filter(pooled), old.filter(pooled)
    edges = _edges(pool_before, pool, "_addr", address_threshold).unionByName(_edges(pool_before, pool, "_nc", name_threshold))
    found = connected_components(_labelled(edges, pool_before), "src", "dst", group="cohort").checkpoint()
    of_new = pool.join(found, pool["_rid"] == found["node"], "left").withColumn("_label", F.coalesce("component", "_rid"))
    of_old = pool_before.join(found, pool_before["_label"] == found["node"])
    grown = of_old.select(F.col("node").alias("label"), F.col("component").alias("current")).distinct().checkpoint()
    of_old = of_old.withColumn("_label", F.col("component"))
    pool_all = of_new.select(*columns, "_label").unionByName(of_old.select(*columns, "_label")).checkpoint()

    merged = merge_groups(keyed_all, [key], columns=columns, order_by=order_by, rules=rules, reuse=False)
    merged = merged.withColumn("_group", F.concat(F.lit("key:"), F.col(key).cast("string")))
    clusters = merge_groups(pool_all, ["_label"], columns=columns, order_by=order_by, rules=rules, reuse=False)
    clusters = clusters.withColumn("_group", F.concat(F.lit("cluster:"), F.col("_label").cast("string"))).drop("_label")
    replaced = keyed.select(F.concat(F.lit("key:"), F.col(key).cast("string")).alias("group")).distinct()
    replaced = replaced.unionByName(grown.select(F.concat(F.lit("cluster:"), F.col("label").cast("string")).alias("group")))

    path = f"{folder}/batch-{len(state['batches']):06d}-{uuid.uuid4().hex}"
    records = keyed.withColumn("_label", F.lit(None).cast("bigint")).select(*columns, *_OWN).unionByName(of_new.select(*columns, *_OWN))
    records.repartition("_bucket", F.pmod(F.xxhash64("_rid"), F.lit(8))).write.partitionBy("_bucket").parquet(f"{path}/records")
    merged.unionByName(clusters).write.parquet(f"{path}/clean")
    replaced.write.parquet(f"{path}/replaced")
    labels = _relabelled(spark, state["labels"], grown)
    labels.write.parquet(f"{path}/labels")

    groups = spark.read.parquet(f"{path}/clean").count()
    rows = keyed_all.count() + pool_all.count()
    state = {
        "batches": [*state["batches"], path],
        "labels": f"{path}/labels",
        "next_id": got["last"] + 1,
    }
    publish(spark, folder, state, expected=began)
    return {"rows_added": got["n"], "groups_merged": groups, "rows_merged": rows}


def _relabelled(spark: SparkSession, path: str | None, grown: DataFrame) -> DataFrame:
    """(label, current) of all labels that are no longer their cluster's: the map before, followed by what grew together now."""
    changed = grown.filter(F.col("label") != F.col("current"))
    if path is None:
        return changed
    now = changed.select(F.col("label").alias("was"), F.col("current").alias("then"))
    held = spark.read.parquet(path)
    held = held.join(now, held["current"] == now["was"], "left").select("label", F.coalesce("then", "current").alias("current"))
    return held.unionByName(changed)


def clean_table(spark: SparkSession, folder: str) -> DataFrame:
    """The clean table that holds now."""
    state = published(spark, folder)
    if state is None:
        raise FileNotFoundError(f"nothing was published at {folder}")
    rows = _tables(spark, state, "clean")
    replaced = _tables(spark, state, "replaced").groupBy("group").agg(F.max("_batch").alias("_by"))
    gone = (rows["_group"] == replaced["group"]) & (replaced["_by"] > rows["_batch"])
    return rows.join(replaced, gone, "left_anti").drop("_group", "_batch")
