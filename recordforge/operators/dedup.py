"""Deduplication: exact key (D1) and blocked fuzzy matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import match_key, sorted_tokens
from .components import connected_components
from .merge import merge_groups
from .normalise import composite_key_expr
from .simjoin import similarity_join

# Shares that a key's rows are dealt into; a key's representative is copied as often.
KEY_SALTS = 16


def merge_keyed(keyed: DataFrame, key: str, order_by=("id",), rules=None, reuse: bool = True) -> DataFrame:
    """D1 on rows whose key is not null. Single-row groups come out unchanged
    under every rule, so no count or anti-join is needed."""
    return merge_groups(keyed, [key], columns=keyed.columns, order_by=order_by, rules=rules, reuse=reuse)


def dedup_exact(df: DataFrame, key: str = "google_place_id", order_by=("id",), rules=None) -> DataFrame:
    """Merge rows sharing a non-null key; null-key rows pass through."""
    merged = merge_keyed(df.filter(F.col(key).isNotNull()), key, order_by, rules)
    return merged.unionByName(df.filter(F.col(key).isNull()))


def match_keys(
    pool: DataFrame,
    node: str = "_rid",
    cohort: str = "city",
    address: str = "display_address",
    name: str = "name",
    unknown: str = config.UNKNOWN_COHORT,
) -> DataFrame:
    """D2 + O7/O8 keys: (node, cohort, addr_key, nc_key) with sorted tokens."""
    return pool.select(
        F.col(node).alias("node"),
        F.coalesce(F.col(cohort), F.lit(unknown)).alias("cohort"),
        sorted_tokens(match_key(F.col(address))).alias("addr_key"),
        sorted_tokens(composite_key_expr(name, cohort)).alias("nc_key"),
    )


def key_table(keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Distinct (cohort, key) with a representative node, and the star edges
    linking every other record of that key to its representative."""
    k = keys.select("node", "cohort", F.col(column).alias("key")).filter(F.length("key") > 0)
    reps = k.groupBy("cohort", "key").agg(F.min("node").alias("rep"))
    # a key may be hot (all nameless rows of a city share one): both sides are dealt by salt, too
    salt = F.pmod(F.xxhash64("node"), F.lit(KEY_SALTS)).cast("int")
    spread = reps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(KEY_SALTS - 1))))
    star = (
        k.withColumn("salt", salt)
        .join(spread, ["cohort", "key", "salt"])
        .filter(F.col("node") != F.col("rep"))
        .select("cohort", F.col("node").alias("src"), F.col("rep").alias("dst"))
    )
    return reps.withColumnRenamed("rep", "node"), star


def fuzzy_edges(
    keys: DataFrame,
    address_threshold: int = config.FUZZY_ADDRESS_THRESHOLD,
    name_threshold: int = config.FUZZY_NAME_CITY_THRESHOLD,
) -> DataFrame:
    """D3: all match edges (cohort, src, dst) between pool records.

    An edge exists iff the addresses reach ``address_threshold`` or the
    name+city keys reach ``name_threshold`` (the reference falls through
    to the second test whenever the first does not fire), so the edge set is
    the union of two independent similarity joins. Equal keys are collapsed
    first (lossless: equal strings score 100) and re-attached by star edges.
    """
    out = []
    for column, t in (("addr_key", address_threshold), ("nc_key", name_threshold)):
        reps, star = key_table(keys, column)
        sim = similarity_join(reps, t).select("cohort", F.col("node_a").alias("src"), F.col("node_b").alias("dst"))
        out += [star, sim]
    edges = out[0]
    for e in out[1:]:
        edges = edges.unionByName(e)
    return edges


def pool_with_ids(pool: DataFrame, node: str = "_rid") -> DataFrame:
    """Stable record ids: assigned once and checkpointed, so a recomputed
    partition after executor loss cannot renumber records."""
    return pool.withColumn(node, F.monotonically_increasing_id()).checkpoint()


def fuzzy_components(
    pool: DataFrame,
    node: str = "_rid",
    cohort: str = "city",
    address: str = "display_address",
    name: str = "name",
    address_threshold: int = config.FUZZY_ADDRESS_THRESHOLD,
    name_threshold: int = config.FUZZY_NAME_CITY_THRESHOLD,
) -> DataFrame:
    """D3 + D4: (node, component) for pool records that have a match edge."""
    keys = match_keys(pool, node=node, cohort=cohort, address=address, name=name)
    return connected_components(fuzzy_edges(keys, address_threshold, name_threshold), "src", "dst", group="cohort")


def fuzzy_clusters(pool: DataFrame, node: str = "_rid", **kw) -> DataFrame:
    """(node, cluster) for every pool record; singletons are their own
    cluster. ``pool`` must carry the id column ``node``."""
    comps = fuzzy_components(pool, node, **kw)
    return (
        pool.select(node)
        .join(comps.withColumnRenamed("node", node), node, "left")
        .select(node, F.coalesce(F.col("component"), F.col(node)).alias("cluster"))
    )


def merge_pool(rows: DataFrame, order_by=("id",), rules=None, **fuzzy) -> DataFrame:
    """D5 on the pool, the rows without an exact key.

    Records without any match edge are single-row clusters, which every rule
    leaves unchanged, so they pass through; only clustered records are
    shuffled into the merge aggregation.
    """
    columns = rows.columns
    pool = pool_with_ids(rows)
    comps = fuzzy_components(pool, **fuzzy).withColumnRenamed("node", "_rid")
    tagged = pool.join(comps, "_rid", "left")
    single = tagged.filter(F.col("component").isNull()).select(*columns)
    merged = merge_groups(
        tagged.filter(F.col("component").isNotNull()), ["component"], columns=columns, order_by=order_by, rules=rules
    )
    return single.unionByName(merged.select(*columns))


def dedup_fuzzy(df: DataFrame, key: str = "google_place_id", order_by=("id",), rules=None, **fuzzy) -> DataFrame:
    """Fuzzy-merge the rows without an exact key; keyed rows pass."""
    pool = df.filter(F.col(key).isNull())
    return df.filter(F.col(key).isNotNull()).unionByName(merge_pool(pool, order_by, rules, **fuzzy))
