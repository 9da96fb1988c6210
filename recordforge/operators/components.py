"""Connected components of an edge DataFrame.

Two phases, the same at every size:

1. *Contract*: every task replaces its edges, ``CONTRACT_EDGES`` at a time, by
   ``node -> smallest node of its local component``, which keeps the components
   whatever the partitioning: as the edges are read, where they are dense enough for that to
   leave clearly fewer, and after each shuffle. Edges with a ``group`` column (a block no edge crosses,
   e.g. the cohort) are rebalanced by it before (AQE splits oversized partitions).
2. *Sample and finish* (after Sutton et al., "Optimizing Parallel Graph Connectivity
   Computation via Subgraph Sampling", IPDPS 2018): each node keeps two of its
   edges, to its smallest neighbour and to one drawn by hash, so at most two for
   each node remain whatever the number of edges. The components of this sample are
   found by star rounds; most are whole components already, above all the largest.
   All edges inside one are dropped, the others now link sampled components, and
   star rounds on those few finish the work.

Star rounds are alternating *large-star* / *small-star* steps (Kiveris et al.,
"Connected Components in MapReduce and Beyond", SoCC 2014). Every round is a few
partial aggregations and joins; no node's neighbourhood is ever collected. The
edges of a hub, a node with more than a thousandth of all edges (found in a share of them;
it steers the dealing only), are dealt by salt as well as by node when they are joined with
the nodes' minima or labels, of which a hub's salts have a copy each, so a hub with a third of
all edges is spread over tasks; no other node is copied. Edges are checkpointed to the shared checkpoint folder
every round, which cuts the lineage and survives executor loss. Where the contraction
leaves a star forest, as it does if all edges of a component met in one task, no
round is needed, and with a ``group`` (without one it is not looked for) no sample either.

Result: one row per node that has an edge, ``component`` = smallest node id.
"""

from __future__ import annotations

import sys
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


#: Edges that a task holds at a time while it contracts them.
CONTRACT_EDGES = 1_000_000
#: Edges with more nodes than this share of them are not contracted as they are read.
DENSE = 0.75
#: Shares that a node's edges are dealt into.
EDGE_SALTS = 16
#: A hub has more than one in so many of the edges; hubs are found in about so many edges.
HUB_SHARE, HUB_EDGES = 1_000, 1_000_000


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, smallest node of each one's component) of the edges (u, v)."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        for at in (a, b, label[a], label[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _contract(batches, dense: bool = False):
    """Edges as (node, local root), a bounded number of edges at a time. With ``dense``, edges that have
    nearly as many nodes stay as they are: little would be gained."""

    def step(us, vs):
        u, v = np.concatenate(us), np.concatenate(vs)
        if dense and len(np.unique(np.concatenate([u, v]))) > DENSE * len(u):
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        nodes, roots = smallest_reachable(u, v)
        keep = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], names=["u", "v"])

    us, vs, held = [], [], 0
    for batch in batches:
        us.append(np.asarray(batch.column("u")))
        vs.append(np.asarray(batch.column("v")))
        held += batch.num_rows
        if held >= CONTRACT_EDGES:
            yield step(us, vs)
            us, vs, held = [], [], 0
    if held:
        yield step(us, vs)


def _orient(edges: DataFrame) -> DataFrame:
    """Undirected edges as (u, v) with u > v, no self loops, distinct."""
    return (
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter(F.col("u") != F.col("v"))
        .distinct()
    )


def _salt(node: str):
    return F.pmod(F.xxhash64(node), F.lit(EDGE_SALTS)).cast("int").alias("salt")


def _hubs(e: DataFrame) -> dict[str, list[int]]:
    """The hubs among the nodes ``u`` and ``v``, at most HUB_SHARE each (two small jobs)."""
    n = e.count()
    drawn = e.filter(F.pmod(F.xxhash64("u", "v"), F.lit(max(1, n // HUB_EDGES))) == 0)
    ends = drawn.select(F.explode(F.array(*[F.struct(F.lit(c).alias("end"), F.col(c).alias("node")) for c in ("u", "v")])).alias("x")).select("x.*")
    least = min(n, HUB_EDGES) // HUB_SHARE
    found = ends.groupBy("end", "node").count().filter(F.col("count") > least).orderBy(F.col("count").desc()).limit(2 * HUB_SHARE).collect()
    return {c: [r["node"] for r in found if r["end"] == c] for c in ("u", "v")}


def _dealt(other: str, node: str, hubs: list[int]):
    """The salt of an edge where it meets ``node``: by its other end if that is a hub, else 0."""
    return F.when(F.col(node).isin(hubs), _salt(other)).otherwise(0).alias("salt")


def _minima(e: DataFrame) -> DataFrame:
    """(u, m): the smallest neighbour of every node with smaller ones."""
    return e.groupBy("u").agg(F.min("v").alias("m"))


def _per_salt(rows: DataFrame, node: str, hubs: list[int]) -> DataFrame:
    """``rows``, one for each ``node``, with a copy for each salt that its edges can have."""
    salts = F.when(F.col(node).isin(hubs), F.sequence(F.lit(0), F.lit(EDGE_SALTS - 1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("salt", F.explode(salts))


def _large_star(e: DataFrame, hubs: dict) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest node of its
    closed neighbourhood. With edges kept as (u > v), node v's minimum is
    min(v, its smaller neighbours), so each edge (u, v) becomes (u, m(v)).
    One output row per input edge: no growth, duplicates go in small-star."""
    mins = _per_salt(_minima(e).withColumnRenamed("u", "v"), "v", hubs["v"])
    return e.select("u", "v", _dealt("u", "v", hubs["v"])).join(mins, ["v", "salt"], "left").select("u", F.coalesce("m", "v").alias("v"))


def _small_star(e: DataFrame, hubs: dict) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest. Large-star keeps how many edges each ``u`` has, so its hubs hold."""
    mins = _minima(e)
    linked = e.select("u", "v", _dealt("v", "u", hubs["u"])).join(_per_salt(mins, "u", hubs["u"]), ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _orient(linked.unionByName(mins.select("u", F.col("m").alias("v"))))


def _is_star_forest(e: DataFrame) -> bool:
    """Every child has exactly one parent and no parent is a child: then each
    component is one star around its smallest node (one job)."""
    children = e.groupBy("u").agg((F.min("v") != F.max("v")).alias("several"))
    parents = e.select(F.col("v").alias("u")).distinct().withColumn("is_parent", F.lit(True))
    bad = children.join(parents, "u", "left").filter(F.col("several") | F.col("is_parent").isNotNull())
    return bad.isEmpty()


def _sample(e: DataFrame) -> DataFrame:
    """At most two edges for each node: to its smallest neighbour, and to one by hash."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    kept = both.groupBy("u").agg(F.min("v").alias("a"), F.min_by("v", F.struct(F.xxhash64("u", "v"), "v")).alias("b"))
    return _orient(kept.select("u", F.explode(F.array("a", "b")).alias("v")))


def _relabel(e: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends (a node without one is its own), less those inside one label."""
    hubs = _hubs(e)
    for end, other in (("u", "v"), ("v", "u")):
        own = _per_salt(labels.select(F.col("u").alias(end), F.col("v").alias("label")), end, hubs[end])
        e = e.select("u", "v", _dealt(other, end, hubs[end])).join(own, [end, "salt"], "left").select(other, F.coalesce("label", end).alias(end))
    return _orient(e)


def _contracted(e: DataFrame, contract: bool) -> DataFrame:
    return (e.mapInArrow(_contract, "u bigint, v bigint") if contract else e).checkpoint()


def _star_rounds(e: DataFrame, contract: bool, max_rounds: int | None) -> tuple[DataFrame, int]:
    """The star forest of ``e``, and the rounds that it took."""
    rounds = 0
    while not _is_star_forest(e):
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError("connected components did not converge")
        hubs = _hubs(e)
        e = _contracted(_small_star(_large_star(e, hubs), hubs), contract)
        rounds += 1
    return e, rounds


def connected_components(
    edges: DataFrame,
    src: str = "src",
    dst: str = "dst",
    group: str | None = None,
    max_rounds: int | None = None,
    contract: bool = True,
    stats: dict | None = None,
) -> DataFrame:
    """(node, component) for every node of ``edges`` (long ids); self-loops
    are ignored, so a node seen only in a self-loop is not listed.

    ``group`` (optional) names a column no edge crosses; it only steers the
    local contraction's partitioning and never changes the result.
    Rounds run until the edges form a star forest (O(log^2 n) rounds in the
    worst case); ``max_rounds`` is only a guard for callers who want one, for each phase.
    ``contract=False`` leaves out the local contraction. ``stats`` receives the edges
    after the contraction and those between sampled components (counted for it), and the
    rounds of both phases. Runs jobs while it is built.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    cols = [F.col(src).cast("bigint").alias("u"), F.col(dst).cast("bigint").alias("v")]
    if group is not None:
        local = edges.select(group, *cols).hint("rebalance", group).select("u", "v")
    else:
        local = edges.select(*cols)
    if contract:
        local = local.filter(F.col("u").isNotNull() & F.col("v").isNotNull())
        local = local.mapInArrow(partial(_contract, dense=group is None), "u bigint, v bigint")
    e = _contracted(_orient(local), contract)
    seen = {"edges": e.count() if stats is not None else None, "sample_rounds": 0, "rest_rounds": 0, "rest_edges": 0}
    if group is None or not _is_star_forest(e):
        labels, seen["sample_rounds"] = _star_rounds(_contracted(_sample(e), contract), contract, max_rounds)
        rest = _contracted(_relabel(e, labels), contract)
        seen["rest_edges"] = rest.count() if stats is not None else None
        if not rest.isEmpty():
            roots, seen["rest_rounds"] = _star_rounds(rest, contract, max_rounds)
            top = roots.select(F.col("u").alias("v"), F.col("v").alias("root"))
            hubs = _hubs(labels)["v"]
            salted = labels.select("u", "v", _dealt("u", "v", hubs)).join(_per_salt(top, "v", hubs), ["v", "salt"], "left")
            labels = salted.select("u", F.coalesce("root", "v").alias("v")).unionByName(roots).checkpoint()
        e = labels
    if stats is not None:
        stats.update(seen)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
