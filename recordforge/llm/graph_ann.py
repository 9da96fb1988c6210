"""Approximate nearest neighbours on robust-pruned directed graphs (operator 9).

Vectors are dealt by a hash of their id and values into shards of bounded size
(rows of one id spread; only rows equal in both, one point, stay together). A task
builds one graph for a shard: starting from random edges, every point is
searched greedily from the entry point; the points expanded on the way are its
candidates, and relaxed distance pruning keeps near and diverse ones (a
candidate is dropped if ``alpha`` times its distance to a kept neighbour is no
more than its distance to the point). Kept edges are also added backwards and
pruned where a point has too many. Two passes run, the first with alpha 1.

Queries, the rows of a stated set, are sent to every shard in blocks: a task
holds one shard and walks its graph by beam search for one block after the
other, and a shard is copied once for every ``SPREAD`` blocks. The best of all
shards are ranked by the cosine in double precision of the original vectors. Points are searched in step with
numpy, a batch at a time. Equal vectors of a shard are one point that keeps its
smallest ids, as many as may be asked for, so copies of any number neither
crowd the graph nor break ties wrongly.

Vectors that are null, empty, zero or hold null or non-finite components, and
rows without an id, take no part, as query or candidate. Vectors of different
length are never compared. Every query row is answered, also rows that share
an id or are equal throughout: their results have the ranks 1..k each. A query
excludes all rows of its own id; where these fill its beam, its block's shard is
compared in full. Ties go to the smaller id. Extra columns are ignored; an empty table
or query set gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .binary_neardup import usable
from .common import by_value, grouped, map_batches, materialise

by_value(__name__)

SHARD = 4096  # vectors, on average
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
QUERY_BLOCK = 2048
SPREAD = 16  # blocks of queries that one copy of a shard meets


def beam_search(points: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, beam: int, visits: bool = False):
    """Greedy searches in step. (points, cosines) of each query's beam, best first; with ``visits``
    also the points expanded. Absent entries are -1."""
    m, n = len(queries), len(points)
    beam = min(beam, n)
    ids = np.full((m, beam), -1, dtype=np.int64)
    sims = np.full((m, beam), -np.inf, dtype=np.float32)
    done = np.zeros((m, beam), dtype=bool)
    seen = np.zeros((m, n), dtype=bool)
    ids[:, 0], sims[:, 0] = entry, queries @ points[entry]
    seen[:, entry] = True
    expanded: list[tuple[np.ndarray, np.ndarray]] = []
    active = np.arange(m)
    while len(active):
        open_sims = np.where(done[active] | (ids[active] < 0), -np.inf, sims[active])
        pick = open_sims.argmax(axis=1)
        some = open_sims[np.arange(len(active)), pick] > -np.inf
        active, pick = active[some], pick[some]
        if not len(active):
            break
        done[active, pick] = True
        at = ids[active, pick]
        expanded.append((active, at))
        near = graph[at]
        fresh = near >= 0
        near = np.where(fresh, near, 0)
        fresh &= ~seen[active[:, None], near]
        row, col = np.nonzero(fresh)
        seen[active[row], near[row, col]] = True
        found = np.einsum("qkd,qd->qk", points[near], queries[active])
        found = np.where(fresh, found, -np.inf)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[active], found], axis=1)
        all_done = np.concatenate([done[active], np.zeros_like(fresh)], axis=1)
        best = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, axis=1)
        sims[active] = np.take_along_axis(all_sims, best, axis=1)
        done[active] = np.take_along_axis(all_done, best, axis=1)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
    if not visits:
        return ids, sims
    steps = np.zeros(m, dtype=np.int64)
    walked = np.full((m, max(1, len(expanded))), -1, dtype=np.int64)
    for who, at in expanded:
        walked[who, steps[who]] = at
        steps[who] += 1
    return ids, sims, walked


def once(rows: np.ndarray) -> np.ndarray:
    """Each row's entries, descending, with repeated ones replaced by -1 at the end."""
    rows = -np.sort(-rows, axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
    return -np.sort(-rows, axis=1)


def robust_prune(points: np.ndarray, centre: np.ndarray, candidates: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """For each of ``centre`` (indices) at most ``degree`` of its ``candidates`` (-1: none): near and diverse ones."""
    m = len(candidates)
    candidates = once(candidates)
    candidates = np.where(candidates == centre[:, None], -1, candidates)
    own = points[candidates]
    far = 2 - 2 * np.einsum("mcd,md->mc", own, points[centre])  # squared distances
    far = np.where(candidates >= 0, far, np.inf)
    between = 2 - 2 * np.matmul(own, own.transpose(0, 2, 1))
    kept = np.full((m, degree), -1, dtype=np.int64)
    c = candidates.shape[1]
    left = far.copy()
    rows = np.arange(m)
    for k in range(min(degree, c)):
        best = left.argmin(axis=1)
        some = left[rows, best] < np.inf
        if not some.any():
            break
        kept[some, k] = candidates[rows, best][some]
        covered = alpha * alpha * between[rows, best] <= far
        covered[rows, best] = True
        left = np.where(covered, np.inf, left)
        left[~some] = np.inf
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, batch: int = 256, seed: int = 9):
    """(graph as (n, degree) indices with -1 for none, entry point) over unit ``points``."""
    n = len(points)
    rng = np.random.default_rng(seed)
    entry = int((points @ points.mean(axis=0)).argmax())
    if n <= degree + 1:
        every = np.tile(np.arange(n), (n, 1))
        graph = np.where(every == np.arange(n)[:, None], -1, every)
        return graph, entry
    graph = rng.integers(0, n, (n, degree))
    graph = once(np.where(graph == np.arange(n)[:, None], -1, graph))
    for relax in (1.0, alpha):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            who = order[lo : lo + batch]
            ids, _, walked = beam_search(points, graph, entry, points[who], beam, visits=True)
            candidates = np.concatenate([ids, walked, graph[who]], axis=1)
            graph[who] = robust_prune(points, who, candidates, relax, degree)
            # the same edges backwards
            src, dst = np.repeat(who, degree), graph[who].ravel()
            src, dst = src[dst >= 0], dst[dst >= 0]
            by = np.argsort(dst, kind="stable")
            src, dst = src[by], dst[by]
            target, first, count = np.unique(dst, return_index=True, return_counts=True)
            back = np.full((len(target), int(count.max())), -1, dtype=np.int64)
            back[np.repeat(np.arange(len(target)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
            merged = once(np.concatenate([graph[target], back], axis=1))
            held = (merged >= 0).sum(axis=1)
            easy = held <= degree
            graph[target[easy]] = merged[easy][:, :degree]
            for at in range(0, int((~easy).sum()), batch):
                t = np.nonzero(~easy)[0][at : at + batch]
                graph[target[t]] = robust_prune(points, target[t], merged[t], relax, degree)
    return graph, entry


def index(vectors: DataFrame, shard: int = SHARD, keep: int = 5, **build) -> DataFrame:
    """One row per shard and vector length: (shard, dim, n, entry, ids, offsets, raw, graph) as binary."""
    shards = max(1, -(-vectors.count() // shard))
    dealt = vectors.withColumn("dim", F.size("vector")).withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    dealt = dealt.select("shard", "dim", "vec_id", "vector").repartition(shards, "shard", "dim").sortWithinPartitions("shard", "dim", "vec_id")

    def run(batches):
        import pyarrow as pa

        for group in grouped(batches, 2):
            dim = group.column("dim")[0].as_py()
            vec_id = np.asarray(group.column("vec_id"))
            raw = np.asarray(group.column("vector").combine_chunks().flatten()).reshape(-1, dim)
            _, first, member = np.unique(raw + 0.0, axis=0, return_index=True, return_inverse=True)
            by = np.argsort(member.ravel(), kind="stable")  # ids ascend within a point
            count = np.bincount(member.ravel())
            ids, offsets = smallest_ids(vec_id[by], count, keep)
            points = raw[first]
            graph, entry = build_graph(unit(points).astype(np.float32), **build)
            row = [group.column("shard")[0].as_py(), dim, len(points), entry, ids.tobytes(), offsets.tobytes(), points.tobytes(), graph.astype(np.int32).tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
            names = ["shard", "dim", "n", "entry", "ids", "offsets", "raw", "graph"]
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    schema = "shard int, dim int, n int, entry int, ids binary, offsets binary, raw binary, graph binary"
    return map_batches(dealt, run, schema)


def smallest_ids(ids: np.ndarray, count: np.ndarray, keep: int):
    """(ids, offsets): of every point's ascending ``ids`` (``count`` each) the first 2 ``keep``, an id at most ``keep``
    times. Without the rows of any one id they hold the first ``keep`` of the others, or all."""
    point = np.repeat(np.arange(len(count)), count)

    def nth(new):  # place of each entry since the last new one
        start = np.nonzero(new)[0]
        return np.arange(len(new)) - np.repeat(start, np.diff(np.append(start, len(new))))

    few = nth(np.append(True, (ids[1:] != ids[:-1]) | (point[1:] != point[:-1]))) < keep
    ids, point = ids[few], point[few]
    few = nth(np.append(True, point[1:] != point[:-1])) < 2 * keep
    return ids[few], np.concatenate([[0], np.cumsum(np.bincount(point[few], minlength=len(count)))])


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def search(shards: DataFrame, queries: DataFrame, k: int, beam: int = SEARCH_BEAM, batch: int = 256,
           block: int = QUERY_BLOCK, spread: int = SPREAD) -> DataFrame:
    """Each shard's best (query, query_id, vec_id, score) for each row of ``queries`` (query, vec_id, vector), at most ``k``;
    ``query`` tells query rows apart."""
    blocks = max(1, -(-queries.count() // block))
    held = queries.withColumn("dim", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    # a block is bounded: about ``block`` rows by construction
    one = F.collect_list(F.struct("query", "vec_id", "vector"))
    held = held.groupBy("dim", "block").agg(one.alias("rows"))
    held = held.select("dim", "block", F.col("rows.query").alias("query"), F.col("rows.vec_id").alias("qid"), F.flatten("rows.vector").alias("q"))
    places = shards.select("shard", "dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    sent = held.join(places, ["dim", "block"]).withColumn("part", F.floor(F.col("block") / spread).cast("int"))
    copies = shards.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) // spread)))).withColumn("block", F.lit(-1))
    both = copies.unionByName(sent, allowMissingColumns=True)
    both = both.select("shard", "dim", "part", "block", "n", "entry", "ids", "offsets", "raw", "graph", "query", "qid", "q")
    both = both.repartition("shard", "dim", "part").sortWithinPartitions("shard", "dim", "part", "block")

    def run(batches):
        import pyarrow as pa

        for table in batches:
            for row in range(table.num_rows):
                get = lambda c: table.column(table.schema.get_field_index(c))[row]
                if get("block").as_py() < 0:  # a shard; its blocks of queries follow
                    dim, n, entry = (get(c).as_py() for c in ("dim", "n", "entry"))
                    raw = np.frombuffer(get("raw").as_py(), dtype=np.float64).reshape(n, dim)
                    ids, offsets = (np.frombuffer(get(c).as_py(), dtype=np.int64) for c in ("ids", "offsets"))
                    graph = np.frombuffer(get("graph").as_py(), dtype=np.int32).reshape(n, -1)
                    exact = unit(raw)
                    points = exact.astype(np.float32)
                    least, most = np.minimum.reduceat(ids, offsets[:-1]), np.maximum.reduceat(ids, offsets[:-1])
                    continue
                query, qid = np.asarray(get("query").values), np.asarray(get("qid").values)
                q = np.asarray(get("q").values).reshape(-1, dim)
                for lo in range(0, len(qid), batch):
                    own = unit(q[lo : lo + batch])
                    near, _ = beam_search(points, graph, entry, own.astype(np.float32), beam)
                    out = [[], [], [], []]
                    for number, name, vector, original, found in zip(query[lo : lo + batch], qid[lo : lo + batch], own, q[lo : lo + batch], near):
                        found = found[found >= 0]
                        found = found[(least[found] != name) | (most[found] != name)]
                        if len(found) < min(k, n):  # the beam was full of the query's own id
                            found = np.nonzero((least != name) | (most != name))[0]
                        if not len(found):
                            continue
                        score = exact[found] @ vector
                        kth = max(0, len(score) - k)
                        top = found[score >= np.partition(score, kth)[kth] - 1e-9]
                        who = np.concatenate([ids[offsets[x] : offsets[x + 1]] for x in top])
                        each = np.repeat(cosines(raw[top], original), offsets[top + 1] - offsets[top])
                        other = who != name
                        who, each = who[other], each[other]
                        first = np.lexsort((who, -each))[:k]
                        out[0].append(np.full(len(first), number))
                        out[1].append(np.full(len(first), name))
                        out[2].append(who[first])
                        out[3].append(each[first])
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["query", "query_id", "vec_id", "score"])

    return map_batches(both, run, "query bigint, query_id bigint, vec_id bigint, score double")


def cosines(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal rows get equal values."""
    return (rows * vector).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((vector * vector).sum()))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
            shard: int = SHARD, beam: int = SEARCH_BEAM, **build) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each row of ``queries``."""

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
        return df.filter(F.col("vec_id").isNotNull() & F.coalesce(usable("vector"), F.lit(False)))

    shards = materialise(index(clean(rows), shard, keep=k, **build))
    # numbered once, in the checkpoint folder: no later scan renumbers a row
    asked = materialise(clean(queries).withColumn("query", F.monotonically_increasing_id()))
    found = search(shards, asked, k, beam)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
