"""N-gram Jaccard join by a MinHash LSH forest (operator 10).

Documents are sets of word 5-shingles (lower-cased, split at white space; a
text of fewer words is one shingle). Those with Jaccard similarity of at least
``threshold`` are linked.

1. Copies collapse: equal shingle sets are one class, found by a 128-bit hash.
2. Each class gets ``TREES`` paths of ``DEPTH`` minimum hashes. The forest holds
   the paths of a tree as a sorted prefix trie. Matching begins with whole paths
   and shortens the prefix level by level, as far as the target recall asks:
   down to the longest prefix ``d`` with ``1 - (1 - t^d)^TREES >= recall``.
   Spark deals out the tries by their prefixes of that length; within one, a
   task walks the sorted run from long to short prefixes and unites those
   whose signatures agree to within ``SIGMAS`` standard errors of the
   threshold. Members already united need no further comparison.
3. The united sets (components) hold every candidate pair. Within each, whole
   shingle sets are compared exactly, and links are counted with the copies.

No group is ever in one task whole: tries and components above a block size are
cut into blocks that meet pairwise, and only counts and spanning edges leave a
task, never all pairs. Nothing is broadcast by force.

Texts that are null or without words link with nothing, and so do rows without
an id. Repeated rows are copies of each other. Different texts that share an id are
documents of their own, each with its own links; as a class is named by its smallest id, two
classes may then have the same name. An empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import block_pairs, by_value, grouped, map_batches, materialise, merge_labels, text_slices

by_value(__name__)

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 16, 8
TARGET_RECALL = 0.9995
SIGMAS = 4.0
TRIE_BLOCK = 4096  # members of a trie in one task
EXACT_BLOCK = 512  # members of a component on one side of an exact block
EXACT_SHINGLES = 2_000_000  # and their shingles


def least_prefix(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix that finds a pair at the threshold in some tree with the target recall."""
    for d in range(depth, 0, -1):
        if 1 - (1 - threshold**d) ** trees >= recall:
            return d
    raise ValueError("the target recall needs more trees")


class WordHashes(dict):
    """64-bit hashes of words, kept for words seen before."""

    def __missing__(self, word: str) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(self) < 400_000:
            self[word] = value
        return value


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str | None], words: WordHashes, n: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text its distinct shingle hashes, ascending; empty if it has no words."""
    split = [t.lower().split() if t else [] for t in texts]
    size = np.asarray([len(w) for w in split], dtype=np.int64)
    flat = np.fromiter((words[w] for ws in split for w in ws), dtype=np.uint64, count=int(size.sum()))
    ends = np.cumsum(size)
    out = []
    factor = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(flat) - n + 1), dtype=np.uint64)
    for k in range(n):
        rolled = rolled * factor + flat[k : len(flat) - n + 1 + k]
    rolled = mix64(rolled)
    for end, m in zip(ends, size):
        if m >= n:
            out.append(np.unique(rolled[end - m : end - n + 1]))
        elif m:
            h = np.uint64(m)
            for x in flat[end - m : end]:
                h = np.uint64((int(h) * int(factor) + int(x)) & 0xFFFFFFFFFFFFFFFF)
            out.append(mix64(np.asarray([h], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def hash_family(n: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 2**63, n, dtype=np.uint64)


def signatures(sets: list[np.ndarray], n: int = TREES * DEPTH) -> np.ndarray:
    """uint32 minimum hashes, one row per non-empty set."""
    flat = np.concatenate(sets)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), n), dtype=np.uint32)
    hashed = np.empty_like(flat)
    for k, (a, b) in enumerate(zip(*hash_family(n))):
        np.multiply(flat, a, out=hashed)
        np.add(hashed, b, out=hashed)
        out[:, k] = np.minimum.reduceat(hashed, first) >> np.uint64(32)
    return out


def sketch(docs: DataFrame, prefix: int) -> DataFrame:
    """(doc_id, h, n, hi, lo, keys, sig) from (doc_id, text, h): shingle count, 128-bit hash of the set, each tree's key, signature;
    hi, lo and sig are null for rows without an id or without words."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        words = WordHashes()
        for batch in batches:
            for at, count in text_slices(batch, "text"):
                part = batch.slice(at, count)
                sets = shingle_sets(part.column(1).to_pylist(), words)
                sets = [s if d is not None else s[:0] for s, d in zip(sets, part.column(0).to_pylist())]
                some = np.asarray([len(s) > 0 for s in sets], dtype=bool)
                m, k = len(sets), int(some.sum())
                pair, keys, sig = np.zeros((m, 2), np.int64), np.zeros((m, TREES), np.uint64), [None] * m
                if k:
                    full = [s for s in sets if len(s)]
                    pair[some] = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in full), dtype="<i8").reshape(k, 2)
                    minima = signatures(full)
                    paths = minima.reshape(k, TREES, DEPTH).astype(np.uint64)
                    key = np.zeros((k, TREES), dtype=np.uint64)
                    for d in range(prefix):
                        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + paths[:, :, d] + np.uint64(1))
                    keys[some] = key
                    for i, row in zip(np.nonzero(some)[0], minima):
                        sig[i] = row.tobytes()
                offsets = pa.array(np.arange(0, TREES * m + 1, TREES, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(pair[:, 0].copy(), mask=~some),
                        pa.array(pair[:, 1].copy(), mask=~some),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())),
                        pa.array(sig, pa.binary()),
                    ],
                    ["doc_id", "h", "n", "hi", "lo", "keys", "sig"],
                )

    return map_batches(docs, run, "doc_id bigint, h bigint, n bigint, hi bigint, lo bigint, keys array<bigint>, sig binary")


def unite_in_tries(rows: DataFrame, prefix: int, threshold: float) -> DataFrame:
    """Spanning edges (src, dst) of the pairs whose signatures nearly reach the threshold.

    ``rows``: (tree, key, p, q, node, sig), the members of tries, block by block."""
    n = TREES * DEPTH
    least = n * (threshold - SIGMAS * (threshold * (1 - threshold) / n) ** 0.5)

    def run(batches):
        import pyarrow as pa

        src, dst = [], []
        for group in grouped(batches, 4):
            m = group.num_rows
            if m < 2:
                continue
            tree = group.column(0)[0].as_py()
            node = np.asarray(group.column("node"))
            sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), dtype=np.uint32).reshape(m, n)
            if m == 2:  # most tries hold one pair
                if (sig[0] == sig[1]).sum() >= least:
                    src.append(node[:1])
                    dst.append(node[1:])
            else:
                path = sig[:, tree * DEPTH : (tree + 1) * DEPTH]
                order = np.lexsort(path.T[::-1])  # the trie as a sorted run
                sig, node, path = sig[order], node[order], path[order]
                label = walk_trie(sig, path, prefix, least)
                away = label != np.arange(m)
                src.append(node[away])
                dst.append(node[label[away]])
            if sum(map(len, src)) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"])
                src, dst = [], []
        if src:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"])

    return map_batches(rows, run, "src bigint, dst bigint")


def walk_trie(sig: np.ndarray, path: np.ndarray, prefix: int, least: float) -> np.ndarray:
    """Labels of the members of one sorted trie after uniting agreeing members, long prefixes first."""
    m = len(sig)
    near = (sig[1:] == sig[:-1]).sum(axis=1) >= least
    label = merge_labels(np.stack([np.nonzero(near)[0], np.nonzero(near)[0] + 1], axis=1), m)
    shared = np.minimum.accumulate((path[1:] == path[:-1]).astype(np.int8), axis=1).sum(axis=1)
    for depth in range(path.shape[1], prefix - 1, -1):
        cuts = np.concatenate([[0], np.nonzero(shared < depth)[0] + 1, [m]])
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi - lo < 2:
                continue
            for i in range(lo, hi - 1):
                rest = np.nonzero(label[i + 1 : hi] != label[i])[0] + i + 1
                if not len(rest):
                    if (label[lo:hi] == label[i]).all():
                        break
                    continue
                hit = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
                for other in np.unique(label[hit]):
                    a, b = sorted((int(label[i]), int(other)))
                    label[label == b] = a
    return label


def exact_links(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, n_links, root) from (cluster, p, q, block, node, copies, text): exact similarities in each block pair."""

    def run(batches):
        import pyarrow as pa

        words = WordHashes()
        for group in grouped(batches, 3):
            p, q = group.column("p")[0].as_py(), group.column("q")[0].as_py()
            node = np.asarray(group.column("node"))
            copies = np.asarray(group.column("copies"))
            block = np.asarray(group.column("block"))
            sets = shingle_sets(group.column("text").to_pylist(), words)
            # rows that repeat an id and a set stand for one member
            once = sorted({(n, s.tobytes()): i for i, (n, s) in reversed(list(enumerate(zip(node.tolist(), sets))))}.values())
            node, copies, block, sets = node[once], copies[once], block[once], [sets[i] for i in once]
            link = similar(sets, threshold) & (node[:, None] != node[None, :])
            if p != q:
                link &= block[:, None] != block[None, :]
            weight = link @ copies.astype(np.float64)
            a, b = np.nonzero(np.triu(link))
            label = merge_labels(np.stack([a, b], axis=1), len(node))
            root = np.full(len(node), np.iinfo(np.int64).max)
            np.minimum.at(root, label, node)
            some = link.any(axis=1)
            if some.any():
                cols = [node[some], np.rint(weight[some]).astype(np.int64), root[label[some]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["node", "n_links", "root"])

    return map_batches(rows, run, "node bigint, n_links bigint, root bigint")


def similar(sets: list[np.ndarray], threshold: float, columns: int = 8192) -> np.ndarray:
    """Boolean matrix of the pairs of sets with Jaccard similarity of at least ``threshold``."""
    m = len(sets)
    size = np.asarray([len(s) for s in sets], dtype=np.float64)
    if m == 2:
        common = np.zeros((2, 2))
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        owner = np.repeat(np.arange(m), size.astype(np.int64))
        _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        used = np.cumsum(count > 1) - 1  # shingles of one set alone need no column
        keep = count[col] > 1
        owner, col = owner[keep], used[col[keep]]
        order = np.argsort(col, kind="stable")
        owner, col = owner[order], col[order]
        common = np.zeros((m, m), dtype=np.float32)
        for lo in range(0, int(col[-1]) + 1 if len(col) else 0, columns):
            a, b = np.searchsorted(col, [lo, lo + columns])
            held = np.zeros((m, min(columns, int(col[-1]) + 1 - lo)), dtype=np.float32)
            held[owner[a:b], col[a:b] - lo] = 1.0
            common += held @ held.T
        common = common.astype(np.float64)
    union = size[:, None] + size[None, :] - common
    link = (common >= threshold * union - 1e-9) & (union > 0)
    np.fill_diagonal(link, False)
    return link


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                 recall: float = TARGET_RECALL, trie_block: int = TRIE_BLOCK, exact_block: int = EXACT_BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links, kept), one row per row of ``docs``.

    class_id is the smallest id that links reach (its own, if none); n_links
    counts the other documents linked directly, copies included; kept marks the
    rows whose id is their class_id (rows without an id are kept)."""
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")).withColumn("h", F.xxhash64("text"))
    prefix = least_prefix(threshold, recall)
    sketches = materialise(sketch(docs, prefix))
    classes = materialise(
        sketches.filter(F.col("hi").isNotNull()).groupBy("hi", "lo").agg(
            F.min(F.struct("doc_id", "h")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"),
            F.first("keys").alias("keys"), F.first("sig").alias("sig"),
        ).withColumn("node", F.monotonically_increasing_id())
    )
    leaves = classes.select("node", F.posexplode("keys").alias("tree", "key"))
    tries = materialise(leaves.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    members = leaves.join(tries, ["tree", "key"]).withColumn("blocks", F.ceil(F.col("m") / trie_block).cast("int"))
    members = members.join(classes.select("node", "sig"), "node")
    members = block_pairs(members).select("tree", "key", "p", "q", "node", "sig")
    members = members.repartition("tree", "key", "p", "q").sortWithinPartitions("tree", "key", "p", "q")
    edges = unite_in_tries(members, prefix, threshold).distinct()
    clusters = connected_components(edges)

    cluster = materialise(clusters.join(classes.select("node", "rep", "copies", "n"), "node").withColumnRenamed("component", "cluster"))
    sizes = materialise(cluster.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("words")))
    blocks = F.ceil(F.greatest(F.col("m") / exact_block, F.col("words") / EXACT_SHINGLES)).cast("int")
    cluster = materialise(cluster.join(sizes, "cluster").select("cluster", "node", "rep.*", "copies", blocks.alias("blocks")))
    texts = docs.join(cluster, ["doc_id", "h"])  # the text of each class's representative
    rows = block_pairs(texts).select("cluster", "p", "q", "block", "node", "copies", "text")
    rows = rows.repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q")
    links = materialise(exact_links(rows, threshold))

    counts = links.groupBy("node").agg(F.sum("n_links").alias("links"))
    joined = connected_components(links.filter("node != root").select(F.col("node").alias("src"), F.col("root").alias("dst")))
    first = joined.join(classes.select("node", F.col("rep.doc_id").alias("first")), "node").groupBy("component").agg(F.min("first").alias("first"))
    result = classes.select("hi", "lo", "node", "rep", "copies").join(counts, "node", "left").join(joined, "node", "left")
    result = materialise(
        result.join(first, "component", "left").select(
            "hi", "lo", F.coalesce("first", "rep.doc_id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        )
    )
    rows = sketches.select("doc_id", "hi", "lo").join(result, ["hi", "lo"], "left")
    class_id = F.coalesce("class_id", "doc_id")
    kept = F.coalesce(class_id == F.col("doc_id"), F.lit(True))
    return rows.select("doc_id", class_id.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), kept.alias("kept"))
