"""Embedding near-duplicates by randomised-rotation binary codes (operator 5).

Every vector is normalised, padded with zeros to ``code_bits`` dimensions and
turned by one seeded random rotation. Its code is the signs of the result; two
correction factors are stored with it, the inner product ``a`` of the vector
with its own normalised sign vector, and the error scale sqrt(1 - a^2) / a.
For a query ``q`` the estimate <signs, q> / (sqrt(bits) a) of the cosine is
unbiased, and it errs by more than ``epsilon`` error scales / sqrt(bits - 1)
with a probability that falls as exp(-c epsilon^2). Only pairs whose upper
confidence bound reaches the threshold are recomputed, exactly, in double
precision from the original vectors.

Which pairs meet at all:

1. Equal vectors collapse (a group of copies of any size is one with a count).
2. Signs of further rotations are cut into ``tables`` bands of ``band`` bits. Two
   vectors at the threshold agree in a sign with p = 1 - arccos(t) / pi, so they
   share a band somewhere with 1 - (1 - p^band)^tables, which ``tables`` brings to
   ``recall``; ``band`` grows with the logarithm of the number of vectors, so that
   unlike vectors rarely meet and work does not grow with the square of the input.
   Members of a bucket are united by search: a vector's links among those not yet
   united are found by estimate and recomputation, then theirs, and so on.
3. Within each component of the united vectors all pairs are compared, so a pair
   that shared no band is still found if others connect it.

Buckets and components above a block size are cut into blocks that meet pairwise;
a task holds two blocks and emits spanning edges or counts, never pairs. A group
of near copies costs the square of its distinct vectors, as its links are counted.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing, and so do rows without an id, as do vectors of different length
with each other. Rows that repeat are copies of each other and link. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .common import block_pairs, by_value, grouped, map_batches, materialise

by_value(__name__)

THRESHOLD = 0.95
CODE_BITS = 128
EPSILON = 5.0
BLOCK = 4096  # vectors on one side of a task
RECALL = 0.9999  # of a pair at the threshold, by the bands alone


def rotation(bits: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix, the same for every call."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return q * np.sign(np.diag(r))


def code_size(dim: int, least: int) -> int:
    """Bits of a code for vectors of ``dim`` components: whole bytes, ``least`` or more."""
    return max(least, -(-dim // 8) * 8)


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign bits, inner product with the own sign vector) of unit ``vectors``."""
    bits = len(turn)
    turned = vectors @ turn[: vectors.shape[1]]
    own = np.abs(turned).sum(axis=1) / np.sqrt(bits)
    return np.packbits(turned >= 0, axis=1), own


def usable(column: str):
    """Non-null, non-empty, all components finite and not all zero."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def band_plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(bits of a band, number of tables) for ``n`` vectors."""
    band = min(48, 3 + max(1, n).bit_length())
    agree = 1 - np.arccos(threshold) / np.pi
    return band, max(1, int(np.ceil(np.log(1 - recall) / np.log1p(-(agree**band)))))


def band_keys(unit: np.ndarray, band: int, tables: int) -> np.ndarray:
    """A 64-bit key for each vector and table: signs of rotations, ``band`` to a table."""
    size = code_size(unit.shape[1], 64)
    per = max(1, size // band)  # tables that one rotation gives
    if band > size:
        raise ValueError("a band is longer than a rotation")
    keys = np.empty((len(unit), tables), dtype=np.int64)
    weight = np.int64(1) << np.arange(band, dtype=np.int64)
    for first in range(0, tables, per):
        signs = unit @ rotation(size, 1000 + first)[: unit.shape[1]] >= 0
        for t in range(first, min(tables, first + per)):
            keys[:, t] = signs[:, (t - first) * band : (t - first + 1) * band] @ weight
    return keys


def to_bytes(vector: np.ndarray) -> bytes:
    """In single precision where that is exact."""
    single = vector.astype(np.float32)
    return single.tobytes() if (single == vector).all() else vector.tobytes()


def from_bytes(raw: list[bytes], dim: int) -> np.ndarray:
    return np.stack([np.frombuffer(r, dtype=np.float32 if len(r) == 4 * dim else np.float64) for r in raw]).astype(np.float64)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def codes(vectors: DataFrame, bits: int, band: int, tables: int) -> DataFrame:
    """``vectors`` (node, copies, vector) with code, factor and components as binary, and a key for each table."""

    def run(batches):
        import pyarrow as pa

        turns: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                raw = batch.column(batch.schema.get_field_index("vector"))
                dims = np.asarray(raw.value_lengths())
                for dim in np.unique(dims):
                    part = batch.filter(pa.array(dims == dim))
                    values = np.asarray(part.column(part.schema.get_field_index("vector")).flatten()).astype(np.float64).reshape(-1, dim)
                    size = code_size(int(dim), bits)
                    if size not in turns:
                        turns[size] = rotation(size)
                    code, own = encode(unit(values), turns[size])
                    keys = band_keys(unit(values), band, tables)
                    offsets = pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(part.schema.get_field_index("node")),
                            part.column(part.schema.get_field_index("copies")),
                            pa.array(np.full(len(values), dim, dtype=np.int32)),
                            pa.array([c.tobytes() for c in code], pa.binary()),
                            pa.array(own),
                            pa.array([to_bytes(v) for v in values], pa.binary()),
                            pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                        ],
                        ["node", "copies", "dim", "code", "own", "raw", "keys"],
                    )

    return map_batches(vectors, run, "node bigint, copies bigint, dim int, code binary, own double, raw binary, keys array<bigint>")


def block_of(group, dim: int) -> dict:
    """The vectors of a group as arrays."""
    code = np.frombuffer(b"".join(group.column("code").to_pylist()), dtype=np.uint8).reshape(group.num_rows, -1)
    return {"code": code, "own": np.asarray(group.column("own")), "unit": unit(from_bytes(group.column("raw").to_pylist(), dim))}


def take(block: dict, at: np.ndarray) -> dict:
    return {k: v[at] for k, v in block.items()}


def linked_pairs(a: dict, b: dict, turn: np.ndarray, threshold: float, epsilon: float, chunk: int = 512):
    """Index pairs (i, j) of blocks ``a`` and ``b`` with cosine >= threshold."""
    bits, dim = len(turn), a["unit"].shape[1]
    signs = (np.unpackbits(b["code"], axis=1)[:, :bits].astype(np.float32) * 2 - 1).T
    own = b["own"].astype(np.float32)
    slack = epsilon * np.sqrt(np.maximum(0.0, 1 - b["own"] ** 2)) / b["own"] / np.sqrt(bits - 1)
    # <signs, q> / (sqrt(bits) own) + slack >= threshold, as a bound on <signs, q>
    least = ((threshold - slack) * np.sqrt(bits) * own - 1e-3).astype(np.float32)
    turned = (a["unit"] @ turn[:dim]).astype(np.float32)
    out = []
    for lo in range(0, len(turned), chunk):
        i, j = np.nonzero(turned[lo : lo + chunk] @ signs >= least)
        i = i + lo
        for at in range(0, len(i), 65_536):
            x, y = i[at : at + 65_536], j[at : at + 65_536]
            ok = np.einsum("ij,ij->i", a["unit"][x], b["unit"][y]) >= threshold
            out.append(np.stack([x[ok], y[ok]], axis=1))
    return np.concatenate(out) if out else np.empty((0, 2), dtype=np.int64)


def search_links(block: dict, turn: np.ndarray, threshold: float, epsilon: float) -> np.ndarray:
    """Spanning pairs of the members of ``block`` that links connect, found by search."""
    left = np.arange(len(block["unit"]))
    out = []
    while len(left) > 1:
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            pairs = linked_pairs(take(block, front[:512]), take(block, left), turn, threshold, epsilon)
            new, first = np.unique(pairs[:, 1], return_index=True)
            out.append(np.stack([front[pairs[first, 0]], left[new]], axis=1))
            front = np.concatenate([front[512:], left[new]])
            left = np.delete(left, new)
    return np.concatenate(out) if out else np.empty((0, 2), dtype=np.int64)


def unite_in_buckets(rows: DataFrame, threshold: float, bits: int, epsilon: float) -> DataFrame:
    """Spanning edges (src, dst) from the members of buckets (dim, table, key, p, q, node, code, own, raw)."""

    def run(batches):
        import pyarrow as pa

        turns: dict[int, np.ndarray] = {}
        held: list[np.ndarray] = []
        for group in grouped(batches, 5):
            if group.num_rows < 2:
                continue
            dim = group.column("dim")[0].as_py()
            size = code_size(dim, bits)
            if size not in turns:
                turns[size] = rotation(size)
            pairs = search_links(block_of(group, dim), turns[size], threshold, epsilon)
            if len(pairs):
                held.append(np.asarray(group.column("node"))[pairs])
            if sum(map(len, held)) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(held).T], ["src", "dst"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(held).T], ["src", "dst"])

    return map_batches(rows, run, "src bigint, dst bigint")


def compare_blocks(rows: DataFrame, threshold: float, bits: int, epsilon: float) -> DataFrame:
    """(node, n_links) from the block pairs of components (cluster, p, q, block, dim, node, copies, code, own, raw)."""

    def run(batches):
        import pyarrow as pa

        turns: dict[int, np.ndarray] = {}
        for group in grouped(batches, 3):
            dim, p, q = (group.column(c)[0].as_py() for c in ("dim", "p", "q"))
            size = code_size(dim, bits)
            if size not in turns:
                turns[size] = rotation(size)
            block = np.asarray(group.column("block"))
            left, right = np.nonzero(block == p)[0], np.nonzero(block == q)[0]
            if not len(left) or not len(right):
                continue
            whole = block_of(group, dim)
            node, copies = np.asarray(group.column("node")), np.asarray(group.column("copies"))
            links = np.zeros(len(node), dtype=np.int64)
            for lo in range(0, len(left), 512):  # a stretch of one side against the other
                own = left[lo : lo + 512]
                pairs = linked_pairs(take(whole, own), take(whole, right), turns[size], threshold, epsilon)
                i, j = own[pairs[:, 0]], right[pairs[:, 1]]
                if p == q:
                    i, j = i[i < j], j[i < j]
                links += np.bincount(i, weights=copies[j], minlength=len(node)).astype(np.int64)
                links += np.bincount(j, weights=copies[i], minlength=len(node)).astype(np.int64)
            some = links > 0
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(links[some])], ["node", "n_links"])

    return map_batches(rows, run, "node bigint, n_links bigint")


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD,
                    bits: int = CODE_BITS, epsilon: float = EPSILON, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``rows``."""
    rows = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    good = F.col("vec_id").isNotNull() & F.coalesce(usable("vector"), F.lit(False))
    distinct = materialise(rows.filter(good).groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")))
    band, tables = band_plan(distinct.count(), threshold, recall)
    coded = materialise(codes(distinct, bits, band, tables))

    leaves = coded.select("node", "dim", F.posexplode("keys").alias("table", "key"))
    buckets = materialise(leaves.groupBy("dim", "table", "key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"))
    members = leaves.join(buckets, ["dim", "table", "key"]).withColumn("blocks", F.ceil(F.col("m") / block).cast("int"))
    members = block_pairs(members.join(coded.select("node", "code", "own", "raw"), "node"))
    members = members.select("dim", "table", "key", "p", "q", "node", "code", "own", "raw")
    members = members.repartition("dim", "table", "key", "p", "q").sortWithinPartitions("dim", "table", "key", "p", "q")
    joined = connected_components(unite_in_buckets(members, threshold, bits, epsilon).distinct())

    cluster = materialise(joined.withColumnRenamed("component", "cluster"))
    sizes = materialise(cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")))
    dealt = cluster.join(sizes, "cluster").join(coded.select("node", "dim", "copies", "code", "own", "raw"), "node")
    dealt = block_pairs(dealt).select("cluster", "p", "q", "block", "dim", "node", "copies", "code", "own", "raw")
    dealt = dealt.repartition("cluster", "p", "q").sortWithinPartitions("cluster", "p", "q")
    counts = compare_blocks(dealt, threshold, bits, epsilon).groupBy("node").agg(F.sum("n_links").alias("links"))

    result = coded.select("node", "copies").join(counts, "node", "left").join(cluster, "node", "left")
    result = materialise(
        result.select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("cluster", "node").alias("component_id"))
    )
    found = rows.filter(good).join(distinct.select("vector", "node"), "vector").select("vec_id", "node").join(result, "node")
    found = found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    rest = rows.filter(~good).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return found.unionByName(rest)
