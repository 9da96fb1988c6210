"""Blocked fuzzy self-join (D2/D3) without materialising pair rows.

Input: distinct match keys ``(cohort, key, node)``. Output: every pair of
keys of the same cohort whose token-sort similarity reaches the threshold.

The similarity is one of the InDel distance ``d(a, b) = la + lb - 2 * LCS``, which is
a metric: a pair matches iff ``100 * d <= (100 - t) * (la + lb)``, and for any pivot ``p``
``|d(a, p) - d(b, p)| <= d(a, b)``. Plan (all DataFrame operations, work grows with
the data, no driver loop):

* Every cohort gets pivots: of a bounded sample (the first key by hash of each of
  ``_SAMPLE`` buckets, a partial aggregate) the one farthest from those chosen,
  again and again. Every key learns its exact distance to each pivot of its cohort.
* Every key also gets a *signature* of 192 bits, three for each of 64 classes of characters: their
  count modulo 6 as a cyclic code, in which one step changes one bit. An edit changes one
  count by one, so signatures that differ in more bits than the threshold allows edits are no match.
* Keys are dealt by cohort into as many shares as full packets need (at most ``_DEALS``), and a share is cut in
  the order of length, nearest pivot and ring (the distance to it) into *packets* of one cohort and at
  most ``packet_size`` keys, fewer where keys are long. A cohort that holds a third of all rows is
  spread over tasks. How keys are cut does not depend on the number of tasks.
* A packet keeps its least and largest length, distance to the first pivots and
  count of a few character classes (one edit changes one count by one). Two
  packets whose rings around some pivot, or whose counts, lie farther apart than the
  edits the threshold allows hold no match: such pairs of packets are dropped, and so
  are those outside the length band ``la <= lb <= la * (200 - t) / t``. Only ids
  and boxes take part in that.
* Key lists are attached to the remaining packet pairs by equi-joins on one
  packet id each, and the pairs are dealt evenly. Each packet pair is one row carrying both key lists,
  whose keys flow to an Arrow task one after another, so the task holds one packet pair and never a batch of them.
  It goes through a pair tile by tile, in the length band: it drops the pairs of keys whose signatures differ
  too much in the 64 bits that tell most in these packets (one machine word a pair), then, word by word, those that all bits or the
  rings around some pivot set too far apart, scores the others (:class:`~recordforge.functions.similarity.PairScorer`)
  and emits only matches. Candidate pairs exist only inside that task's memory, which flushes by pairs and by bytes.

Keys may be marked as fresh: then only pairs with a fresh key are wanted, packets hold
fresh keys or others only, and two packets of others never meet (incremental dedup).

Packets are written once to the checkpoint folder, so a recomputed task cannot
cut them differently. No filter loses a pair; pivots only decide what is compared.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions import similarity as _similarity
from ..functions.similarity import PairScorer
from ..session import checkpoint_dir

# The scoring task and its kernel travel with the job (pickled by value), so
# executors need numpy and pyarrow but not this package installed.
cloudpickle.register_pickle_by_value(_similarity)
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGE_SCHEMA = "cohort string, key_a string, key_b string, node_a bigint, node_b bigint"

# candidate pairs and bytes of strings scored per vectorised call inside a task
_CHUNK_PAIRS = 50_000
_CHUNK_BYTES = 8_000_000
# Pairs of keys whose signatures are compared at a time, and most keys of one side; the words of a tile stay in the processor's cache.
_TILE, _TILE_B = 32_768, 4096
# Keys measured at a time.
_MEASURED = 1024
# Characters of a key that count as one key of a packet.
_KEY_CHARS = 256

# Character classes whose counts order the keys and bound their distance.
_CLASSES = ["01234", "56789", "ae", "iou", "bcdfgh", "jklmn", "pqrs", "tvwxyz"]
# Shares that the packets of one cohort are dealt into when paired, and a cohort's keys when they meet its pivots.
_PAIR_SALTS = 16
# Most shares that a cohort's keys are dealt into when they are cut into packets; what a share may hold more than another.
_DEALS, _UNEVEN = 32, 1.1
# Keys of a cohort that its pivots are chosen from, and pivots of a cohort.
_SAMPLE = 256
PIVOTS = 16
# Pivots whose rings bound a packet: the first, which lie farthest apart. Pairs are told apart by all.
_BOX_PIVOTS = 4
_SIGNATURE = ["sig0", "sig1", "sig2"]


def _score_blocks(threshold: int):
    def run(batches):
        buf = _Chunk()
        for cohort, a, b in _packet_pairs_of(batches):
            for i, j in _near_pairs(a, b or a, b is None, threshold):
                buf.add(cohort, False, a.keys, a.nodes, (b or a).keys, (b or a).nodes, (i, j))
                if buf.pairs >= _CHUNK_PAIRS or buf.bytes >= _CHUNK_BYTES:
                    out = buf.flush(threshold)
                    if out is not None:
                        yield out
        out = buf.flush(threshold)
        if out is not None:
            yield out

    return run


def _packet_pairs_of(batches):
    """(cohort, packet, other packet or None if it is the same) of rows that come pair by pair, first ``a``, then ``b``."""
    now, cohort, held = None, None, ([], [])

    def pair():
        return cohort, _Packet(held[0]), _Packet(held[1]) if held[1] else None

    for batch in batches:
        a, b = (batch.column(c).to_numpy() for c in "ab")
        second = batch.column("second").to_numpy(zero_copy_only=False)
        cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (second[1:] != second[:-1])) + 1
        for at, to in zip([0, *cut.tolist()], [*cut.tolist(), len(a)]):
            if at == to:
                continue
            if now != (a[at], b[at]):
                if now is not None:
                    yield pair()
                now, cohort, held = (a[at], b[at]), batch.column("cohort")[at].as_py(), ([], [])
            held[int(second[at])].append(batch.slice(at, to - at))
    if now is not None:
        yield pair()


class _Packet:
    """The keys of a packet by ascending length: lengths, signatures, rings, nodes."""

    def __init__(self, rows: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        lens = rows.column("len").to_numpy()
        order = np.argsort(lens, kind="stable")
        self.lens = lens[order].astype(np.int64)
        self.nodes = rows.column("node").to_numpy()[order]
        self.words = np.ascontiguousarray(np.stack([rows.column(w).to_numpy() for w in _SIGNATURE], axis=1)[order]).view(np.uint64)
        self.rings = _rings(rows.column("dist"))[order]
        self.keys = rows.column("key").take(pa.array(order)).to_pylist()


def _near_pairs(a: _Packet, b: _Packet, same: bool, threshold: int):
    """Runs of candidate pairs (i, j): inside the length band, with signatures and rings close enough. Loses no match."""
    held, n = [], 0
    words_a, words_b = _telling_bits(a.words, b.words)
    word_a, word_b = words_a[0], words_b[0]
    words, bits = np.empty(_TILE, np.uint64), np.empty(_TILE, np.uint8)
    rows = min(_TILE // min(len(b.lens), _TILE_B), 256)
    for i0 in range(0, len(a.lens), rows):
        la = a.lens[i0 : i0 + rows]
        first = np.searchsorted(b.lens * (200 - threshold), la[0] * threshold)
        last = np.searchsorted(b.lens * threshold, la[-1] * (200 - threshold), side="right")
        for j0 in range(max(first, i0 + 1) if same else first, last, _TILE_B):
            j1 = min(last, j0 + _TILE_B)
            size = len(la) * (j1 - j0)
            np.bitwise_xor(word_a[i0 : i0 + rows, None], word_b[None, j0:j1], out=words[:size].reshape(len(la), j1 - j0))
            differ = np.bitwise_count(words[:size], out=bits[:size])
            at = np.flatnonzero(differ <= min(255, (la[-1] + b.lens[j1 - 1]) * (100 - threshold) // 100))
            i = at // (j1 - j0)
            held.append((i0 + i, j0 + at - i * (j1 - j0), differ[at]))
            n += len(at)
            if n >= 2 * _CHUNK_PAIRS:
                yield _nearer(a, b, same, threshold, words_a, words_b, *map(np.concatenate, zip(*held)))
                held, n = [], 0
    if n:
        yield _nearer(a, b, same, threshold, words_a, words_b, *map(np.concatenate, zip(*held)))


def _telling_bits(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Three words a key: all bits of its signature, in the first word the 64 in which most pairs of the two packets differ, in
    the last those in which fewest do. Any order loses no match."""
    a, b = (np.unpackbits(x.view(np.uint8), axis=1) for x in (a, b))
    p, q = a.mean(axis=0), b.mean(axis=0)
    most = np.argsort(-(p + q - 2 * p * q), kind="stable")
    return tuple(np.ascontiguousarray(np.ascontiguousarray(np.packbits(x[:, most], axis=1)).view(np.uint64).T) for x in (a, b))


def _nearer(a: _Packet, b: _Packet, same: bool, threshold: int, words_a, words_b, i, j, differ):
    """Of the pairs (i, j), whose first words differ in ``differ`` bits, those inside the length band whose whole signatures
    and whose rings are close enough. Word by word, so most pairs are gone after the second."""
    if same:
        near = i < j
        i, j, differ = i[near], j[near], differ[near]
    long = a.lens[i] + b.lens[j]
    allowed = long * (100 - threshold) // 100
    for wa, wb in zip(words_a[1:], words_b[1:]):
        differ = differ + np.bitwise_count(wa[i] ^ wb[j])  # at most 192
        near = differ <= allowed
        i, j, differ, allowed, long = i[near], j[near], differ[near], allowed[near], long[near]
    near = 200 * np.minimum(a.lens[i], b.lens[j]) >= threshold * long
    i, j, allowed = i[near], j[near], allowed[near]
    near = (np.abs(a.rings[i] - b.rings[j]) <= allowed[:, None]).all(axis=1)
    return i[near], j[near]


def signatures(hist: np.ndarray) -> np.ndarray:
    """192 bits a row of 64 counts, as three int64: each count modulo 6 as 000, 100, 110, 111, 011, 001. The bits in which
    two rows differ are at most the sum of the counts' differences, a lower bound of the InDel distance."""
    m = hist % 6
    bits = np.concatenate([(m >= k) & (m < k + 3) for k in (1, 2, 3)], axis=1)
    return np.packbits(bits, axis=1).view(np.int64)


def _rings(column) -> np.ndarray:
    """Distances to the pivots, a row per key; missing pivots (the same ones for a whole cohort) are 0."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), PIVOTS), dtype=np.int16)
    out[np.arange(PIVOTS) < lengths[:, None]] = np.asarray(column.flatten())
    return out


class _Chunk:
    """Accumulates candidate pairs of packet pairs until enough are pending."""

    def __init__(self):
        self._reset()

    def _reset(self):
        self.strings, self.nodes, self.cohorts = [], [], []
        self.ia, self.ib = [], []
        self.pairs = self.bytes = 0

    def add(self, cohort, same, a_keys, a_nodes, b_keys, b_nodes, near=None):
        """The pairs ``near`` of two packets, or else all: with ``same`` those of one packet with itself."""
        if near is None:
            near = np.triu_indices(len(a_keys), 1) if same else np.indices((len(a_keys), len(b_keys))).reshape(2, -1)
        i, j = near
        if not len(i):
            return
        base = len(self.strings)
        for keys, nodes, at, side in ((a_keys, a_nodes, i, self.ia), (b_keys, b_nodes, j, self.ib)):
            used, own = np.unique(at, return_inverse=True)  # only keys of such pairs are held
            side.append(base + own)
            base += len(used)
            held = [keys[x] for x in used.tolist()]
            self.strings += held
            self.nodes.append(np.asarray(nodes, dtype=np.int64)[used])
            self.bytes += sum(4 * len(x) + 100 for x in held)  # code points of each string, and the string
        self.cohorts.append((cohort, len(i)))
        self.pairs += len(i)

    def flush(self, threshold):
        if not self.pairs:
            self._reset()
            return None
        ia = np.concatenate(self.ia)
        ib = np.concatenate(self.ib)
        coh = np.repeat(np.arange(len(self.cohorts)), [n for _, n in self.cohorts])
        names = [c for c, _ in self.cohorts]
        nodes = np.concatenate(self.nodes)
        scorer = PairScorer(self.strings)
        hit = scorer.matches(ia, ib, threshold, histograms=False)  # their signatures have told what histograms can
        ia, ib, coh = ia[hit], ib[hit], coh[hit]
        strings = self.strings
        self._reset()
        if not len(ia):
            return None
        ka = [strings[i] for i in ia]
        kb = [strings[i] for i in ib]
        # canonical orientation: key_a < key_b
        flip = [x > y for x, y in zip(ka, kb)]
        key_a = [y if f else x for x, y, f in zip(ka, kb, flip)]
        key_b = [x if f else y for x, y, f in zip(ka, kb, flip)]
        fl = np.array(flip, dtype=bool)
        na_, nb_ = nodes[ia], nodes[ib]
        node_a = np.where(fl, nb_, na_)
        node_b = np.where(fl, na_, nb_)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[c] for c in coh], pa.string()),
                pa.array(key_a, pa.string()),
                pa.array(key_b, pa.string()),
                pa.array(node_a, pa.int64()),
                pa.array(node_b, pa.int64()),
            ],
            names=["cohort", "key_a", "key_b", "node_a", "node_b"],
        )


def farthest_first(strings: list[str], n: int = PIVOTS) -> list[str]:
    """Up to ``n`` of the strings: the first, then each time the one whose least InDel distance to those chosen is largest."""
    strings = sorted(set(strings))
    scorer = PairScorer(strings)
    everyone = np.arange(len(strings))
    chosen, nearest = [0], None
    while True:
        d = scorer.distances(everyone, np.full(len(strings), chosen[-1]))
        nearest = d if nearest is None else np.minimum(nearest, d)
        if len(chosen) == n or not nearest.max():
            return [strings[i] for i in chosen]
        chosen.append(int(nearest.argmax()))


def _choose_pivots(batches):
    for batch in batches:
        chosen = [farthest_first(x) for x in batch.column("sample").to_pylist()]
        columns = [batch.column("cohort"), pa.array(chosen, pa.list_(pa.string())), batch.column("new"), batch.column("old")]
        yield pa.RecordBatch.from_arrays(columns, names=["cohort", "pivots", "new", "old"])


_OWN = ["cohort", "key", "node", "len", "fresh", "weight", "total"]


def _measure(batches):
    """Each key's signature and its distances to its cohort's pivots, in place of the pivots."""
    for batch in (whole.slice(at, _MEASURED) for whole in batches for at in range(0, whole.num_rows, _MEASURED)):
        pivots = batch.column("pivots")
        keys = batch.column("key").to_pylist()
        coded = pivots.flatten().dictionary_encode()
        per_key = np.diff(pivots.offsets.to_numpy())  # flatten() and offsets go by the slice
        own = np.repeat(np.arange(len(keys)), per_key)
        scorer = PairScorer([*keys, *coded.dictionary.to_pylist()])
        d = scorer.distances(own, len(keys) + np.asarray(coded.indices))
        d = np.minimum(d, np.iinfo(np.int16).max)  # cut off, rings are no farther apart than before
        dist = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per_key)]), pa.int32()), pa.array(d, pa.int16()))
        words = [pa.array(w) for w in signatures(scorer.hist[: len(keys)]).T]
        own = _OWN
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *words, dist], names=[*own, *_SIGNATURE, "dist"])


def with_pivot_distances(k: DataFrame) -> DataFrame:
    """``k`` (cohort, key, node, len, fresh) with its weight (the keys it counts as), the ``total`` of its cohort's fresh keys or
    others, its signature and ``dist``, its distances to the pivots of its cohort."""
    k = k.withColumn("weight", F.greatest(F.lit(1), F.ceil(F.col("len") / F.lit(_KEY_CHARS))).cast("bigint"))
    bucket = F.pmod(F.xxhash64("key"), F.lit(_SAMPLE))
    weights = [F.sum(F.when(F.col("fresh") == new, F.col("weight")).otherwise(0)).alias(n) for n, new in (("new", True), ("old", False))]
    sample = k.groupBy("cohort", bucket.alias("bucket")).agg(F.min_by("key", F.struct(F.xxhash64("key", F.lit(1)), "key")).alias("key"), *weights)
    sample = sample.groupBy("cohort").agg(F.collect_list("key").alias("sample"), F.sum("new").alias("new"), F.sum("old").alias("old"))  # at most _SAMPLE keys
    pivots = sample.mapInArrow(_choose_pivots, "cohort string, pivots array<string>, new bigint, old bigint")
    pivots = pivots.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_PAIR_SALTS - 1))))
    salt = F.pmod(F.xxhash64("key"), F.lit(_PAIR_SALTS)).cast("int")
    # a key is little data and much work: dealt by number, neither merged nor broadcast by size
    tasks = int(k.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = k.withColumn("salt", salt).repartition(tasks, "cohort", "salt").join(pivots.hint("merge"), ["cohort", "salt"])
    met = met.withColumn("total", F.when(F.col("fresh"), F.col("new")).otherwise(F.col("old"))).select(*_OWN, "pivots")
    own = "cohort string, key string, node bigint, len int, fresh boolean, weight bigint, total bigint"
    return met.mapInArrow(_measure, f"{own}, {', '.join(f'{w} bigint' for w in _SIGNATURE)}, dist array<smallint>")


def similarity_join(
    keys: DataFrame,
    threshold: int,
    cohort: str = "cohort",
    key: str = "key",
    node: str = "node",
    packet_size: int = config.SIMJOIN_PACKET_SIZE,
    fresh: str | None = None,
) -> DataFrame:
    """Pairs of distinct keys within a cohort with similarity >= threshold.

    ``keys`` must hold one row per distinct ``(cohort, key)``; empty keys are
    ignored. Returns ``cohort, key_a, key_b, node_a, node_b`` with
    ``key_a < key_b``. With ``fresh``, a boolean column, only pairs with a fresh key.
    Runs a job while it is built (the packets are written).
    """
    t = int(threshold)
    if not 0 < t <= 100:
        raise ValueError("threshold must be in (0, 100]")
    k = (
        keys.select(
            F.col(cohort).alias("cohort"),
            F.col(key).alias("key"),
            F.col(node).cast("bigint").alias("node"),
            (F.col(fresh) if fresh else F.lit(True)).alias("fresh"),
        )
        .filter(F.length("key") > 0)
        .withColumn("len", F.length("key"))
    )
    packets = _packets(k, packet_size)
    # a packet pair is little data and much work: dealt by number, not merged by size
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        _packet_pairs(packets, t)
        .repartition(tasks, "b")
        .join(packets.select(F.col("packet").alias("b"), F.col("items").alias("items_b")), "b")
        .repartition(tasks, "a")
        .join(packets.select(F.col("packet").alias("a"), "cohort", F.col("items").alias("items_a")), "a")
        .repartition(tasks, "a", "b")
    )
    # a pair's keys flow one by one, first those of a; a packet that meets itself comes once
    sides = [F.struct(F.lit(n == "b").alias("second"), F.col(f"items_{n}").alias("items")) for n in "ab"]
    blocks = blocks.withColumn("side", F.explode(F.when(F.col("a") == F.col("b"), F.array(sides[0])).otherwise(F.array(*sides))))
    blocks = blocks.select("cohort", "a", "b", "side.second", F.explode("side.items").alias("x")).select("cohort", "a", "b", "second", "x.*")
    return blocks.mapInArrow(_score_blocks(t), EDGE_SCHEMA)


def _packets(k: DataFrame, packet_size: int) -> DataFrame:
    """(packet, cohort, fresh, items, short, long, lo, hi): keys cut in the order of length, nearest pivot and ring."""
    lower = F.lower("key")
    counts = F.array(*[F.length(lower) - F.length(F.translate(lower, chars, "")) for chars in _CLASSES])
    ring = F.array_min("dist")
    order = ["len", "cell", "ring", "counts", "key"]
    if "fresh" not in k.columns:
        k = k.withColumn("fresh", F.lit(True))
    dealt = with_pivot_distances(k).withColumns({"counts": counts, "ring": ring, "cell": F.array_position("dist", ring)})
    # by hash, not by range: a range would measure every key twice, for its sample
    deals = F.least(F.lit(_DEALS), F.ceil(F.col("total") * _UNEVEN / packet_size))
    dealt = dealt.withColumns({"deals": deals, "deal": F.pmod(F.xxhash64("key", F.lit(2)), deals)})
    share = F.col("total") * _UNEVEN / F.col("deals")  # of one size where a share makes several packets
    size = F.least(F.lit(packet_size), F.ceil(share / F.ceil(share / packet_size)))
    before = F.sum("weight").over(Window.partitionBy("cohort", "fresh", "deal").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight")
    cut = dealt.withColumn("sub", F.floor(before / size))
    bounds = [f(F.get("counts", F.lit(i))).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max)) for i in range(len(_CLASSES))]
    rings = [f(F.get("dist", F.lit(i))).alias(f"{n}{i}") for n, f in (("near", F.min), ("far", F.max)) for i in range(_BOX_PIVOTS)]
    bounds += [F.min("len").alias("short"), F.max("len").alias("long")]
    packed = cut.groupBy("cohort", "fresh", "deal", "sub").agg(F.collect_list(F.struct("node", "key", "len", *_SIGNATURE, "dist")).alias("items"), *bounds, *rings)
    checkpoint_dir(k.sparkSession)
    return packed.drop("deal", "sub").withColumn("packet", F.monotonically_increasing_id()).checkpoint()


def _packet_pairs(packets: DataFrame, threshold: int) -> DataFrame:
    """(a, b) ids of the packet pairs that length, class counts and rings admit; a packet pairs with itself, too."""
    boxes = ["short", "long"] + [f"{n}{i}" for n in ("lo", "hi") for i in range(len(_CLASSES))] + [f"{n}{i}" for n in ("near", "far") for i in range(_BOX_PIVOTS)]
    salt = F.pmod(F.xxhash64("packet"), F.lit(_PAIR_SALTS)).cast("int")
    left = packets.select("cohort", F.col("packet").alias("a"), F.col("fresh").alias("fa"), salt.alias("salt"), *[F.col(c).alias(f"a_{c}") for c in boxes])
    right = packets.select("cohort", F.col("packet").alias("b"), F.col("fresh").alias("fb"), *[F.col(c).alias(f"b_{c}") for c in boxes])
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_PAIR_SALTS - 1))))

    def apart(low, high, i):
        gap = F.greatest(F.col(f"a_{low}{i}") - F.col(f"b_{high}{i}"), F.col(f"b_{low}{i}") - F.col(f"a_{high}{i}"), F.lit(0))
        return gap  # a pivot that a cohort lacks is null on both sides; greatest skips nulls

    edits = sum((apart("lo", "hi", i) for i in range(1, len(_CLASSES))), apart("lo", "hi", 0))
    between_rings = F.greatest(*[apart("near", "far", i) for i in range(_BOX_PIVOTS)])
    allowed = (F.col("a_long") + F.col("b_long")) * (100 - threshold)
    admitted = (edits * 100 <= allowed) & (between_rings * 100 <= allowed) & (F.col("fa") | F.col("fb")) & (F.col("a") <= F.col("b"))
    for x, y in (("a", "b"), ("b", "a")):
        admitted = admitted & (F.col(f"{x}_short") * threshold <= F.col(f"{y}_long") * (200 - threshold))
    return left.join(right, ["cohort", "salt"]).filter(admitted).select("a", "b")
