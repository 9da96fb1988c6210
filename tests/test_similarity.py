"""Similarity kernel, blocked join and components."""

import random

import numpy as np
from pyspark.sql import functions as F

from recordforge.functions.similarity import PairScorer, lcs_length, token_sort_ratio
from recordforge.operators.components import connected_components
from recordforge.operators.simjoin import similarity_join


def _dp(a, b):
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, d in enumerate(b):
            cur.append(prev[j] + 1 if ch == d else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def _strings(rng, n):
    out = []
    for _ in range(n):
        length = rng.choice([1, 5, 20, 40, 63, 64, 65, 90])
        out.append("".join(rng.choice("ab cé") for _ in range(length)))
    for _ in range(n // 2):
        s = list(rng.choice(out))
        for _ in range(rng.randint(0, 3)):
            if s and rng.random() < 0.5:
                del s[rng.randrange(len(s))]
            else:
                s.insert(rng.randint(0, len(s)), rng.choice("abz"))
        out.append("".join(s))
    return out


def test_lcs_matches_dp():
    rng = random.Random(3)
    xs = _strings(rng, 40)
    for a in xs[:25]:
        for b in xs[:25]:
            assert lcs_length(a, b) == _dp(a, b)


def test_vectorised_filters_are_lossless():
    rng = random.Random(5)
    xs = _strings(rng, 120)
    sc = PairScorer(xs)
    ia, ib = np.triu_indices(len(xs), 1)
    for t in (60, 85, 90):
        got = sc.matches(ia, ib, t)
        exp = np.array([200 * _dp(xs[i], xs[j]) >= t * (len(xs[i]) + len(xs[j])) for i, j in zip(ia, ib)])
        assert (got == exp).all()


def test_word_order_does_not_matter():
    assert token_sort_ratio("229 South 4th St, Brooklyn", "Brooklyn, 229 4th St South") > 90
    assert token_sort_ratio("new york", "york new") == 100.0


def test_blocked_join_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for cohort in ("a", "b", "c"):
        base = _strings(rng, 30)
        keys = sorted(set(" ".join(sorted(s.split())) for s in base) - {""})
        rows += [(cohort, k, i + 1000 * ord(cohort)) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "cohort string, key string, node long")
    for t in (70, 85):
        got = {(r.cohort, r.key_a, r.key_b) for r in similarity_join(df, t, packet_size=4).collect()}
        exp = set()
        for c1, k1, _ in rows:
            for c2, k2, _ in rows:
                if c1 == c2 and k1 < k2 and 200 * _dp(k1, k2) >= t * (len(k1) + len(k2)):
                    exp.add((c1, k1, k2))
        assert got == exp


def _components(edges):
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for e in edges for x in e}


def test_components_any_partitioning(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(400)]
    edges = [(a, b) for a, b in edges if a != b]  # self-loops carry no connectivity and are ignored
    exp = _components(edges)
    df = spark.createDataFrame(edges, "src long, dst long")
    for parts in (1, 13):
        got = {r.node: r.component for r in connected_components(df.repartition(parts)).collect()}
        assert got == exp
    grouped = df.withColumn("g", (F.col("src") >= 400).cast("int"))
    got = {r.node: r.component for r in connected_components(grouped, group="g").collect()}
    assert got == exp


def test_single_hot_cohort_split_into_packets(spark, sf_small):
    """Every pool record in one cohort, packets of 8 keys: same pairs as
    scoring all pairs at once."""
    from recordforge.operators.dedup import key_table, match_keys, pool_with_ids
    from recordforge.plans.catalog import prepared

    pool = pool_with_ids(prepared(spark, sf_small).filter(F.col("google_place_id").isNull()))
    keys = match_keys(pool).withColumn("cohort", F.lit("hot"))
    reps, _ = key_table(keys, "addr_key")
    got = {(r.key_a, r.key_b) for r in similarity_join(reps, 70, packet_size=8).collect()}
    ks = [r.key for r in reps.select("key").collect()]
    ia, ib = np.triu_indices(len(ks), 1)
    hit = PairScorer(ks).matches(ia, ib, 70)
    assert got == {tuple(sorted((ks[i], ks[j]))) for i, j in zip(ia[hit], ib[hit])}
    assert len(got) > 0


def test_components_node_with_two_local_roots(spark):
    """Edges of one component in different tasks: the contraction gives node 3
    two roots (1 and 2); the rounds must still join 1, 2 and 3."""
    a = spark.createDataFrame([(1, 3)], "src long, dst long")
    b = spark.createDataFrame([(2, 3)], "src long, dst long")
    df = a.union(b)
    assert df.rdd.getNumPartitions() >= 2
    got = sorted((r.node, r.component) for r in connected_components(df).collect())
    assert got == [(1, 1), (2, 1), (3, 1)]


def test_long_keys_among_short_ones():
    """Keys of several words and one of 20,000 characters, with bounded slices."""
    rng = random.Random(8)
    xs = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([30, 130, 500, 1100]))) for _ in range(30)]
    xs += [x[:-2] + "zz" for x in xs] + ["ab" * 10_000, "ab" * 9_990 + "b" * 20]
    sc = PairScorer(xs)
    ia, ib = np.triu_indices(len(xs), 1)
    got = sc.matches(ia, ib, 85)
    short = [k for k in range(len(ia)) if len(xs[ia[k]]) + len(xs[ib[k]]) < 2000]
    for k in short:
        assert got[k] == (200 * _dp(xs[ia[k]], xs[ib[k]]) >= 85 * (len(xs[ia[k]]) + len(xs[ib[k]])))
    assert got[-1]


def test_one_key_packets_are_not_held():
    from recordforge.operators.simjoin import _Chunk

    chunk = _Chunk()
    for k in range(1000):
        chunk.add("c", True, [f"key {k}"], [k], [f"key {k}"], [k])
    assert not chunk.strings and not chunk.pairs


def test_hot_cohort_packets_come_from_many_tasks(spark):
    from recordforge.operators.simjoin import _packets

    keys = spark.range(20_000).select(
        F.lit("hot").alias("cohort"), F.substring(F.md5(F.col("id").cast("string")), 1, 12).alias("key"), F.col("id").alias("node"), F.lit(12).alias("len")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        packets = _packets(keys, 64)
        sizes = [r.n for r in packets.select(F.size("items").alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 64
        per_task = packets.groupBy(F.spark_partition_id()).agg(F.sum(F.size("items")).alias("n")).collect()
        assert len(per_task) > 3 and max(r.n for r in per_task) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hub_edges_are_dealt_by_salt(spark):
    from recordforge.operators import components

    edges = spark.range(1, 50_001).select(F.lit(0).cast("long").alias("v"), F.col("id").alias("u"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = edges.select("u", "v", components._salt("u")).repartition("v", "salt")
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 2 and max(sizes) < 35_000
        got = connected_components(edges.select(F.col("u").alias("src"), F.col("v").alias("dst")), contract=False)
        assert got.filter("component != 0").isEmpty() and got.count() == 50_001
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_pivots_and_rings_bound_the_distance():
    from recordforge.operators.simjoin import PIVOTS, farthest_first

    rng = random.Random(2)
    xs = sorted({x for x in _strings(rng, 60) if x})
    pivots = farthest_first(xs)
    assert len(pivots) == len(set(pivots)) == min(PIVOTS, len(xs)) and farthest_first(["a", "a"]) == ["a"]
    sc = PairScorer([*xs, *pivots])
    n = len(xs)
    to = np.stack([sc.distances(np.arange(n), np.full(n, n + k)) for k in range(len(pivots))], axis=1)
    ia, ib = np.triu_indices(n, 1)
    d = sc.distances(ia, ib)
    assert (np.abs(to[ia] - to[ib]).max(axis=1) <= d).all()
    assert d[0] == len(xs[ia[0]]) + len(xs[ib[0]]) - 2 * _dp(xs[ia[0]], xs[ib[0]])


def test_only_pairs_with_a_fresh_key(spark):
    rng = random.Random(4)
    keys = sorted({" ".join(sorted(s.split())) for s in _strings(rng, 80)} - {""})
    rows = [("c", k, i, i % 3 == 0) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "cohort string, key string, node long, new boolean")
    every = {(r.node_a, r.node_b) for r in similarity_join(df, 70, packet_size=4).collect()}
    some = {(r.node_a, r.node_b) for r in similarity_join(df, 70, packet_size=4, fresh="new").collect()}
    assert some == {(a, b) for a, b in every if a % 3 == 0 or b % 3 == 0} and 0 < len(some) < len(every)


def test_rings_leave_few_pairs_to_score(spark):
    """One giant cohort: most pairs inside the length band are dropped by their rings, none that matches."""
    from recordforge.operators import simjoin

    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 14))) for _ in range(900)]
    keys = sorted({" ".join(sorted(rng.sample(words, 3) + [str(rng.randint(1, 999))])) for _ in range(700)})
    keys += [k + "x" for k in keys[:40]]
    n = len(keys)
    ia, ib = np.triu_indices(n, 1)
    sc = PairScorer(keys)
    hit = sc.matches(ia, ib, 85)
    want = {tuple(sorted((keys[i], keys[j]))) for i, j in zip(ia[hit], ib[hit])}
    df = spark.createDataFrame([("hot", k, i) for i, k in enumerate(keys)], "cohort string, key string, node long")
    got = {(r.key_a, r.key_b) for r in similarity_join(df, 85).collect()}
    assert got == want and len(want) >= 40
    pivots = simjoin.farthest_first(keys[:256])
    both = PairScorer([*keys, *pivots])
    to = np.stack([both.distances(np.arange(n), np.full(n, n + k)) for k in range(len(pivots))], axis=1)
    near = 100 * np.abs(to[ia] - to[ib]).max(axis=1) <= 15 * (sc.lens[ia] + sc.lens[ib])
    band = 200 * np.minimum(sc.lens[ia], sc.lens[ib]) >= 85 * (sc.lens[ia] + sc.lens[ib])
    assert (near & band).sum() < 0.5 * band.sum()


def test_components_by_sample_and_rest(spark):
    """Phases 1 and 2 with many tasks: dense blocks, chains, bridges and a hub, against a union-find."""
    rng = random.Random(9)
    edges = [(b * 100 + rng.randrange(100), b * 100 + rng.randrange(100)) for b in range(12) for _ in range(400)]
    edges += [(b * 100 + 99, (b + 1) * 100) for b in (0, 1, 4, 7)]  # bridges
    edges += [(5000 + i, 5001 + i) for i in range(400)] + [(9000, 9001 + i) for i in range(500)]
    edges = [(a, b) for a, b in edges if a != b]
    exp = _components(edges)
    df = spark.createDataFrame(edges, "src long, dst long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for contract in (True, False):
            stats = {}
            got = {r.node: r.component for r in connected_components(df.repartition(7), contract=contract, stats=stats).collect()}
            assert got == exp
            assert stats["sample_rounds"] > 0 and stats["rest_edges"] < stats["edges"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_components_of_no_edges(spark):
    none = spark.createDataFrame([], "src long, dst long")
    assert connected_components(none).collect() == []
    assert connected_components(spark.createDataFrame([(3, 3)], "src long, dst long")).collect() == []


def test_signatures_bound_the_distance():
    from recordforge.operators.simjoin import signatures

    rng = random.Random(12)
    xs = sorted({x for x in _strings(rng, 80) if x}) + ["a" * 9, "a" * 4, "a" * 400]
    sc = PairScorer(xs)
    words = signatures(sc.hist)
    ia, ib = np.triu_indices(len(xs), 1)
    bits = np.bitwise_count((words[ia] ^ words[ib]).view(np.uint64)).sum(axis=1)
    assert (bits <= sc.distances(ia, ib)).all() and bits.max() > 10


def test_packets_do_not_shrink_with_more_tasks(spark):
    """A cohort's packets are cut by its keys, also where keys have many lengths and tasks are many; long keys make small packets."""
    from recordforge.operators.simjoin import _packets

    key = F.substring(F.repeat(F.md5(F.col("id").cast("string")), 2), 1, (F.col("id") % 40 + 20).cast("int"))
    keys = spark.range(8_000).select(F.lit("hot").alias("cohort"), key.alias("key"), F.col("id").alias("node")).withColumn("len", F.length("key"))
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert _packets(keys, 512).count() <= 2 * 16
        long = keys.limit(64).withColumn("key", F.concat("key", F.repeat(F.lit("x"), 2000))).withColumn("len", F.length("key"))
        sizes = [r.n for r in _packets(long, 8).select(F.size("items").alias("n")).collect()]
        assert sum(sizes) == 64 and max(sizes) <= 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)


def test_only_hubs_are_copied_for_their_salts(spark):
    """The minima of nodes that are no hubs meet their edges in one copy: copies of all would be many times the nodes."""
    from recordforge.operators import components

    edges = [(10_000 + i, i % 4_000) for i in range(8_000)] + [(30_000 + i, 7) for i in range(3_000)]
    e = spark.createDataFrame(edges, "u long, v long")
    hubs = components._hubs(e)
    assert hubs["v"] == [7] and hubs["u"] == []
    for node, some in (("v", hubs["v"]), ("u", hubs["u"])):
        rows = e.select(node).distinct()
        assert components._per_salt(rows, node, some).count() == rows.count() + (components.EDGE_SALTS - 1) * len(some)
    salts = e.filter("v = 7").select(components._dealt("u", "v", hubs["v"])).distinct().count()
    assert salts == components.EDGE_SALTS
    got = {r.node: r.component for r in connected_components(e, "u", "v").collect()}
    assert got == _components(edges)


def test_dense_edges_are_contracted_as_they_are_read():
    import pyarrow as pa
    from recordforge.operators.components import _contract

    def run(edges):
        u, v = (pa.array(x, pa.int64()) for x in zip(*edges))
        return [tuple(r.values()) for b in _contract([pa.RecordBatch.from_arrays([u, v], names=["u", "v"])], dense=True) for r in b.to_pylist()]

    block = [(a, b) for a in range(1, 20) for b in range(a)]
    assert run(block) == [(a, 0) for a in range(1, 20)]
    chain = [(i + 1, i) for i in range(50)]
    assert run(chain) == chain


def test_small_cohorts_make_one_packet_and_large_ones_full_packets(spark):
    """Few keys of a cohort are not cut into many packets: the pairs of packets grow with the square of full packets only."""
    from recordforge.operators.simjoin import _packets

    key = F.md5(F.col("id").cast("string"))
    keys = spark.range(3_000).select(F.when(F.col("id") < 1_000, "a").otherwise("b").alias("cohort"), key.alias("key"), F.col("id").alias("node"), F.lit(32).alias("len"))
    fresh = keys.withColumn("fresh", F.col("node") % 10 == 0)
    sizes = sorted((r.cohort, r.fresh, r.n) for r in _packets(fresh, 1_200).select("cohort", "fresh", F.size("items").alias("n")).collect())
    assert [(c, f) for c, f, _ in sizes] == [("a", False), ("a", True), ("b", False), ("b", False), ("b", True)]
    assert sum(n for *_, n in sizes) == 3_000 and max(n for *_, n in sizes) <= 1_200


def _packet_rows(keys, nodes, a, b, second):
    import pyarrow as pa
    from recordforge.operators.simjoin import signatures

    words = signatures(PairScorer(keys).hist)
    n = len(keys)
    columns = {"cohort": ["c"] * n, "a": [a] * n, "b": [b] * n, "second": [second] * n, "node": nodes, "key": keys, "len": pa.array(map(len, keys), pa.int32())}
    columns |= {f"sig{k}": words[:, k] for k in range(3)} | {"dist": pa.array([[0]] * n, pa.list_(pa.int16()))}
    return pa.RecordBatch.from_pydict(columns)


def test_packet_pairs_flow_key_by_key():
    """Batches that end anywhere: a task takes one packet pair at a time, a packet with itself or with another."""
    import pyarrow as pa
    from recordforge.operators.simjoin import _packet_pairs_of

    parts = [_packet_rows(["aa", "b"], [1, 2], 5, 5, False), _packet_rows(["aa", "b"], [1, 2], 5, 6, False), _packet_rows(["ccc", "d", "ee"], [3, 4, 5], 5, 6, True)]
    rows = pa.Table.from_batches(parts)
    for size in (1, 2, 3, 7):
        got = [(c, a.keys, b and b.keys, a.nodes.tolist()) for c, a, b in _packet_pairs_of(rows.combine_chunks().to_batches(max_chunksize=size))]
        assert got == [("c", ["b", "aa"], None, [2, 1]), ("c", ["b", "aa"], ["d", "ee", "ccc"], [2, 1])]
    assert list(_packet_pairs_of([])) == []


def test_near_pairs_lose_no_match_and_leave_few():
    """The 64 bits that tell most and then all bits: no match is lost, and of digits and letters nearly all other pairs go."""
    from recordforge.operators.simjoin import _Packet, _near_pairs

    rng = random.Random(21)
    keys = sorted({f"{rng.randint(1, 99_999)} chicago {''.join(rng.choice('abcdefghijklmnop') for _ in range(14))} road" for _ in range(600)})
    keys += [k.replace("road", "rd") for k in keys[:50]] + ["ü" * 3, "z" * 400, "z" * 390]
    packet = _Packet([_packet_rows(keys, list(range(len(keys))), 1, 1, False)])
    sc = PairScorer(packet.keys)
    ia, ib = np.triu_indices(len(keys), 1)
    hit = sc.matches(ia, ib, 85)
    near = {(int(i), int(j)) for run in _near_pairs(packet, packet, True, 85) for i, j in zip(*run)}
    assert hit.sum() >= 51 and near >= {(int(i), int(j)) for i, j in zip(ia[hit], ib[hit])}
    assert len(near) < 0.005 * len(ia)


def test_distances_of_empty_and_of_unknown_characters():
    sc = PairScorer(["", "abc", "xyz", "\U0010ffff", "abc" * 40])
    ia, ib = np.indices((5, 5)).reshape(2, -1)
    want = [len(sc.strings[i]) + len(sc.strings[j]) - 2 * _dp(sc.strings[i], sc.strings[j]) for i, j in zip(ia, ib)]
    assert sc.distances(ia, ib).tolist() == want
    assert (PairScorer(["p", "0"]).hist.argmax(axis=1) != PairScorer(["0", "p"]).hist.argmax(axis=1)).all()


def test_pairs_are_scored_alike_without_histograms():
    rng = random.Random(9)
    xs = _strings(rng, 80)
    sc = PairScorer(xs)
    ia, ib = np.triu_indices(len(xs), 1)
    got = sc.matches(ia, ib, 85, histograms=False)
    assert "hist" not in vars(sc)  # none were made
    assert got.any() and (got == sc.matches(ia, ib, 85)).all()


def test_keys_are_measured_a_bounded_number_at_a_time():
    import pyarrow as pa
    from recordforge.operators import simjoin

    rng = random.Random(4)
    n = 2 * simjoin._MEASURED + 300
    keys = [f"{k} " + "".join(rng.choice("abcdef") for _ in range(9)) for k in range(n)]
    pivots = [keys[k % 7 : k % 7 + k % 4] for k in range(n)]  # some have none
    columns = [pa.array(["c"] * n), pa.array(keys), pa.array(range(n), pa.int64()), pa.array(map(len, keys), pa.int32())]
    columns += [pa.array([True] * n), pa.array([1] * n, pa.int64()), pa.array([n] * n, pa.int64()), pa.array(pivots, pa.list_(pa.string()))]
    out = list(simjoin._measure([pa.RecordBatch.from_arrays(columns, names=[*simjoin._OWN, "pivots"])]))
    assert [b.num_rows for b in out] == [simjoin._MEASURED] * 2 + [300]
    got = pa.Table.from_batches(out)
    assert got.column("key").to_pylist() == keys
    want = [[len(k) + len(p) - 2 * _dp(k, p) for p in ps] for k, ps in zip(keys, pivots)]
    assert got.column("dist").to_pylist() == want


def test_few_keys_are_measured_by_many_tasks(spark):
    """Some thousand short keys are few bytes, which Spark would merge into one task."""
    from recordforge.operators.simjoin import with_pivot_distances

    keys = spark.range(4_000).select(F.when(F.col("id") >= 0, "hot").alias("cohort"), F.md5(F.col("id").cast("string")).alias("key"), F.col("id").alias("node"))
    keys = keys.groupBy("cohort", "key").agg(F.min("node").alias("node")).withColumns({"len": F.length("key"), "fresh": F.lit(True)})
    measured = with_pivot_distances(keys).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in measured.groupBy("task").count().collect()]
    assert len(sizes) > 3 and sum(sizes) == 4_000 and max(sizes) < 2_000


def test_rest_of_a_signature_decides():
    """Keys that differ by classes the first word cannot all hold: no pair too far apart is left, none near is lost."""
    from recordforge.operators.simjoin import _Packet, _near_pairs

    rng = random.Random(12)
    keys = sorted({"".join(rng.sample("abcdefghijklmnopqrstuvwxyz0123456789", 30)) for _ in range(120)} | {"abcdefghijklmnopqrstuvwxyz0123", "abcdefghijklmnopqrstuvwxyz012"})
    packet = _Packet([_packet_rows(keys, list(range(len(keys))), 1, 1, False)])
    sc = PairScorer(packet.keys)
    near = [(int(i), int(j)) for run in _near_pairs(packet, packet, True, 85) for i, j in zip(*run)]
    ia, ib = np.triu_indices(len(keys), 1)
    hit = sc.matches(ia, ib, 85)
    assert {(int(i), int(j)) for i, j in zip(ia[hit], ib[hit])} <= set(near) and len(near) == len(set(near))
    differ = [np.bitwise_count(packet.words[i] ^ packet.words[j]).sum() for i, j in near]
    assert all(15 * (sc.lens[i] + sc.lens[j]) >= 100 * d for (i, j), d in zip(near, differ))
