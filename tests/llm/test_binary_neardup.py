import numpy as np
import pytest

from recordforge.llm import binary_neardup as B


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


def brute(rows, threshold=0.95):
    good = [(k, np.asarray(v, dtype=np.float32).astype(float)) for k, v, _ in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    link = {k: set() for k, _ in good}
    for i, (a, x) in enumerate(good):
        for b, y in good[i + 1 :]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                link[a].add(b)
                link[b].add(a)
    label = {k: k for k in link}
    for _ in link:
        for k in link:
            label[k] = min([label[k], *(label[o] for o in link[k])])
    out = {k: (0, k, True) for k, _, _ in rows}
    out.update({k: (len(link[k]), label[k], label[k] == k) for k in link})
    return out


def vectors(rng, dim=32):
    rows = []
    for _ in range(25):
        base = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 6)):
            rows.append((len(rows), (base + rng.standard_normal(dim) * rng.choice([0.05, 0.2, 0.3])).tolist(), 0))
    hot = rng.standard_normal(dim)
    rows += [(1000 + i, (hot + 0.03 * rng.standard_normal(dim)).tolist(), 1) for i in range(60)]
    rows += [(2000 + i, [float(x) for x in range(dim)], 2) for i in range(40)]  # exact copies
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.0] * dim, 1), (3003, [nan] + [1.0] * (dim - 1), 1)]
    rows += [(3004, [inf] + [1.0] * (dim - 1), 1), (3005, [None] + [1.0] * (dim - 1), 1), (3006, [1.0, 2.0], 1), (3007, [2.0, 4.0], 1)]
    rows += [(3008, [1e-30] * dim, 1), (3009, [1e30] * dim, 1)]
    return rows


@pytest.mark.parametrize("block", [4096, 32])
def test_equals_brute_force(spark, block):
    rows = vectors(np.random.default_rng(2))
    df = frame(spark, rows).repartition(4).selectExpr("*", "1 AS node", "2 AS copies")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in B.near_duplicates(df, block=block).collect()}
    want = brute(rows)
    for k in (3008, 3009):  # scaled by powers that single precision holds: one direction
        assert got[k][0] >= 1
    assert got == want


def test_estimates_are_unbiased_and_within_bounds():
    rng = np.random.default_rng(3)
    dim, bits = 48, B.CODE_BITS
    x, y = (rng.standard_normal((4000, dim)) for _ in range(2))
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    y = 0.9 * x + 0.5 * y
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    turn = B.rotation(bits)
    code, own = B.encode(y, turn)
    signs = np.unpackbits(code, axis=1)[:, :bits] * 2.0 - 1
    estimate = ((x @ turn[:dim]) * signs).sum(axis=1) / np.sqrt(bits) / own
    true = (x * y).sum(axis=1)
    assert abs((estimate - true).mean()) < 0.005
    slack = B.EPSILON * np.sqrt(1 - own**2) / own / np.sqrt(bits - 1)
    assert (np.abs(estimate - true) <= slack).all()


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (2, [2.0, -1.0], 0)]
    got = sorted((tuple(r) for r in B.near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True), (2, 0, 2, True)], key=repr)
    assert B.near_duplicates(frame(spark, [])).collect() == []
