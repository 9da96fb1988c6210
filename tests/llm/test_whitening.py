from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordforge.llm import whitening as wh


def plain(vectors):
    """Distinct x vectors, n, S and the covariance by definition, centred before multiplying."""
    x = [tuple(floor(64 * c) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, d = len(fit), len(fit[0])
    s = [sum(v[i] for v in fit) for i in range(d)]
    mean = [Fraction(t, n) for t in s]
    cov = [[sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in fit) / n for j in range(d)] for i in range(d)]
    return x, n, s, cov


def test_equals_the_definition(spark):
    rng = np.random.default_rng(1)
    base = (rng.standard_normal((60, 5)) @ rng.standard_normal((5, 5))).tolist()
    good = [*base, base[0], base[0], base[7]]  # copies count once
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(k, v) for k, v in enumerate(good)] + [(1000 + k, v) for k, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).repartition(4)
    out = wh.whiten(df, components=3).toPandas()
    x, n, s, cov = plain(good)
    assert sorted(out.vec_id.unique()) == list(range(len(good))) and set(out.n) == {n}
    v = np.array([[float(c) for c in r] for r in cov])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(sum(cov[i][i] for i in range(5)))
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    centred = np.array([[float(Fraction(a) - Fraction(t, n)) for a, t in zip(r, s)] for r in x])
    for k in range(3):
        want = centred @ vectors[:, k] / np.sqrt(values[k])
        sign = np.sign(want @ wide[:, k])
        assert np.allclose(wide[:, k] * sign, want, atol=1e-9)
    for (vec, k), r in out.set_index(["vec_id", "component"]).iterrows():
        assert r.deviation == sum((n * a - t) ** 2 for a, t in zip(x[vec], s))
        assert abs(r.explained - values[k - 1] / trace) < 1e-12
    assert out.identity_error.nunique() == 1 and out.identity_error[0] < 1e-9


def test_squares_are_exact_beyond_64_bits():
    rng = np.random.default_rng(2)
    for bits, kind in ((15, np.int64), (40, np.int64), (60, np.int64), (75, object)):
        y = np.array([[int(v) * 2 ** max(0, bits - 50) for v in row] for row in rng.integers(-(2 ** min(bits, 50)), 2 ** min(bits, 50), (40, 4))], dtype=object).astype(kind)
        got = [sum(int(p) << (wh.BITS * k) for k, p in enumerate(col)) for col in wh.squares(y).T.tolist()]
        rows = [[int(v) for v in r] for r in y.tolist()]
        want = [sum((r[i] + (r[j] if j != i else 0)) ** 2 for r in rows) for i, j in zip(*(t.tolist() for t in wh.pairs_of(4)))]
        assert got == want


def test_large_entries_do_not_lose_digits(spark):
    rows = [(k, [2.0**35 + k, -(2.0**35), k * 0.5]) for k in range(20)] + [(99, [2.0**36, 0.0, 0.0])]
    out = wh.whiten(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).toPandas()
    assert 99 not in set(out.vec_id) and set(out.component) == {1}  # the two varying dimensions are one line
    x, n, s, _ = plain([v for _, v in rows[:-1]])
    want = {k: sum((n * a - t) ** 2 for a, t in zip(x[k], s)) for k in range(20)}
    assert dict(zip(out.vec_id, out.deviation)) == want


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert wh.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect() == []


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(None, [float(k), float(k * k)]) for k in range(6)] + [(5, [1.0, 9.0]), (5, [1.0, 9.0])]
    out = wh.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    assert out.count() == 2 * len(rows) and out.filter("vec_id is null").count() == 12


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    out = wh.whiten(df).toPandas()
    vectors = [r[0] for r in df.select("embedding").collect()]
    assert all(isfinite(c) for v in vectors for c in v) and len(out) == 16 * len(vectors)
    assert out.identity_error[0] < 1e-4 and out.groupby("vec_id").deviation.nunique().max() == 1
