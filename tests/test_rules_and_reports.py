"""Automaton rules, exact quantiles and threshold top-k against their plain versions."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordforge import config
from recordforge.operators import automaton
from recordforge.operators.automaton import first_name, first_rule
from recordforge.operators.classify import keyword_expr
from recordforge.operators.impute import extract_expr
from recordforge.operators.quantiles import exact_quantiles
from recordforge.operators.report import frequent_values, top_values


def texts(words, n, seed):
    rng = random.Random(seed)
    mix = lambda w: rng.choice([w, w.upper(), w.title(), w[:-1], w + "x"])
    some = ["the", "İnn", "ſad", "Ünter", "ß", "", "of"]
    return [" ".join(mix(rng.choice(words)) if rng.random() < 0.4 else rng.choice(some) for _ in range(rng.randrange(6))) for _ in range(n)]


def test_first_rule_equals_the_case_chain(spark):
    rules = config.NAME_KEYWORDS_TO_CUISINE
    rows = [(t,) for t in texts([k for k, _ in rules], 400, 1)] + [(None,), ("",)]
    table = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(rules)], "keyword string, value string, priority int")
    got = spark.createDataFrame(rows, "t string").select(first_rule(F.col("t"), table).alias("a"), keyword_expr("t").alias("b")).collect()
    assert all(r.a == r.b for r in got) and sum(r.a is not None for r in got) > 100


def test_ten_thousand_rules(spark):
    rng = random.Random(2)
    keys = ["".join(rng.choices("abcdef", k=rng.randrange(4, 9))) for _ in range(10_000)]
    rules = [(k, f"v{i}", rng.randrange(3000)) for i, k in enumerate(keys)]
    docs = ["".join(rng.choices("abcdef ", k=300)) for _ in range(60)]
    table = spark.createDataFrame(rules + [(None, "never", 0)], "keyword string, value string, priority int")
    began = time.monotonic()
    got = spark.createDataFrame([(d,) for d in docs], "t string").select("t", first_rule(F.col("t"), table).alias("v")).collect()
    assert time.monotonic() - began < 60
    for r in got:
        hit = min(((p, k, v) for k, v, p in rules if k in r.t), default=(None, None, None))
        assert r.v == hit[2]


def test_rules_edge_cases(spark, monkeypatch):
    one = spark.createDataFrame([("x",), (None,)], "t string")
    empty = spark.createDataFrame([], "keyword string, value string, priority int")
    assert [r[0] for r in one.select(first_rule(F.col("t"), empty)).collect()] == [None, None]
    every = spark.createDataFrame([("", "any", 5), ("x", "x", 7)], "keyword string, value string, priority int")
    assert [r[0] for r in one.select(first_rule(F.col("t"), every)).collect()] == ["any", "any"]
    monkeypatch.setattr(automaton, "MAX_CHARS", 3)
    with pytest.raises(ValueError, match="more than 3"):
        first_rule(F.col("t"), every)


def test_first_name_equals_the_pattern(spark):
    names = [*config.KNOWN_CITIES, "St. Ives", "St. Ives Bay", "İnn"]
    rows = [(t,) for t in texts(names, 400, 3)] + [(None,), ("in st. ives bay",), ("SAN FRANCISCO",)]
    table = spark.createDataFrame([(n,) for n in [*names, "", None]], "name string")
    df = spark.createDataFrame(rows, "t string")
    got = df.select("t", first_name(F.col("t"), table).alias("a"), extract_expr(F.col("t"), names).alias("b")).collect()
    assert [r for r in got if r.a != r.b] == [] and sum(r.a is not None for r in got) > 100


@pytest.mark.parametrize("kind", ["distinct", "scales", "hot", "two", "inf"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(5)
    x = {
        "distinct": rng.random(20_000),
        "scales": np.exp(rng.normal(0, 200, 20_000)),
        "hot": np.where(rng.random(20_000) < 0.4, 3.25, rng.normal(3.25, 1e-9, 20_000)),
        "two": rng.integers(0, 2, 20_000).astype(float),
        "inf": np.where(rng.random(20_000) < 0.3, -np.inf, rng.random(20_000)),
    }[kind]
    probs = [0.0, 0.001, 0.25, 0.5, 0.8, 0.999, 1.0]
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    got = {r.prob: (r.n, r.value) for r in exact_quantiles(df, "x", probs, accuracy=50, few=20).collect()}
    ordered = np.sort(x)
    for p in probs:
        at = (len(x) - 1) * p
        low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        assert got[p] == (20_000, low if low == high else low + (high - low) * (at - np.floor(at)))


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 2)], "x double, k int")
    got = exact_quantiles(df, ["x", "k"], [0.5]).collect()
    assert [(r.column, r.n, r.value) for r in got] == [("x", 0, None), ("k", 2, 1.5)]


def test_frequent_values(spark):
    rng = random.Random(6)
    skewed = [(str(int(rng.paretovariate(0.6))),) for _ in range(20_000)] + [(None,)] * 500
    even = [(str(i % 700),) for i in range(7_000)]
    for rows in (skewed, even, [], [("a",), ("b",), (None,)]):
        df = spark.createDataFrame(rows, "v string")
        for buckets in (7, 1024):
            assert frequent_values(df, "v", 10, buckets).collect() == top_values(df, "v", 10).collect()
