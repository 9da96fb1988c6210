"""Fuzzy dedup semantics on micro tables (FIXTURES.md §4) and plan shape."""

from recordforge import config
from recordforge.operators.dedup import dedup_fuzzy
from recordforge.plans.catalog import clean

COLS = config.REQUIRED_COLUMNS
SCHEMA = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in COLS)


def row(i, name, city, addr):
    return (str(i), name, city, addr, None, None, None, None, None, None)


def run(spark, rows):
    out = dedup_fuzzy(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(r.id for r in out)


def test_transitive_cluster(spark):
    # A~B (93) and B~C (90) reach 85, A~C (83) does not: still one cluster
    rows = [
        row(1, "A", "Chicago", "100 alpha beta street, chicago"),
        row(2, "B", "Chicago", "100 alpha betx strext, chicago"),
        row(3, "C", "Chicago", "100 alphx bxtx strxxt, chicago"),
    ]
    assert run(spark, rows) == ["1"]


def test_name_city_fall_through(spark):
    # addresses score 24, name+city 98 >= 90
    rows = [
        row(1, "Chez Marcel Abcdefgh", "Chicago", "1 quince court"),
        row(2, "Chez Marcell Abcdefgh", "Chicago", "99 mulberry lane zz"),
    ]
    assert run(spark, rows) == ["1"]


def test_cohorts_never_mix(spark):
    rows = [
        row(1, "Same Name", "Chicago", "1 same street"),
        row(2, "Same Name", "Boston", "1 same street"),
        row(3, "Same Name", None, "1 same street"),
    ]
    assert run(spark, rows) == ["1", "2", "3"]


def test_nameless_rows_of_a_city_match(spark):
    # no name: the name+city key is the city alone, equal keys score 100
    # (row 2 has more non-null cells, so it survives and keeps its id)
    rows = [row(1, None, "Chicago", None), row(2, None, "Chicago", "x"), row(3, None, None, None)]
    assert run(spark, rows) == ["2", "3"]


def test_no_cartesian_or_nested_loop_joins(spark, sf_small):
    plan = clean(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
