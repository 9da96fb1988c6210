"""Merge rules against hand-worked rows, and the midpoint against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from recordforge.operators.merge import merge_groups

COLS = ["id", "name", "city", "display_address", "google_place_id", "latitude", "longitude",
        "price_point", "primary_type", "website"]


SCHEMA = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in COLS)


def merged(spark, column, values, **other):
    """The value of ``column`` after merging rows 0, 1, ... that are equally complete, in this order."""
    rows = []
    for i, v in enumerate(values):
        row = dict.fromkeys(COLS) | {"id": str(i), "google_place_id": "g"} | other | {column: v}
        # one more filled cell makes up for a null, so completeness does not reorder the rows
        row["price_point" if column != "price_point" else "city"] = "x" if v is None else None
        rows.append(tuple(row[c] for c in COLS))
    return merge_groups(spark.createDataFrame(rows, SCHEMA), ["google_place_id"], columns=COLS).collect()[0][column]


@pytest.mark.parametrize(
    ("column", "values", "expected"),
    [
        ("city", ["LA", "Los Angeles"], "LA"),  # first
        ("city", [None, "", "  ", "LA"], "LA"),  # first that is not blank
        ("city", ["", "  "], ""),  # all blank: the first row's
        ("city", [None, None], None),
        ("display_address", ["1 A St", "1 A Street", "2 B Street"], "1 A Street"),  # longest, ties to the earlier
        ("display_address", ["", None, "22 B"], "22 B"),
        ("website", ["http://m.com/x", "http://m.com", "http://n.com"], "http://m.com"),  # shortest, ties to the earlier
        ("website", ["", "http://m.com"], "http://m.com"),
        ("primary_type", ["restaurant", "bar", "cafe"], "bar"),  # first that is not generic
        ("primary_type", ["restaurant", None, "restaurant"], "restaurant"),
        ("primary_type", ["restaurant", "Restaurant "], "Restaurant "),  # generic only: the last present one
        ("name", ["merois", "MEROIS", "Merois", "MeRoIs"], "Merois"),  # first in mixed case
        ("name", [None, "MEROIS", "merois"], "MEROIS"),
        ("latitude", [34.0, 34.5, 35.0], 34.625),  # ((34 + 34.5) / 2 + 35) / 2
        ("latitude", [None, 34.0, None, 35.0], 34.5),
        ("latitude", [None, None], None),
    ],
)
def test_rule(spark, column, values, expected):
    assert merged(spark, column, values) == expected


def test_merois_three(spark):
    rows = [
        ("1", "merois", "LA", "8358 Sunset Blvd", "p", 34.0, -118.0, None, "restaurant", "http://m.com/?utm=1"),
        ("2", "Merois", "LA", "8358 Sunset Blvd, West Hollywood", "p", 34.2, -118.2, "high", None, "http://m.com"),
        ("3", "MEROIS", None, "8358 Sunset", "p", 34.4, None, None, "bar", None),
    ]
    schema = ", ".join(f"{c} {'double' if c in ('latitude', 'longitude') else 'string'}" for c in COLS)
    r = merge_groups(spark.createDataFrame(rows, schema), ["google_place_id"], columns=COLS).collect()[0]
    assert r.name == "Merois"
    assert r.display_address == "8358 Sunset Blvd, West Hollywood"
    assert r.website == "http://m.com"
    assert r.primary_type == "bar"
    # survivor order: ids 1, 2 (9 cells) then 3 (7 cells): ((34.0 + 34.2) / 2 + 34.4) / 2
    assert r.latitude == ((34.0 + 34.2) / 2 + 34.4) / 2
    assert r.longitude == (-118.0 + -118.2) / 2


def loop(values):
    acc = None
    for v in values:
        acc = v if acc is None else (acc + v) / 2.0
    return acc


def midpoint(spark, values, partitions):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that runs are many
    try:
        df = spark.createDataFrame([(f"{i:06d}", "g", float(v)) for i, v in enumerate(values)], "id string, g string, latitude double")
        out = merge_groups(df.repartition(partitions), ["g"], columns=["id", "g", "latitude"])
        return out.collect()[0].latitude
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_midpoint_weighs_every_value(spark):
    rng = random.Random(3)
    values = [34.0 + rng.random() for _ in range(1000)]
    assert midpoint(spark, values, 5) == pytest.approx(loop(values), rel=1e-12)
    first_huge = [1e300] + [1.0] * 69
    assert midpoint(spark, first_huge, 3) == pytest.approx(loop(first_huge), rel=1e-9)
    assert midpoint(spark, [float("inf")] + [1.0] * 1999, 3) == float("inf")
    assert midpoint(spark, [1.0] * 3000, 3) == 1.0


def test_hot_group_is_spread_over_tasks(spark):
    """The runs of one group come out of more than one partition."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = df.repartitionByRange("g", "id").withColumn("p", F.spark_partition_id())
        assert dealt.select("p").distinct().count() > 1
        plan = merge_groups(df.withColumn("latitude", F.rand()), ["g"], columns=["id", "g", "latitude"])._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_midpoint_of_one_long_group(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("g").alias("g"), F.col("id"), (F.pmod(F.col("id") * 7919, F.lit(10_007)) / 3).alias("x"))
    got = merge_groups(df, ["g"], columns=["id", "x"], order_by=("id",), rules={"x": "midpoint"}).head()
    acc = 0.0
    for i in range(n):
        v = i * 7919 % 10_007 / 3
        acc = v if i == 0 else (acc + v) / 2
    assert got.id == 0 and abs(got.x - acc) < 1e-9 * acc


def test_first_row_of_a_group_is_one_aggregate(spark):
    """The value that a rule falls back on comes from the group's first row, found once for all columns."""
    rows = spark.createDataFrame(
        [("1", 7, None, " ", "A", None), ("2", 7, "x", None, "B", None), ("3", 8, " ", None, None, "")],
        "id string, g int, a string, b string, c string, d string",
    )
    out = merge_groups(rows, ["g"], columns=["id", "a", "b", "c", "d"], rules={"b": "longest", "d": "shortest"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min_by(") == 5 + 1
    got = {r.g: (r.id, r.a, r.b, r.c, r.d) for r in out.collect()}
    assert got == {7: ("1", "x", " ", "A", None), 8: ("3", " ", None, None, "")}
