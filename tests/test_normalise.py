"""Micro cases of FIXTURES.md §4 for O1-O6, I1, I2."""

from pyspark.sql import functions as F

from recordforge import config
from recordforge.operators import impute as I
from recordforge.operators import normalise as N


def one(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_casing(spark):
    cases = {
        "traif": "Traif",
        "PRIME STEAKHOUSE": "Prime Steakhouse",
        "SPQR": "SPQR",
        "Le Bernardin": "Le Bernardin",
        "joe's stone crab": "Joe'S Stone Crab",
        "A B C D E": "A B C D E",
        "ABCDEF": "Abcdef",
    }
    df = one(spark, [(k,) for k in cases], "name string")
    got = dict(zip(cases, [r[0] for r in N.name_case(df).collect()]))
    assert got == cases


def test_blank_vs_null_order(spark):
    df = one(spark, [("  ",), (" null ",), ("null",), (None,)], "name string")
    out = [r[0] for r in df.transform(N.null_sentinels).transform(lambda d: N.strip_columns(d, ["name"])).collect()]
    assert out == ["", "null", None, None]


def test_url(spark):
    df = one(spark, [("http://a.com//",), ("x.co/",), (" http://abc.de/x/ ",), (None,)], "website string")
    assert [r[0] for r in N.clean_url(df).collect()] == ["http://a.com", None, "http://abc.de/x", None]


def test_price_chain(spark):
    df = one(
        spark,
        [
            (None, "diner", None),
            (None, "x", "http://www.Maria-Bar.com"),
            (None, "restaurant", "http://plain.com"),
            ("", "diner", None),
            ("medium", "diner", None),
        ],
        "price_point string, primary_type string, website string",
    )
    assert [r[0] for r in I.impute_price(df).collect()] == ["low", "high", None, "", "medium"]


def test_city_extract(spark):
    df = one(
        spark,
        [
            (None, "5 Main St, CHICAGO"),
            (None, "1 Bay St, San Francisco Bay Area"),
            (None, "9 Lincoln Road, Miami Beach"),
            ("Boston", "5 Main St, Chicago"),
            (None, "nowhere"),
        ],
        "city string, display_address string",
    )
    assert [r[0] for r in I.impute_city(df).collect()] == [
        "CHICAGO", "San Francisco Bay Area", "Lincoln", "Boston", None
    ]


def test_null_sentinels_exact(spark):
    vals = config.NULL_STRINGS + [" n/a ", "nan", "NA"]
    df = one(spark, [(v,) for v in vals], "c string")
    out = [r[0] for r in N.null_sentinels(df).collect()]
    assert out == [None] * len(config.NULL_STRINGS) + [" n/a ", "nan", "NA"]


def test_completeness_counts_blank(spark):
    df = one(spark, [("", None, 1.0)], "a string, b string, c double")
    assert N.with_completeness(df).collect()[0].completeness == 2
