"""Scoring over its whole input domain and bin boundaries."""

import itertools

import numpy as np

from recordforge import config
from recordforge.operators.score import add_scores, label_expr
from pyspark.sql import functions as F


def test_label_bins_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 2.0, 2.1, 4.0, 6.0, 8.0, 8.1, 10.0)], "s double")
    got = [r[0] for r in df.select(label_expr(F.col("s"))).collect()]
    assert got == ["Not Romantic", "Not Romantic", "Casual", "Casual", "Somewhat Romantic",
                   "Romantic", "Highly Romantic", "Highly Romantic"]


def test_score_domain_exact(spark):
    prices = [None, "budget", "low", "medium", "high", "luxury"]
    addrs = [None, "1 park avenue", "2 main st"]
    types = [None, "french_restaurant", "diner"]
    names = [None, "chez x", "the rose", "plain"]
    cats = list(config.CUISINE_ROMANCE_SCORE) + ["Unknown"]
    webs = [None, "  ", "http://x.com"]
    rows = list(itertools.product(prices, addrs, types, names, cats, webs))
    df = spark.createDataFrame(
        rows, "price_point string, display_address string, primary_type string, name string, "
        "cuisine_category string, website string"
    )
    got = [r.romantic_score for r in add_scores(df).collect()]
    w = config.ROMANTIC_SCORE_WEIGHTS
    exp = []
    for p, a, t, n, c, web in rows:
        sp = (config.PRICE_POINT_NUMERIC[p] - 1.0) / 3.0 if p in config.PRICE_POINT_NUMERIC else 0.5
        sa = 1.0 if a and "park avenue" in a else 0.0
        st = 1.0 if t in config.FANCY_PRIMARY_TYPES else 0.0
        sn = 1.0 if n and "chez" in n else (0.5 if n and "rose" in n else 0.0)
        sc = config.CUISINE_ROMANCE_SCORE.get(c, 0.3)
        sw = 1.0 if web and web.strip() else 0.0
        raw = w["price_point"] * sp + w["address"] * sa + w["fancy_type"] * st + w["name_keyword"] * sn \
            + w["cuisine"] * sc + w["has_website"] * sw
        exp.append(float(np.round(raw * 10.0, 1)))
    assert got == exp
