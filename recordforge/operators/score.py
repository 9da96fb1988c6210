"""Weighted, auditable scoring.

Six signals in [0, 1], a weighted sum scaled to 0-10 and right-closed bins.
Rounding follows numpy (``rint(x * 10**d) / 10**d``, half to even), which is
what the reference's ``Series.round`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions.text import contains_any_sql, lookup_sql, py_strip, sql_lit, sql_ref


def np_round(x: Column, decimals: int) -> Column:
    scale = float(10**decimals)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def presence_signal(c: Column) -> Column:
    """1.0 for a non-null, non-blank value."""
    return F.coalesce(F.length(py_strip(c)) > 0, F.lit(False)).cast("double")


SIGNALS = [
    ("price_point", "score_price"),
    ("address", "score_address"),
    ("fancy_type", "score_fancy_type"),
    ("name_keyword", "score_name"),
    ("cuisine", "score_cuisine"),
    ("has_website", "score_website"),
]


#: The rule tables of R1-R5; a caller may replace any of them.
SIGNAL_RULES = {
    "price_numeric": config.PRICE_POINT_NUMERIC,
    "price_default": config.PRICE_POINT_DEFAULT,
    "address_tokens": config.HIGH_TICKET_ADDRESS_TOKENS,
    "fancy_types": config.FANCY_PRIMARY_TYPES,
    "name_high": config.ROMANTIC_NAME_KEYWORDS_HIGH,
    "name_medium": config.ROMANTIC_NAME_KEYWORDS_MEDIUM,
    "affinity": config.CUISINE_ROMANCE_SCORE,
    "affinity_default": config.DEFAULT_CUISINE_AFFINITY,
}


def signal_columns(
    price: str = "price_point",
    address: str = "display_address",
    ptype: str = "primary_type",
    name: str = "name",
    category: str = "cuisine_category",
    website: str = "website",
    rules: dict | None = None,
) -> dict[str, Column]:
    """R1-R6 over column names: ordinal min-max, any token, set membership, best
    keyword tier, category affinity, presence. ``rules`` replaces entries of
    ``SIGNAL_RULES``. The tables are written as SQL text (one driver call per signal)."""
    unknown = set(rules or {}) - set(SIGNAL_RULES)
    if unknown:
        raise ValueError(f"unknown signal rules: {sorted(unknown)}")
    rule = SIGNAL_RULES | (rules or {})
    one, half, zero = sql_lit(1.0), sql_lit(0.5), sql_lit(0.0)
    default = (rule["price_default"] - 1.0) / 3.0
    price_num = lookup_sql(sql_ref(price), {k: float(v) for k, v in rule["price_numeric"].items()})
    lname = f"coalesce(lower({sql_ref(name)}), '')"
    fancy = ", ".join(sql_lit(t) for t in rule["fancy_types"])
    affinity = lookup_sql(sql_ref(category), {k: float(v) for k, v in rule["affinity"].items()})
    return {
        "price_point": F.expr(
            f"least(greatest(coalesce(({price_num} - {one}) / {sql_lit(3.0)}, {sql_lit(default)}), {zero}), {one})"
        ),
        "address": F.expr(
            f"CAST({contains_any_sql(f'lower({sql_ref(address)})', rule['address_tokens'])} AS DOUBLE)"
        ),
        "fancy_type": F.expr(f"CAST(coalesce(lower({sql_ref(ptype)}) IN ({fancy}), false) AS DOUBLE)"),
        "name_keyword": F.expr(
            f"CASE WHEN {contains_any_sql(lname, rule['name_high'])} THEN {one} "
            f"WHEN {contains_any_sql(lname, rule['name_medium'])} THEN {half} ELSE {zero} END"
        ),
        "cuisine": F.expr(f"coalesce({affinity}, {sql_lit(float(rule['affinity_default']))})"),
        "has_website": presence_signal(F.col(website)),
    }


def label_expr(score: Column, edges=None, labels=None) -> Column:
    """Right-closed bins (-inf, e1], (e1, e2], ..., (ek, inf)."""
    edges = config.SCORE_BIN_EDGES if edges is None else edges
    labels = config.SCORE_LABELS if labels is None else labels
    expr = F.when(score.isNull(), F.lit("nan"))
    for edge, label in zip(edges, labels):
        expr = expr.when(score <= F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[len(edges)]))


def add_scores(df: DataFrame, weights: dict | None = None, **columns) -> DataFrame:
    """Signal columns (3 decimals), weighted score (1 decimal), label.

    The sum runs left to right in the signal order so that the double result
    is the same as the reference's.
    """
    weights = config.ROMANTIC_SCORE_WEIGHTS if weights is None else weights
    sig = signal_columns(**columns)
    tmp = {f"__sig_{key}": sig[key] for key, _ in SIGNALS}
    raw = None
    for key, _ in SIGNALS:
        term = F.lit(float(weights[key])) * F.col(f"__sig_{key}")
        raw = term if raw is None else raw + term
    return (
        df.withColumns(tmp)
        .withColumns({name: np_round(F.col(f"__sig_{key}"), 3) for key, name in SIGNALS})
        .withColumn("romantic_score", np_round(raw * F.lit(10.0), 1))
        .withColumn("romantic_label", label_expr(F.col("romantic_score")))
        .drop(*tmp.keys())
    )
