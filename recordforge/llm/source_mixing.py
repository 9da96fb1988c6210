"""Mixing sources to target weights by Pareto order sampling (operator 8, native).

Every source has a target in words. A document's expected copies are its
source's target over the source's size (times a relative document weight, if
one is given), at most ``max_copies``. The whole part is allocated for certain;
the fraction is the inclusion probability ``p`` of one more copy. Documents are
ranked by ``(u / (1 - u)) / (p / (1 - p))`` with ``u`` a hash of id and text (Rosén's
Pareto order sampling), and the ranking is taken until the source's remaining
words are used up, the document at the edge only if that comes nearer.

Scale: documents are counted into buckets of the rank key first (partial
sums); only the one bucket per source in which the words run out is ranked row
by row. Its expected size is bounded, since near the edge the rank key has a
density of at most one. Joins with per-source figures are salted, so a hot
source spreads over tasks. Only DataFrame functions are used.

Null or empty text has size 0; a null source is a source of its own, last in
order. Documents of size 0 are never taken. Different texts that share an id, or
have none, draw numbers of their own; rows equal in id and text share one and are
interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, salt_of, salted

WORD = r"[^\x20\x09-\x0D]+"
#: Expected documents in the bucket that is ranked row by row.
BUCKET_ROWS = 2048
MAX_COPIES = 3
SEED = "mix-1"


def uniform(doc_id, text, seed: str = SEED):
    """A number in (0, 1) from the first 52 bits of md5(seed:id:md5(text)); a null text counts as empty."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    digits = F.substring(F.md5(key), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES, period: int = 3) -> DataFrame:
    """(source, source_size, n, target) from rows (source, size).

    Weights 1..period repeat over the sources in code point order, null last;
    targets share the sum of all sizes by weight, stop at ``max_copies`` times
    the source's size, and the excess is reshared by weight (water filling:
    target = min(cap, level * weight), the level found from prefix sums over
    the sources ordered by cap / weight). One row per source goes through the
    windows here, never one per document.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("w", ((F.row_number().over(order) - 1) % period + 1).cast("bigint"))
    per = per.withColumn("cap", F.lit(max_copies).cast("bigint") * F.col("source_size"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("total", F.sum("source_size").over(every))
    per = per.withColumn("left_words", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
    per = per.withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))
    # a source is capped while the level over the sources not yet capped would pass its cap
    per = per.withColumn("level", F.col("left_words") / F.col("left_w"))
    per = per.withColumn("capped", F.col("cap") <= F.col("level") * F.col("w"))
    per = per.withColumn("level", F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("w"), "level"))).over(every))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("level")["level"] * F.col("w"))
    return per.select("source", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weight: str | None = None,
    max_copies: int = MAX_COPIES,
    bucket_rows: int = BUCKET_ROWS,
    seed: str = SEED,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken, *ties), one row per
    input row. ``weight`` names an optional positive column of relative
    inclusion weights (null counts as 1). ``ties`` names columns that order rows
    equal in id and size, so that which of them is taken is determined."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        (F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)).alias("g"),
        uniform(F.col(doc_id), F.col(text), seed).alias("u"),
        *ties,
    )
    rows = materialise(rows)  # small rows; the texts are scanned once
    stats = source_targets(rows, max_copies)
    if weight:
        mass = rows.groupBy("source").agg(F.sum(F.col("g") * F.col("size")).alias("mass"))
        stats = stats.join(mass, stats["source"].eqNullSafe(mass["source"]), "left").drop(mass["source"])
        rate = F.col("target") / F.col("mass")
    else:
        rate = F.col("target") / F.col("source_size")
    stats = stats.select(
        F.col("source").alias("_s"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, rate).otherwise(0.0).alias("rate"),
        F.ceil(F.col("n") / bucket_rows).cast("bigint").alias("n_buckets"),
    )
    stats = materialise(stats)
    by_id = salt_of("doc_id", "u", *ties)

    def with_source(df: DataFrame, side: DataFrame) -> DataFrame:
        on = df["source"].eqNullSafe(side["_s"]) & (df["_salt"] == side["_salt"])
        return df.join(side, on, "left").drop("_s").drop(side["_salt"])

    rows = with_source(rows.withColumn("_salt", by_id), salted(stats))
    copies = F.least(F.lit(float(max_copies)), F.col("rate") * F.col("g"))
    p = F.col("p")
    rows = (
        rows.withColumn("expected", F.when(F.col("size") > 0, copies).otherwise(0.0))
        .withColumn("certain", F.floor("expected").cast("bigint"))
        .withColumn("p", F.col("expected") - F.col("certain"))
        .withColumn("open", (p > 0) & (F.col("size") > 0) & (F.col("certain") < max_copies))
        .withColumn("q", F.when(F.col("open"), (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))))
        .withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * F.col("n_buckets")).cast("bigint"))
    )
    sums = rows.groupBy("source", "bucket").agg(
        F.sum(F.when(F.col("open"), F.col("size")).otherwise(0)).alias("words"),
        F.sum(F.col("certain") * F.col("size")).alias("sure"),
        F.max("target").alias("target"),
    )
    upto = Window.partitionBy("source").orderBy(F.col("bucket").asc_nulls_first())
    sums = sums.withColumn("upto", F.sum("words").over(upto.rowsBetween(Window.unboundedPreceding, 0)))
    sums = sums.withColumn("need", F.col("target") - F.sum("sure").over(Window.partitionBy("source")))
    edge = sums.groupBy(F.col("source").alias("_s")).agg(
        F.max("need").alias("need"),
        F.min(F.when(F.col("bucket").isNotNull() & (F.col("upto") > F.col("need")), F.struct("bucket", F.col("upto") - F.col("words")))).alias("e"),
    )
    edge = edge.select("_s", "need", F.col("e")["bucket"].alias("edge_bucket"), F.col("e")["col2"].alias("before"))
    rows = with_source(rows, salted(edge))
    at_edge = F.col("open") & F.col("bucket").eqNullSafe(F.col("edge_bucket"))
    whole = rows.filter(~at_edge).withColumn(
        "extra", (F.col("open") & (F.col("edge_bucket").isNull() | (F.col("bucket") < F.col("edge_bucket")))).cast("bigint")
    )
    ranked = Window.partitionBy("source").orderBy("q", "size", "doc_id", *ties).rowsBetween(Window.unboundedPreceding, 0)
    part = rows.filter(at_edge).withColumn("cum", F.col("before") + F.sum("size").over(ranked))
    part = part.withColumn("extra", (2 * F.col("cum") - F.col("size") <= 2 * F.col("need")).cast("bigint")).drop("cum")
    out = whole.unionByName(part).withColumn("copies", F.col("certain") + F.col("extra"))
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *ties
    )


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5(coalesce(text, '')) AS text_md5 FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w
  FROM d GROUP BY source
), lv AS (
  SELECT *, {MAX_COPIES} * source_size AS cap,
         CAST(sum(source_size) OVER () - coalesce(sum({MAX_COPIES} * source_size) OVER o, 0) AS BIGINT) AS left_words,
         CAST(sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS BIGINT) AS left_w
  FROM per
  WINDOW o AS (ORDER BY CAST({MAX_COPIES} * source_size AS DOUBLE) / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, CAST(left_words AS DOUBLE) / left_w AS level, cap <= CAST(left_words AS DOUBLE) / left_w * w AS is_capped FROM lv
), first_open AS (
  SELECT level FROM capped WHERE NOT is_capped ORDER BY CAST(cap AS DOUBLE) / w, level LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN CAST(cap AS DOUBLE) ELSE (SELECT level FROM first_open) * w END AS target
  FROM capped
), odds AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         CASE WHEN d.size > 0 AND t.source_size > 0 THEN least({MAX_COPIES}.0::DOUBLE, t.target / t.source_size) ELSE 0.0::DOUBLE END AS expected,
         (CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || d.text_md5), 1, 13))::BIGINT AS DOUBLE) + 0.5) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), keyed AS (
  SELECT *, CAST(floor(expected) AS BIGINT) AS certain, expected - floor(expected) AS p FROM odds
), ranked AS (
  SELECT *, p > 0 AND size > 0 AND certain < {MAX_COPIES} AS open,
         CASE WHEN p > 0 AND size > 0 AND certain < {MAX_COPIES} THEN (u / (1 - u)) / (p / (1 - p)) END AS q,
         target - sum(certain * size) OVER (PARTITION BY source) AS need
  FROM keyed
), cum AS (
  SELECT *, sum(CASE WHEN open THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY q ASC NULLS LAST, size, doc_id ROWS UNBOUNDED PRECEDING) AS c FROM ranked
)
SELECT doc_id, size, source_size, target,
       CAST((certain + CASE WHEN open AND 2 * c - size <= 2 * need THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM cum
"""
