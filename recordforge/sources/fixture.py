"""Venue table derived from the driver's ``customer`` table.

The reference reads one venues CSV that is not shipped with it. This recipe
derives raw venue records (three per venue, with planted sentinels, casing,
blanks, abbreviations and shifted coordinates) from ``customer`` so that the
work grows with the input. The same SQL text runs in Spark SQL and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VENUES_SQL = """
WITH b AS (
  SELECT c_custkey AS k, CAST(floor(c_custkey / 3e0) AS BIGINT) AS v, c_custkey % 3 AS r,
    translate(md5(CAST(CAST(floor(c_custkey / 3e0) AS BIGINT) AS STRING)), '0123456789', 'ghijklmnop') AS h
  FROM {customer}
), s AS (
  SELECT k, v, r,
    CASE v % 11 WHEN 0 THEN 'Chez Marcel' WHEN 1 THEN 'Le Petit Jardin' WHEN 2 THEN 'Prime Steakhouse'
      WHEN 3 THEN 'Nola Cantina' WHEN 4 THEN 'Joe''s Stone Crab' WHEN 5 THEN 'L''Artusi' WHEN 6 THEN 'Sushi Bar Kashiba'
      WHEN 7 THEN 'Wine Bar & Grill' WHEN 8 THEN 'The Secret Garden' WHEN 9 THEN 'Pasta Moon' ELSE 'Flora Room' END
      || ' ' || upper(substr(h, 1, 1)) || substr(h, 2, 11) AS stem,
    substr(h, 13, 14) AS lane,
    CASE v % 7 WHEN 0 THEN 'New York City' WHEN 1 THEN 'San Francisco Bay Area' WHEN 2 THEN 'Las Vegas'
      WHEN 3 THEN 'Chicago' WHEN 4 THEN 'Washington, DC' WHEN 5 THEN 'San Francisco' ELSE 'St. Louis' END AS town,
    CASE v % 6 WHEN 0 THEN 'Park Avenue' WHEN 1 THEN 'Mulberry Street' WHEN 2 THEN 'Rodeo Drive'
      WHEN 3 THEN 'Lincoln Road' WHEN 4 THEN 'Maria Street' ELSE 'Quince Court' END AS street
  FROM b
)
SELECT CAST(k AS STRING) AS id,
  CASE WHEN k % 61 = 0 THEN 'null' WHEN k % 67 = 0 THEN 'SPQR' WHEN k % 13 = 5 THEN stem || 'e' WHEN r = 1 THEN lower(stem) WHEN r = 2 AND v % 2 = 0 THEN '  ' || upper(stem)
    ELSE stem || CASE WHEN k % 5 = 0 THEN ' ' ELSE '' END END AS name,
  CASE WHEN k % 17 = 0 THEN 'n/a' WHEN k % 19 = 0 THEN '' ELSE town END AS city,
  CASE WHEN k % 23 = 0 THEN 'NULL'
    ELSE CAST(v * 7 + 11 AS STRING) || ' ' || lane || ' ' || CASE WHEN r = 2 THEN replace(replace(street, 'Street', 'St'), 'Avenue', 'Ave') ELSE street END
      || ', ' || CASE WHEN r = 1 THEN upper(town) ELSE town END END AS display_address,
  CASE WHEN v % 4 = 0 OR (v % 4 = 1 AND r = 2) THEN 'none' ELSE 'place-' || CAST(v AS STRING) END AS google_place_id,
  CASE WHEN k % 29 = 0 THEN NULL ELSE 4e1 + (v % 100) / 1e2 + r * 5e-4 END AS latitude,
  CASE WHEN k % 31 = 0 THEN NULL ELSE -7.4e1 - (v % 50) / 1e2 - r * 5e-4 END AS longitude,
  CASE k % 8 WHEN 0 THEN 'null' WHEN 1 THEN 'budget' WHEN 2 THEN 'LOW' WHEN 3 THEN ' medium ' WHEN 4 THEN 'high'
    WHEN 5 THEN 'N/A' WHEN 6 THEN 'Medium' ELSE 'luxury' END AS price_point,
  CASE WHEN r = 1 THEN 'restaurant' WHEN k % 37 = 0 THEN 'None' ELSE CASE v % 9 WHEN 0 THEN 'french_restaurant' WHEN 1 THEN 'Fine_Dining_Restaurant'
    WHEN 2 THEN 'steak_house' WHEN 3 THEN 'restaurant' WHEN 4 THEN 'diner' WHEN 5 THEN 'hotel'
    WHEN 6 THEN 'fast_food_restaurant' WHEN 7 THEN 'cafe' ELSE 'restaurant' END END AS primary_type,
  CASE WHEN k % 41 = 0 THEN 'null' WHEN k % 43 = 0 THEN 'x.co/' ELSE 'http://www.' ||
    CASE v % 5 WHEN 0 THEN 'bellagio' WHEN 1 THEN 'sushi-kai' WHEN 2 THEN 'thai-corner' WHEN 3 THEN 'maria' ELSE 'plain' END
    || CAST(v AS STRING) || '.com' || CASE r WHEN 0 THEN '/' WHEN 1 THEN '/?utm=1' ELSE '//' END END AS website
FROM s
"""


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def venues_from_customer(spark: SparkSession, customer: DataFrame) -> DataFrame:
    """Raw venue records (strings as a CSV would hold them, sentinels kept)."""
    return spark.sql(VENUES_SQL, customer=customer.select("c_custkey"))


#: Neighbouring rows that are dealt out together.
BLOCK = 256


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to as many tasks as a shuffle has, in blocks of neighbours (so a partial aggregate still finds them
    together); a table of few files or row groups would leave all that follows to few tasks. By place, so no value is hot."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("__block", F.floor(F.monotonically_increasing_id() / BLOCK))
    return placed.repartition(tasks, "__block").drop("__block")


def raw_venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return venues_from_customer(spark, spread(read_table(spark, sf_dir, "customer").select("c_custkey")))


def venues_sql_duckdb() -> str:
    """The same recipe for DuckDB over its ``customer`` view."""
    return VENUES_SQL.replace("{customer}", "customer")
