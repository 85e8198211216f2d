"""Registry of queries with their SQL twins, and the proxies that stand for register tables.

The test tables hold no register: an order stands for a candidacy, its customer for the name that blocks pairs, its year
for the election, its smallest supplier for the council (with nation and region around it), its parts for the list's
other candidates. Everything is computed over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.dates import birth_window
from kindred.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with SQL for the same rows where SQL can say it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def candidacies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidacy proxy: id, key, year, day, age, blo, bhi, party, occ, price, council, district, region, parts."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    own = lines.groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_suppkey").alias("_s"), F.array_sort(F.collect_set("l_partkey")).alias("parts"))
    places = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("_s"), "s_nationkey", "n_regionkey")
    day, age = F.col("o_orderdate").cast("date"), (18 + F.col("o_orderkey") % 70).cast("int")
    lo, hi = birth_window(day, age)
    rows = orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"), F.year(day).alias("year"), day.alias("day"), age.alias("age"), lo.alias("blo"), hi.alias("bhi"), F.col("o_orderstatus").alias("party"), F.col("o_orderpriority").alias("occ"), F.col("o_totalprice").alias("price"))
    rows = rows.join(own, "id", "left").join(places, "_s", "left")

    def known(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    return rows.select("id", "key", "year", "day", "age", "blo", "bhi", "party", "occ", "price", known("_s").alias("council"), known("s_nationkey").alias("district"), known("n_regionkey").alias("region"), F.coalesce("parts", F.array().cast("array<bigint>")).alias("parts"))


#: The same in SQL, to begin a WITH clause.
CAND = """cand AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS key, CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(o.o_orderdate AS DATE) AS day,
    CAST(18 + o.o_orderkey % 70 AS INTEGER) AS age,
    CAST(CAST(o.o_orderdate AS DATE) + 1 - to_years(CAST(19 + o.o_orderkey % 70 AS INTEGER)) AS DATE) + 1 AS blo,
    CAST(CAST(o.o_orderdate AS DATE) + 1 - to_years(CAST(18 + o.o_orderkey % 70 AS INTEGER)) AS DATE) AS bhi,
    o.o_orderstatus AS party, o.o_orderpriority AS occ, o.o_totalprice AS price,
    coalesce(CAST(l.s AS VARCHAR), '') AS council, coalesce(CAST(s.s_nationkey AS VARCHAR), '') AS district,
    coalesce(CAST(n.n_regionkey AS VARCHAR), '') AS region, coalesce(l.parts, []) AS parts
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS s, list_sort(list(DISTINCT l_partkey)) AS parts FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON s.s_suppkey = l.s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
)"""

#: Blocked pairs with their overlap.
PAIRS = """pairs AS (
  SELECT a.key, a.id AS id_a, b.id AS id_b, a.year AS year_a, b.year AS year_b, a.council AS council_a, b.council AS council_b,
    a.district AS district_a, b.district AS district_b, a.region AS region_a, b.region AS region_b, a.party AS party_a, b.party AS party_b,
    a.occ AS occ_a, b.occ AS occ_b, a.parts AS parts_a, b.parts AS parts_b, a.price AS price_a, b.price AS price_b, a.age AS age_a, b.age AS age_b,
    a.day AS day_a, b.day AS day_b,
    CAST(date_diff('day', greatest(a.blo, b.blo), least(a.bhi, b.bhi)) + 1 AS INTEGER) AS overlap
  FROM cand a JOIN cand b ON a.key = b.key AND a.year < b.year
), kept AS (SELECT * FROM pairs WHERE overlap > -366)"""

#: Their comparison levels.
LEVELS = """levels AS (
  SELECT *,
    CASE WHEN council_a = council_b THEN 'zast' WHEN district_a = district_b THEN 'okres' WHEN region_a <> '' AND region_b <> '' AND region_a = region_b THEN 'kraj' ELSE 'other' END AS geo,
    CASE WHEN len(parts_a) = 0 OR len(parts_b) = 0 THEN 'na' WHEN len(list_intersect(parts_a, parts_b)) = 0 THEN '0' WHEN len(list_intersect(parts_a, parts_b)) = 1 THEN '1' ELSE '2+' END AS cocand,
    CASE WHEN party_a = 'O' AND party_b = 'O' THEN 'both_none' WHEN party_a = party_b THEN 'same' ELSE 'diff' END AS party,
    CASE WHEN occ_a = occ_b THEN 'same' WHEN left(occ_a, 1) = '1' AND left(occ_b, 1) = '2' THEN 'similar' ELSE 'diff' END AS occ
  FROM kept
)"""
