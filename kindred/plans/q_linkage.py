"""Queries of the linkage itself: pairs, levels, parameters, scores, corrections, clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.dates import birth_window, overlap_days
from kindred.functions.numbers import draw
from kindred.operators import clustering, linkage
from kindred.plans.catalogue import CAND, LEVELS, PAIRS, candidacies, query
from kindred.session import settled, table

FIELDS = ("geo", "cocand", "party", "occ")
GEO = (("council", "zast", False), ("district", "okres", False), ("region", "kraj", True))


def levelled(spark, sf_dir) -> DataFrame:
    pairs = linkage.blocked_pairs(candidacies(spark, sf_dir))
    occ = F.when(F.col("occ_a") == F.col("occ_b"), "same").when(F.col("occ_a").startswith("1") & F.col("occ_b").startswith("2"), "similar").otherwise("diff")
    return pairs.withColumns({"geo": linkage.geo_level(GEO), "cocand": linkage.shared_level("parts"), "party": linkage.party_level("party", "O"), "occ": occ})


#: m from pairs that can be one person, u from all others of the key; 15 % prior.
SCORED = f"""WITH {CAND}, {PAIRS}, {LEVELS},
long AS (SELECT overlap, unnest(['geo', 'cocand', 'party', 'occ']) AS field, unnest([geo, cocand, party, occ]) AS level FROM levels),
m AS (SELECT field, level, count(*) / sum(count(*)) OVER (PARTITION BY field) AS p FROM long WHERE overlap > 0 GROUP BY 1, 2),
u AS (SELECT field, level, count(*) / sum(count(*)) OVER (PARTITION BY field) AS p FROM long WHERE overlap <= 0 GROUP BY 1, 2),
w AS (SELECT coalesce(m.field, u.field) AS field, coalesce(m.level, u.level) AS level, log2(greatest(coalesce(m.p, 1e-4), 1e-4) / greatest(coalesce(u.p, 1e-4), 1e-4)) AS bits FROM m FULL JOIN u ON m.field = u.field AND m.level = u.level),
scored AS (
  SELECT l.*, log2(0.15) + g.bits + c.bits + p.bits + o.bits AS weight, p.bits AS w_party
  FROM levels l JOIN w g ON g.field = 'geo' AND g.level = l.geo JOIN w c ON c.field = 'cocand' AND c.level = l.cocand
  JOIN w p ON p.field = 'party' AND p.level = l.party JOIN w o ON o.field = 'occ' AND o.level = l.occ
  WHERE l.overlap > 0
),
normal AS (
  SELECT *, od / (1 + sum(od) OVER (PARTITION BY year_a, year_b, id_a) + sum(od) OVER (PARTITION BY year_a, year_b, id_b) - od) AS p
  FROM (SELECT *, pow(2, greatest(least(weight, 60), -60)) AS od FROM scored)
)"""


def scored(spark, sf_dir) -> DataFrame:
    # the levels feed three consumers: computed once
    pairs = settled(levelled(spark, sf_dir).select("key", "id_a", "id_b", "year_a", "year_b", "overlap", *FIELDS, "district_a", "district_b", "price_a", "price_b", "party_a", "party_b", "council_a", "council_b"), "levels")
    possible = pairs.where("overlap > 0")
    m = linkage.distribution(possible, FIELDS).select("field", "level", "p")
    u = linkage.distribution(pairs.where("overlap <= 0"), FIELDS).select("field", "level", "p")
    weighted = linkage.field_weights(possible, m, u, FIELDS)
    return weighted.withColumn("weight", F.log2(F.lit(0.15)) + sum((F.col(f"w_{f}") for f in FIELDS[1:]), F.col("w_geo")))


@query(SCORED + " SELECT id_a, id_b, geo, cocand, party, occ, round(weight, 6) AS weight, round(p, 6) AS p FROM normal")
def q01_scored_pairs(spark, sf_dir):
    rows = linkage.normalised(linkage.best_per_pair(scored(spark, sf_dir), "id_a", "id_b"), "id_a", "id_b")
    return rows.select("id_a", "id_b", *FIELDS, F.round("weight", 6).alias("weight"), F.round("p", 6).alias("p"))


@query(f"""WITH {CAND} SELECT c.id, c.key, c.year, c.party, c.council, c.district, c.region, n.n_name AS nation, k.c_mktsegment AS segment,
  array_to_string(parts, ',') AS parts, concat_ws(':', c.year, c.key, c.id) AS cid FROM cand c JOIN customer k ON k.c_custkey = c.key LEFT JOIN nation n ON n.n_nationkey = k.c_nationkey""")
def q02_enriched(spark, sf_dir):
    rows = candidacies(spark, sf_dir).join(table(spark, sf_dir, "customer"), F.col("key") == F.col("c_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select("id", "key", "year", "party", "council", "district", "region", F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"), F.array_join("parts", ",").alias("parts"), F.concat_ws(":", "year", "key", "id").alias("cid"))


@query(f"WITH {CAND} SELECT id, age, CAST(blo AS VARCHAR) AS blo, CAST(bhi AS VARCHAR) AS bhi, CAST(date_diff('day', greatest(blo, DATE '1950-06-01'), least(bhi, DATE '1960-05-31')) + 1 AS INTEGER) AS overlap, abs(date_diff('day', blo, DATE '1955-01-01')) > 1825 AS far FROM cand")
def q03_birth_windows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"), (18 + F.col("o_orderkey") % 70).cast("int").alias("age"))
    lo, hi = birth_window(F.col("day"), F.col("age"))
    rows = rows.select("id", "age", lo.alias("blo"), hi.alias("bhi"))
    other = overlap_days(F.col("blo"), F.col("bhi"), F.lit("1950-06-01").cast("date"), F.lit("1960-05-31").cast("date"))
    far = F.abs(F.datediff(F.lit("1955-01-01").cast("date"), F.col("blo"))) > 1825
    return rows.select("id", "age", F.col("blo").cast("string").alias("blo"), F.col("bhi").cast("string").alias("bhi"), other.alias("overlap"), far.alias("far"))


@query(f"""WITH {CAND}, {PAIRS}, {LEVELS}, long AS (SELECT year_a, year_b, unnest(['geo', 'cocand', 'party', 'occ']) AS field, unnest([geo, cocand, party, occ]) AS level FROM levels)
SELECT year_a, year_b, field, level, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY year_a, year_b, field), 8) AS p FROM long GROUP BY 1, 2, 3, 4""")
def q04_level_distributions(spark, sf_dir):
    rows = linkage.distribution(levelled(spark, sf_dir), FIELDS, ["year_a", "year_b"])
    return rows.select("year_a", "year_b", "field", "level", "n", F.round("p", 8).alias("p"))


@query(f"""WITH {CAND}, {PAIRS}, {LEVELS}, r AS (SELECT *, row_number() OVER (PARTITION BY year_a, year_b, id_a ORDER BY list_position(['zast', 'okres', 'kraj', 'other'], geo), id_b) AS rn FROM levels WHERE overlap > 0)
SELECT year_a, year_b, id_a, id_b, geo FROM r WHERE rn = 1""")
def q05_seed_pairs(spark, sf_dir):
    rows = linkage.first_by_level(levelled(spark, sf_dir).where("overlap > 0"), ["year_a", "year_b", "id_a"], "geo", ["zast", "okres", "kraj", "other"], ["id_b"])
    return rows.select("year_a", "year_b", "id_a", "id_b", "geo")


@query("""WITH s AS (SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS nation, CAST(n_regionkey AS VARCHAR) AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey),
n AS (SELECT nation, count(*) AS c FROM s GROUP BY 1), r AS (SELECT region, count(*) AS c FROM s GROUP BY 1), t AS (SELECT count(*) AS c FROM s)
SELECT s_suppkey, round(greatest(n.c, 1) / t.c, 9) AS u_nation, round(greatest(greatest(r.c, n.c) - n.c, 1) / t.c, 9) AS u_region FROM s JOIN n USING (nation) JOIN r USING (region), t""")
def q06_ring_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.select("s_suppkey", F.col("s_nationkey").cast("string").alias("nation"), F.col("n_regionkey").cast("string").alias("region"))
    rings = linkage.ring_probability(rows, ["nation", "region"])
    return rings.select("s_suppkey", F.round("u_nation", 9).alias("u_nation"), F.round("u_region", 9).alias("u_region"))


@query("""WITH d AS (SELECT DISTINCT c_nationkey, c_mktsegment, left(c_name, 12) AS first, c_custkey % 7 AS f FROM customer),
g AS (SELECT c_nationkey, c_mktsegment, count(*) - 1 AS others FROM (SELECT DISTINCT c_nationkey, c_mktsegment, f FROM d) GROUP BY 1, 2)
SELECT c_nationkey, c_mktsegment, others, round(greatest(least((others + 1) / (2.5 + 1), 50), 1), 6) AS k FROM g""")
def q07_local_concentration(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").withColumn("f", F.col("c_custkey") % 7)
    found = linkage.local_concentration(rows, "c_nationkey", "c_mktsegment", "f", F.lit(2.5))
    return found.select("c_nationkey", "c_mktsegment", "others", F.round("k", 6).alias("k"))


@query(f"""WITH {CAND} SELECT a.id, coalesce(bool_or(b.blo > a.bhi OR b.bhi < a.blo), FALSE) AS clash FROM cand a JOIN cand b ON a.key = b.key AND a.year = b.year GROUP BY a.id""")
def q08_clash_in_group(spark, sf_dir):
    return clustering.clash_within(candidacies(spark, sf_dir), ["key", "year"]).select("id", "clash")


@query("""SELECT l_orderkey, l_linenumber, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 8) AS share,
  round(l_quantity / (1 + sum(l_quantity) OVER (PARTITION BY l_orderkey) + sum(l_quantity) OVER (PARTITION BY l_partkey, l_suppkey) - l_quantity), 8) AS p FROM lineitem""")
def q09_competitor_share(spark, sf_dir):
    from kindred.functions.numbers import share_among
    from kindred.operators.windows import share_of

    rows = table(spark, sf_dir, "lineitem")
    a, b = F.sum("l_quantity").over(Window.partitionBy("l_orderkey")), F.sum("l_quantity").over(Window.partitionBy("l_partkey", "l_suppkey"))
    return rows.select("l_orderkey", "l_linenumber", F.round(share_of("l_extendedprice", "l_orderkey"), 8).alias("share"), F.round(share_among(F.col("l_quantity"), a, b), 8).alias("p"))


@query(SCORED + """, fixed AS (SELECT *, party = 'same' AND year_b - year_a >= 4 AS reused FROM normal),
less AS (SELECT *, weight - CASE WHEN reused THEN w_party ELSE 0 END AS w2 FROM fixed),
again AS (SELECT *, od2 / (1 + sum(od2) OVER (PARTITION BY year_a, year_b, id_a) + sum(od2) OVER (PARTITION BY year_a, year_b, id_b) - od2) AS p2
  FROM (SELECT *, pow(2, greatest(least(w2, 60), -60)) AS od2 FROM less))
SELECT id_a, id_b, reused, round(w2, 6) AS weight, round(p2, 6) AS p FROM again""")
def q53_corrected_scores(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumn("reused", (F.col("party") == "same") & (F.col("year_b") - F.col("year_a") >= 4))
    rows = linkage.normalised(linkage.less_reused(rows, F.col("reused")), "id_a", "id_b")
    return rows.select("id_a", "id_b", "reused", F.round("weight", 6).alias("weight"), F.round("p", 6).alias("p"))


@query(f"""WITH {CAND}, b AS (SELECT key, district, count(*) AS n_area FROM cand WHERE district <> '' GROUP BY 1, 2), t AS (SELECT key, count(*) AS n_total FROM cand WHERE district <> '' GROUP BY 1),
s AS (SELECT district, count(*) / (SELECT count(*) FROM cand WHERE district <> '') AS share, count(*) >= 600 AS big FROM cand WHERE district <> '' GROUP BY 1)
SELECT b.key, b.district, round(greatest(least((n_area + 0.5 * share) / (n_total + 0.5) / share, 50), 1), 6) AS k, big FROM b JOIN t USING (key) JOIN s USING (district)""")
def q53b_regional_factor(spark, sf_dir):
    rows = candidacies(spark, sf_dir).where("district <> ''")
    by_area, total = rows.groupBy("key", "district").agg(F.count("*").alias("n_area")), rows.groupBy("key").agg(F.count("*").alias("n_total"))
    areas = rows.groupBy("district").agg(F.count("*").alias("n"))
    share = areas.select("district", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"), (F.col("n") >= 600).alias("big"))
    factors = linkage.regional_factor(by_area, total, share.select("district", "share"), "key", "district")
    return factors.join(share.select("district", "big"), "district").select("key", "district", F.round("k", 6).alias("k"), "big")


@query(f"""WITH {CAND}, p AS (SELECT id, year || '|' || key || '|' || age AS pe0, council FROM cand), c AS (SELECT *, count(*) OVER (PARTITION BY pe0, council) > 1 AS clash, count(*) OVER (PARTITION BY pe0) AS n FROM p)
SELECT id, CASE WHEN clash THEN pe0 || '|' || id ELSE pe0 END AS pe, n FROM c""")
def q52_person_events(spark, sf_dir):
    rows = candidacies(spark, sf_dir).select("id", "council", F.concat_ws("|", "year", "key", "age").alias("pe0"))
    clash = F.count("*").over(Window.partitionBy("pe0", "council")) > 1
    rows = rows.withColumns({"clash": clash, "n": F.count("*").over(Window.partitionBy("pe0"))})
    return rows.select("id", F.when(F.col("clash"), F.concat_ws("|", "pe0", "id")).otherwise(F.col("pe0")).alias("pe"), "n")


#: Scores of all pairs of a key; what several parts read is made once.
SCORED_ALL = SCORED.replace("WHERE l.overlap > 0", "")
for _part in ("cand", "levels", "w"):
    SCORED_ALL = SCORED_ALL.replace(f"{_part} AS (", f"{_part} AS MATERIALIZED (", 1)


@query(SCORED_ALL + " SELECT id_a, id_b, overlap, round(weight, 6) AS weight FROM scored WHERE overlap <= 0 AND weight - log2(0.15) > 0")
def q52b_age_conflicts(spark, sf_dir):
    pairs = settled(levelled(spark, sf_dir).select("id_a", "id_b", "overlap", *FIELDS), "levels")
    m, u = linkage.distribution(pairs.where("overlap > 0"), FIELDS), linkage.distribution(pairs.where("overlap <= 0"), FIELDS)
    rows = linkage.field_weights(pairs, m, u, FIELDS).withColumn("w_prior", F.log2(F.lit(0.15)))
    rows = rows.withColumn("weight", F.col("w_prior") + sum((F.col(f"w_{f}") for f in FIELDS[1:]), F.col("w_geo")))
    return linkage.conflicts(rows, 0.0).select("id_a", "id_b", "overlap", F.round("weight", 6).alias("weight"))


@query(f"""WITH {CAND}, {PAIRS}, {LEVELS}, f AS (SELECT key, year, count(*) AS n FROM cand GROUP BY 1, 2),
e AS (SELECT l.*, f.n * 0.01 AS expected FROM levels l JOIN f ON f.key = l.key AND f.year = l.year_b WHERE overlap > 0),
s AS (SELECT *, row_number() OVER (PARTITION BY year_a, year_b, id_a ORDER BY list_position(['zast', 'okres', 'kraj', 'other'], geo), id_b) AS rn FROM e WHERE expected < 0.02),
rare AS (SELECT c.year AS year_a, o.year AS year_b, count(*) AS n FROM cand c JOIN (SELECT DISTINCT year FROM cand) o ON c.year < o.year JOIN f ON f.key = c.key AND f.year = c.year WHERE f.n * 0.01 < 0.02 GROUP BY 1, 2)
SELECT s.year_a, s.year_b, count(*) AS seeds, round(count(*) / rare.n, 8) AS r FROM s JOIN rare USING (year_a, year_b) WHERE rn = 1 GROUP BY s.year_a, s.year_b, rare.n""")
def q52c_rerun_rate(spark, sf_dir):
    rows = candidacies(spark, sf_dir)
    names = rows.groupBy("key", "year").agg((F.count("*") * F.lit(0.01)).alias("expected"))
    pairs = levelled(spark, sf_dir).where("overlap > 0").join(names.withColumnRenamed("year", "year_b"), ["key", "year_b"])
    seeds = linkage.first_by_level(pairs.where("expected < 0.02"), ["year_a", "year_b", "id_a"], "geo", ["zast", "okres", "kraj", "other"], ["id_b"])
    rare = rows.join(names, ["key", "year"]).where("expected < 0.02").groupBy(F.col("year").alias("year_a")).agg(F.count("*").alias("n"))
    return seeds.groupBy("year_a", "year_b").agg(F.count("*").alias("seeds")).join(rare, "year_a").select("year_a", "year_b", "seeds", F.round(F.col("seeds") / F.col("n"), 8).alias("r"))


def proposals(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the clustering: records of the keys, scored pairs with a proposal by p and a second signal."""
    nodes = candidacies(spark, sf_dir).select("key", F.concat_ws("|", "year", "key", "id").alias("pe"), "year", "blo", "bhi", "id")
    edges = linkage.normalised(scored(spark, sf_dir), "id_a", "id_b")
    second = (F.col("cocand") == "2+") | (F.col("party") == "same") | (F.col("geo") == "zast")
    proposal = F.when((F.col("p") >= 0.6) & second, "auto_match").when(F.col("p") >= 0.55, "auto_jev").when(F.col("p") >= 0.3, "manual_review").otherwise("possible_match")
    edges = edges.select("key", F.concat_ws("|", "year_a", "key", "id_a").alias("pe_a"), F.concat_ws("|", "year_b", "key", "id_b").alias("pe_b"), "p", proposal.alias("proposal"), F.lit(False).alias("split"), "year_a", "year_b")
    return nodes, settled(edges, "edges")


@query()
def q21_constrained_clusters(spark, sf_dir):
    nodes, edges = proposals(spark, sf_dir)
    decided, persons = clustering.constrained(nodes, edges)
    return decided.groupBy("decision").agg(F.count("*").alias("n")).unionByName(persons.agg(F.lit("persons").alias("decision"), F.count_distinct("person").alias("n")))


@query()
def q22_greedy_one_to_one(spark, sf_dir):
    _, edges = proposals(spark, sf_dir)
    return clustering.greedy_pairs(edges).select("pe_a", "pe_b", F.round("p", 6).alias("p"), "linked")


@query()
def q60_cluster_fold(spark, sf_dir):
    nodes, edges = proposals(spark, sf_dir)
    _, persons = clustering.constrained(nodes, edges)
    return persons


@query("""WITH RECURSIVE e AS (SELECT DISTINCT a.o_custkey AS a, b.o_custkey AS b FROM orders a JOIN lineitem la ON la.l_orderkey = a.o_orderkey JOIN lineitem lb ON lb.l_partkey = la.l_partkey AND lb.l_suppkey = la.l_suppkey JOIN orders b ON b.o_orderkey = lb.l_orderkey WHERE a.o_custkey <> b.o_custkey),
r(node, label) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.label FROM r JOIN e ON e.a = r.node)
SELECT node, min(label) AS component FROM r GROUP BY node""")
def q20_components(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", "l_suppkey", "o_custkey").distinct()
    # a star for each (part, supplier): the same components as all pairs of its customers
    hubs = lines.groupBy("l_partkey", "l_suppkey").agg(F.min("o_custkey").alias("a"))
    edges = lines.join(hubs, ["l_partkey", "l_suppkey"]).where("a <> o_custkey").select("a", F.col("o_custkey").alias("b"))
    return clustering.connected(edges)


@query(f"""WITH {CAND}, n AS (SELECT *, row_number() OVER (PARTITION BY district ORDER BY id) AS rn, count(*) OVER (PARTITION BY district) AS n FROM cand WHERE year = 1996 AND district <> ''),
b AS (SELECT id, district FROM cand WHERE year = 1997 AND district <> '')
SELECT b.id AS id_b, n.id AS id_a, b.district FROM b JOIN n ON n.district = b.district AND n.rn = 1 + CAST('0x' || substr(md5('partner|' || b.id), 1, 7) AS BIGINT) % n.n""")
def q43_random_partner(spark, sf_dir):
    rows = candidacies(spark, sf_dir).where("district <> ''").select("id", "district", "year")
    pairs = linkage.partners_within(rows.where("year = 1996").drop("year"), rows.where("year = 1997").drop("year"), "district")
    return pairs.select("id_b", "id_a", F.col("district_b").alias("district"))


@query(f"""WITH {CAND}, s AS (SELECT id, key, year, CAST('0x' || substr(md5('us|' || id), 1, 7) AS BIGINT) % (SELECT greatest(count(*) // 17, 1) FROM cand) AS slot FROM cand)
SELECT a.id AS id_a, b.id AS id_b FROM s a JOIN s b ON a.slot = b.slot AND a.year < b.year AND a.key <> b.key""")
def q43b_strangers(spark, sf_dir):
    rows = candidacies(spark, sf_dir).select("id", "key", "year")
    # as many slots as keep a slot's rows about the same, so strangers grow with the rows
    rows = rows.withColumn("slot", draw(F.lit(max(rows.count() // 17, 1)), "id", seed="us"))
    a, b = linkage.suffixed(rows, "a", ["slot"]), linkage.suffixed(rows, "b", ["slot"])
    return a.join(b, "slot").where("year_a < year_b and key_a <> key_b").select("id_a", "id_b")


@query("""WITH s AS (SELECT o_custkey AS key, min(o_orderdate) AS lo, max(o_orderdate) AS hi, count(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
c AS (SELECT s.*, c_nationkey, c_mktsegment, c_custkey % 2 AS g FROM s JOIN customer ON c_custkey = key),
p AS (SELECT a.key AS key_a, b.key AS key_b, a.g, count(*) OVER (PARTITION BY a.key) AS na, count(*) OVER (PARTITION BY b.key) AS nb FROM c a JOIN c b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.g = b.g AND a.key <> b.key AND a.hi < b.lo)
SELECT g, count(*) AS pairs, count(*) FILTER (greatest(na, nb) = 1) AS unique_pairs FROM p GROUP BY g""")
def q55_renamed_with_control(spark, sf_dir):
    spans = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("key")).agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    rows = spans.join(table(spark, sf_dir, "customer"), F.col("key") == F.col("c_custkey")).select("key", "lo", "hi", "c_nationkey", "c_mktsegment", (F.col("c_custkey") % 2).alias("g"))
    by = ["c_nationkey", "c_mktsegment", "g"]
    pairs = linkage.suffixed(rows, "a", by).join(linkage.suffixed(rows, "b", by), by).where("key_a <> key_b and hi_a < lo_b")
    from kindred.operators.windows import one_to_one

    return pairs.withColumn("only", one_to_one("key_a", "key_b")).groupBy("g").agg(F.count("*").alias("pairs"), F.count_if("only").alias("unique_pairs"))
