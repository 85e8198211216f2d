"""Queries of the relational core: windows, joins, aggregates, sorts, sets, conditional columns."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.functions import numbers
from kindred.functions.dates import five_year_bucket, parsed, share_of_year_left
from kindred.operators import marts, sampling, windows
from kindred.plans.catalogue import query
from kindred.session import table


@query("""SELECT o_orderkey, CAST(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS INTEGER) AS rank_min,
  round((rank() OVER (PARTITION BY o_orderstatus ORDER BY floor(o_totalprice / 1000)) + (count(*) OVER (PARTITION BY o_orderstatus, floor(o_totalprice / 1000)) - 1) / 2.0) / count(*) OVER (PARTITION BY o_orderstatus), 9) AS pct,
  round(1 - cume_dist() OVER (PARTITION BY o_orderpriority ORDER BY floor(o_totalprice / 1000)), 9) AS above FROM orders""")
def q10_ranks(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("k", F.floor(F.col("o_totalprice") / 1000))
    return rows.select("o_orderkey", windows.rank_min("o_totalprice", "o_custkey").alias("rank_min"), F.round(windows.percent_rank_average("k", "o_orderstatus"), 9).alias("pct"), F.round(1 - windows.share_at_most("k", "o_orderpriority"), 9).alias("above"))


@query("""WITH g AS (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n, count(*) OVER (PARTITION BY l_suppkey) AS per_supp FROM lineitem)
SELECT l_orderkey, l_linenumber, n > 1 AS dup, n, per_supp FROM g WHERE per_supp >= 500""")
def q11_duplicates(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumns({"dup": windows.duplicated("l_partkey", "l_suppkey"), "n": F.count("*").over(Window.partitionBy("l_partkey", "l_suppkey"))})
    sizes = rows.groupBy("l_suppkey").agg(F.count("*").alias("per_supp")).where("per_supp >= 500")
    return rows.join(sizes, "l_suppkey").select("l_orderkey", "l_linenumber", "dup", "n", "per_supp")


@query("""WITH y AS (SELECT o_custkey AS c, year(o_orderdate) AS y, n_name AS place FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)
SELECT DISTINCT a.c, a.place, EXISTS (SELECT 1 FROM y b WHERE b.c = a.c AND b.y = 1999) AS elsewhere FROM y a WHERE a.y = 1998 AND NOT EXISTS (SELECT 1 FROM y b WHERE b.c = a.c AND b.y = 1999 AND b.place = a.place)""")
def q12_leavers(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("o_custkey").alias("c"), F.year("o_orderdate").alias("y"), F.col("n_name").alias("place"))
    return marts.leavers(rows, "c", "place", "y", 1998, 1999)


@query("""WITH a AS (SELECT DISTINCT o_custkey AS c FROM orders WHERE year(o_orderdate) = 1998), b AS (SELECT DISTINCT o_custkey AS c FROM orders WHERE year(o_orderdate) = 1999)
SELECT c_custkey, c_custkey IN (SELECT c FROM a) AS then_, (c_custkey IN (SELECT c FROM a)) <> (c_custkey IN (SELECT c FROM b)) AS half FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""")
def q12b_semi_and_xor(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("y"))
    a, b = (orders.where(F.col("y") == y).select("c_custkey").distinct().withColumn(n, F.lit(True)) for y, n in ((1998, "a"), (1999, "b")))
    rows = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation").where("n_regionkey < 3")), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    rows = rows.join(a, "c_custkey", "left").join(b, "c_custkey", "left")
    then = F.coalesce("a", F.lit(False))
    return rows.select("c_custkey", then.alias("then_"), (then != F.coalesce("b", F.lit(False))).alias("half"))


@query("""WITH m AS (SELECT l_suppkey, l_quantity, count(*) AS c FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY c DESC, l_quantity) AS rn FROM m)
SELECT l.l_suppkey, round(median(l_extendedprice), 4) AS med, round(quantile_cont(l_extendedprice, 0.99), 4) AS q99, round(avg(l_discount), 8) AS mean, r.l_quantity AS mode FROM lineitem l JOIN r ON r.l_suppkey = l.l_suppkey AND rn = 1 GROUP BY l.l_suppkey, r.l_quantity""")
def q13_mode_median_quantile(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.round(F.median("l_extendedprice"), 4).alias("med"), F.round(F.percentile("l_extendedprice", F.lit(0.99)), 4).alias("q99"), F.round(F.avg("l_discount"), 8).alias("mean"), marts.mode_smallest("l_quantity").alias("mode")
    )


@query("""SELECT CAST(g AS INTEGER) AS bin, count(p_size) AS n FROM range(0, 71) t(g) LEFT JOIN (SELECT greatest(least(p_size, 70), 0) AS p_size FROM part) ON p_size = g GROUP BY 1""")
def q13b_histogram(spark, sf_dir):
    return marts.histogram(table(spark, sf_dir, "part"), "p_size", 0, 70)


AGE = "CASE WHEN a < 30 THEN '18-29' WHEN a < 40 THEN '30-39' WHEN a < 50 THEN '40-49' WHEN a < 60 THEN '50-59' WHEN a < 70 THEN '60-69' ELSE '70+' END"


@query(f"""SELECT {AGE} AS band, CASE WHEN o_totalprice < 50000 THEN 'small' WHEN o_totalprice < 200000 THEN 'middle' ELSE 'large' END AS size, count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 8) AS rate FROM (SELECT *, 18 + o_orderkey % 70 AS a FROM orders) GROUP BY 1, 2""")
def q14_binned_rates(spark, sf_dir):
    age = 18 + F.col("o_orderkey") % 70
    band = marts.binned(age, [18, 30, 40, 50, 60, 70, 200], ["18-29", "30-39", "40-49", "50-59", "60-69", "70+"])
    size = marts.binned(F.col("o_totalprice"), [-1e18, 5e4, 2e5, 1e18], ["small", "middle", "large"])
    return table(spark, sf_dir, "orders").groupBy(band.alias("band"), size.alias("size")).agg(F.count("*").alias("n"), F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 8).alias("rate"))


@query("""WITH s AS (SELECT o_custkey, o_orderstatus, sum(o_totalprice) AS w FROM orders GROUP BY 1, 2), t AS (SELECT *, w / sum(w) OVER (PARTITION BY o_custkey) AS share FROM s)
SELECT o_custkey, o_orderstatus, round(share, 8) AS share FROM t WHERE share >= 0.95""")
def q15_dominant_value(spark, sf_dir):
    return marts.dominant(table(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus", "o_totalprice").select("o_custkey", "o_orderstatus", F.round("share", 8).alias("share"))


@query("""SELECT o_orderpriority, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS f, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS o, round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS p FROM orders GROUP BY 1""")
def q15b_pivot(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.sum("o_totalprice"), 2))
    return rows.select("o_orderpriority", F.col("F").alias("f"), F.col("O").alias("o"), F.col("P").alias("p"))


@query("""WITH g AS (SELECT p_brand, p_size, round(avg(p_retailprice), 6) AS v FROM part GROUP BY 1, 2 HAVING count(*) >= 2), k AS (SELECT least(50, count(*) // 2) AS k FROM g),
t AS (SELECT *, row_number() OVER (ORDER BY v DESC, p_brand, p_size) AS up, row_number() OVER (ORDER BY v, p_brand DESC, p_size DESC) AS down FROM g)
SELECT 'top' AS side, CAST(up AS INTEGER) AS place, p_brand, p_size, v FROM t, k WHERE up <= k UNION ALL SELECT 'bottom', CAST(down AS INTEGER), p_brand, p_size, v FROM t, k WHERE down <= k""")
def q16_ends(spark, sf_dir):
    groups = table(spark, sf_dir, "part").groupBy("p_brand", "p_size").agg(F.round(F.avg("p_retailprice"), 6).alias("v"), F.count("*").alias("n")).where("n >= 2").drop("n")
    return windows.ends_without_overlap(groups, "v", "p_brand", "p_size").select("side", "place", "p_brand", "p_size", "v")


@query("""WITH r AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations), m AS (SELECT *, CAST(sum(CASE WHEN before IS NULL OR before <> role THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS run FROM r)
SELECT conv_id, run, role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM m GROUP BY 1, 2, 3""")
def q27_runs(spark, sf_dir):
    return windows.runs(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


@query("""SELECT s_suppkey, n_name AS nation, coalesce(r_name, 'nowhere') AS region, coalesce(p.b, n_name, '?') AS label FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 3
LEFT JOIN (SELECT p_partkey, p_brand AS b FROM part WHERE p_size < 10) p ON p_partkey = s_suppkey""")
def q37_lookups(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    rows = rows.join(F.broadcast(table(spark, sf_dir, "region").where("r_regionkey < 3")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    parts = table(spark, sf_dir, "part").where("p_size < 10").select(F.col("p_partkey").alias("s_suppkey"), F.col("p_brand").alias("b"))
    rows = rows.join(parts, "s_suppkey", "left")
    return rows.select("s_suppkey", F.col("n_name").alias("nation"), F.coalesce("r_name", F.lit("nowhere")).alias("region"), F.coalesce("b", "n_name", F.lit("?")).alias("label"))


@query("""SELECT o_orderkey, 'v1' AS version, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status, CASE WHEN o_totalprice < 10000 THEN 'a' WHEN o_totalprice < 100000 THEN 'b' ELSE 'c' END AS band,
  CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE o_totalprice END AS updated, round_even(greatest(least(o_totalprice / 1000, 200), 5) * 10, 0) AS clipped, o_orderstatus <> 'P' AND o_orderpriority <> '' AND o_orderstatus = left(o_orderpriority, 1) AS both_known,
  coalesce(nullif(o_orderstatus, 'P'), o_orderpriority) AS filled FROM orders""")
def q39_conditional_columns(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus"))
    band = F.when(F.col("o_totalprice") < 10000, "a").when(F.col("o_totalprice") < 100000, "b").otherwise("c")
    updated = F.when(F.col("o_orderpriority").like("1%"), 0).otherwise(F.col("o_totalprice"))
    clipped = F.bround(numbers.clip(F.col("o_totalprice") / 1000, 5, 200) * 10, 0)
    known = (status != "") & (F.col("o_orderpriority") != "") & (status == F.left("o_orderpriority", F.lit(1)))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.lit("v1").alias("version"), status.alias("status"), band.alias("band"), updated.alias("updated"), clipped.alias("clipped"), known.alias("both_known"), F.coalesce(F.nullif("o_orderstatus", F.lit("P")), "o_orderpriority").alias("filled"))


@query("""SELECT p_partkey, (p_size > 10 AND NOT p_brand = 'Brand#11') OR p_type LIKE '%STEEL%' AS mask, (p_size > 25) <> (p_retailprice > 1000) AS half, p_size IN (1, 5, 9) AS listed, p_size BETWEEN 10 AND 20 AS ranged,
  regexp_matches(p_name, '(an|er)') AS found, starts_with(p_brand, 'Brand#1') AS started, p_name IS NULL AS missing, (SELECT count(DISTINCT q.p_type) FROM part q WHERE q.p_brand = part.p_brand) > 1 AS many FROM part""")
def q40_predicates(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    many = rows.groupBy("p_brand").agg((F.count_distinct("p_type") > 1).alias("many"))
    c = F.col
    return rows.join(many, "p_brand").select(
        "p_partkey", (((c("p_size") > 10) & ~(c("p_brand") == "Brand#11")) | c("p_type").contains("STEEL")).alias("mask"), ((c("p_size") > 25) != (c("p_retailprice") > 1000)).alias("half"), c("p_size").isin(1, 5, 9).alias("listed"),
        c("p_size").between(10, 20).alias("ranged"), c("p_name").rlike("(an|er)").alias("found"), c("p_brand").startswith("Brand#1").alias("started"), c("p_name").isNull().alias("missing"), "many",
    )


@query("""WITH e AS (SELECT l_orderkey AS a, l_partkey AS b, l_suppkey AS s, min(l_linenumber) AS ln FROM lineitem GROUP BY 1, 2, 3)
SELECT a, b, s, o_orderstatus AS status_a, p_brand AS brand_b, coalesce(d.decision, 'reject') AS decision, o_custkey % 10 <> b % 10 AS apart FROM e JOIN orders ON o_orderkey = a JOIN part ON p_partkey = b
LEFT JOIN (SELECT l_orderkey, l_partkey, max(CASE WHEN l_returnflag = 'R' THEN 'auto' ELSE 'review' END) AS decision FROM lineitem WHERE l_quantity > 25 GROUP BY 1, 2) d ON d.l_orderkey = a AND d.l_partkey = b""")
def q41_pair_to_entity(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    edges = lines.groupBy(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"), F.col("l_suppkey").alias("s")).agg(F.min("l_linenumber").alias("ln"))
    decided = lines.where("l_quantity > 25").groupBy(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b")).agg(F.max(F.when(F.col("l_returnflag") == "R", "auto").otherwise("review")).alias("decision"))
    orders, parts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_orderstatus").alias("status_a"), "o_custkey"), table(spark, sf_dir, "part").select(F.col("p_partkey").alias("b"), F.col("p_brand").alias("brand_b"))
    rows = edges.join(orders, "a").join(parts, "b").join(decided, ["a", "b"], "left")
    return rows.select("a", "b", "s", "status_a", "brand_b", F.coalesce("decision", F.lit("reject")).alias("decision"), (F.col("o_custkey") % 10 != F.col("b") % 10).alias("apart"))


@query("""WITH o AS (SELECT o_orderkey AS id, o_custkey AS key, year(o_orderdate) AS y, CAST(o_orderdate AS DATE) AS d, c_nationkey AS place, c_mktsegment AS seg, o_totalprice AS v FROM orders JOIN customer ON c_custkey = o_custkey)
SELECT 'far apart' AS kind, count(*) AS n FROM o a JOIN o b ON a.key = b.key AND a.y < b.y AND abs(date_diff('day', a.d, b.d)) > 1500
UNION ALL SELECT 'gap band', count(*) FROM o a JOIN o b ON a.key = b.key AND b.y - a.y BETWEEN 3 AND 5
UNION ALL SELECT 'same year', count(*) FROM o a JOIN o b ON a.key = b.key AND a.y = b.y AND a.id < b.id
UNION ALL SELECT 'same place other key', count(*) FROM (SELECT DISTINCT place, seg, key, y FROM o WHERE v > 300000) a JOIN (SELECT DISTINCT place, seg, key, y FROM o WHERE v > 300000) b ON a.place = b.place AND a.seg = b.seg AND a.key < b.key AND a.y <> b.y
UNION ALL SELECT 'gone', count(*) FROM (SELECT DISTINCT key FROM o a WHERE y = 1996 AND NOT EXISTS (SELECT 1 FROM o b WHERE b.key = a.key AND b.y BETWEEN a.y + 1 AND a.y + 2))""")
def q42_theta_self_joins(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = rows.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("key"), F.year("o_orderdate").alias("y"), F.col("o_orderdate").cast("date").alias("d"), F.col("c_nationkey").alias("place"), F.col("c_mktsegment").alias("seg"), F.col("o_totalprice").alias("v"))
    from kindred.operators.linkage import suffixed

    same = suffixed(rows, "a", ["key"]).join(suffixed(rows, "b", ["key"]), "key")
    gaps = same.agg(F.count_if((F.col("y_a") < F.col("y_b")) & (F.abs(F.datediff("d_a", "d_b")) > 1500)).alias("far apart"), F.count_if((F.col("y_b") - F.col("y_a")).between(3, 5)).alias("gap band"), F.count_if((F.col("y_a") == F.col("y_b")) & (F.col("id_a") < F.col("id_b"))).alias("same year"))
    gaps = gaps.unpivot([], ["far apart", "gap band", "same year"], "kind", "n")
    near = rows.where("v > 300000").select("place", "seg", "key", "y").distinct()
    other = suffixed(near, "a", ["place", "seg"]).join(suffixed(near, "b", ["place", "seg"]), ["place", "seg"]).where("key_a < key_b and y_a <> y_b").agg(F.lit("same place other key").alias("kind"), F.count("*").alias("n"))
    later = rows.select(F.col("key").alias("k2"), F.col("y").alias("y2"))
    gone = rows.where("y = 1996").join(later, (F.col("key") == F.col("k2")) & F.col("y2").between(F.col("y") + 1, F.col("y") + 2), "left_anti").agg(F.lit("gone").alias("kind"), F.count_distinct("key").alias("n"))
    return gaps.unionByName(other).unionByName(gone)


@query("""WITH a AS (SELECT n_name AS area, c_mktsegment AS name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2), t AS (SELECT area, 'total' AS name, sum(n) AS n FROM a GROUP BY 1)
SELECT area, name, CAST(n AS BIGINT) AS n, round(n / (SELECT sum(n) FROM a), 9) AS share FROM (SELECT * FROM a UNION ALL SELECT * FROM t)""")
def q45_roll_up(spark, sf_dir):
    from kindred.sources.readers import rolled_up

    rows = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("office"), F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("n"))
    offices = F.broadcast(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("office"), F.col("n_name").alias("area")))
    found = rolled_up(rows, offices, "office", "area", "name", "n")
    everyone = F.sum(F.when(F.col("name") != "total", F.col("n"))).over(Window.partitionBy())
    return found.select("area", "name", "n", F.round(F.col("n") / everyone, 9).alias("share"))


@query("""SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS n_status, max(o_totalprice) AS top, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 8) AS rate, bool_or(o_totalprice > 300000) AS any_big, bool_and(o_totalprice > 5000) AS all_big,
  string_agg(DISTINCT left(o_orderpriority, 1), ',' ORDER BY left(o_orderpriority, 1)) AS levels, round(10000.0 * count(*) FILTER (o_orderstatus = 'P') / count(*), 4) AS per_10k, count(*) FILTER (year(o_orderdate) >= 1998) AS late FROM orders GROUP BY 1""")
def q46_aggregates(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    c = F.col
    return rows.groupBy("o_custkey").agg(
        F.count("*").alias("n"), F.count_distinct("o_orderstatus").alias("n_status"), F.max("o_totalprice").alias("top"), F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("first_order"), F.round(F.avg((c("o_orderstatus") == "F").cast("double")), 8).alias("rate"),
        F.bool_or(c("o_totalprice") > 300000).alias("any_big"), F.bool_and(c("o_totalprice") > 5000).alias("all_big"), F.array_join(F.array_sort(F.collect_set(F.left("o_orderpriority", F.lit(1)))), ",").alias("levels"),
        F.round(10000.0 * F.count_if(c("o_orderstatus") == "P") / F.count("*"), 4).alias("per_10k"), F.count_if(F.year("o_orderdate") >= 1998).alias("late"),
    )


@query("""SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def q46b_most_common(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_type").limit(10)


@query("""SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS position, last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_order,
  greatest(count(*) OVER (PARTITION BY o_custkey), count(*) OVER (PARTITION BY CAST(o_orderdate AS DATE))) = 1 AS unique_pair FROM orders""")
def q47_windows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    line = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    last = rows.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("last_order"))
    rows = rows.withColumns({"n": F.count("*").over(Window.partitionBy("o_custkey")), "position": F.row_number().over(line), "unique_pair": windows.one_to_one("o_custkey", "day")})
    return rows.join(last, "o_custkey").select("o_orderkey", "n", "position", "last_order", "unique_pair")


@query("""(SELECT 'head' AS kind, p_partkey FROM part ORDER BY p_brand DESC, p_size, p_partkey LIMIT 20) UNION ALL (SELECT 'tail', p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey DESC LIMIT 20)
UNION ALL (SELECT 'category', p_partkey FROM part ORDER BY list_position(['Brand#32', 'Brand#11'], p_brand) NULLS LAST, p_partkey LIMIT 20)
UNION ALL (SELECT 'tier', p_partkey FROM part ORDER BY CASE WHEN starts_with(p_name, 'a') THEN 0 WHEN contains(p_name, 'a') THEN 1 ELSE 2 END, p_size DESC, p_partkey LIMIT 40)""")
def q48_sorts(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    named = lambda df, n, kind: df.limit(n).select(F.lit(kind).alias("kind"), "p_partkey")
    category = F.nullif(F.array_position(F.array(F.lit("Brand#32"), F.lit("Brand#11")), F.col("p_brand")), F.lit(0))
    tier = F.when(F.col("p_name").startswith("a"), 0).when(F.col("p_name").contains("a"), 1).otherwise(2)
    out = named(rows.orderBy(F.desc("p_brand"), "p_size", "p_partkey"), 20, "head").unionByName(named(rows.orderBy(F.desc("p_retailprice"), F.desc("p_partkey")), 20, "tail"))
    return out.unionByName(named(rows.orderBy(category.asc_nulls_last(), "p_partkey"), 20, "category")).unionByName(named(rows.orderBy(tier, F.desc("p_size"), "p_partkey"), 40, "tier"))


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderpriority LIKE '1%')
SELECT 'union all' AS op, count(*) AS n FROM (SELECT k FROM a UNION ALL SELECT k FROM b) UNION ALL SELECT 'union', count(*) FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'difference', count(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT 'both', count(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b)""")
def q48b_sets(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    a, b = orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).distinct(), orders.where("o_orderpriority like '1%'").select(F.col("o_custkey").alias("k")).distinct()
    named = lambda df, op: df.agg(F.lit(op).alias("op"), F.count("*").alias("n"))
    return named(a.unionByName(b), "union all").unionByName(named(a.unionByName(b).distinct(), "union")).unionByName(named(a.join(b, "k", "left_anti"), "difference")).unionByName(named(a.join(b, "k", "left_semi"), "both"))


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 0 END AS s0, CASE WHEN o_orderstatus = 'P' THEN 1 END AS s1, CASE WHEN o_orderpriority LIKE '1%' THEN 2 END AS s2 FROM orders),
u AS (SELECT o_orderkey, unnest([s0, s1, s2]) AS stratum_rank FROM s), q AS (SELECT *, row_number() OVER (PARTITION BY stratum_rank ORDER BY md5('lab|' || o_orderkey), o_orderkey) AS rn FROM u WHERE stratum_rank IS NOT NULL),
k AS (SELECT *, min(stratum_rank) OVER (PARTITION BY o_orderkey) AS first FROM q WHERE rn <= 40)
SELECT o_orderkey, ['large', 'pending', 'urgent'][stratum_rank + 1] AS stratum FROM k WHERE stratum_rank = first""")
def q19_stratified_sample(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    strata = [("large", F.col("o_totalprice") > 250000), ("pending", F.col("o_orderstatus") == "P"), ("urgent", F.col("o_orderpriority").startswith("1"))]
    drawn = sampling.stratified(sampling.in_strata(rows, strata), "stratum", 40, "o_orderkey", seed="lab")
    return sampling.first_stratum(drawn, "o_orderkey").select("o_orderkey", "stratum")


@query("""SELECT c_custkey, CAST(row_number() OVER (ORDER BY md5('salt|' || c_custkey), c_custkey) AS BIGINT) AS person FROM customer""")
def q32_anonymous_numbers(spark, sf_dir):
    return sampling.dense_numbers(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", salt="salt", name="person")


@query("""WITH n AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer), t AS (SELECT count(*) AS c FROM customer), d AS (SELECT range AS draw, CAST('0x' || substr(md5('wr|' || range), 1, 7) AS BIGINT) % (SELECT c FROM t) + 1 AS rn FROM range(500))
SELECT draw, c_custkey FROM d JOIN n USING (rn)""")
def q43c_with_replacement(spark, sf_dir):
    from kindred.operators.sampling import with_replacement

    rows = table(spark, sf_dir, "customer").select("c_custkey")
    numbered = sampling_numbers(rows)
    return with_replacement(numbered, rows.count(), 500, seed="wr").select("draw", "c_custkey")


def sampling_numbers(rows):
    """Rows numbered by key: range partitions are counted, then numbered inside, so no task holds all rows."""
    ranged = rows.repartitionByRange("c_custkey").withColumn("_p", F.spark_partition_id())
    from kindred.session import settled

    ranged = settled(ranged, "ranged")
    before = ranged.groupBy("_p").agg(F.count("*").alias("_n")).select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(before), "_p").select("c_custkey", (F.col("_before") + F.row_number().over(Window.partitionBy("_p").orderBy("c_custkey"))).alias("rn"))


@query("""SELECT o_orderkey, strftime(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS day, round(date_diff('day', CAST(o_orderdate AS DATE), make_date(year(o_orderdate), 12, 31)) / 365, 9) AS left_, CAST(least(greatest(year(o_orderdate) - year(o_orderdate) % 5, 1920), 2020) AS INTEGER) AS bucket,
  round(greatest(least((o_custkey % 9 + 1) / (o_custkey % 4 + 1), 50), 1), 9) AS smoothed, round(o_totalprice / greatest(o_custkey % 3, 0.5), 4) AS floored, CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS chosen,
  round((o_custkey % 11 + 0.5) * (o_orderkey % 13 + 0.5) / 1000 / 0.93, 9) AS expected FROM orders""")
def q50_dates_and_numbers(spark, sf_dir):
    c = F.col
    day = c("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parsed(F.date_format("o_orderdate", "yyyyMMdd")).cast("string").alias("day"), F.round(share_of_year_left(day), 9).alias("left_"), five_year_bucket(F.year("o_orderdate")).alias("bucket"),
        F.round(numbers.concentration(c("o_custkey") % 9, c("o_custkey") % 4), 9).alias("smoothed"), F.round(numbers.ratio(c("o_totalprice"), c("o_custkey") % 3, 0.5), 4).alias("floored"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (c("o_orderkey") % 3 + 1).cast("int")).alias("chosen"),
        F.round((c("o_custkey") % 11 + 0.5) * (c("o_orderkey") % 13 + 0.5) / 1000 / 0.93, 9).alias("expected"),
    )


@query("""WITH y AS (SELECT c_custkey, 40 + c_custkey % 30 AS born FROM customer), q AS (SELECT c_custkey, unnest(range(born, 90)) AS a FROM y) SELECT c_custkey, round(greatest(exp(sum(ln(1 - (0.001 + a * 0.0004)))), 0.01), 9) AS survival FROM q GROUP BY 1""")
def q50b_survival(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", (40 + F.col("c_custkey") % 30).cast("int").alias("born"))
    # one product for each year of birth, looked up by the rows
    products = rows.select("born").distinct().select("born", F.explode(F.sequence("born", F.lit(89))).alias("a")).groupBy("born").agg(F.greatest(F.exp(F.sum(F.log(1 - (F.lit(0.001) + F.col("a") * 0.0004)))), F.lit(0.01)).alias("survival"))
    return rows.join(F.broadcast(products), "born").select("c_custkey", F.round("survival", 9).alias("survival"))


@query("""WITH o AS (SELECT l_orderkey AS id, list_sort(list(DISTINCT l_suppkey)) AS s, list_sort(list(DISTINCT l_suppkey) FILTER (l_suppkey % 2 = 0)) AS e FROM lineitem GROUP BY 1)
SELECT id, array_to_string(list_filter(s, lambda x: x <> id % 100), ',') AS others, array_to_string(s[1:3], ',') AS first_three, coalesce(len(e), 0) < len(s) AND coalesce(len(e), 0) > 0 AS proper, len(list_intersect(s, [id % 100, id % 10, 7])) AS shared, array_to_string(list_transform(string_split('12,80,7,90,' || id % 100, ','), lambda x: CASE WHEN x IN ('80', '90') THEN '' ELSE 'p' || x END), '|') AS mapped FROM o""")
def q51_arrays(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_set("l_suppkey")).alias("s"))
    even = F.filter("s", lambda x: x % 2 == 0)
    codes = F.split(F.concat(F.lit("12,80,7,90,"), (F.col("id") % 100).cast("string")), ",")
    mapped = F.transform(codes, lambda x: F.when(x.isin("80", "90"), "").otherwise(F.concat(F.lit("p"), x)))
    shared = F.size(F.array_intersect("s", F.array((F.col("id") % 100).cast("long"), (F.col("id") % 10).cast("long"), F.lit(7).cast("long")))).cast("long")
    return rows.select("id", F.array_join(F.array_remove("s", F.col("id") % 100), ",").alias("others"), F.array_join(F.slice("s", 1, 3), ",").alias("first_three"), (numbers.proper_subset(even, F.col("s")) & (F.size(even) > 0)).alias("proper"), shared.alias("shared"), F.array_join(mapped, "|").alias("mapped"))


@query("""SELECT l_orderkey AS id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS at, l_partkey AS member FROM lineitem""")
def q51b_flatten_nested(spark, sf_dir):
    nested = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("list"))
    return nested.select("id", F.posexplode("list").alias("at", "x")).select("id", "at", F.col("x.l_partkey").alias("member"))
