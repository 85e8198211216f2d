"""Queries of the register's sources and sinks, further pair rules, forms of texts, pages and prototype decisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.operators import classification, linkage, marts
from kindred.plans.catalogue import CAND, candidacies, query
from kindred.plans.q_linkage import SCORED, scored
from kindred.session import scratch, settled, table
from kindred.sources import readers, sinks


@query("SELECT 'nation.parquet' AS file, count(*) AS n FROM nation UNION ALL SELECT 'region.parquet', count(*) FROM region")
def q61_wildcard_scan(spark, sf_dir):
    """Tables found by a pattern, told apart by the files they come from."""
    rows = spark.read.option("mergeSchema", True).parquet(f"{sf_dir}/[nr]*gion.parquet", f"{sf_dir}/[nr]*tion.parquet")
    return rows.groupBy(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")).agg(F.count("*").alias("n"))


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total, CAST(sum(CASE WHEN year(o_orderdate) >= 1998 THEN 1 ELSE 0 END) AS BIGINT) AS with_status FROM orders GROUP BY 1")
def q61b_years_of_text_tables(spark, sf_dir):
    """A text table for each year, the earlier ones without a column; the union is tolerant."""
    rows = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    frames = {}
    for year in [r["year"] for r in rows.select("year").distinct().collect()]:
        columns = ["o_orderkey", "o_totalprice"] + (["o_orderstatus"] if year >= 1998 else [])
        path = scratch(spark, f"year-{year}")
        sinks.write_text_table(rows.where(F.col("year") == year).select(*columns), path)
        frames[year] = readers.read_text_table(spark, path, columns, pattern="*.csv.gz")
    found = readers.union_years(frames)
    return found.groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum(F.col("o_totalprice").cast("double")), 2).alias("total"), F.count("o_orderstatus").alias("with_status"))


@query("SELECT p_brand, count(*) AS n, round(avg(p_retailprice), 6) AS mean FROM part GROUP BY 1")
def q61c_json_parameters(spark, sf_dir):
    """Parameters written as JSON and read by a schema."""
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.round(F.avg("p_retailprice"), 6).alias("mean"))
    path = scratch(spark, "parameters")
    rows.write.json(path)
    return spark.read.schema("p_brand string, n long, mean double").json(path)


@query("SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY 1, 2")
def q61d_wide_to_long(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    wide = rows.groupBy("o_custkey").pivot("year").count()
    return readers.wide_to_long(wide, ["o_custkey"], "year", "n")


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 'PRAVDA' WHEN p_size < 10 THEN 'NEPRAVDA' ELSE p_brand END AS name FROM part")
def q61e_repaired_names(spark, sf_dir):
    broken = F.when(F.col("p_size") > 40, "true").when(F.col("p_size") < 10, "false").otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", readers.repaired_flag(broken).alias("name"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q61f_embedded_state(spark, sf_dir):
    page = F.concat(F.lit("<html><script>const STATE = "), F.col("props"), F.lit(";</script></html>"))
    rows = table(spark, sf_dir, "events").withColumn("html", page)
    return readers.embedded_json(rows, "html", r"(?s)STATE = (\{.*?\});", "k string").select("event_id", "state.k")


@query("SELECT n_nationkey, n_name FROM nation")
def q61g_first_existing(spark, sf_dir):
    return readers.first_existing(spark, f"{sf_dir}/no-such-table.parquet", f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")


@query("SELECT doc_id, CAST(quality AS BIGINT) AS answer FROM labels UNION ALL SELECT doc_id, CAST(-1 AS BIGINT) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q62_first_answer_wins(spark, sf_dir):
    path = scratch(spark, "answers")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("long").alias("answer"))
    sinks.append_new(labels, path, ["doc_id"])
    sinks.append_new(table(spark, sf_dir, "documents").select("doc_id", F.lit(-1).cast("long").alias("answer")), path, ["doc_id"])
    return spark.read.parquet(path)


@query("SELECT n_name, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def q62b_nested_pages(spark, sf_dir):
    """A JSON page for each key in a folder of its own, read back."""
    rows = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    path = scratch(spark, "pages")
    sinks.write_nested(rows, "n_name", path, ["c_mktsegment"], ["c_custkey"])
    back = spark.read.schema("n_name string, rows string, n long").json(path)
    keys = F.from_json("rows", "array<struct<c_custkey: long>>")
    return back.select("n_name", "n", F.aggregate(keys, F.lit(0).cast("long"), lambda s, x: s + x["c_custkey"]).alias("keys"))


@query("SELECT lower(left(r, 2)) AS prefix, count(*) AS n FROM (SELECT DISTINCT c_custkey, r FROM (SELECT c_custkey, c_mktsegment AS r FROM customer)) GROUP BY 1")
def q62c_shard_files(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", text.shard_keys("c_mktsegment").alias("keys"))
    path = scratch(spark, "shards")
    sinks.write_shards(rows, "keys", ["c_custkey"], path)
    return spark.read.schema("prefix string, c_custkey long").json(path).groupBy("prefix").agg(F.count("*").alias("n"))


@query("SELECT 'nation.parquet' AS file_name, TRUE AS filled")
def q62d_sizes(spark, sf_dir):
    return sinks.sizes(table(spark, sf_dir, "nation")).select("file_name", (F.col("file_size") > 0).alias("filled"))


@query(f"WITH {CAND} SELECT a.id AS id_a, b.id AS id_b FROM cand a JOIN cand b ON a.council = b.council AND a.occ = b.occ AND a.year < b.year AND a.key <> b.key AND a.blo <= b.bhi AND b.blo <= a.bhi WHERE a.council <> ''")
def q63_same_first_other_surname(spark, sf_dir):
    rows = candidacies(spark, sf_dir).where("council <> ''").select("id", "key", "year", "blo", "bhi", "council", "occ")
    by = ["council", "occ"]
    pairs = linkage.suffixed(rows, "a", by).join(linkage.suffixed(rows, "b", by), by)
    return pairs.where("year_a < year_b and key_a <> key_b and blo_a <= bhi_b and blo_b <= bhi_a").select("id_a", "id_b")


@query(f"WITH {CAND} SELECT a.id AS id_a, b.id AS id_b FROM cand a JOIN cand b ON a.year = b.year AND a.region = b.region AND a.occ = b.occ AND a.id < b.id AND a.council <> b.council AND a.blo <= b.bhi AND b.blo <= a.bhi WHERE a.region <> ''")
def q63b_same_election_and_district(spark, sf_dir):
    rows = candidacies(spark, sf_dir).where("region <> ''").select("id", "year", "region", "occ", "council", "blo", "bhi")
    return linkage.concurrent_pairs(rows, ["year", "region", "occ"], differ=["council"])


@query(f"WITH {CAND} SELECT a.id AS id_a, b.id AS id_b, (b.age - a.age) - (b.year - a.year) AS gap FROM cand a JOIN cand b ON a.key = b.key AND a.region = b.region AND a.year < b.year WHERE abs((b.age - a.age) - (b.year - a.year)) >= 5")
def q63c_ages_apart(spark, sf_dir):
    rows = candidacies(spark, sf_dir).select("id", "key", "region", "year", "age")
    pairs = linkage.suffixed(rows, "a", ["key", "region"]).join(linkage.suffixed(rows, "b", ["key", "region"]), ["key", "region"])
    gap = (F.col("age_b") - F.col("age_a")) - (F.col("year_b") - F.col("year_a"))
    return pairs.where("year_a < year_b").withColumn("gap", gap).where("abs(gap) >= 5").select("id_a", "id_b", "gap")


@query("""WITH a AS (SELECT o_orderkey AS x, row_number() OVER (ORDER BY md5('a|' || o_orderkey), o_orderkey) AS i FROM orders QUALIFY i <= 400), b AS (SELECT o_orderkey AS y, row_number() OVER (ORDER BY md5('b|' || o_orderkey), o_orderkey) AS i FROM orders QUALIFY i <= 400)
SELECT CAST(i AS INTEGER) AS i, x, y FROM a JOIN b USING (i)""")
def q64_zipped_samples(spark, sf_dir):
    """Two random samples of a fixed size side by side; places are numbered after the samples are drawn."""
    def drawn(seed: str, name: str):
        rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(name), F.md5(F.concat(F.lit(f"{seed}|"), F.col("o_orderkey").cast("string"))).alias("h"))
        return rows.orderBy("h", name).limit(400).withColumn("i", F.row_number().over(Window.orderBy("h", name))).drop("h")

    return drawn("a", "x").join(drawn("b", "y"), "i").select("i", "x", "y")


#: Abbreviations for the test texts.
SHORT = {"lg": "large", "med": "medium", "sm": "small size", "std": "standard"}


@query("""WITH t AS (SELECT p_partkey, lower(replace(replace(replace(p_type || ' ' || p_name, 'LARGE', 'lg'), 'MEDIUM', 'med'), 'SMALL', 'sm')) AS t FROM part),
w AS (SELECT p_partkey, flatten(list_transform(regexp_extract_all(t, '[a-z]+'), lambda x: string_split(CASE x WHEN 'lg' THEN 'large' WHEN 'med' THEN 'medium' WHEN 'sm' THEN 'small size' WHEN 'std' THEN 'standard' ELSE x END, ' '))) AS w FROM t)
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_transform(list_filter(w, lambda x: length(x) >= 3), lambda x: left(x, 5)))), ' ') AS stems FROM w""")
def q65_expanded_stems(spark, sf_dir):
    short = F.replace(F.replace(F.replace(F.concat_ws(" ", "p_type", "p_name"), F.lit("LARGE"), F.lit("lg")), F.lit("MEDIUM"), F.lit("med")), F.lit("SMALL"), F.lit("sm"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.stems(short, expand=SHORT), " ").alias("stems"))


@query("""SELECT o_orderkey, regexp_replace(regexp_replace(lower(' ,' || o_orderpriority || '  x;. '), '\\s+', ' ', 'g'), '^[ ,.;\\-]+|[ ,.;\\-]+$', '', 'g') AS form, replace(format('{:,}', CAST(o_custkey * 1000 AS BIGINT)), ',', ' ') AS spaced,
len(list_filter(list_transform(regexp_split_to_array(o_orderpriority || ', a/b', '[,;/()+]| [-–] '), lambda x: trim(x)), lambda x: x <> '')) AS pieces FROM orders""")
def q65b_forms(spark, sf_dir):
    odd = F.concat(F.lit(" ,"), F.col("o_orderpriority"), F.lit("  x;. "))
    pieces = text.parts(F.concat(F.col("o_orderpriority"), F.lit(", a/b")))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.squeezed(odd).alias("form"), text.thousands(F.col("o_custkey") * 1000).alias("spaced"), F.size(pieces).cast("long").alias("pieces"))


@query("""SELECT doc_id, CASE WHEN contains(t, 'license') AND NOT regexp_matches(t, '(?s)license.*(apache|mit)') THEN 'other' WHEN contains(t, 'license') THEN 'named' ELSE 'none' END AS group_ FROM (SELECT doc_id, lower(text) AS t FROM documents)""")
def q65c_lookahead(spark, sf_dir):
    """A rule with a lookahead: a word that certain others don't follow anywhere."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    rules = [("license", "named"), (r"(?s)^(?!.*license.*(apache|mit)).*license", "other")]
    return classification.by_rules(rows, "t", rules, F.lit("none")).select("doc_id", F.col("group").alias("group_"))


@query("""WITH c AS (SELECT p_type, regexp_extract(p_brand, '[0-9]+') AS code FROM part), n AS (SELECT p_type, left(code, 1) AS major, code, count(*) AS k FROM c GROUP BY 1, 2, 3),
m AS (SELECT p_type, major, row_number() OVER (PARTITION BY p_type ORDER BY sum(k) DESC, major) AS rn FROM n GROUP BY 1, 2), s AS (SELECT n.p_type, n.major, code, count(*) OVER (PARTITION BY n.p_type) AS children, row_number() OVER (PARTITION BY n.p_type ORDER BY k DESC, code) AS rs FROM n JOIN m ON m.p_type = n.p_type AND m.major = n.major AND m.rn = 1)
SELECT p_type, major, code, children = 1 AS only FROM s WHERE rs = 1""")
def q66_two_step_choice(spark, sf_dir):
    """The main group first, then one of its subgroups; an only one needs no choice. Codes: the first digit is the group."""
    code = F.regexp_extract("p_brand", "[0-9]+", 0)
    counts = table(spark, sf_dir, "part").groupBy("p_type", F.left(code, F.lit(1)).alias("major"), code.alias("code")).agg(F.count("*").alias("k"))
    main = counts.groupBy("p_type", "major").agg(F.sum("k").alias("k")).groupBy("p_type").agg(F.min_by("major", F.struct(-F.col("k"), F.col("major"))).alias("major"))
    below = counts.join(main, ["p_type", "major"]).groupBy("p_type", "major").agg(F.min_by("code", F.struct(-F.col("k"), F.col("code"))).alias("code"), F.count("*").alias("children"))
    return below.select("p_type", "major", "code", (F.col("children") == 1).alias("only"))


@query("""WITH f AS (SELECT p_brand, p_type AS k, max(p_size) AS v FROM part WHERE p_size <= 25 GROUP BY 1, 2), s AS (SELECT p_brand, p_type AS k, max(p_size) AS v FROM part WHERE p_size > 10 GROUP BY 1, 2)
SELECT coalesce(f.p_brand, s.p_brand) AS p_brand, coalesce(f.k, s.k) AS k, coalesce(s.v, f.v) AS v FROM f FULL JOIN s ON f.p_brand = s.p_brand AND f.k = s.k""")
def q66b_merged_dictionaries(spark, sf_dir):
    def dictionary(rows, name):
        pairs = rows.groupBy("p_brand", "p_type").agg(F.max("p_size").alias("v"))
        return pairs.groupBy("p_brand").agg(F.map_from_entries(F.collect_list(F.struct("p_type", "v"))).alias(name))

    rows = table(spark, sf_dir, "part")
    both = dictionary(rows.where("p_size <= 25"), "f").join(dictionary(rows.where("p_size > 10"), "s"), "p_brand", "full")
    empty = F.create_map().cast("map<string,int>")
    return both.select("p_brand", F.explode(marts.merged_maps(F.coalesce("f", empty), F.coalesce("s", empty))).alias("k", "v"))


@query("""WITH t AS (SELECT p_partkey, p_type, string_split(p_name, ' ') AS w FROM part), v AS (SELECT w[1] AS token, w[2] AS g, count(*) AS n, sum(count(*)) OVER (PARTITION BY w[1]) AS total FROM t GROUP BY 1, 2), best AS (SELECT token, g, n / total AS share, row_number() OVER (PARTITION BY token ORDER BY n DESC, g) AS rn FROM v),
r AS (SELECT p_partkey, p_type, CASE WHEN p_type LIKE 'PROMO%' THEN 'promo' END AS rule, g, share FROM t LEFT JOIN best ON token = w[1] AND rn = 1)
SELECT p_partkey, coalesce(rule, g) AS group_, rule IS NULL AND share < 0.6 AS lowconf, rule IS NULL AS kw FROM r""")
def q67_second_pass_and_flags(spark, sf_dir):
    """Rules first; what they leave is classified by its leading word, with flags for weak shares and for the way taken."""
    w = F.split("p_name", " ")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.get(w, F.lit(0)).alias("token"), F.get(w, F.lit(1)).alias("g"))
    counts = rows.groupBy("token", "g").agg(F.count("*").alias("n"))
    best = counts.groupBy("token").agg(F.min_by("g", F.struct(-F.col("n"), F.col("g"))).alias("guess"), (F.max("n") / F.sum("n")).alias("share"))
    ruled = classification.by_rules(rows, "p_type", [("^PROMO", "promo")]).drop("src", "g")
    found = ruled.join(best, "token", "left")
    kw = F.col("group").isNull()
    return found.select("p_partkey", F.coalesce("group", "guess").alias("group_"), (kw & (F.col("share") < 0.6)).alias("lowconf"), kw.alias("kw"))


@query("""WITH b AS (SELECT p_brand, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS share, round(median(p_retailprice), 6) AS median, round(avg(p_retailprice), 6) AS mean, round(min(p_retailprice), 6) AS low, round(max(p_retailprice), 6) AS high, round(avg(p_size), 6) AS size, min(p_size) AS smallest, max(p_size) AS largest,
  count(DISTINCT p_type) AS n_types, count(DISTINCT p_name) AS n_names, count(*) FILTER (p_size > 25) AS n_large, round(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END), 9) AS large, CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS place FROM part GROUP BY 1),
t AS (SELECT p_brand, p_type, count(*) AS k FROM part GROUP BY 1, 2), m AS (SELECT p_brand, arg_min(p_type, (-k, p_type)) AS top_type, max(k) AS top_n FROM t GROUP BY 1)
SELECT b.*, top_type, top_n FROM b JOIN m USING (p_brand)""")
def q68_wide_cards(spark, sf_dir):
    """Seventeen figures of each category in one aggregate, with the most common text beside it."""
    rows = table(spark, sf_dir, "part")
    price, size, big = F.col("p_retailprice"), F.col("p_size"), F.col("p_size") > 25
    base = rows.groupBy("p_brand").agg(
        F.count("*").alias("n"), F.round(F.median(price), 6).alias("median"), F.round(F.avg(price), 6).alias("mean"), F.round(F.min(price), 6).alias("low"), F.round(F.max(price), 6).alias("high"), F.round(F.avg(size), 6).alias("size"), F.min(size).alias("smallest"), F.max(size).alias("largest"),
        F.count_distinct("p_type").alias("n_types"), F.count_distinct("p_name").alias("n_names"), F.count_if(big).alias("n_large"), F.round(F.avg(big.cast("double")), 9).alias("large"),
    )
    # windows over one row for each category
    base = base.withColumns({"share": F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 9), "place": F.rank().over(Window.orderBy(F.desc("n")))})
    texts = rows.groupBy("p_brand", "p_type").agg(F.count("*").alias("k")).groupBy("p_brand").agg(F.min_by("p_type", F.struct(-F.col("k"), F.col("p_type"))).alias("top_type"), F.max("k").alias("top_n"))
    return base.join(texts, "p_brand")


@query(f"WITH {CAND}, l AS (SELECT year, council, count(*) AS n, round(avg(age), 6) AS mean FROM cand WHERE council <> '' GROUP BY 1, 2 HAVING count(*) >= 5) SELECT year, council, n, mean, round(percent_rank() OVER (PARTITION BY year ORDER BY mean), 9) AS younger FROM l")
def q69_list_ages(spark, sf_dir):
    lists = candidacies(spark, sf_dir).where("council <> ''").groupBy("year", "council").agg(F.count("*").alias("n"), F.round(F.avg("age"), 6).alias("mean")).where("n >= 5")
    return lists.select("year", "council", "n", "mean", F.round(F.percent_rank().over(Window.partitionBy("year").orderBy("mean")), 9).alias("younger"))


@query(f"""WITH {CAND}, y AS (SELECT key, year, bool_or(party = 'F') AS won, count(*) AS n FROM cand GROUP BY 1, 2), r AS (SELECT key, year, won, lag(year) OVER w AS before, lag(won) OVER w AS won_before, min(year) OVER (PARTITION BY key) AS since, row_number() OVER w AS runs, (SELECT min(year) FROM cand) AS first FROM y WINDOW w AS (PARTITION BY key ORDER BY year))
SELECT key, year, coalesce(before = year - 1 AND won_before, FALSE) AS incumbent, before IS NULL AND year > first AS newcomer, since, CAST(runs AS INTEGER) AS runs, runs >= 7 AS stalwart FROM r""")
def q69b_flags(spark, sf_dir):
    rows = candidacies(spark, sf_dir).groupBy("key", "year").agg(F.bool_or(F.col("party") == "F").alias("won"))
    first = rows.agg(F.min("year").alias("first"))
    line = Window.partitionBy("key").orderBy("year")
    flags = {
        "incumbent": F.coalesce((F.lag("year").over(line) == F.col("year") - 1) & F.lag("won").over(line), F.lit(False)),
        "newcomer": F.lag("year").over(line).isNull() & (F.col("year") > F.col("first")),
        "since": F.min("year").over(Window.partitionBy("key")),
        "runs": F.row_number().over(line),
    }
    found = rows.join(F.broadcast(first)).withColumns(flags)
    return found.select("key", "year", "incumbent", "newcomer", "since", "runs", (F.col("runs") >= 7).alias("stalwart"))


@query(f"WITH {CAND} SELECT year, round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END), 9) AS share, round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END) FILTER (party = 'F'), 9) AS share_won FROM cand JOIN customer ON c_custkey = key GROUP BY 1")
def q69c_shares_by_year(spark, sf_dir):
    rows = candidacies(spark, sf_dir).select("key", "year", "party").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment"), "key")
    own = (F.col("c_mktsegment") == "BUILDING").cast("double")
    return rows.groupBy("year").agg(F.round(F.avg(own), 9).alias("share"), F.round(F.avg(F.when(F.col("party") == "F", own)), 9).alias("share_won"))


@query("""WITH n AS (SELECT n_regionkey, n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2), b AS (SELECT r_name, arg_max(n_name, (n, n_name)) AS largest, max(n) AS n FROM n JOIN region ON r_regionkey = n_regionkey GROUP BY 1) SELECT r_name, largest, n FROM b WHERE r_name IN ('ASIA', 'EUROPE', 'AFRICA', 'AMERICA')""")
def q69d_largest_place(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    wanted = spark.createDataFrame([(x,) for x in ("ASIA", "EUROPE", "AFRICA", "AMERICA")], "r_name string")
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    rows = nations.join(wanted, "r_name", "left_semi").join(counts, "n_nationkey")
    return rows.groupBy("r_name").agg(F.max_by("n_name", F.struct("n", "n_name")).alias("largest"), F.max("n").alias("n"))


@query(f"""WITH {CAND}, d AS (SELECT * FROM cand WHERE district <> ''), e AS (SELECT DISTINCT key, district, year FROM d),
p AS (SELECT a.year, a.party, len(list_intersect(a.parts, b.parts)) AS mates, abs(a.age + 1 - b.age) AS apart FROM d a JOIN d b ON a.district = b.district AND a.occ = b.occ AND b.year = a.year + 1 AND a.key <> b.key AND a.blo <= b.bhi AND b.blo <= a.bhi
  WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.key = a.key AND e.district = a.district AND e.year = a.year + 1) AND NOT EXISTS (SELECT 1 FROM e WHERE e.key = b.key AND e.district = b.district AND e.year = b.year - 1)),
c AS (SELECT year, count(*) FILTER (party = 'F') AS real, count(*) FILTER (party = 'O') AS control, count(*) FILTER (party = 'F' AND apart = 0) AS near_real, count(*) FILTER (party = 'O' AND apart = 0) AS near_control, count(*) FILTER (mates >= 1) AS with_mates FROM p GROUP BY 1)
SELECT year, real, control, near_real, near_control, with_mates, round(near_real - near_control * (real / greatest(control, 1)), 6) + 0.0 AS excess, round(1 - near_control * (real / greatest(control, 1)) / greatest(near_real, 1), 6) + 0.0 AS precision_ FROM c""")
def q70_renamed_counts(spark, sf_dir):
    """Pairs that may be one person under a new name: same place and trade, birth windows that meet, neither name on the
    other's side. A group that can't have changed names tells how many come about by chance."""
    rows = candidacies(spark, sf_dir).where("district <> ''").select("id", "key", "year", "district", "occ", "party", "parts", "age", "blo", "bhi")
    there = rows.select("key", "district", "year").distinct()
    gone = rows.join(there.select("key", "district", (F.col("year") - 1).alias("year")), ["key", "district", "year"], "left_anti")
    new = rows.join(there.select("key", "district", (F.col("year") + 1).alias("year")), ["key", "district", "year"], "left_anti")
    a = linkage.suffixed(gone.withColumn("then", F.col("year") + 1), "a", ["district", "occ", "then"])
    b = linkage.suffixed(new.withColumn("then", F.col("year")), "b", ["district", "occ", "then"])
    pairs = a.join(b, ["district", "occ", "then"]).where("key_a <> key_b and blo_a <= bhi_b and blo_b <= bhi_a")
    near, real, control = F.col("age_a") + 1 == F.col("age_b"), F.col("party_a") == "F", F.col("party_a") == "O"
    counts = pairs.groupBy(F.col("year_a").alias("year")).agg(F.count_if(real).alias("real"), F.count_if(control).alias("control"), F.count_if(real & near).alias("near_real"), F.count_if(control & near).alias("near_control"), F.count_if(F.size(F.array_intersect("parts_a", "parts_b")) >= 1).alias("with_mates"))
    chance = F.col("near_control") * (F.col("real") / F.greatest(F.col("control"), F.lit(1)))
    return counts.withColumns({"excess": F.round(F.col("near_real") - chance, 6) + 0.0, "precision_": F.round(1 - chance / F.greatest(F.col("near_real"), F.lit(1)), 6) + 0.0})


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' AND o_totalprice > 300000 THEN 's01' WHEN o_orderpriority LIKE '1%' THEN 's02' WHEN o_orderpriority LIKE '2%' AND o_totalprice > 300000 THEN 's03' WHEN o_orderpriority LIKE '2%' THEN 's04' WHEN year(o_orderdate) = 1995 THEN 's05' WHEN year(o_orderdate) = 1996 THEN 's06' WHEN year(o_orderdate) = 1997 THEN 's07' WHEN o_orderstatus = 'F' THEN 's08' WHEN o_orderstatus = 'P' THEN 's09' WHEN o_totalprice > 400000 THEN 's10' WHEN o_totalprice > 200000 THEN 's11' WHEN o_totalprice > 100000 THEN 's12' ELSE 's13' END AS stratum FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('blind|' || o_orderkey), o_orderkey) AS rn FROM s) SELECT o_orderkey, stratum FROM r WHERE rn <= 40""")
def q71_thirteen_strata(spark, sf_dir):
    """A blind sample of 40 from each of thirteen strata, by hashes, so it is the same in every run."""
    year, price, urgent = F.year("o_orderdate"), F.col("o_totalprice"), F.left("o_orderpriority", F.lit(1))
    cases = [(urgent == "1") & (price > 300000), urgent == "1", (urgent == "2") & (price > 300000), urgent == "2", year == 1995, year == 1996, year == 1997, F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P", price > 400000, price > 200000, price > 100000]
    chain = F.lit(None).cast("string")
    for k, hit in reversed(list(enumerate(cases, 1))):
        chain = F.when(hit, F.lit(f"s{k:02d}")).otherwise(chain)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(chain, F.lit("s13")).alias("stratum"), F.md5(F.concat(F.lit("blind|"), F.col("o_orderkey").cast("string"))).alias("h"))
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy("stratum").orderBy("h", "o_orderkey")))
    return ranked.where("rn <= 40").select("o_orderkey", "stratum")


PROTOTYPE = """, best AS (SELECT id_a, year_b, max(weight) AS weight, arg_max(geo, (weight, id_b)) AS geo, arg_max(p, (weight, id_b)) AS p FROM normal GROUP BY 1, 2),
decided AS (SELECT *, CASE WHEN p >= 0.999 AND geo IN ('zast', 'okres') THEN 'auto' WHEN p >= 0.9 THEN 'review' WHEN p >= 0.5 THEN 'possible' ELSE 'none' END AS decision FROM best)"""


@query(SCORED + PROTOTYPE + " SELECT id_a, year_b, geo, round(weight, 6) AS weight, decision FROM decided")
def q72_prototype_decisions(spark, sf_dir):
    return prototype(spark, sf_dir).select("id_a", "year_b", "geo", F.round("weight", 6).alias("weight"), "decision")


@query(SCORED + PROTOTYPE + " SELECT decision, count(*) AS n, round(sum(1 - p), 6) AS expected_false, count(DISTINCT id_a) AS events FROM decided GROUP BY 1")
def q72b_prototype_report(spark, sf_dir):
    return prototype(spark, sf_dir).groupBy("decision").agg(F.count("*").alias("n"), F.round(F.sum(1 - F.col("p")), 6).alias("expected_false"), F.count_distinct("id_a").alias("events"))


def prototype(spark, sf_dir):
    """The best pair of each record and later election, and the prototype's ladder of decisions."""
    rows = linkage.normalised(scored(spark, sf_dir), "id_a", "id_b")
    best = rows.groupBy("id_a", "year_b").agg(F.max(F.struct("weight", "id_b", "geo", "p")).alias("b")).select("id_a", "year_b", "b.weight", "b.geo", "b.p")
    ladder = F.when((F.col("p") >= 0.999) & F.col("geo").isin("zast", "okres"), "auto").when(F.col("p") >= 0.9, "review").when(F.col("p") >= 0.5, "possible").otherwise("none")
    return best.withColumn("decision", ladder)


@query("""WITH l AS (SELECT l_orderkey, count(*) AS n, string_agg(l_partkey, ' ' ORDER BY l_linenumber, l_partkey) AS line FROM lineitem GROUP BY 1) SELECT l_orderkey, n, line, CASE WHEN n > 1 THEN 'list' ELSE 'single' END AS kind FROM l""")
def q73_static_lists(spark, sf_dir):
    lists = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("rows"))
    line = F.array_join(F.transform("rows", lambda r: r["l_partkey"].cast("string")), " ")
    return lists.select("l_orderkey", "n", line.alias("line"), F.when(F.col("n") > 1, "list").otherwise("single").alias("kind"))


@query("SELECT DISTINCT n_name AS code FROM nation WHERE length(n_name) = 9")
def q73b_codes_of_a_length(spark, sf_dir):
    return table(spark, sf_dir, "nation").where(F.char_length("n_name") == 9).select(F.col("n_name").alias("code")).distinct()


@query(f"""WITH {CAND}, k AS (SELECT key, council, count(DISTINCT year) AS runs FROM cand WHERE council <> '' GROUP BY 1, 2), c AS (SELECT council, count(*) AS people, count(*) FILTER (runs >= 2) AS loyal FROM k GROUP BY 1) SELECT council, people, loyal FROM c WHERE people BETWEEN 20 AND 2000 ORDER BY loyal DESC, council LIMIT 10""")
def q73c_picked_councils(spark, sf_dir):
    runs = candidacies(spark, sf_dir).where("council <> ''").groupBy("key", "council").agg(F.count_distinct("year").alias("runs"))
    found = runs.groupBy("council").agg(F.count("*").alias("people"), F.count_if(F.col("runs") >= 2).alias("loyal"))
    return found.where("people between 20 and 2000").orderBy(F.desc("loyal"), "council").limit(10)


@query("""WITH w AS (SELECT user_id, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, arg_max(event_type, (ts, event_id)) AS last FROM events GROUP BY 1, 2), c AS (SELECT *, lag(last) OVER (PARTITION BY user_id ORDER BY slot) AS before FROM w) SELECT user_id, CAST(slot AS VARCHAR) AS slot, last FROM c WHERE before IS NULL OR before <> last""")
def q74_changed_snapshots(spark, sf_dir):
    """The last state of each quarter of an hour, where it is another one than before."""
    rows = table(spark, sf_dir, "events").groupBy("user_id", F.window(F.col("ts").cast("timestamp"), "15 minutes").alias("w")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last"))
    rows = rows.select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("slot"), "last")
    before = F.lag("last").over(Window.partitionBy("user_id").orderBy("slot"))
    return rows.withColumn("before", before).where(~F.col("before").eqNullSafe(F.col("last"))).drop("before")


@query("""WITH a AS (SELECT o_custkey AS u, o_orderkey AS x, o_orderstatus AS own FROM orders), p AS (SELECT a.x AS x, b.x AS y, a.own = b.own AS ours, abs(a.x - b.x) < 4000 AS theirs FROM a JOIN a b ON a.u = b.u AND a.x < b.x)
SELECT count(*) FILTER (ours AND theirs) AS both_, count(*) FILTER (ours AND NOT theirs) AS only_ours, count(*) FILTER (NOT ours AND theirs) AS only_theirs, count(*) FILTER (NOT ours AND NOT theirs) AS neither FROM p""")
def q75_cross_pairs(spark, sf_dir):
    """Pairs of one name that two linkages put together or apart."""
    from kindred.operators import evaluation

    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("x"), F.col("o_orderstatus").alias("own"))
    pairs = linkage.suffixed(rows, "a", ["o_custkey"]).join(linkage.suffixed(rows, "b", ["o_custkey"]), "o_custkey").where("x_a < x_b")
    marked = pairs.select((F.col("own_a") == F.col("own_b")).alias("ours"), (F.abs(F.col("x_a") - F.col("x_b")) < 4000).alias("theirs"))
    return evaluation.agreement(marked, "ours", "theirs").select(F.col("both").alias("both_"), "only_ours", "only_theirs", "neither")


@query(f"""WITH {CAND}, c AS (SELECT id, key, year, parts, price, party, region, blo, bhi, list_sort(list_distinct(regexp_extract_all(lower(occ), '[a-z]+'))) AS t FROM cand),
p AS (SELECT a.id AS id_a, b.id AS id_b, a.t AS ta, b.t AS tb, a.parts AS pa, b.parts AS pb, a.price AS ra, b.price AS rb, a.region AS ga, b.region AS gb FROM c a JOIN c b ON a.key = b.key AND a.year < b.year AND date_diff('day', greatest(a.blo, b.blo), least(a.bhi, b.bhi)) + 1 > -366)
SELECT id_a, id_b, CASE WHEN len(ta) = 0 AND len(tb) = 0 THEN 'none' WHEN ta = tb THEN 'same' WHEN len(list_filter(ta, lambda x: NOT list_contains(tb, x))) = 0 AND len(ta) < len(tb) THEN 'gained' ELSE 'other' END AS titles,
  CASE WHEN len(pa) = 0 OR len(pb) = 0 THEN 'na' WHEN len(list_intersect(pa, pb)) > 0 THEN 'shared' ELSE 'none' END AS list_party,
  CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 'missing' WHEN ta = tb THEN 'same' WHEN rb > 350000 AND NOT ra > 350000 THEN 'to_retired' WHEN ra < 20000 AND NOT rb < 20000 THEN 'from_student'
    WHEN len(list_intersect(ta, tb)) >= 0.5 * len(list_distinct(list_concat(ta, tb))) OR len(list_filter(ta, lambda x: NOT list_contains(tb, x))) = 0 OR len(list_filter(tb, lambda x: NOT list_contains(ta, x))) = 0 THEN 'similar' WHEN ga <> '' AND ga = gb THEN 'same_field' ELSE 'diff' END AS occ FROM p""")
def q76_further_levels(spark, sf_dir):
    """Levels of titles, list parties and occupations of the pairs of a name."""
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower("occ"), F.lit("([a-z]+)"), 1)))
    rows = candidacies(spark, sf_dir).select("id", "key", "year", "blo", "bhi", "parts", "region", words.alias("t"), (F.col("price") > 350000).alias("retired"), (F.col("price") < 20000).alias("student"))
    pairs = linkage.blocked_pairs(rows)
    return pairs.select("id_a", "id_b", linkage.titles_level("t").alias("titles"), linkage.list_party_level("parts").alias("list_party"), linkage.occupation_level("t", "region", "retired", "student").alias("occ"))


@query(f"""WITH {CAND}, n AS (SELECT count(*) AS c FROM cand), sa AS (SELECT cand.*, CAST('0x' || substr(md5('strangersa|' || key || '|' || id), 1, 7) AS BIGINT) % (SELECT greatest(1, c * c // 40000) FROM n) AS slot FROM cand), sb AS (SELECT cand.*, CAST('0x' || substr(md5('strangersb|' || key || '|' || id), 1, 7) AS BIGINT) % (SELECT greatest(1, c * c // 40000) FROM n) AS slot FROM cand),
far AS (SELECT 'u' AS kind, a.party = b.party AS same, a.region <> '' AND a.region = b.region AS near FROM sa a JOIN sb b ON a.slot = b.slot AND a.year < b.year AND a.key <> b.key),
num AS (SELECT *, row_number() OVER (PARTITION BY council ORDER BY id) AS rn, count(*) OVER (PARTITION BY council) AS size FROM cand), pick AS (SELECT *, CAST('0x' || substr(md5('partner|' || id), 1, 7) AS BIGINT) % size + 1 AS want FROM num),
loc AS (SELECT 'u_loc' AS kind, a.party = b.party AS same, a.region <> '' AND a.region = b.region AS near FROM pick b JOIN num a ON a.council = b.council AND a.rn = b.want WHERE a.year < b.year AND a.key <> b.key),
x AS (SELECT * FROM far UNION ALL SELECT * FROM loc) SELECT kind, count(*) AS n, round(avg(CASE WHEN same THEN 1.0 ELSE 0.0 END), 9) AS party, round(avg(CASE WHEN near THEN 1.0 ELSE 0.0 END), 9) AS region FROM x GROUP BY 1""")
def q76b_strangers_agree(spark, sf_dir):
    """How often strangers agree, drawn from all rows and from those of one place: what u and u_loc are made from."""
    rows = settled(candidacies(spark, sf_dir).select("id", "key", "year", "party", "region", "council"), "rows")
    far = linkage.strangers(rows, 20_000, rows.count())
    near = linkage.partners_within(rows, rows, "council").where("year_a < year_b and key_a <> key_b")
    found = None
    for kind, pairs in (("u", far), ("u_loc", near)):
        own = pairs.select(F.lit(kind).alias("kind"), (F.col("party_a") == F.col("party_b")).alias("same"), linkage.known_and_equal("region").alias("near"))
        found = own if found is None else found.unionByName(own)
    return found.groupBy("kind").agg(F.count("*").alias("n"), F.round(F.avg(F.col("same").cast("double")), 9).alias("party"), F.round(F.avg(F.col("near").cast("double")), 9).alias("region"))
