"""Queries of the marts, the evaluation, sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.operators import evaluation, marts
from kindred.plans.catalogue import query
from kindred.session import scratch, table
from kindred.sources import readers, sinks
from kindred.streaming import changes


@query("""WITH x AS (SELECT *, o_totalprice > 150000 AS ours, o_orderstatus = 'F' AS theirs FROM orders)
SELECT count(*) FILTER (ours AND theirs) AS both, count(*) FILTER (ours AND NOT theirs) AS only_ours, count(*) FILTER (NOT ours AND theirs) AS only_theirs, count(*) FILTER (NOT ours AND NOT theirs) AS neither,
round(count(*) FILTER (ours AND theirs) / greatest(count(*) FILTER (ours), 1), 9) AS precision, round(count(*) FILTER (ours AND theirs) / greatest(count(*) FILTER (theirs), 1), 9) AS recall FROM x""")
def q17_agreement(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select((F.col("o_totalprice") > 150000).alias("ours"), (F.col("o_orderstatus") == "F").alias("theirs"))
    return evaluation.agreement(rows, "ours", "theirs").withColumns({"precision": F.round("precision", 9), "recall": F.round("recall", 9)})


@query("""WITH t AS (SELECT p_type, count(*) AS n, min(p_brand) = 'Brand#11' AS agree FROM part GROUP BY 1) SELECT round(sum(CASE WHEN NOT agree THEN n ELSE 0 END) / sum(n), 9) AS disagreement, count(*) FILTER (NOT agree) AS n_differ, count(*) AS n_texts FROM t""")
def q17b_weighted_disagreement(spark, sf_dir):
    texts = table(spark, sf_dir, "part").groupBy("p_type").agg(F.count("*").alias("n"), (F.min("p_brand") == "Brand#11").alias("agree"))
    return evaluation.weighted_disagreement(texts, "n", "agree").withColumn("disagreement", F.round("disagreement", 9))


SCORED = "s AS (SELECT doc_id, quality, n_chars // 100 AS v FROM labels JOIN documents USING (doc_id))"


def scored(spark, sf_dir):
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "quality", F.floor(F.col("n_chars") / 100).alias("v"))


@query(f"WITH {SCORED} SELECT round(avg(CASE WHEN a.v > b.v THEN 1.0 WHEN a.v = b.v THEN 0.5 ELSE 0.0 END), 9) AS auc, (SELECT count(*) FROM s WHERE quality = 1) AS n_pos, (SELECT count(*) FROM s WHERE quality <> 1) AS n_neg FROM s a JOIN s b ON a.quality = 1 AND b.quality <> 1")
def q18_auc(spark, sf_dir):
    return evaluation.auc(scored(spark, sf_dir), "v", "quality").withColumn("auc", F.round("auc", 9))


@query(f"""WITH {SCORED}, r AS (SELECT CAST(t AS DOUBLE) AS threshold, avg(CASE WHEN quality = 1 THEN CASE WHEN v >= t THEN 1.0 ELSE 0.0 END END) AS tpr, avg(CASE WHEN quality <> 1 THEN CASE WHEN v >= t THEN 1.0 ELSE 0.0 END END) AS fpr FROM s, (SELECT unnest([1, 5, 20, 50]) AS t) GROUP BY t)
SELECT threshold, round(tpr, 9) AS tpr, round(fpr, 9) AS fpr, round(tpr / greatest(fpr, 0.001), 6) AS lr_yes, round((1 - tpr) / greatest(1 - fpr, 0.001), 6) AS lr_no FROM r""")
def q18b_sweep(spark, sf_dir):
    rows = evaluation.sweep(scored(spark, sf_dir), "v", "quality", [1, 5, 20, 50])
    return rows.select("threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"), F.round("lr_yes", 6).alias("lr_yes"), F.round("lr_no", 6).alias("lr_no"))


@query(f"WITH {SCORED}, c AS (SELECT quantile_cont(v, 0.99) AS threshold FROM s WHERE quality <> 1) SELECT round(threshold, 6) AS threshold, round(avg(CASE WHEN v > threshold THEN 1.0 ELSE 0.0 END), 9) AS tpr FROM s, c WHERE quality = 1 GROUP BY threshold")
def q18c_recall_at_one_percent(spark, sf_dir):
    return evaluation.recall_at(scored(spark, sf_dir), "v", "quality").select(F.round("threshold", 6).alias("threshold"), F.round("tpr", 9).alias("tpr"))


@query("SELECT o_orderpriority, round(sum(1 - (o_orderkey % 100) / 100), 6) AS expected_false, count(*) AS n FROM orders GROUP BY 1")
def q57_expected_false(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").withColumn("p", (F.col("o_orderkey") % 100) / 100)
    return evaluation.expected_false(rows, "p", "o_orderpriority").withColumn("expected_false", F.round("expected_false", 6))


@query("SELECT p_brand, count(*) AS n, count(*) FILTER (p_size > 25) AS large FROM part GROUP BY 1 HAVING count(*) FILTER (p_size > 25) > 0 ORDER BY large DESC, p_brand LIMIT 10")
def q57b_disagreement_list(spark, sf_dir):
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("p_size") > 25).alias("large"))
    return rows.where("large > 0").orderBy(F.desc("large"), "p_brand").limit(10)


@query()
def q58_logistic_combination(spark, sf_dir):
    rows = scored(spark, sf_dir).withColumns({"x": F.log1p("v"), "z": F.col("doc_id") % 7, "fold": (F.col("doc_id") % 2).cast("int")})
    return evaluation.combined(rows, ["x", "z"], "quality", "fold").select("doc_id", "quality", "combined")


@query("""SELECT c.o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS since, CAST(max(year(o_orderdate)) AS INTEGER) AS last, count(DISTINCT year(o_orderdate)) AS n_runs, string_agg(year(o_orderdate) || ':' || o_orderkey, ' ' ORDER BY year(o_orderdate), o_orderkey) AS history, count(DISTINCT year(o_orderdate)) >= 7 AS stalwart FROM orders c GROUP BY 1""")
def q54_history(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey")
    found = marts.history(rows, "o_custkey", ["year"], ["o_orderkey"])
    lines = F.transform("history", lambda h: F.concat_ws(":", h["year"].cast("string"), h["o_orderkey"].cast("string")))
    return found.select("o_custkey", "since", "last", "n_runs", F.array_join(lines, " ").alias("history"), (F.col("n_runs") >= 7).alias("stalwart"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS v, count(*) OVER (PARTITION BY l_orderkey) // 2 AS seats FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY v DESC) AS INTEGER) AS vote_rank, round(v / sum(v) OVER (PARTITION BY l_orderkey), 8) AS vote_share, rank() OVER (PARTITION BY l_orderkey ORDER BY v DESC) <= seats AND l_linenumber > seats AS lifted FROM x""")
def q54b_preference_votes(spark, sf_dir):
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "lineitem").withColumn("seats", F.floor(F.count("*").over(Window.partitionBy("l_orderkey")) / 2))
    rows = rows.withColumns(marts.skipped_ahead("l_extendedprice", "l_linenumber", "seats", "l_orderkey"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "vote_rank", F.round("vote_share", 8).alias("vote_share"), "lifted")


@query("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_totalprice > 200000 THEN 'large' END, CASE WHEN o_orderstatus = 'F' THEN 'done' END, CASE WHEN o_orderpriority LIKE '1%' THEN 'urgent' END], lambda x: x IS NOT NULL), '; ') AS why FROM orders""")
def q54c_reasons(spark, sf_dir):
    why = marts.reasons((F.col("o_totalprice") > 200000, "large"), (F.col("o_orderstatus") == "F", "done"), (F.col("o_orderpriority").startswith("1"), "urgent"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(why, "; ").alias("why"))


@query("""SELECT name, min(p_partkey) AS id FROM (SELECT p_partkey, unnest([p_brand, p_type, left(p_name, 4)]) AS name FROM part) WHERE name <> '' GROUP BY 1""")
def q54d_list_identity(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.left("p_name", F.lit(4)).alias("short"))
    return marts.list_identity(rows, ["p_brand", "p_type", "short"], "p_partkey")


@query("""SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY year(o_orderdate)), 9) AS share FROM orders GROUP BY 1, 2, year(o_orderdate)""")
def q54e_class_shares(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    return marts.value_shares(rows, "o_orderstatus", ["year"]).select("year", "o_orderstatus", "n", F.round("share", 9).alias("share"))


@query("""WITH b AS (SELECT p_brand, count(*) AS n, round(median(p_retailprice), 6) AS median, round(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END), 9) AS rate, count(DISTINCT p_type) AS n_texts FROM part GROUP BY 1),
t AS (SELECT p_brand, p_type, count(*) AS k, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS rn FROM part GROUP BY 1, 2 HAVING count(*) >= 5), l AS (SELECT p_brand, string_agg(p_type || '=' || k, ', ' ORDER BY rn) AS top FROM t WHERE rn <= 50 GROUP BY 1) SELECT b.*, top FROM b LEFT JOIN l USING (p_brand)""")
def q56_cards(spark, sf_dir):
    rows = marts.cards(table(spark, sf_dir, "part"), "p_brand", "p_retailprice", F.col("p_size") > 25, "p_type")
    top = F.array_join(F.transform("top", lambda x: F.concat_ws("=", x["p_type"], x["k"].cast("string"))), ", ")
    return rows.select("p_brand", "n", F.round("median", 6).alias("median"), F.round("rate", 9).alias("rate"), "n_texts", top.alias("top"))


@query("""SELECT n_name, count(*) AS n, md5(string_agg(c_custkey || '/' || c_mktsegment, ',' ORDER BY c_custkey)) AS rows FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def q31_nested_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    found = sinks.nested(rows, "n_name", ["c_mktsegment"], ["c_custkey"])
    parsed = F.from_json("rows", "array<struct<c_custkey: long, c_mktsegment: string>>")
    return found.select("n_name", "n", F.md5(F.array_join(F.transform(parsed, lambda x: F.concat_ws("/", x["c_custkey"].cast("string"), x["c_mktsegment"])), ",")).alias("rows"))


@query("""SELECT 'nation' AS name, count(*) AS n, CAST(sum(n_nationkey) AS BIGINT) AS keys FROM nation UNION ALL SELECT 'region', count(*), CAST(sum(r_regionkey) AS BIGINT) FROM region UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier""")
def q33_many_tables(spark, sf_dir):
    frames = [table(spark, sf_dir, n).select(F.lit(n).alias("name"), F.col(k).cast("long").alias("k")) for n, k in (("nation", "n_nationkey"), ("region", "r_regionkey"), ("supplier", "s_suppkey"))]
    rows = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return rows.groupBy("name").agg(F.count("*").alias("n"), F.sum("k").alias("keys"))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END AS priority FROM orders""")
def q34_text_round_trip(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("priority"))
    path = scratch(spark, "text-table")
    sinks.write_text_table(rows, path)
    back = readers.read_text_table(spark, path, rows.columns)
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"), "day", "priority")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, '' AS p_colour, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def q35_tolerant_projection(spark, sf_dir):
    return readers.tolerant(table(spark, sf_dir, "part"), {"p_partkey": "string", "p_brand": "string", "p_colour": "string", "p_size": "string"})


@query("""SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1""")
def q36_last_write(spark, sf_dir):
    return readers.latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["value", "event_type"])


@query("""WITH a AS (SELECT CASE WHEN quality = 1 THEN 'pair@1' ELSE 'occ@1' END AS kind, doc_id AS a, toxic AS b, doc_id / 1000 AS cost FROM labels) SELECT kind, count(*) AS n, round(sum(cost), 4) AS cost FROM a WHERE kind LIKE 'pair@%' GROUP BY 1""")
def q38_cost_report(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select(F.when(F.col("quality") == 1, "pair@1").otherwise("occ@1").alias("kind"), F.col("doc_id").alias("a"), F.col("toxic").alias("b"), (F.col("doc_id") / 1000).alias("cost"))
    return readers.cost_report(rows, "pair@%")


@query("""SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS answer FROM documents LEFT JOIN (SELECT doc_id, quality FROM labels WHERE toxic = 0) USING (doc_id)""")
def q38b_answers(spark, sf_dir):
    pairs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("a"), F.lit(0).alias("b"))
    answers = table(spark, sf_dir, "labels").select(F.lit("pair@1").alias("kind"), F.col("doc_id").alias("a"), F.col("toxic").alias("b"), F.col("quality").cast("double").alias("p"))
    return readers.with_answers(pairs, answers, "pair@1").select(F.col("a").alias("doc_id"), "answer")


@query("""WITH e AS (SELECT *, md5(event_type) AS digest, lag(md5(event_type)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT event_id, user_id, digest FROM e WHERE before IS NULL OR before <> digest""")
def q29_changes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("digest", F.md5("event_type"))
    return changes.changed(rows, "user_id", ["ts", "event_id"], "digest").select("event_id", "user_id", "digest")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, props LIKE '{%' AS is_json FROM events""")
def q29b_json(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("props").startswith("{").alias("is_json"))


@query("""WITH e AS (SELECT *, md5(event_type) AS digest, lag(md5(event_type)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT event_id, user_id, digest FROM e WHERE before IS NULL OR before <> digest""")
def q30_change_stream(spark, sf_dir):
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(_folder(spark, sf_dir, "events"))
    stream = stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", F.md5("event_type").alias("digest"))
    path, checkpoint = scratch(spark, "changes"), scratch(spark, "changes-state")
    changes.run_available(changes.changed_stream(stream, "user_id", ["ts", "event_id"], "digest"), path, checkpoint)
    return spark.read.parquet(path).select("event_id", "user_id", "digest")


@query("""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def q30b_daily_windows(spark, sf_dir):
    rows = changes.windowed(table(spark, sf_dir, "events"), "ts", "1 day", "event_type")
    return rows.select(F.col("window.start").cast("date").cast("string").alias("day"), "event_type", "n")


@query("""WITH o AS (SELECT *, min(ts) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id) AS opened FROM events) SELECT event_id, user_id FROM o WHERE ts >= opened""")
def q59_gated(spark, sf_dir):
    rows = changes.gated(table(spark, sf_dir, "events"), "user_id", "ts", F.col("event_type") == "purchase")
    return rows.select("event_id", "user_id")


@query("SELECT event_id, user_id, value FROM events")
def q59b_restarted_archive(spark, sf_dir):
    """An archive written in two runs of one checkpoint: the second run adds nothing twice."""
    path, checkpoint, feed = scratch(spark, "archive"), scratch(spark, "archive-state"), _folder(spark, sf_dir, "events")
    for _ in range(2):
        stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(feed).select("event_id", "user_id", "value")
        changes.run_available(stream, path, checkpoint)
    return spark.read.parquet(path)


def _folder(spark, sf_dir: str, name: str) -> str:
    """A folder that a file stream can watch: the table's copy in the shared folder."""
    path = scratch(spark, f"feed-{name}")
    table(spark, sf_dir, name).write.parquet(path)
    return path
