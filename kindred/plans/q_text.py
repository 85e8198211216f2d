"""Queries over free texts: folding, tokens, rules, votes, search, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from kindred.functions import numbers, text
from kindred.operators import classification
from kindred.operators import sets as sets_join
from kindred.plans.catalogue import query
from kindred.session import settled, table

#: Folding in SQL for the letters of the test texts.
FOLD = f"trim(lower(translate({{}}, '{text.ACCENTED}', '{text.PLAIN}')))"


def fold(c: str) -> str:
    return FOLD.format(c)


@query(f"""WITH f AS (SELECT doc_id, source, {fold("text")} AS t FROM documents), w AS (SELECT doc_id, source, regexp_extract_all(t, '[a-z]+') AS w FROM f),
s AS (SELECT doc_id, source, list_sort(list_distinct(list_transform(list_filter(w, lambda x: length(x) >= 3), lambda x: left(x, 5)))) AS s FROM w)
SELECT doc_id, len(s) AS n_stems, md5(array_to_string(s, ',')) AS digest FROM s""")
def q23_stems(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", text.stems("text").alias("s"))
    return rows.select("doc_id", F.size("s").cast("long").alias("n_stems"), F.md5(F.array_join("s", ",")).alias("digest"))


@query(f"""WITH f AS (SELECT doc_id, source, {fold("text")} AS t FROM documents), s AS (SELECT source, list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(t, '[a-z]+'), lambda x: length(x) >= 3), lambda x: left(x, 5)))) AS s, min(doc_id) AS doc, count(*) AS copies FROM f GROUP BY 1, 2),
p AS (SELECT a.doc AS x, b.doc AS y, a.copies AS cx, b.copies AS cy, len(a.s) AS nx, len(b.s) AS ny, len(list_intersect(a.s, b.s)) AS o FROM s a JOIN s b ON a.source = b.source AND a.doc < b.doc AND least(len(a.s), len(b.s)) > 0 AND 10 * least(len(a.s), len(b.s)) >= 8 * greatest(len(a.s), len(b.s)))
SELECT x AS doc_a, y AS doc_b, cx AS copies_a, cy AS copies_b, round(o / (nx + ny - o), 9) AS jaccard FROM p WHERE 10 * o >= 8 * (nx + ny - o)""")
def q23b_jaccard_of_copies(spark, sf_dir):
    """Pairs of texts of one source whose stems have a Jaccard similarity of 0.8 or more, equal stem sets being one row
    with its number of copies. Candidates come from kindred.operators.sets; the sets themselves decide."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.array_join(text.stems("text"), " ").alias("words"))
    # a condition on words would go below the aggregate and fold every text a second time
    sets = rows.groupBy("source", "words").agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.max(F.length("words")).alias("long"))
    sets = settled(sets.where("long > 0").drop("long"), "stem-sets")
    near = settled(sets_join.candidates(sets, "source", "doc", "words"), "stem-candidates")
    one = near.select(F.explode(F.array("doc_a", "doc_b")).alias("doc")).distinct()
    wanted = settled(sets.join(one, "doc", "left_semi"), "stem-sets-of-candidates")
    left, right = (wanted.select("source", F.col("doc").alias(f"doc_{x}"), F.split("words", " ").alias(f"s_{x}"), F.col("copies").alias(f"copies_{x}")) for x in "ab")
    pairs = near.join(left, "doc_a").join(right, ["source", "doc_b"]).withColumns({"o": F.size(F.array_intersect("s_a", "s_b")), "all": F.size("s_a") + F.size("s_b")})
    return pairs.where("10 * o >= 8 * (all - o)").select("doc_a", "doc_b", "copies_a", "copies_b", F.round(numbers.jaccard(F.col("s_a"), F.col("s_b")), 9).alias("jaccard"))


VOTES = """known AS (SELECT doc_id, lang, list_distinct(list_transform(regexp_extract_all(lower(text), '[\\p{L}]{2,}'), lambda x: x)) AS w FROM documents),
c AS (SELECT token, lang, count(*) AS n FROM (SELECT unnest(w) AS token, lang FROM known) GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY token) AS total, row_number() OVER (PARTITION BY token ORDER BY n DESC, lang) AS rn FROM c),
model AS (SELECT token, lang AS grp, n, n / total AS share FROM t WHERE rn = 1 AND total >= 3 AND n >= 0.85 * total)"""


@query(f"WITH {VOTES} SELECT token, grp AS group_, n, round(share, 9) AS share FROM model")
def q24_keyword_votes(spark, sf_dir):
    return classification.votes(table(spark, sf_dir, "documents"), "text", "lang").select("token", F.col("group").alias("group_"), "n", F.round("share", 9).alias("share"))


@query("""WITH k AS (SELECT doc_id AS id, lang AS g, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}]{2,}'))) AS token FROM documents), c AS (SELECT token, g, count(*) AS n FROM k GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY token) AS total FROM c),
r AS (SELECT k.id, t.g, t.n - CASE WHEN k.g = t.g THEN 1 ELSE 0 END AS n, t.total - 1 AS total FROM k JOIN t USING (token)), v AS (SELECT id, g, count(*) AS votes FROM r WHERE total >= 3 AND n >= 0.85 * total GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, g) AS rn FROM v)
SELECT doc_id, lang AS own, b.g AS guess, b.g = lang AS right_ FROM documents LEFT JOIN b ON b.id = doc_id AND rn = 1""")
def q24b_voted_texts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("own"))
    return classification.left_out(rows, "doc_id", "text", "own").select("doc_id", "own", "guess", (F.col("guess") == F.col("own")).alias("right_"))


@query("""WITH k AS (SELECT p_partkey AS id, p_name, p_brand AS g, unnest(list_distinct(regexp_extract_all(lower(p_name), '[\\p{L}]{2,}'))) AS token FROM part), c AS (SELECT token, g, count(*) AS n FROM k GROUP BY 1, 2), t AS (SELECT *, sum(n) OVER (PARTITION BY token) AS total FROM c),
r AS (SELECT k.id, t.g, t.n - CASE WHEN k.g = t.g THEN 1 ELSE 0 END AS n, t.total - 1 AS total FROM k JOIN t USING (token)), v AS (SELECT id, g, count(*) AS votes FROM r WHERE total >= 3 AND n >= 0.3 * total GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY votes DESC, g) AS rn FROM v)
SELECT p_partkey, p_brand AS own, b.g AS guess FROM part LEFT JOIN b ON b.id = p_partkey AND rn = 1""")
def q24c_leave_one_out(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.col("p_brand").alias("own"))
    return classification.left_out(rows, "p_partkey", "p_name", "own", share=0.3).select("p_partkey", "own", "guess")


RULES = (("(?U)(the|und|les)", "common"), ("^[a-z]{1,4}\\b", "short"), ("license", "legal"), ("\\d{4,}", "number"))


@query("""SELECT doc_id, CASE WHEN n_chars > 5000 THEN lang WHEN regexp_matches(t, '[0-9]{4,}') THEN 'number' WHEN contains(t, 'license') THEN 'legal' WHEN regexp_matches(t, '^[a-z]{1,4}($|[^a-z0-9_àâäáãéèêëíîïóôöõúùûüñçßìòœ])') THEN 'short' WHEN regexp_matches(t, '(the|und|les)') THEN 'common' ELSE lang END AS group_,
CASE WHEN n_chars > 5000 THEN 'model' WHEN regexp_matches(t, '[0-9]{4,}') OR contains(t, 'license') OR regexp_matches(t, '^[a-z]{1,4}($|[^a-z0-9_àâäáãéèêëíîïóôöõúùûüñçßìòœ])') OR regexp_matches(t, '(the|und|les)') THEN 'rule' ELSE 'model' END AS src FROM (SELECT doc_id, lang, n_chars, lower(text) AS t FROM documents)""")
def q25_ordered_rules(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", F.lower("text").alias("t"))
    rules = [(p.replace("\\b", "($|[^a-z0-9_àâäáãéèêëíîïóôöõúùûüñçßìòœ])"), g) for p, g in RULES]
    found = classification.by_rules(rows, "t", rules, F.col("lang"), F.col("n_chars") > 5000)
    return found.select("doc_id", F.col("group").alias("group_"), "src")


@query("""WITH s AS (SELECT l.doc_id, CASE WHEN n_chars > 2000 THEN 'long' ELSE lang END AS g0, CASE WHEN n_chars > 2000 THEN 'rule' ELSE 'model' END AS src0, CASE WHEN l.quality = 0 THEN 'junk' ELSE '' END AS other, l.toxic = 0 AS agrees FROM labels l JOIN documents d USING (doc_id))
SELECT doc_id, CASE WHEN src0 <> 'rule' AND NOT agrees AND other <> '' THEN other ELSE g0 END AS group_, CASE WHEN src0 <> 'rule' AND NOT agrees AND other <> '' THEN 'second' ELSE src0 END AS src FROM s""")
def q56b_second_opinion(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")
    rows = docs.select("doc_id", F.when(F.col("n_chars") > 2000, "long").otherwise(F.col("lang")).alias("group"), F.when(F.col("n_chars") > 2000, "rule").otherwise("model").alias("src"))
    second = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 0, "junk").otherwise("").alias("other"), (F.col("toxic") == 0).alias("agrees"))
    return classification.corrected(rows, second, "doc_id").select("doc_id", F.col("group").alias("group_"), "src")


@query("""SELECT page_id, split_part(url, '://', 1) AS scheme, regexp_extract(url, '://([^/?#]*)', 1) AS host, split_part(regexp_extract(url, '://[^/]*/([^?#]*)', 1), '/', 1) AS lang, length(url) - length(replace(url, '/', '')) AS slashes, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
  len(regexp_extract_all(html, '<p[ >]')) AS paragraphs, regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS tracked, sha256(regexp_replace(html, 'track\\([0-9]+\\)', '', 'g')) AS digest FROM pages""")
def q26_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    return rows.select(
        "page_id", F.split_part("url", F.lit("://"), F.lit(1)).alias("scheme"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("host"), F.split_part(F.regexp_extract("url", "://[^/]*/([^?#]*)", 1), F.lit("/"), F.lit(1)).alias("lang"), F.regexp_count("url", F.lit("/")).cast("long").alias("slashes"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<p[ >]")).cast("long").alias("paragraphs"), F.regexp_extract("html", r"track\(([0-9]+)\)", 1).alias("tracked"), F.sha2(F.regexp_replace("html", r"track\([0-9]+\)", ""), 256).alias("digest"),
    )


@query(f"""SELECT p_partkey, CASE WHEN {fold("p_name")} = 'part' THEN 0 WHEN starts_with({fold("p_name")}, 'p') THEN 1 ELSE 2 END AS tier FROM part WHERE contains({fold("p_name")}, 'a') AND contains({fold("p_name")}, 'r') ORDER BY tier, p_size DESC, p_partkey LIMIT 40""")
def q28_search(spark, sf_dir):
    rows = table(spark, sf_dir, "part").where(text.contains_all_words("p_name", "A r"))
    tier = F.when(text.fold("p_name") == "part", 0).when(text.fold("p_name").startswith("p"), 1).otherwise(2)
    return rows.withColumn("tier", tier).orderBy("tier", F.desc("p_size"), "p_partkey").limit(40).select("p_partkey", "tier")


@query(f"""WITH w AS (SELECT c_custkey, list_distinct(list_filter(list_transform(regexp_split_to_array({fold("c_name")}, '[\\s#-]+'), lambda x: left(x, 2)), lambda x: x <> '')) AS k FROM customer), u AS (SELECT c_custkey, unnest(k) AS prefix FROM w) SELECT prefix, count(*) AS n, min(c_custkey) AS first FROM u GROUP BY 1""")
def q28b_shards(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.explode(text.shard_keys(F.replace("c_name", F.lit("#"), F.lit(" ")))).alias("prefix"))
    return rows.groupBy("prefix").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first"))


@query("""WITH t AS (SELECT p_partkey, regexp_split_to_array(trim(p_name), '\\s+') AS w FROM part), known AS (SELECT DISTINCT w[1] AS t, 'one' AS g FROM t UNION SELECT DISTINCT array_to_string(w[1:2], ' '), 'two' FROM t JOIN part USING (p_partkey) WHERE len(w) >= 2 AND p_size > 30),
r AS (SELECT p_partkey, array_to_string(w[1:k], ' ') AS t, k FROM (SELECT p_partkey, w, unnest(range(1, len(w) + 1)) AS k FROM t)), m AS (SELECT p_partkey, known.t, g, k, row_number() OVER (PARTITION BY p_partkey ORDER BY k DESC, known.t) AS rn FROM r JOIN known ON known.t = r.t)
SELECT p_partkey, t AS text, max(g) AS group_ FROM m WHERE rn = 1 GROUP BY 1, 2""")
def q44_token_runs(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    w = F.split(F.trim("p_name"), r"\s+")
    one, two = rows.select(F.get(w, F.lit(0)).alias("text"), F.lit("one").alias("group")), rows.where((F.size(w) >= 2) & (F.col("p_size") > 30)).select(F.array_join(F.slice(w, 1, 2), " ").alias("text"), F.lit("two").alias("group"))
    return classification.run_lookup(rows, "p_partkey", "p_name", one.unionByName(two).distinct()).select("p_partkey", "text", F.col("group").alias("group_"))


@query("""SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey WHERE a.p_name <> '' AND b.p_name <> '' AND (starts_with(a.p_name, split_part(b.p_name, ' ', 1)) OR starts_with(b.p_name, split_part(a.p_name, ' ', 1)))""")
def q44b_same_start(spark, sf_dir):
    from kindred.operators.linkage import suffixed

    rows = table(spark, sf_dir, "part").select("p_brand", "p_size", F.col("p_partkey").alias("id"), "p_name", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("head"))
    pairs = suffixed(rows, "a", ["p_brand", "p_size"]).join(suffixed(rows, "b", ["p_brand", "p_size"]), ["p_brand", "p_size"]).where("id_a < id_b")
    hit = F.col("p_name_a").startswith(F.col("head_b")) | F.col("p_name_b").startswith(F.col("head_a"))
    return pairs.where((F.col("p_name_a") != "") & (F.col("p_name_b") != "") & hit).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


@query(f"""WITH d AS (SELECT doc_id, text, {fold("text")} AS f FROM documents)
SELECT doc_id, regexp_split_to_array(trim(text), '\\s+')[1] AS first, len(string_split(text, '|')) AS bars, lower(regexp_split_to_array(trim(text), '\\s+')[1]) AS low, upper(lang || source) AS up, ends_with(text, '.') AS dotted, regexp_matches(lower(text), '(licensed|released)') AS flagged,
  array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(text, '([A-Za-z0-9.]+@[a-z0-9.]+)'), lambda x: lower(x)))), ';') AS mails, md5(trim(regexp_replace(regexp_replace(f, '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '-')) AS slug, length(text) >= 190 AS long_,
  lang || ' / ' || source || ' (' || n_chars || ')' AS profile FROM d JOIN documents USING (doc_id, text)""")
def q49_strings(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    t = F.col("text")
    return rows.select(
        "doc_id", text.first_token("text").alias("first"), F.size(F.split("text", r"\|")).cast("long").alias("bars"), F.lower(text.first_token("text")).alias("low"), F.upper(F.concat("lang", "source")).alias("up"), t.endswith(".").alias("dotted"), F.lower("text").rlike("(licensed|released)").alias("flagged"),
        text.extracted("text", r"([A-Za-z0-9.]+@[a-z0-9.]+)").alias("mails"), F.md5(text.slug(text.fold("text"))).alias("slug"), (F.char_length("text") >= 190).alias("long_"), F.format_string("%s / %s (%d)", "lang", "source", "n_chars").alias("profile"),
    )


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(replace(p_type, 'PH.D', 'phd')), '[a-z]+'))), ' ') AS titles, trim(regexp_replace(lower(p_name), '[^a-z]+', ' ', 'g')) AS letters, regexp_replace(lower(p_name), '^[a-z]+\\s+', '') AS stripped, translate(p_name, 'aeiou', '') AS consonants, trim(regexp_replace(lower(p_brand), '[\\s-]+', ' ', 'g')) AS norm FROM part""")
def q49b_strings_of_parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.titles("p_type", F.lit("")), " ").alias("titles"), text.letters_only("p_name").alias("letters"), F.regexp_replace(F.lower("p_name"), r"^[a-z]+\s+", "").alias("stripped"), F.translate("p_name", "aeiou", "").alias("consonants"), text.name_norm("p_brand").alias("norm"))


@query("""WITH k AS (SELECT doc_id, lower(trim(regexp_extract(text, '^[A-Za-z]+'))) AS first, lower(regexp_extract(text, '([A-Za-z]+)[^A-Za-z]*$', 1)) AS surname, CASE WHEN lang = 'fr' THEN 'Z' ELSE 'M' END AS sex FROM documents), n AS (SELECT first, sum(CASE WHEN sex = 'Z' THEN 1 ELSE 0 END) AS z, sum(CASE WHEN sex = 'M' THEN 1 ELSE 0 END) AS m FROM k GROUP BY 1),
g AS (SELECT first, CASE WHEN z >= 0.95 * (z + m) THEN 'Z' WHEN m >= 0.95 * (z + m) THEN 'M' END AS g FROM n)
SELECT doc_id, CASE WHEN g = 'Z' THEN 'Z' WHEN g = 'M' AND NOT regexp_matches(surname, '(á|ova|ová)$') THEN 'M' WHEN g IS NULL AND regexp_matches(surname, '(á|ova|ová)$') THEN 'Z' END AS gender FROM k JOIN g USING (first)""")
def q15c_gender(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.lower(F.trim(F.regexp_extract("text", "^[A-Za-z]+", 0))).alias("first"), F.lower(F.regexp_extract("text", "([A-Za-z]+)[^A-Za-z]*$", 1)).alias("surname"), F.when(F.col("lang") == "fr", "Z").otherwise("M").alias("sex"))
    births = rows.groupBy(F.col("first").alias("name"), "sex").agg(F.count("*").alias("n"))
    return classification.gender(rows, "first", "surname", classification.name_gender(births)).select("doc_id", "gender")


@query()
def q24d_tail_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.lower("p_name").alias("t"), "p_brand", "p_size")
    known = rows.where("p_size <= 10").groupBy(F.col("t").alias("text")).agg(F.min("p_brand").alias("group"))
    model = classification.votes(rows, "t", "p_brand", share=0.3)
    return classification.tail_groups(rows, "p_partkey", "t", known, model, [("^retired", "status")], [("z$", "weak")])
