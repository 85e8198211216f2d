import random

from pyspark.sql import functions as F

from kindred.operators import classification, evaluation, linkage, marts, sampling, sets, windows
from kindred.sources import readers, sinks
from kindred.streaming import changes


def test_gender(spark):
    births = spark.createDataFrame([("jana", "Z", 100), ("petr", "M", 100), ("martina", "Z", 99), ("martina", "M", 1), ("vlasta", "Z", 50), ("vlasta", "M", 50)], "name string, sex string, n int")
    rows = spark.createDataFrame([("Jana", "Nováková"), ("Petr", "Novák"), ("Martina", "Polakovič"), ("Petr", "Nováková"), ("Vlasta", "Burian"), ("Vlasta", "Buriánová")], "first string, surname string")
    official = spark.createDataFrame([("vlasta", "Z"), ("vlasta", "M")], "name string, gender string")
    found = classification.gender(rows, "first", "surname", classification.name_gender(births), official)
    assert {(r.first, r.surname): r.gender for r in found.collect()} == {("Jana", "Nováková"): "Z", ("Petr", "Novák"): "M", ("Martina", "Polakovič"): "Z", ("Petr", "Nováková"): None, ("Vlasta", "Burian"): None, ("Vlasta", "Buriánová"): "Z"}


def test_later_rules_win_and_skip_holds(spark):
    rows = spark.createDataFrame([("kovář",), ("kovář v důchodu",), ("chovatel psů",), ("nic",)], "t string")
    found = classification.by_rules(rows, "t", [("kovář", "craft"), ("důchod", "retired"), ("chov", "farm")], skip=F.col("t").contains("psů"))
    assert {r.t: r.group for r in found.collect()} == {"kovář": "craft", "kovář v důchodu": "retired", "chovatel psů": None, "nic": None}


def test_tail_groups_by_precedence(spark):
    known = spark.createDataFrame([("kovář", "craft"), ("učitel", "school"), ("řidič autobusu", "transport")], "text string, group string")
    votes = spark.createDataFrame([("zubní", "health")], "token string, group string")
    rows = spark.createDataFrame([(1, "důchodce, kovář"), (2, "mistr, kovář"), (3, "učitel na škole"), (4, "starší učitel"), (5, "zubní technik"), (6, "student"), (7, "xyz"), (8, "")], "id int, t string")
    found = classification.tail_groups(rows, "id", "t", known, votes, [("důchod", "retired")], [("student", "student")])
    assert {r.id: (r.group, r.how) for r in found.collect()} == {1: ("retired", "status"), 2: ("craft", "exact"), 3: ("school", "prefix"), 4: ("school", "suffix"), 5: ("health", "vote"), 6: ("student", "weak"), 7: (None, "none"), 8: (None, "none")}


def test_occupation_levels_in_order(spark):
    empty = F.array().cast("array<string>")
    base = spark.range(1).select(empty.alias("o_a"), F.array(F.lit("x")).alias("o_b"), F.lit("").alias("g_a"), F.lit("").alias("g_b"), F.lit(False).alias("r_a"), F.lit(True).alias("r_b"), F.lit(True).alias("s_a"), F.lit(False).alias("s_b"))
    level = linkage.occupation_level("o", "g", "r", "s")
    x, y = F.array(F.lit("x")), F.array(F.lit("y"))
    assert base.select(level).first()[0] == "missing"
    assert base.withColumn("o_a", x).select(level).first()[0] == "same"
    assert base.withColumn("o_a", y).select(level).first()[0] == "to_retired"
    assert base.withColumns({"o_a": y, "r_b": F.lit(False)}).select(level).first()[0] == "from_student"
    plain = base.withColumns({"o_a": y, "r_b": F.lit(False), "s_a": F.lit(False)})
    assert plain.select(level).first()[0] == "diff"
    assert plain.withColumns({"g_a": F.lit("f"), "g_b": F.lit("f")}).select(level).first()[0] == "same_field"


def test_unknown_places_do_not_agree(spark):
    rows = spark.createDataFrame([("", "", "1", "2"), ("5", "5", "1", "2")], "k_a string, k_b string, c_a string, c_b string")
    assert [r[0] for r in rows.select(linkage.geo_level([("c", "zast", False), ("k", "kraj", True)])).collect()] == ["other", "kraj"]


def test_ranks_and_runs(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate([5, 5, 7, 7, 5])], "g string, i int, v int")
    assert [(r.run, r.v, r.n) for r in windows.runs(rows, "g", "i", "v").orderBy("run").collect()] == [(1, 5, 2), (2, 7, 2), (3, 5, 1)]
    pct = {r.v: r.p for r in rows.withColumn("p", windows.percent_rank_average("v", "g")).collect()}
    assert abs(pct[5] - 0.4) < 1e-12 and abs(pct[7] - 0.9) < 1e-12
    ends = windows.ends_without_overlap(rows.withColumn("k", F.col("v") * 10 + F.col("i")), "k").collect()
    assert len(ends) == 4 and len({r.k for r in ends}) == 4


def test_auc_counts_ties_half(spark):
    rows = spark.createDataFrame([(1.0, 1), (1.0, 0), (2.0, 1), (0.0, 0)], "s double, y int")
    assert evaluation.auc(rows, "s", "y").first().auc == (0.5 + 1 + 1 + 1) / 4
    assert evaluation.auc(rows.where("y = 1"), "s", "y").first().auc is None


def test_samples_are_reproducible_and_bounded(spark):
    rows = spark.range(100).withColumn("g", F.col("id") % 3)
    a = {r.id for r in sampling.stratified(rows, "g", 5, "id", seed="x").collect()}
    assert len(a) == 15 and a == {r.id for r in sampling.stratified(rows.repartition(7), "g", 5, "id", seed="x").collect()}
    assert sorted(r.number for r in sampling.dense_numbers(rows, "id", name="number").collect()) == list(range(1, 101))


def test_text_tables_logs_and_appends(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a,b", None), ("2", 'q"x', "z")], "k string, v string, w string")
    sinks.write_text_table(rows, str(tmp_path / "t"))
    assert sorted(map(tuple, readers.read_text_table(spark, str(tmp_path / "t"), ["k", "v", "w"]).collect())) == [("1", "a,b", ""), ("2", 'q"x', "z")]
    for batch in ([("x", 1), ("x", 2)], [("x", 9), ("y", 3)]):
        sinks.append_new(spark.createDataFrame(batch[:1] if batch[0][1] == 1 else batch, "k string, v int"), str(tmp_path / "a"), ["k"])
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "a")).collect())) == [("x", 1), ("y", 3)]
    log = spark.createDataFrame([("k", 1, "same"), ("k", 2, "different")], "key string, t int, label string")
    assert readers.latest(log, ["key"], ["t"], ["label"]).first().label == "different"
    assert readers.tolerant(rows, {"k": "int", "new": "string"}).orderBy("k").first() == (1, "")


def test_numbered_batches_go_on_where_they_stopped(spark, tmp_path):
    changes.register(spark)
    feed = tmp_path / "feed"
    feed.mkdir()

    def run():
        stream = spark.readStream.format("numbered_batches").load(str(feed))
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).start(str(tmp_path / "out"))
        query.processAllAvailable()
        query.stop()

    (feed / "body_1.xml").write_text("<a/>")
    run()
    (feed / "body_2.xml").write_text("<b/>")
    run()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == [(1, "<a/>"), (2, "<b/>")]


def test_digest_ignores_the_generation_time(spark):
    a, b, c = (F.lit(f'<X DATUM_CAS_GENEROVANI="{t}"><Y v="{v}"/></X>') for t, v in ((1, 1), (2, 1), (2, 2)))
    row = spark.range(1).select(*(changes.body_digest(x, r'\s+DATUM_CAS_GENEROVANI="[^"]*"').alias(n) for n, x in (("a", a), ("b", b), ("c", c)))).first()
    assert row.a == row.b != row.c


def test_marts(spark):
    rows = spark.createDataFrame([("p", 2010, "x"), ("p", 2014, "y"), ("q", 2010, "x")], "person string, year int, place string")
    found = {(r.person, r.place): r.elsewhere for r in marts.leavers(rows, "person", "place", "year", 2010, 2014).collect()}
    assert found == {("p", "x"): True, ("q", "x"): False}
    assert marts.histogram(rows, "year", 2009, 2014).where("n > 0").count() == 2
    wide = spark.createDataFrame([("Jana", 3, 0), ("Petr", 1, 2)], ["name", "1990", "1991"])
    assert sorted(map(tuple, readers.wide_to_long(wide, ["name"], "year", "count").collect())) == [("Jana", 1990, 3), ("Petr", 1990, 1), ("Petr", 1991, 2)]


def test_auc_and_quantile_over_many_scores(spark):
    """Ranges of scores give what one list of all of them gives, with ties, few scores and none."""
    import random

    import numpy as np

    from kindred.operators import evaluation

    rng = random.Random(4)
    many = [(round(rng.gauss(0, 1), rng.choice([1, 4])), int(rng.random() < 0.3)) for _ in range(3000)]
    for rows in (many, many[:7], [(1.0, 1), (1.0, 0)]):
        df = spark.createDataFrame([*rows, (None, 1)], "v double, y int").where("v is not null")
        pos, neg = [v for v, y in rows if y], [v for v, y in rows if not y]
        found = evaluation.auc(df, "v", "y").first()
        want = np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg]) if pos and neg else None
        assert found.auc is None if want is None else abs(found.auc - want) < 1e-9
        if pos and neg:
            cut = evaluation.recall_at(df, "v", "y", 0.1).first()
            assert abs(cut.threshold - np.quantile(neg, 0.9)) < 1e-9 and abs(cut.tpr - np.mean([p > cut.threshold for p in pos])) < 1e-9
    assert evaluation.auc(df.limit(0), "v", "y").first().auc is None and evaluation.recall_at(df.limit(0), "v", "y").count() == 0


def test_concurrent_pairs_meet_once_and_only_nearby(spark):
    begins = [f"19{y}-{m}-01" for y in (40, 41, 69, 70, 99) for m in ("02", "06", "10")]
    rows = spark.createDataFrame([(i % 61, i % 2, i % 3, begins[i * 7 % 15]) for i in range(240)], "id int, key int, place int, b string").selectExpr("id", "key", "place", "date(b) as blo", "date(b) + 364 - id % 3 as bhi")
    pairs = linkage.concurrent_pairs(rows, ["key"], ["place"])
    own = [tuple(r) for r in rows.collect()]
    wanted = sorted((a[0], b[0]) for a in own for b in own if a[0] < b[0] and a[1] == b[1] and a[2] != b[2] and a[3] <= b[4] and b[3] <= a[4])
    assert sorted(tuple(r) for r in pairs.collect()) == wanted and wanted
    # rows of one key in far years share no join key, so they don't meet
    assert "bin" in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_hold_all_near_sets_and_few_others(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(900)]
    own = [set(rng.sample(vocabulary, n)) for n in (1, 2, 4, 5, 6, 9, 10, 40, 60, 130, 398, 402, 440, 700, 798, 804, 850) for _ in range(4)]
    for s in own[:]:  # near copies on either side of the threshold and of the sizes where sketches grow
        for part in (0.02, 0.08, 0.11, 0.13, 0.2):
            gone = set(rng.sample(sorted(s), int(part * len(s))))
            own += [s - gone, s | set(rng.sample(vocabulary, int(part * len(s)))), (s - gone) | set(rng.sample(vocabulary, len(gone)))]
    texts = sorted({" ".join(sorted(s)) for s in own})
    rows = [(i, f"s{i % 2}", w) for i, w in enumerate(texts)]
    found = {tuple(r) for r in sets.candidates(spark.createDataFrame(rows, "doc long, source string, words string"), "source", "doc", "words").collect()}
    split = [(i, g, set(w.split(" "))) for i, g, w in rows]
    pairs = [(a, b, len(x & y), len(x | y)) for i, (a, g, x) in enumerate(split) for b, h, y in split[i + 1 :] if g == h]
    near = {(a, b) for a, b, o, u in pairs if 10 * o >= 8 * u}
    # what shares a rare word but is far apart goes by its sketch: without sketches these are most of the candidates
    assert near <= found and len(near) > 300 and len(found) < 3 * len(near)
