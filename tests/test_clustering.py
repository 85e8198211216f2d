import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kindred.operators import clustering, linkage

NODES = {"2010|a": (2010, 0, 300), "2014|a": (2014, 0, 300), "2018|a": (2018, 0, 300)}


def edge(a, b, p, proposal="auto_match", split=False):
    return {"pe_a": a, "pe_b": b, "p": p, "proposal": proposal, "split": split}


def test_transitivity_guard():
    chain = [edge("2010|a", "2014|a", 0.9999), edge("2014|a", "2018|a", 0.9999)]
    assert clustering.decide(NODES, [*chain, edge("2010|a", "2018|a", 0.2, "possible_match")])[0][1] == "conflict_transitive"
    assert clustering.decide(NODES, chain)[0][1] == "conflict_transitive"
    decisions, persons = clustering.decide(NODES, [*chain, edge("2010|a", "2018|a", 0.95, "manual_review")])
    assert decisions == ["auto_match", "auto_match", "implied"] and set(persons.values()) == {"2010|a"}


def test_election_and_birth_clashes():
    nodes = NODES | {"2014|b": (2014, 0, 300), "2018|c": (2018, 900, 1000)}
    decisions, _ = clustering.decide(nodes, [edge("2010|a", "2014|a", 0.99), edge("2010|a", "2014|b", 0.98), edge("2014|a", "2018|c", 0.97), edge("2010|a", "2018|a", 0.9, split=True)])
    assert decisions == ["auto_match", "conflict_election_clash", "conflict_birth_clash", "manual_review_namesake"]


@given(st.integers(0, 10**6))
@settings(max_examples=60, deadline=None)
def test_clusters_keep_their_invariants(seed):
    rng = random.Random(seed)
    nodes = {f"{y}|{i}": (y, lo := rng.randrange(300), lo + 200) for i, y in enumerate(rng.choices(range(2002, 2030, 4), k=9))}
    names = list(nodes)
    edges = [edge(a, b, rng.random(), rng.choice(list(clustering.RANKS))) for i, a in enumerate(names) for b in names[i + 1 :] if rng.random() < 0.6]
    _, persons = clustering.decide(nodes, edges)
    direct = {frozenset((e["pe_a"], e["pe_b"])): e["p"] for e in edges}
    for person in set(persons.values()):
        own = [n for n, p in persons.items() if p == person]
        assert person == min(own) and len({nodes[n][0] for n in own}) == len(own)
        assert max(nodes[n][1] for n in own) <= min(nodes[n][2] for n in own)
        assert all(direct.get(frozenset((a, b)), 0) >= clustering.DIRECT for i, a in enumerate(own) for b in own[i + 1 :])


def test_clustering_by_key_is_clustering_as_a_whole(spark):
    rng = random.Random(5)
    nodes, edges = {}, []
    for key in range(12):
        names = [f"{y}|{key}|{i}" for i, y in enumerate(rng.choices(range(2002, 2026, 4), k=6))]
        nodes |= {n: (int(n[:4]), lo := rng.randrange(200), lo + 250) for n in names}
        edges += [edge(a, b, rng.random(), rng.choice(list(clustering.RANKS))) for i, a in enumerate(names) for b in names[i + 1 :]]
    decisions, persons = clustering.decide(nodes, edges)
    day = F.date_add(F.lit("1900-01-01").cast("date"), F.col("lo"))
    rows = spark.createDataFrame([(n.split("|")[1], n, *v) for n, v in nodes.items()], "key string, pe string, year int, lo int, hi int")
    rows = rows.select("key", "pe", "year", day.alias("blo"), F.date_add(F.lit("1900-01-01").cast("date"), F.col("hi")).alias("bhi"))
    links = spark.createDataFrame([(e["pe_a"].split("|")[1], *e.values()) for e in edges], "key string, pe_a string, pe_b string, p double, proposal string, split boolean")
    decided, found = clustering.constrained(rows, links)
    assert {r.pe: r.person for r in found.collect()} == persons
    assert {(r.pe_a, r.pe_b): r.decision for r in decided.collect()} == {(e["pe_a"], e["pe_b"]): d for e, d in zip(edges, decisions)}


def test_greedy_pairs_use_each_record_once(spark):
    rows = spark.createDataFrame([("k", 1, 2, "a1", "b1", 0.9), ("k", 1, 2, "a1", "b2", 0.8), ("k", 1, 2, "a2", "b1", 0.7), ("k", 1, 2, "a2", "b2", 0.1)], "key string, year_a int, year_b int, pe_a string, pe_b string, p double")
    assert {(r.pe_a, r.pe_b) for r in clustering.greedy_pairs(rows).where("linked").collect()} == {("a1", "b1"), ("a2", "b2")}


def test_connected_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.component) for r in clustering.connected(edges).collect()} == {(i, 0) for i in range(21)} | {(100, 100), (101, 100)}


def test_shares_of_competitors_stay_below_one(spark):
    rows = spark.createDataFrame([(1, 2, f"a{i % 3}", f"b{i % 4}", float(i)) for i in range(12)], "year_a int, year_b int, a string, b string, weight double")
    found = linkage.normalised(rows, "a", "b").groupBy("a").agg(F.sum("p").alias("p")).collect()
    assert all(r.p <= 1 for r in found)
