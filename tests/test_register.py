"""The whole linkage over a small made-up register."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.plans import register

YEARS = (2014, 2018, 2022)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    firsts, surnames = ["Jan", "Petr", "Eva", "Jana", "Karel", "Ivo", "Olga", "Dana"], [f"{a}{b}{c}" for a in ("Nov", "Svob", "Dvor", "Cern") for b in ("á", "o", "e") for c in ("k", "tný", "ček", "ra")]
    people = [(rng.choice(firsts), rng.choice(surnames), rng.randint(1945, 1990), rng.randrange(30), rng.choice(["učitel", "lékař", "kovář", "účetní"])) for _ in range(420)]
    kvrk, truth = [], {}
    for year in YEARS:
        at = {}
        for n, (first, surname, born, council, job) in enumerate(people):
            if rng.random() < 0.75:
                place = at[council] = at.get(council, 0) + 1
                row = {"year": year, "KODZASTUP": f"5{council:03}", "COBVODU": "1", "POR_STR_HL": str(place % 3 + 1), "PORCISLO": str(place), "JMENO": first, "PRIJMENI": surname, "TITULPRED": "Ing." if n % 9 == 0 else "", "TITULZA": "", "VEK": str(year - born), "POVOLANI": job, "BYDLISTEN": f"Obec {council}", "PSTRANA": "99" if n % 2 else "7", "MANDAT": "N", "PLATNOST": "A", "OKRES": f"CZ{council // 10}"}
                kvrk.append(row)
                truth[f"{year}:{row['KODZASTUP']}:1:{row['POR_STR_HL']}:{place}"] = n
    kvrk.append(kvrk[0] | {"PORCISLO": "999", "VEK": ""})
    councils = [(y, f"5{c:03}") for y in YEARS for c in range(30)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    out = {
        "kvrk": spark.createDataFrame(kvrk),
        "kvros": frame([(y, k, "1", str(i), f"List {i}", "80" if i == 1 else f"{i},90,x") for y, k in councils for i in (1, 2, 3)], "year int, KODZASTUP string, COBVODU string, POR_STR_HL string, NAZEVCELK string, SLOZENI string"),
        "kvcoco": frame([(y, k, "", "OZ", "K1") for y, k in councils], "year int, KODZASTUP string, NADRZASTUP string, TYPZASTUP string, KRAJ string"),
        "kvrzcoco": frame([(y, k, "1", "R" + k[1] if y == 2022 else "", "1200") for y, k in councils], "year int, KODZASTUP string, COBVODU string, ORP string, POCOBYV string"),
        "cvs": frame([(y, str(i), f"Strana {i}") for y in YEARS for i in (2, 3)], "year int, VSTRANA string, ZKRATKAV8 string"),
        "cpp": frame([(y, "7", "Sedm") for y in YEARS], "year int, PSTRANA string, ZKRATKAP8 string"),
    }
    return out, truth, firsts, surnames


@pytest.fixture(scope="module")
def linked(spark, tables):
    found, truth, firsts, surnames = tables
    rows = register.candidacies(found)
    by_year = lambda names: spark.createDataFrame([(n.upper(), y, 3) for n in names for y in range(1940, 2000)], "name string, year int, count int")
    cohorts = spark.createDataFrame([(y, s, 60_000) for y in range(1920, 2005) for s in "MZ"], "year int, sex string, n int")
    life = spark.createDataFrame([(p, s, a, 0.002) for p in range(1990, 2025, 5) for s in "MZ" for a in range(0, 101)], "period int, sex string, age int, q double")
    rows = register.expected_namesakes(rows, by_year(firsts), by_year(surnames), cohorts, life)
    edges, conflicts, parameters = register.score(rows, 2000)
    flagged = register.person_flags(rows)
    return (*register.persons(flagged, register.proposals(edges, flagged)), edges, parameters, rows, truth)


def test_candidacies_are_enriched(tables):
    rows = register.candidacies(tables[0])
    assert rows.count() == len(tables[1]) and rows.where("ORP = ''").count() == 0
    row = rows.where("POR_STR_HL = '2'").first()
    assert row.parties == ["strana 2"] and row.key not in row.cocand and row.blo < row.bhi
    assert rows.where("POR_STR_HL = '1'").first().parties == []


def test_people_are_found_across_elections(linked):
    edges, people, *_, truth = linked
    found = {r.id: r.person for r in people.collect()}
    assert set(found) == set(truth)
    auto = edges.where(F.col("decision").startswith("auto")).collect()
    assert len(auto) > 200
    assert sum(truth[r.id_a] == truth[r.id_b] for r in auto) >= 0.99 * len(auto)
    same = sum(1 for a in truth for b in truth if a < b and truth[a] == truth[b])
    kept = sum(1 for a in truth for b in truth if a < b and truth[a] == truth[b] and found[a] == found[b])
    assert kept >= 0.8 * same


def test_probabilities_and_parameters(linked):
    _, _, edges, parameters, rows, _ = linked
    assert edges.where("p < 0 or p > 1 or p is null").count() == 0
    sums = parameters.where("field <> 'r'").groupBy("kind", "field", "year_a", "year_b").agg(F.sum("p").alias("p")).collect()
    assert sums and all(abs(r.p - 1) < 1e-9 for r in sums)
    assert rows.where("E <= 0 or E is null").count() == 0


def test_region_only_raises_the_prior(spark, linked):
    _, _, edges, _, rows, _ = linked
    names = [r[0] for r in rows.select(F.upper("PRIJMENI")).distinct().collect()]
    bearers = spark.createDataFrame([(n, f"N{d}", 1 + 9 * (d == 0)) for n in names for d in range(3)], "surname string, nuts string, count long")
    districts = spark.createDataFrame([(f"CZ{d}", f"N{d}") for d in range(3)], "OKRES string, nuts string")
    after = register.raised_by_region(edges, rows, bearers, districts)
    assert after.count() == edges.count()
    both = after.select("pe_a", "pe_b", F.col("weight").alias("w")).join(edges, ["pe_a", "pe_b"])
    assert both.where("w > weight + 1e-9").count() == 0


def test_open_data_has_no_names(linked):
    edges, people, *_ = linked
    links, unsure = register.anonymised(people, edges, "salt")
    assert links.columns == ["id", "year", "person"] and links.select("person").distinct().count() == people.select("person").distinct().count()
    assert unsure.columns == ["id_a", "id_b", "p", "decision"]
