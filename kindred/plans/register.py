"""The whole linkage over register tables: load, expected namesakes, scores of all pairs of elections, gate, persons.

Every step works on all elections at once; an election pair is a pair of columns, not a loop. Tables are DataFrames of
text columns with a `year` column (kindred.sources.readers); reference tables are named in the functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.functions.dates import birth_window, five_year_bucket, parsed, share_of_year_left
from kindred.functions.numbers import UNSEEN, clip, concentration
from kindred.operators import clustering, linkage
from kindred.session import settled
from kindred.sources.readers import with_answers

# Days of the regular elections.
DATES = {2002: "20021101", 2006: "20061020", 2010: "20101015", 2014: "20141010", 2018: "20181005", 2022: "20220923", 2026: "20261009"}
# Usual abbreviations in occupations and what they stand for.
ABBREVIATIONS = {
    "khs": "krajska hygienicka stanice", "hzs": "hasicsky zachranny sbor", "pcr": "policie", "mp": "mestska policie",
    "zs": "zakladni skola", "ms": "materska skola", "ss": "stredni skola", "sou": "stredni odborne uciliste",
    "vs": "vysoka skola", "zd": "zemedelske druzstvo", "ou": "obecni urad", "mu": "mestsky urad", "mmu": "magistrat",
    "ku": "krajsky urad", "fu": "financni urad", "up": "urad prace", "cssz": "ceska sprava socialniho zabezpeceni",
    "ossz": "okresni sprava socialniho zabezpeceni", "cd": "ceske drahy", "acr": "armada", "osvc": "osoba samostatne vydelecne cinna",
    "dps": "dum s pecovatelskou sluzbou", "zzs": "zdravotnicka zachranna sluzba", "ddm": "dum deti a mladeze",
}
# Words of a retired person and of a student; party codes of independents; code of no party.
RETIRED, STUDENT, INDEPENDENT, NO_PARTY = "důchod|penzist|v penzi", "student|žák|žačka", ("80", "90"), "99"
# Adult population for the candidacy rate, the rare-name bound of seed pairs, and thresholds of the gate.
VOTERS, SEED_BELOW, BIG_CITY, CERTAIN, NEARLY, LIKELY, YES = 8_300_000, 0.02, 50_000, 0.999, 0.99, 0.9, 0.8

GEO = (("KODZASTUP", "zast", False), ("city", "city", False), ("ORP", "orp", True), ("OKRES", "okres", False), ("KRAJ", "kraj", True))
LEVELS, LOCAL = ("zast", "city", "orp", "okres", "kraj", "other"), ("zast", "city")
FIELDS = ("cocand", "party", "titles", "occ", "list_party")
PAIR = ("year_a", "year_b")


def _first(df: DataFrame, key: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """One row for each key: that of the smallest order, for "first row wins" without a file order."""
    row = F.struct(*order, *(c for c in columns if c not in order))
    return df.groupBy(*key).agg(F.min(row).alias("_r")).select(*key, *(F.col(f"_r.{c}").alias(c) for c in columns))


def list_parties(lists: DataFrame, parties: DataFrame) -> DataFrame:
    """(year, KODZASTUP, COBVODU, POR_STR_HL, parties): names of the parties of each list, without independents."""
    key = ["year", "KODZASTUP", "COBVODU", "POR_STR_HL"]
    codes = F.transform(F.split("SLOZENI", ","), lambda c: F.try_to_number(F.trim(c), F.lit("999999")).cast("int").cast("string"))
    names = _first(parties.withColumn("code", F.col("VSTRANA").cast("int").cast("string")), ["year", "code"], ["ZKRATKAV8"], ["ZKRATKAV8"])
    rows = lists.select(*key, F.explode(codes).alias("code")).where(F.col("code").isNotNull() & ~F.col("code").isin(*INDEPENDENT))
    named = rows.join(names.select("year", "code", text.fold("ZKRATKAV8").alias("name")), ["year", "code"]).where("name <> ''")
    return named.groupBy(*key).agg(F.array_sort(F.collect_set("name")).alias("parties"))


def candidacies(tables: Mapping[str, DataFrame], fields: DataFrame | None = None, female: DataFrame | None = None) -> DataFrame:
    """Valid candidacies with an age of all elections, normalised and enriched. fields: (text, field) of classified
    occupations; female: (first, surname, gender) where it is known, unknown counts as male."""
    key = ["year", "KODZASTUP", "COBVODU", "POR_STR_HL"]
    k = tables["kvrk"].where((F.col("VEK") != "") & (F.col("PLATNOST") == "A"))
    lists = tables["kvros"].select(*key, "NAZEVCELK", "SLOZENI")
    councils = _first(tables["kvcoco"], ["year", "KODZASTUP"], ["NADRZASTUP", "TYPZASTUP", "KRAJ"], ["NADRZASTUP"])
    places = _first(tables["kvrzcoco"], ["year", "KODZASTUP"], ["ORP", "POCOBYV"], ["COBVODU"] if "COBVODU" in tables["kvrzcoco"].columns else ["ORP"])
    newest = tables["kvrzcoco"].where("ORP <> ''").groupBy("KODZASTUP").agg(F.max_by("ORP", F.struct("year", "ORP")).alias("_orp"))
    k = k.join(lists, key, "left").join(list_parties(lists, tables["cvs"]), key, "left").join(councils, ["year", "KODZASTUP"], "left").join(places, ["year", "KODZASTUP"], "left").join(newest, "KODZASTUP", "left")
    k = k.na.fill("", ["NADRZASTUP", "TYPZASTUP", "KRAJ", "ORP", "POCOBYV", "NAZEVCELK", "SLOZENI", "_orp"])
    own = _first(tables["cpp"], ["year", "PSTRANA"], ["ZKRATKAP8"], ["ZKRATKAP8"]).select("year", "PSTRANA", text.fold("ZKRATKAP8").alias("party_name"))
    k = k.join(own, ["year", "PSTRANA"], "left")

    day = parsed(F.element_at(F.create_map(*(F.lit(x) for pair in DATES.items() for x in pair)), F.col("year").cast("int")))
    age = F.col("VEK").cast("int")
    low, surname, first = F.lower("POVOLANI"), text.name_norm("PRIJMENI"), text.first_token("JMENO")
    k = k.withColumns({"day": day, "age": age, "first": first, "surname": surname, "key": F.concat_ws("|", text.name_norm(first), surname), "party_name": F.coalesce("party_name", F.lit("")), "ORP": F.coalesce(F.nullif("ORP", F.lit("")), "_orp")})
    lo, hi = birth_window(F.col("day"), F.col("age"))
    k = k.withColumns({
        "id": F.concat_ws(":", "year", "KODZASTUP", "COBVODU", "POR_STR_HL", "PORCISLO"), "blo": lo, "bhi": hi, "city": F.coalesce(F.nullif("NADRZASTUP", F.lit("")), "KODZASTUP"),
        "parties": F.coalesce("parties", F.array().cast("array<string>")), "titles": text.titles("TITULPRED", "TITULZA"), "occ": text.stems(F.replace("POVOLANI", F.lit("."), F.lit(" ")), expand=ABBREVIATIONS),
        "retired": low.rlike(RETIRED), "student": low.rlike(STUDENT), "occ_text": text.squeezed("POVOLANI"),
    }).drop("_orp")
    k = k.withColumn("pe", F.concat_ws("|", "year", "key", "city", "VEK"))
    # the same name and age twice in one kind of council are two people
    clash = F.count("*").over(Window.partitionBy("pe", "TYPZASTUP")) > 1
    k = k.withColumn("_clash", clash).withColumn("pe", F.when(F.col("_clash"), F.concat_ws("|", "pe", "id")).otherwise(F.col("pe"))).drop("_clash")
    mates = k.groupBy(*key).agg(F.collect_set("key").alias("_mates"))
    k = k.join(mates, key).withColumn("cocand", F.array_remove("_mates", F.col("key"))).drop("_mates")
    k = k.join(fields.select(F.col("text").alias("occ_text"), "field"), "occ_text", "left").withColumn("field", F.coalesce("field", F.lit(""))) if fields is not None else k.withColumn("field", F.lit(""))
    if female is None:
        return k.withColumn("female", F.lower(F.trim("PRIJMENI")).endswith("á"))
    known = female.select(F.col("first").alias("JMENO"), F.col("surname").alias("PRIJMENI"), (F.col("gender") == "Z").alias("female"))
    return k.join(known, ["JMENO", "PRIJMENI"], "left").withColumn("female", F.coalesce("female", F.lit(False)))


def survival(needed: DataFrame, life: DataFrame, until: int = 2017) -> DataFrame:
    """(born, sex, year, survival): chance of being alive at the start of `until`. needed: distinct (born, sex, year);
    life: (period, sex, age, q). A few thousand combinations, whatever the number of rows."""
    steps = needed.where(F.col("year") < until).select("born", "sex", "year", F.explode(F.sequence("year", F.lit(until - 1))).alias("_y"))
    oldest = life.groupBy("period", "sex").agg(F.max("age").alias("_oldest"))
    steps = steps.withColumn("period", five_year_bucket(F.col("_y"))).join(oldest, ["period", "sex"]).withColumn("age", F.least(F.greatest(F.col("_y") - F.col("born"), F.lit(0)), F.col("_oldest")))
    done = steps.join(life, ["period", "sex", "age"]).groupBy("born", "sex", "year").agg(F.product(1 - F.col("q")).alias("_s"))
    return needed.join(done, ["born", "sex", "year"], "left").select("born", "sex", "year", F.greatest(F.coalesce("_s", F.lit(1.0)), F.lit(0.01)).alias("survival"))


def expected_namesakes(rows: DataFrame, first_names: DataFrame, surnames: DataFrame, cohorts: DataFrame, life: DataFrame) -> DataFrame:
    """rows with E, the living people expected under the same name at the same age. Counts by name and year of birth
    (name, year, count), cohorts (year, sex, n), life as in survival. Two years of birth are possible; each counts by its
    share of the year."""
    late = share_of_year_left(F.col("day"))
    years = F.explode(F.array(F.struct((F.col("year") - F.col("age") - 1).alias("born"), late.alias("share")), F.struct((F.col("year") - F.col("age")).alias("born"), (1 - late).alias("share")))).alias("_b")
    part = rows.select("id", "year", F.upper("first").alias("_f"), F.upper("PRIJMENI").alias("_s"), F.when(F.col("female"), "Z").otherwise("M").alias("sex"), years).select("id", "year", "_f", "_s", "sex", "_b.*")
    part = part.withColumn("_c", F.greatest("born", F.lit(1920)))
    part = part.join(first_names.select(F.col("name").alias("_f"), F.col("year").alias("born"), F.col("count").alias("_fn")), ["_f", "born"], "left")
    part = part.join(surnames.select(F.col("name").alias("_s"), F.col("year").alias("born"), F.col("count").alias("_sn")), ["_s", "born"], "left")
    part = part.join(cohorts.select(F.col("year").alias("_c"), "sex", "n"), ["_c", "sex"], "left")
    part = part.join(survival(part.select("born", "sex", "year").distinct(), life), ["born", "sex", "year"])
    e = F.col("share") * (F.coalesce("_fn", F.lit(0)) + 0.5) * (F.coalesce("_sn", F.lit(0)) + 0.5) / F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)) / F.col("survival")
    return rows.join(part.groupBy("id").agg(F.sum(e).alias("E")), "id")


COMPARED = ("KODZASTUP", "city", "ORP", "OKRES", "KRAJ", "cocand", "PSTRANA", "party_name", "titles", "occ", "retired", "student", "field", "parties")


def with_levels(pairs: DataFrame) -> DataFrame:
    """pairs with the six comparison levels in place of what they compare."""
    party = F.when((F.col("PSTRANA_a") == NO_PARTY) & (F.col("PSTRANA_b") == NO_PARTY), "both_bezpp").when((F.col("party_name_a") == F.col("party_name_b")) & (F.col("party_name_a") != ""), "same").otherwise("diff")
    levels = {"geo": linkage.geo_level(GEO), "cocand": linkage.shared_level("cocand", "city"), "party": party, "titles": linkage.titles_level("titles"), "occ": linkage.occupation_level("occ", "field", "retired", "student"), "list_party": linkage.list_party_level("parties")}
    return pairs.withColumns(levels)


def _table(rows: DataFrame, fields, only: Column | None = None) -> DataFrame:
    """(year_a, year_b, field, level, p) of levels."""
    return linkage.distribution(rows if only is None else rows.where(only), fields, PAIR).select(*PAIR, "field", "level", "p")


def _map(table: DataFrame, name: str) -> DataFrame:
    """The table as one map; it has a row for each election pair, field and level: a few hundred."""
    key = F.concat_ws("|", *(F.col(c).cast("string") for c in PAIR), "field", "level")
    return table.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(key, "p"))).alias(name))


def geo_chances(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """pairs with u_geo, the chance that a stranger of the later election falls into the pair's ring around the earlier
    record: rings are nested, each without the one inside. Counts by code are made once and looked up."""
    total = rows.groupBy(F.col("year").alias("year_b")).agg(F.count("*").alias("_n_b"))
    pairs = pairs.join(total, "year_b")
    inner, chances = F.lit(0), []
    for column, level in (("KODZASTUP", "zast"), ("city", "city"), ("ORP", "orp"), ("OKRES", "okres"), ("KRAJ", "kraj")):
        sizes = rows.groupBy(F.col("year").alias("year_b"), F.col(column).alias(f"{column}_a")).agg(F.count("*").alias(f"_n_{level}"))
        pairs = pairs.join(sizes, ["year_b", f"{column}_a"], "left")
        n = F.coalesce(f"_n_{level}", F.lit(0))
        chances.append((level, F.greatest(n - inner, F.lit(1))))
        inner = F.greatest(n, inner)
    chances.append(("other", F.greatest(F.col("_n_b") - inner, F.lit(1))))
    u = None
    for level, ring in chances:
        u = F.when(F.col("geo") == level, ring) if u is None else u.when(F.col("geo") == level, ring)
    return pairs.withColumn("u_geo", u / F.col("_n_b")).drop("_n_b", *(f"_n_{level}" for level in LEVELS[:-1]))


def effective_namesakes(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """pairs with E_eff: namesakes raised where more first names carry the surname in the city than expected."""
    names = rows.select("year", "city", "surname", "first").distinct()
    spread = names.select("year", F.explode(F.array(*(F.struct(F.lit(y).alias("y")) for y in DATES))).alias("_o"), "city", "surname", "first")
    both = spread.where("year <> _o.y").select(F.least("year", "_o.y").alias("year_a"), F.greatest("year", "_o.y").alias("year_b"), "city", "surname", "first").distinct()
    family = both.groupBy(*PAIR, F.col("city").alias("city_a"), F.col("surname").alias("surname_a")).agg((F.count("*") - 1).alias("_others"))
    city = both.groupBy(*PAIR, F.col("city").alias("city_a")).agg(F.count("*").alias("_city"))
    nation = both.select(*PAIR, "surname", "first").distinct().groupBy(*PAIR, "surname").agg(F.count("*").alias("_n"))
    # a window over election pairs would gather all surnames of one: sums are joined instead
    share = nation.join(F.broadcast(nation.groupBy(*PAIR).agg(F.sum("_n").alias("_all"))), [*PAIR]).select(*PAIR, F.col("surname").alias("surname_a"), (F.col("_n") / F.col("_all")).alias("_share"))
    found = pairs.join(family, [*PAIR, "city_a", "surname_a"], "left").join(city, [*PAIR, "city_a"], "left").join(share, [*PAIR, "surname_a"], "left")
    k = concentration(F.coalesce("_others", F.lit(0)), F.coalesce(F.col("_city") * F.col("_share"), F.lit(0)))
    return found.withColumn("E_eff", F.when(F.col("geo").isin(*LOCAL), F.col("E_a") * k).otherwise(F.col("E_a"))).drop("_others", "_city", "_share")


def score(rows: DataFrame, wanted: int = 200_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(edges, age conflicts, parameters) of all pairs of elections. rows: candidacies with E; wanted: random pairs of
    strangers for each election pair."""
    columns = ["id", "pe", "key", "year", "first", "surname", "blo", "bhi", "E", *COMPARED]
    rows = settled(rows.select(*columns), "candidacies")
    pairs = effective_namesakes(geo_chances(with_levels(linkage.blocked_pairs(rows)), rows), rows)
    keep = ["key", "pe_a", "pe_b", *PAIR, "id_a", "id_b", "E_a", "E_eff", "overlap", "geo", *FIELDS, "u_geo"]
    pairs = settled(pairs.select(*keep), "pairs")

    local = F.col("geo").isin(*LOCAL)
    seed = linkage.first_by_level(pairs.where((F.col("overlap") > 0) & (F.col("E_a") < SEED_BELOW)), [*PAIR, "id_a"], "geo", LEVELS, ["id_b"])
    seed = settled(seed.select(*PAIR, "id_a", "geo", *FIELDS), "seed")
    years = rows.groupBy("year").agg(F.count("*").alias("n"), F.count_if(F.col("E") < SEED_BELOW).alias("rare"))
    count = F.greatest(F.coalesce("seeds", F.lit(0)) / F.greatest("rare", F.lit(1)), F.lit(UNSEEN))
    rates = years.select(F.col("year").alias("year_a"), "rare").join(years.select(F.col("year").alias("year_b"), "n"), F.col("year_a") < F.col("year_b"))
    rates = rates.join(seed.groupBy(*PAIR).agg(F.count("*").alias("seeds")), [*PAIR], "left").select(*PAIR, "seeds", count.alias("r"), (F.col("n") / VOTERS).alias("c"))

    other = tuple(f for f in FIELDS if f != "cocand")
    m = _table(seed, ("geo", *other)).unionByName(_table(seed, ("cocand",), local))
    total = rows.count()
    apart = with_levels(linkage.strangers(rows, wanted * 21, total))
    near = with_levels(linkage.partners_within(rows, rows, "KODZASTUP").where("year_a < year_b and key_a <> key_b"))
    parameters = settled(m.withColumn("kind", F.lit("m")).unionByName(_table(apart, other).withColumn("kind", F.lit("u"))).unionByName(_table(near, FIELDS).withColumn("kind", F.lit("u_loc"))), "parameters")

    weighed = pairs.join(F.broadcast(rates), [*PAIR])
    for kind in ("m", "u", "u_loc"):
        weighed = weighed.join(F.broadcast(_map(parameters.where(F.col("kind") == kind), f"_{kind}")))

    def chance(kind: str, field: str) -> Column:
        key = F.concat_ws("|", *(F.col(c).cast("string") for c in PAIR), F.lit(field), field)
        return F.coalesce(F.try_element_at(f"_{kind}", key), F.lit(UNSEEN))

    weighed = weighed.withColumns({"w_prior": linkage.prior_weight(F.col("r"), F.col("E_eff"), F.col("c")), "w_geo": F.log2(chance("m", "geo") / F.col("u_geo"))})
    for field in FIELDS:
        w = F.log2(chance("m", field) / F.when(local, chance("u_loc", field)).otherwise(chance("u", field)))
        # pairs of different cities say nothing about co-candidates
        weighed = weighed.withColumn(f"w_{field}", F.when(F.col("cocand") == "na", 0.0).otherwise(w) if field == "cocand" else w)
    weights = ["w_prior", "w_geo", *(f"w_{f}" for f in FIELDS)]
    weighed = weighed.withColumn("weight", sum((F.col(w) for w in weights[1:]), F.col(weights[0]))).select(*keep[:-1], *weights, "weight")
    weighed = settled(weighed, "weights")
    best = linkage.best_per_pair(weighed.where("overlap > 0"), "pe_a", "pe_b", ["id_a", "id_b"])
    return linkage.normalised(best, "pe_a", "pe_b"), linkage.conflicts(weighed), parameters.unionByName(rates.select(*PAIR, F.lit("r").alias("field"), F.lit("").alias("level"), F.col("r").alias("p"), F.lit("r").alias("kind")))


def raised_by_region(edges: DataFrame, rows: DataFrame, bearers: DataFrame, districts: DataFrame) -> DataFrame:
    """Scores again with the surname's concentration in the earlier record's district, where that is higher.
    bearers: (surname, nuts, count); districts: (OKRES, nuts)."""
    people = bearers.groupBy("nuts").agg(F.sum("count").alias("_n"))
    share = people.select("nuts", (F.col("_n") / F.sum("_n").over(Window.partitionBy())).alias("share"))
    here = bearers.groupBy("surname", "nuts").agg(F.sum("count").alias("_here"))
    nation = bearers.groupBy("surname").agg(F.sum("count").alias("_nation"))
    a = rows.select(F.col("id").alias("id_a"), F.upper("PRIJMENI").alias("surname"), "OKRES").join(districts, "OKRES", "left")
    found = edges.join(a, "id_a").join(here, ["surname", "nuts"], "left").join(nation, "surname", "left").join(share, "nuts", "left")
    k = (F.coalesce("_here", F.lit(0)) + 0.5 * F.col("share")) / (F.coalesce("_nation", F.lit(0)) + 0.5) / F.col("share")
    local, old = F.col("geo").isin(*LOCAL), F.col("E_eff") / F.col("E_a")
    new = clip(F.greatest(old, F.coalesce(k, F.lit(1.0))), 1.0, 50.0)
    less = F.when(local, F.log2(new / old)).otherwise(0.0)
    found = found.withColumns({"_less": less, "p_before_okres": F.col("p")})
    found = found.withColumns({"weight": F.col("weight") - F.col("_less"), "w_prior": F.col("w_prior") - F.col("_less")})
    return linkage.normalised(found.select(*[c for c in edges.columns if c != "p"], "p_before_okres"), "pe_a", "pe_b")


def person_flags(rows: DataFrame) -> DataFrame:
    """rows with big (city of 50,000 or more), family (a namesake of another age in the council) and main_town."""
    cities = rows.groupBy(F.col("KODZASTUP").alias("city")).agg(F.max_by(F.expr("try_cast(POCOBYV as int)"), "year").alias("_people"))
    towns = rows.groupBy("city").agg(F.mode("BYDLISTEN", True).alias("main_town"))
    flagged = clustering.clash_within(rows, ["KODZASTUP", "key"]).withColumnRenamed("clash", "family")
    return flagged.join(cities, "city", "left").join(towns, "city").withColumn("big", F.coalesce(F.col("_people") >= BIG_CITY, F.lit(False))).drop("_people")


def proposals(edges: DataFrame, rows: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """Edges of p >= 0.5 with flags, second signal and proposal; all others stay as direct evidence with none.
    answers: (kind, a, b, p) of a referee on pairs of ids; kinds "field" and "pair"."""
    side = rows.select("id", "NAZEVCELK", "BYDLISTEN", "main_town", "big", "family")
    found = edges.join(linkage.suffixed(side, "a"), "id_a").join(linkage.suffixed(side, "b"), "id_b")
    split = F.size(F.split("pe_a", r"\|")) > 5
    town = [text.name_norm(f"BYDLISTEN_{s}") for s in "ab"]
    lists = [text.letters_only(f"NAZEVCELK_{s}") for s in "ab"]
    found = found.withColumns({
        "big": F.col("big_a") | F.col("big_b"), "family": F.col("family_a") | F.col("family_b"), "split": split | (F.size(F.split("pe_b", r"\|")) > 5),
        "same_list": (lists[0] == lists[1]) & (F.col("NAZEVCELK_a") != ""), "same_res": text.same_start(*town) & (F.col("BYDLISTEN_a") != F.col("main_town_a")),
    })
    cheap = (F.col("titles") == "same") | F.col("occ").isin("same", "similar", "same_field") | (F.col("party") == "same") | F.col("cocand").isin("1", "2+") | (F.col("list_party") == "shared") | F.col("same_list") | F.col("same_res")
    found = found.withColumns({"a": F.col("id_a"), "b": F.col("id_b")})
    for kind in ("field", "pair"):
        found = (with_answers(found, answers, kind) if answers is not None else found.withColumn("answer", F.lit(0.0))).withColumnRenamed("answer", f"answer_{kind}")
    local, p = F.col("geo").isin(*LOCAL), F.col("p")
    found = found.withColumn("second", F.when(cheap, "rules").when(F.col("answer_field") >= YES, "referee").otherwise(""))
    auto = local & (p >= CERTAIN) & (~(F.col("big") | F.col("family")) | (F.col("second") != "")) & ~F.col("split")
    proposal = F.when(auto, "auto_match").when(local & (p >= NEARLY) & (F.col("second") != "") & (F.col("answer_pair") >= YES), "auto_jev").when(p >= LIKELY, "manual_review").otherwise("possible_match")
    return found.select(*edges.columns, "big", "family", "split", "same_list", "same_res", "second", proposal.alias("proposal"))


def persons(rows: DataFrame, proposed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges with decision, candidacies with person)."""
    nodes = _first(rows, ["key", "pe"], ["year", "blo", "bhi"], ["year"])
    decided, found = clustering.constrained(nodes, proposed)
    edges = proposed.join(decided.select("pe_a", "pe_b", "decision"), ["pe_a", "pe_b"])
    return edges, rows.join(found, "pe").select("id", "person", "year", "JMENO", "PRIJMENI", "TITULPRED", "TITULZA", "VEK", "POVOLANI", "BYDLISTEN", "NAZEVCELK", "PSTRANA", "MANDAT", "KODZASTUP", "city", "big", "family")


def anonymised(people: DataFrame, edges: DataFrame, salt: str) -> tuple[DataFrame, DataFrame]:
    """Open data without names: (id, year, person number), and uncertain edges between candidacies."""
    from kindred.operators.sampling import dense_numbers

    numbers = dense_numbers(people.select("person").distinct(), "person", salt=salt, name="number")
    links = people.join(numbers, "person").select("id", "year", F.col("number").alias("person"))
    unsure = edges.where(F.col("decision").isin("manual_review", "possible_match") | F.col("decision").startswith("conflict")).select("id_a", "id_b", F.bround("p", 4).alias("p"), "decision")
    return links, unsure
