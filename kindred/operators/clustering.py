"""Entities from scored pairs: constrained clustering, greedy one-to-one assignment, connected components.

Only automatic proposals put records together, and all of them come before any other pair's turn. So the ordered part is a
fold over the automatic pairs of one connected component, which is small however common a name is; what becomes of every
other pair follows from the persons that result, in joins.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import discarded, settled

#: Pairs below are not looked at for merging; every pair across two persons needs that much direct evidence.
CONSIDERED, DIRECT = 0.5, 0.5
#: Automatic proposals in the order of their turns; others come last.
AUTOMATIC = ("auto_match", "auto_jev")
RANKS = {name: AUTOMATIC.index(name) if name in AUTOMATIC else len(AUTOMATIC) for name in (*AUTOMATIC, "manual_review", "possible_match")}
ELECTIONS, BIRTHS, EVIDENCE = "conflict_election_clash", "conflict_birth_clash", "conflict_transitive"


class Person(NamedTuple):
    """Records taken for one person, their elections and the days on which all of them can be born."""

    records: frozenset
    elections: frozenset
    first: int
    last: int


def clash(one: Person, two: Person) -> str | None:
    """What keeps two persons apart whatever the evidence."""
    if not one.elections.isdisjoint(two.elections):
        return ELECTIONS
    return BIRTHS if max(one.first, two.first) > min(one.last, two.last) else None


def folded(records: Iterable[tuple[str, int, int, int]], pairs: list[tuple[str, str, str]], evidence: Iterable[tuple[str, str]]) -> tuple[list[str], dict[str, Person]]:
    """Outcome of each automatic pair (a, b, proposal) in the order of their turns, and each record's person.
    evidence: pairs of records whose direct probability is at least DIRECT."""
    holder = {name: Person(frozenset([name]), frozenset([election]), first, last) for name, election, first, last in records}
    near = defaultdict(set)
    for a, b in evidence:
        near[a].add(b)
        near[b].add(a)
    outcomes = []
    for a, b, proposal in pairs:
        one, two = holder[a], holder[b]
        if one is two:
            outcomes.append("implied")
        elif why := clash(one, two):
            outcomes.append(why)
        elif not all(two.records <= near[r] for r in one.records):
            outcomes.append(EVIDENCE)
        else:
            both = Person(one.records | two.records, one.elections | two.elections, max(one.first, two.first), min(one.last, two.last))
            holder |= dict.fromkeys(both.records, both)
            outcomes.append(proposal)
    return outcomes, holder


def decide(nodes: dict[str, tuple[int, int, int]], edges: list[dict]) -> tuple[list[str], dict[str, str]]:
    """The whole clustering of a few records without Spark: decisions of the edges (pe_a, pe_b, p, proposal, split), and the
    person of every node, named by its smallest record."""
    turns = sorted((RANKS[e["proposal"]], -e["p"], e["pe_a"], e["pe_b"], i) for i, e in enumerate(edges) if e["p"] >= CONSIDERED and not e["split"] and e["proposal"] in AUTOMATIC)
    found, holder = folded([(n, *v) for n, v in nodes.items()], [(e["pe_a"], e["pe_b"], e["proposal"]) for e in (edges[t[-1]] for t in turns)], [(e["pe_a"], e["pe_b"]) for e in edges if e["p"] >= DIRECT])
    decisions = dict(zip((t[-1] for t in turns), found, strict=True))

    def other(e: dict) -> str:
        one, two, possible = holder[e["pe_a"]], holder[e["pe_b"]], e["proposal"] == "possible_match"
        if e["p"] < CONSIDERED:
            return "no_match"
        if e["split"]:  # a record that holds two namesakes is never merged
            return "possible_match" if possible else "manual_review_namesake"
        if one is two:
            return "implied"
        why = clash(one, two)
        return e["proposal"] if why is None else "no_match" if possible else why

    return [decisions[i] if i in decisions else other(e) for i, e in enumerate(edges)], {n: min(p.records) for n, p in holder.items()}


def constrained(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """nodes (key, pe, year, blo, bhi), edges (key, pe_a, pe_b, p, proposal, split) -> (edges with decision, (pe, person)).

    Records without an automatic pair are their own person and never leave the JVM.
    """
    day = F.lit("1900-01-01").cast("date")
    own = settled(nodes.select("pe", F.col("year").cast("long").alias("year"), F.datediff("blo", day).cast("long").alias("lo"), F.datediff("bhi", day).cast("long").alias("hi")), "records")
    pairs = edges.select("pe_a", "pe_b", F.col("p").cast("double").alias("p"), "proposal", "split")
    considered = settled(pairs.where(F.col("p") >= CONSIDERED), "considered")
    turn = F.col("proposal").isin(*AUTOMATIC) & ~F.col("split")
    automatic = considered.where(turn)
    parts = settled(connected(automatic, "pe_a", "pe_b"), "parts")

    # evidence of any kind counts, within a component
    sides = parts.select(F.col("node").alias("pe_a"), "component").join(considered, "pe_a")
    inside = sides.join(parts.select(F.col("node").alias("pe_b"), F.col("component").alias("other")), "pe_b").where("component = other").select("component", "pe_a", "pe_b", "p", "proposal", turn.alias("turn"))
    inside = settled(inside, "evidence")
    grouped = own.join(parts, F.col("pe") == F.col("node")).select("component", "pe", "year", "lo", "hi")

    def fold(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        turns = right[right.turn].assign(rank=lambda r: r.proposal.map(RANKS)).sort_values(["rank", "p", "pe_a", "pe_b"], ascending=[True, False, True, True])
        strong = right[right.p >= DIRECT]
        found, holder = folded(left[["pe", "year", "lo", "hi"]].itertuples(index=False, name=None), list(zip(turns.pe_a, turns.pe_b, turns.proposal, strict=True)), zip(strong.pe_a, strong.pe_b, strict=True))
        names = {n: min(p.records) for n, p in holder.items()}
        n, m = len(turns), len(names)
        return pd.DataFrame({"pe": [*turns.pe_a, *names], "other": pd.Series([*turns.pe_b, *[None] * m], dtype=object), "result": [*found, *names.values()], "is_edge": [True] * n + [False] * m})

    both = settled(grouped.groupBy("component").cogroup(inside.groupBy("component")).applyInPandas(fold, "pe string, other string, result string, is_edge boolean"), "clusters")
    merged = both.where("not is_edge").select("pe", F.col("result").alias("person"))
    persons = settled(own.select("pe").join(merged, "pe", "left").select("pe", F.coalesce("person", "pe").alias("person")), "persons")
    decided = considered.join(both.where("is_edge").select(F.col("pe").alias("pe_a"), F.col("other").alias("pe_b"), F.col("result").alias("outcome")), ["pe_a", "pe_b"], "left")

    # a person's elections and common birth window, beside both ends of the pairs that had no turn
    spans = settled(own.join(persons, "pe").groupBy("person").agg(F.collect_set("year").alias("years"), F.max("lo").alias("lo"), F.min("hi").alias("hi")), "spans")
    named = decided
    for side in "ab":
        ends = persons.join(spans, "person").select(F.col("pe").alias(f"pe_{side}"), *(F.col(c).alias(f"{c}_{side}") for c in ("person", "years", "lo", "hi")))
        named = named.join(ends, f"pe_{side}")
    low = pairs.where(~(F.col("p") >= CONSIDERED) | F.col("p").isNull()).select("pe_a", "pe_b", "p", F.lit("no_match").alias("decision"))
    return named.select("pe_a", "pe_b", "p", F.coalesce("outcome", _without_turn()).alias("decision")).unionByName(low), persons


def _without_turn() -> Column:
    """The decision on a pair that put nothing together, from the persons at its two ends."""
    possible = F.col("proposal") == "possible_match"
    why = F.when(F.arrays_overlap("years_a", "years_b"), ELECTIONS).when(F.greatest("lo_a", "lo_b") > F.least("hi_a", "hi_b"), BIRTHS)
    return (
        F.when(F.col("split"), F.when(possible, "possible_match").otherwise("manual_review_namesake"))
        .when(F.col("person_a") == F.col("person_b"), "implied")
        .when(why.isNotNull(), F.when(possible, "no_match").otherwise(why))
        .otherwise(F.col("proposal"))
    )


def greedy_pairs(edges: DataFrame, key: str = "key") -> DataFrame:
    """One-to-one assignment within each key and two elections: pairs by falling p, each record once for each pair of
    elections. edges: (key, year_a, year_b, pe_a, pe_b, p); returns them with linked."""

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["p", "pe_a", "pe_b"], ascending=[False, True, True])
        used: set = set()
        linked = []
        for r in rows.itertuples():
            sides = {(r.year_a, r.year_b, "a", r.pe_a), (r.year_a, r.year_b, "b", r.pe_b)}
            linked.append(not sides & used)
            if linked[-1]:
                used |= sides
        return rows.assign(linked=linked)

    columns = edges.select(key, "year_a", "year_b", "pe_a", "pe_b", "p")
    return columns.groupBy(key, "year_a", "year_b").applyInPandas(pick, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns.schema) + ", linked boolean")


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component: its smallest member) by spreading the smallest label to neighbours and following labels, settled
    after every round; the driver sees a count only."""
    both = settled(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).union(edges.select(F.col(b), F.col(a))).distinct(), "edges")
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = settled(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next")), "hooked")
        jumps = hooked.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        spread = settled(hooked.join(jumps, "next", "left").select("node", F.coalesce("jump", "next").alias("label"), (F.coalesce("jump", "next") != F.col("label")).alias("moved")), "labels")
        discarded(labels, hooked)
        labels = spread
        if spread.where("moved").isEmpty():
            discarded(both)
            return spread.select("node", F.col("label").alias("component"))


def clash_within(rows: DataFrame, by: list[str], lo: str = "blo", hi: str = "bhi") -> DataFrame:
    """rows with clash: some other row of the group has a window apart from this one. A window is apart from another
    exactly if it begins after the group's earliest end or ends before its latest beginning."""
    bounds = rows.groupBy(*by).agg(F.min(hi).alias("_hi"), F.max(lo).alias("_lo"))
    return rows.join(bounds, by).withColumn("clash", (F.col(lo) > F.col("_hi")) | (F.col(hi) < F.col("_lo"))).drop("_hi", "_lo")


