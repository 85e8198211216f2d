"""Record linkage: blocked pairs, comparison levels, level probabilities, weights and competitor-normalised scores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.dates import overlap_days
from kindred.functions.numbers import UNSEEN, bits, clip, concentration, draw, odds, share_among

#: Pairs whose birth windows miss each other by a year or more are no pairs; under one day of overlap they can't be one person.
KEPT_OVERLAP = -366


def suffixed(df: DataFrame, suffix: str, but: Sequence[str] = ()) -> DataFrame:
    return df.select(*(F.col(c) if c in but else F.col(c).alias(f"{c}_{suffix}") for c in df.columns))


def blocked_pairs(rows: DataFrame, key: str = "key", order: str = "year", window: tuple[str, str] = ("blo", "bhi")) -> DataFrame:
    """All pairs of one key from two elections, earlier one as _a, with the overlap of their windows.

    One self-join covers every pair of elections; the overlap is a residual condition of it. Common keys are left to
    adaptive skew handling, which splits them on either side.
    """
    a, b = suffixed(rows, "a", [key]), suffixed(rows, "b", [key])
    lo, hi = window
    pairs = a.join(b, key).where(F.col(f"{order}_a") < F.col(f"{order}_b"))
    pairs = pairs.withColumn("overlap", overlap_days(F.col(f"{lo}_a"), F.col(f"{hi}_a"), F.col(f"{lo}_b"), F.col(f"{hi}_b")))
    return pairs.where(F.col("overlap") > KEPT_OVERLAP)


#: Days of begin dates that share a bin of concurrent_pairs; windows of a year reach into four of them.
BIN_DAYS = 122


def concurrent_pairs(rows: DataFrame, by: Sequence[str], differ: Sequence[str] = (), window: tuple[str, str] = ("blo", "bhi"), days: int = BIN_DAYS) -> DataFrame:
    """(id_a, id_b) of all pairs of rows with different ids that agree in `by`, differ in `differ` and whose windows of
    dates overlap, smaller id first.

    The window that begins later (ties: the larger id) stands in the bin of its first day, the other one in every bin it
    reaches into. So each pair meets once, and a row meets only those whose windows come near its own.
    """
    lo, hi = window
    rows = rows.select(*by, "id", F.unix_date(lo).alias("lo"), F.unix_date(hi).alias("hi"), *differ)
    first, last = (F.floor(F.col(c) / days) for c in ("lo", "hi"))
    early = suffixed(rows.withColumn("bin", F.explode(F.sequence(first, last))), "x", [*by, "bin"])
    late = suffixed(rows.withColumn("bin", first), "y", [*by, "bin"])
    begins = F.expr("(lo_x < lo_y or lo_x = lo_y and id_x < id_y) and lo_y <= hi_x and lo_x <= hi_y and id_x <> id_y")
    apart = [F.col(f"{c}_x") != F.col(f"{c}_y") for c in differ]
    return early.join(late, [*by, "bin"]).where(reduce(and_, apart, begins)).select(F.least("id_x", "id_y").alias("id_a"), F.greatest("id_x", "id_y").alias("id_b"))


def known_and_equal(field: str) -> Column:
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    return (a != "") & (b != "") & (a == b)


def geo_level(fields: Sequence[tuple[str, str, bool]], other: str = "other") -> Column:
    """First of (field, level, only where both are known) that agrees, from the innermost area outwards."""
    out = None
    for field, level, guarded in fields:
        same = known_and_equal(field) if guarded else F.col(f"{field}_a") == F.col(f"{field}_b")
        out = F.when(same, level) if out is None else out.when(same, level)
    return out.otherwise(other)


def shared_level(field: str, within: str | None = None) -> Column:
    """na / 0 / 1 / 2+ shared members of two sets. na: a set is empty or, if `within` is given, the rows differ in it."""
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    n = F.size(F.array_intersect(a, b))
    apart = (F.size(a) == 0) | (F.size(b) == 0) if within is None else F.col(f"{within}_a") != F.col(f"{within}_b")
    return F.when(apart, "na").when(n == 0, "0").when(n == 1, "1").otherwise("2+")


def party_level(field: str, none: str) -> Column:
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    return F.when((a == none) & (b == none), "both_none").when(a == b, "same").otherwise("diff")


def titles_level(field: str) -> Column:
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    return F.when((F.size(a) == 0) & (F.size(b) == 0), "none").when(F.array_sort(a) == F.array_sort(b), "same").when((F.size(F.array_except(a, b)) == 0) & (F.size(a) < F.size(b)), "gained").otherwise("other")


def occupation_level(field: str, group: str, retired: str, student: str, similar: float = 0.5) -> Column:
    """missing > same > to_retired > from_student > similar > same_field > diff, the first that holds."""
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    union = F.size(F.array_union(a, b))
    return (
        F.when((F.size(a) == 0) | (F.size(b) == 0), "missing")
        .when(F.array_sort(a) == F.array_sort(b), "same")
        .when(F.col(f"{retired}_b") & ~F.col(f"{retired}_a"), "to_retired")
        .when(F.col(f"{student}_a") & ~F.col(f"{student}_b"), "from_student")
        .when((F.size(F.array_intersect(a, b)) / F.greatest(union, F.lit(1)) >= similar) | (F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0), "similar")
        .when(known_and_equal(group), "same_field")
        .otherwise("diff")
    )


def list_party_level(field: str) -> Column:
    a, b = F.col(f"{field}_a"), F.col(f"{field}_b")
    return F.when((F.size(a) == 0) | (F.size(b) == 0), "na").when(F.size(F.array_intersect(a, b)) > 0, "shared").otherwise("none")


def long_levels(pairs: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., field, level, n): counts of the levels of all fields in one pass."""
    stacked = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("level")) for f in fields))).alias("x")
    return pairs.select(*by, stacked).groupBy(*by, "x.field", "x.level").agg(F.count("*").alias("n"))


def distribution(pairs: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """long_levels with p, each level's share within its field. Groups are fields: their number is fixed."""
    counts = long_levels(pairs, fields, by)
    return counts.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(*by, "field")))


def first_by_level(pairs: DataFrame, per: Sequence[str], level: str, order: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """For each key the pair of the best level in the given order."""
    rank = F.array_position(F.array(*(F.lit(x) for x in order)), F.col(level))
    return pairs.withColumn("_rn", F.row_number().over(Window.partitionBy(*per).orderBy(rank, *ties))).where("_rn = 1").drop("_rn")


def strangers(rows: DataFrame, wanted: int, count: int, key: str = "key", order: str = "year", seed: str = "strangers") -> DataFrame:
    """About `wanted` random pairs of rows with different keys, earlier election first. Rows fall into as many slots as
    give that many pairs, and slots are joined: an equi-join, no numbering of all rows. count: rows there are."""
    slots = max(1, count * count // max(2 * wanted, 1))
    a = suffixed(rows, "a").withColumn("slot", draw(F.lit(slots), f"{key}_a", "id_a", seed=seed + "a"))
    b = suffixed(rows, "b").withColumn("slot", draw(F.lit(slots), f"{key}_b", "id_b", seed=seed + "b"))
    return a.join(b, "slot").where((F.col(f"{order}_a") < F.col(f"{order}_b")) & (F.col(f"{key}_a") != F.col(f"{key}_b"))).drop("slot")


def partners_within(a: DataFrame, b: DataFrame, place: str, seed: str = "partner") -> DataFrame:
    """Each row of b with one random row of a of the same place: rows of a are numbered within the place and b's hash picks
    a number. Columns of a get _a, those of b _b."""
    numbered = suffixed(a, "a").withColumn("rn_a", F.row_number().over(Window.partitionBy(f"{place}_a").orderBy("id_a")))
    sizes = a.groupBy(place).agg(F.count("*").alias("n"))
    picked = b.join(sizes, place).withColumn("rn", (draw(F.col("n"), "id", seed=seed) + 1).cast("int")).drop("n")
    return suffixed(picked, "b", ["rn"]).join(numbered, [F.col(f"{place}_a") == F.col(f"{place}_b"), F.col("rn_a") == F.col("rn")]).drop("rn", "rn_a")


def ring_probability(rows: DataFrame, levels: Sequence[str]) -> DataFrame:
    """By row, the chance that a stranger agrees at each nested level and no inner one: counts of each ring without what the
    ring inside it holds, at least 1, over all rows. levels: columns from the innermost area outwards."""
    sized = rows
    for level in levels:
        sizes = rows.where(F.col(level) != "").groupBy(level).agg(F.count("*").alias(f"_n_{level}"))
        sized = sized.join(sizes, level, "left").withColumn(f"_n_{level}", F.coalesce(f"_n_{level}", F.lit(0)))
    inner = F.lit(0)
    n = rows.agg(F.count("*").alias("_total"))
    sized = sized.join(F.broadcast(n))
    for level in levels:
        running = F.greatest(F.col(f"_n_{level}"), inner)
        sized = sized.withColumn(f"u_{level}", F.greatest(running - inner, F.lit(1)) / F.col("_total"))
        inner = running
    return sized.select(*rows.columns, *(f"u_{level}" for level in levels))


def local_concentration(a: DataFrame, place: str, name: str, first: str, expected: Column) -> DataFrame:
    """(place, name, k): how many more different first names carry a surname at a place than expected, smoothed, clipped."""
    distinct = a.select(place, name, first).distinct()
    counts = distinct.groupBy(place, name).agg((F.count("*") - 1).alias("others"))
    return counts.select(place, name, "others", concentration(F.col("others"), expected).alias("k"))


def field_weights(pairs: DataFrame, m: DataFrame, u: DataFrame, fields: Sequence[str]) -> DataFrame:
    """pairs with w_<field> bits for every field. m and u: (field, level, p), a row for each level: a bounded number,
    turned into one map for each side."""
    for name, table in (("_m", m), ("_u", u)):
        packed = table.groupBy().agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("=", "field", "level"), F.col("p").cast("double")))).alias(name))
        pairs = pairs.join(F.broadcast(packed))
    for field in fields:
        key = F.concat_ws("=", F.lit(field), field)
        pairs = pairs.withColumn(f"w_{field}", bits(F.try_element_at("_m", key), F.try_element_at("_u", key)))
    return pairs.drop("_m", "_u")


def prior_weight(r: Column, expected: Column, c: Column) -> Column:
    """log2 of the re-run rate over the number of namesakes that the other election is expected to hold."""
    return F.log2(F.greatest(r, F.lit(UNSEEN))) - F.log2(F.greatest(expected * c, F.lit(1e-12)))


def best_per_pair(pairs: DataFrame, a: str, b: str, ties: Sequence[str] = ()) -> DataFrame:
    """The pair of the highest weight for each two person-events."""
    order = Window.partitionBy(a, b).orderBy(F.desc("weight"), *ties)
    return pairs.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def normalised(pairs: DataFrame, a: str, b: str, by: Sequence[str] = ("year_a", "year_b"), weight: str = "weight") -> DataFrame:
    """pairs with p, against all competitors of either side within two elections."""
    own = pairs.withColumn("_odds", odds(F.col(weight)))
    sum_a, sum_b = F.sum("_odds").over(Window.partitionBy(*by, a)), F.sum("_odds").over(Window.partitionBy(*by, b))
    return own.withColumn("p", share_among(F.col("_odds"), sum_a, sum_b)).drop("_odds")


def less_reused(pairs: DataFrame, reused: Column, weight: str = "w_party") -> DataFrame:
    """Takes a field's weight back where its agreement rests on a code that was given anew."""
    return pairs.withColumn("weight", F.when(reused, F.col("weight") - F.col(weight)).otherwise(F.col("weight"))).withColumn(weight, F.when(reused, F.lit(0.0)).otherwise(F.col(weight)))


def regional_factor(bearers: DataFrame, total: DataFrame, share: DataFrame, name: str, area: str) -> DataFrame:
    """(name, area, k): how much more common a name is in an area than the area's share of all people says."""
    rows = bearers.join(total, name).join(share, area)
    k = (F.col("n_area") + 0.5 * F.col("share")) / (F.col("n_total") + 0.5) / F.col("share")
    return rows.select(name, area, clip(k, 1.0, 50.0).alias("k"))


def conflicts(pairs: DataFrame, beyond: float = 10.0, prior: str = "w_prior") -> DataFrame:
    """Pairs that everything but age speaks for: no overlap, and more than so many bits besides the prior."""
    return pairs.where((F.col("overlap") <= 0) & (F.col("weight") - F.col(prior) > beyond))
