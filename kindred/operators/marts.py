"""Aggregates that pages are made of: distributions, histories, cards, list statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_shares(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*by, column).agg(F.count("*").alias("n"))
    # a window over counts: a row for each value
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def histogram(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Counts for every whole number from low to high; values outside go to the ends."""
    clipped = df.select(F.greatest(F.least(F.col(column), F.lit(high)), F.lit(low)).alias("bin"))
    domain = df.sparkSession.range(low, high + 1).select(F.col("id").cast("int").alias("bin"))
    return domain.join(clipped.groupBy(F.col("bin").cast("int").alias("bin")).agg(F.count("*").alias("n")), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def binned(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed bins; outside them null."""
    out = None
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        hit = (value >= low) & (value < high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out


def mode_smallest(column: str) -> Column:
    """Most common value, the smallest of several."""
    return F.mode(column, True)


def dominant(df: DataFrame, by: str, column: str, weight: str, least: float = 0.95) -> DataFrame:
    """(by, column, share) where one value holds at least that share of the weight."""
    sums = df.groupBy(by, column).agg(F.sum(weight).alias("w"))
    shares = sums.withColumn("share", F.col("w") / F.sum("w").over(Window.partitionBy(by)))
    return shares.where(F.col("share") >= least).select(by, column, "share")


def history(rows: DataFrame, person: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Each person's rows as an ordered array, with first and last election and the number of them."""
    entries = F.sort_array(F.collect_list(F.struct(*order, *columns)))
    return rows.groupBy(person).agg(entries.alias("history"), F.count_distinct(order[0]).alias("n_runs"), F.min(order[0]).alias("since"), F.max(order[0]).alias("last"))


def leavers(rows: DataFrame, person: str, place: str, year: str, before: int, after: int) -> DataFrame:
    """Who ran at a place in one election and not in the next; elsewhere: ran at another place then."""
    then, now = rows.where(F.col(year) == before), rows.where(F.col(year) == after)
    gone = then.select(person, place).distinct().join(now.select(person, place).distinct(), [person, place], "left_anti")
    return gone.join(now.select(person).distinct().withColumn("elsewhere", F.lit(True)), person, "left").withColumn("elsewhere", F.coalesce("elsewhere", F.lit(False)))


def list_identity(rows: DataFrame, names: Sequence[str], ident: str) -> DataFrame:
    """(name, id): every form of a list's name leads to the same id, the smallest of those that have it."""
    forms = rows.select(F.explode(F.array(*names)).alias("name"), F.col(ident).alias("id")).where("name <> ''")
    return forms.groupBy("name").agg(F.min("id").alias("id"))


def reasons(*pairs: tuple[Column, str]) -> Column:
    """Phrases of what holds, in their order."""
    return F.array_compact(F.array(*(F.when(where, F.lit(phrase)) for where, phrase in pairs)))


def skipped_ahead(votes: str, position: str, seats: str, by: str) -> dict[str, Column]:
    """Preference votes: rank in the list, share of it, and whether votes alone lifted someone to a seat."""
    line = Window.partitionBy(by)
    rank = F.rank().over(line.orderBy(F.desc(votes)))
    return {"vote_rank": rank, "vote_share": F.col(votes) / F.sum(votes).over(line), "lifted": (rank <= F.col(seats)) & (F.col(position) > F.col(seats))}


def cards(rows: DataFrame, category: str, value: str, elected: Column, text: str, top: int = 50, least: int = 5) -> DataFrame:
    """One row for each category: size, median, rate of success, and its most common texts."""
    base = rows.groupBy(category).agg(F.count("*").alias("n"), F.median(value).alias("median"), F.avg(elected.cast("double")).alias("rate"), F.count_distinct(text).alias("n_texts"))
    texts = rows.groupBy(category, text).agg(F.count("*").alias("k")).where(F.col("k") >= least)
    ranked = texts.withColumn("rn", F.row_number().over(Window.partitionBy(category).orderBy(F.desc("k"), text))).where(F.col("rn") <= top)
    listed = ranked.groupBy(category).agg(F.sort_array(F.collect_list(F.struct("rn", text, "k"))).alias("top"))
    return base.join(listed, category, "left")


def merged_maps(first: Column, second: Column) -> Column:
    """Union of two maps; the second wins."""
    return F.map_concat(F.map_filter(first, lambda k, _: ~F.map_contains_key(second, k)), second)
