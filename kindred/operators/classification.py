"""Classification of short free texts: ordered rules, keyword votes, token runs, gender from names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.text import parts, text, words

#: Votes that a word and a stem need, and the share of its most common group.
WORD_VOTES, STEM_VOTES, VOTE_SHARE = 3, 6, 0.85
#: Share of births of one sex that decides a first name.
NAME_SHARE = 0.95


def by_rules(df: DataFrame, column: str, rules: Sequence[tuple[str, str]], default: Column | None = None, skip: Column | None = None) -> DataFrame:
    """df with group and src. Later rules win, so the last one is tested first; skip keeps rules off a row. Patterns are
    Java regular expressions; (?U) in one makes word characters Unicode."""
    chain = None
    for pattern, group in reversed(rules):
        hit = F.col(column).rlike(pattern)
        chain = F.when(hit, F.lit(group)) if chain is None else chain.when(hit, F.lit(group))
    ruled = chain if skip is None else F.when(~skip, chain)
    base = F.lit(None).cast("string") if default is None else default
    return df.withColumn("_rule", ruled).withColumns({"group": F.coalesce("_rule", base), "src": F.when(F.col("_rule").isNotNull(), "rule").when(base.isNotNull(), "model").otherwise("none")}).drop("_rule")


def corrected(df: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Takes a second opinion (key, other, agrees) where it differs and no rule has decided."""
    rows = df.join(second, key, "left")
    take = F.coalesce((F.col("src") != "rule") & ~F.col("agrees") & (F.col("other") != ""), F.lit(False))
    return rows.withColumns({"group": F.when(take, F.col("other")).otherwise(F.col("group")), "src": F.when(take, "second").otherwise(F.col("src"))}).drop("other", "agrees")


def votes(known: DataFrame, column: str, group: str, count: str | None = None, stem: int | None = None, least: int | None = None, share: float = VOTE_SHARE) -> DataFrame:
    """(token, group, n, share) of tokens that mostly stand for one group; each text votes once for each of its tokens."""
    tokens = F.array_distinct(words(column) if stem is None else F.transform(words(column), lambda w: F.substring(w, 1, stem)))
    rows = known.select(F.explode(tokens).alias("token"), F.col(group).alias("group"), (F.lit(1) if count is None else F.col(count)).alias("v"))
    counts = rows.groupBy("token", "group").agg(F.sum("v").alias("n"))
    # a token has as many rows as there are groups
    totals = Window.partitionBy("token")
    ranked = counts.withColumns({"total": F.sum("n").over(totals), "rn": F.row_number().over(totals.orderBy(F.desc("n"), "group"))})
    need = least or (WORD_VOTES if stem is None else STEM_VOTES)
    return ranked.where((F.col("rn") == 1) & (F.col("total") >= need) & (F.col("n") >= share * F.col("total"))).select("token", "group", "n", (F.col("n") / F.col("total")).alias("share"))


def voted(df: DataFrame, key: str, column: str, table: DataFrame) -> DataFrame:
    """(key, group, votes): the group most of a text's known tokens stand for; ties to the smaller name."""
    tokens = df.select(key, F.explode(F.array_distinct(words(column))).alias("token")).join(table.select("token", "group"), "token")
    counts = tokens.groupBy(key, "group").agg(F.count("*").alias("votes"))
    best = counts.groupBy(key).agg(F.max("votes").alias("votes"), F.min_by("group", F.struct(-F.col("votes"), F.col("group"))).alias("group"))
    return best.select(key, "group", "votes")


def left_out(known: DataFrame, key: str, column: str, group: str, share: float = VOTE_SHARE, least: int = WORD_VOTES) -> DataFrame:
    """(key, group, guess): each known text classified by the votes of all others. A text's own vote is taken off the
    counts of its tokens, so one aggregate serves all texts."""
    tokens = known.select(key, F.col(group).alias("own"), F.explode(F.array_distinct(words(column))).alias("token"))
    counts = tokens.groupBy("token", F.col("own").alias("group")).agg(F.count("*").alias("n"))
    # tokens that could pass at all, with a row for each of their groups
    totals = counts.withColumn("total", F.sum("n").over(Window.partitionBy("token"))).where((F.col("total") > least) & (F.col("n") >= share * (F.col("total") - 1)))
    rest = tokens.join(totals, "token").withColumn("n", F.col("n") - (F.col("own") == F.col("group")).cast("int"))
    fit = rest.where((F.col("n") >= share * (F.col("total") - 1)) & (F.col("total") - 1 >= least))
    tally = fit.groupBy(key, "group").agg(F.count("*").alias("votes"))
    guess = tally.groupBy(key).agg(F.min_by("group", F.struct(-F.col("votes"), F.col("group"))).alias("guess"))
    return known.select(key, group).join(guess, key, "left")


def run_lookup(df: DataFrame, key: str, column: str, known: DataFrame, side: str = "prefix") -> DataFrame:
    """(key, known text, group) of the longest run of leading (or trailing) words that is a known text. known: (text, group)."""
    tokens = F.split(F.trim(text(column)), r"\s+")
    n = F.size(tokens)
    lengths = F.explode(F.sequence(F.lit(1), n)).alias("k")
    rows = df.select(key, tokens.alias("w"), n.alias("n"), lengths)
    run = F.slice("w", F.lit(1), F.col("k")) if side == "prefix" else F.slice("w", F.col("n") - F.col("k") + 1, F.col("k"))
    found = rows.select(key, "k", F.array_join(run, " ").alias("text")).join(known, "text")
    return found.groupBy(key).agg(F.max_by(F.struct("text", "group"), "k").alias("x")).select(key, "x.text", "x.group")


def tail_groups(df: DataFrame, key: str, column: str, known: DataFrame, table: DataFrame, status: Sequence[tuple[str, str]] = (), weak: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Groups of texts that nothing else has classified: status words first; then known parts, known leading words, known
    trailing words and word votes, in this order; a weak status only if nothing else hits. (key, group, how)."""
    rows = df.select(key, F.col(column).alias("_t"))
    for name, patterns in (("status", status), ("weak", weak)):
        chain = F.lit(None).cast("string")
        for pattern, group in reversed(patterns):
            chain = F.when(F.col("_t").rlike(pattern), group).otherwise(chain)
        rows = rows.withColumn(name, chain)
    pieces = rows.select(key, F.posexplode(parts("_t")).alias("at", "part"))
    exact = pieces.join(known.withColumnRenamed("text", "part"), "part").groupBy(key).agg(F.min_by("group", F.struct("at", "group")).alias("exact"))
    named = pieces.select(F.concat_ws("|", F.col(key).cast("string"), F.col("at").cast("string")).alias("piece"), F.col(key), "at", "part")
    found = exact
    for side in ("prefix", "suffix"):
        runs = run_lookup(named, "piece", "part", known, side).join(named.select("piece", key, "at"), "piece")
        found = found.join(runs.groupBy(key).agg(F.min_by("group", F.struct("at", "group")).alias(side)), key, "full")
    found = found.join(voted(rows, key, "_t", table).select(key, F.col("group").alias("vote")), key, "full")
    out = rows.join(found, key, "left")
    order = ("status", "exact", "prefix", "suffix", "vote", "weak")
    how = F.lit("none")
    for name in reversed(order):
        how = F.when(F.col(name).isNotNull(), name).otherwise(how)
    return out.select(key, F.coalesce(*order).alias("group"), how.alias("how"))


def name_gender(births: DataFrame, name: str = "name", sex: str = "sex", n: str = "n", share: float = NAME_SHARE) -> DataFrame:
    """(name, gender) of names nearly always given to one sex: Z or M."""
    sums = births.groupBy(name).agg(F.sum(F.when(F.col(sex) == "Z", F.col(n)).otherwise(0)).alias("z"), F.sum(F.when(F.col(sex) == "M", F.col(n)).otherwise(0)).alias("m"))
    total = F.nullif(F.col("z") + F.col("m"), F.lit(0))
    return sums.select(name, F.when(F.col("z") >= share * total, "Z").when(F.col("m") >= share * total, "M").alias("gender")).where("gender is not null")


def gender(df: DataFrame, first: str, surname: str, names: DataFrame, official: DataFrame | None = None) -> DataFrame:
    """df with gender: the official list, else births, else the surname's ending. A female ending against a male first
    name, and the other way round where only endings speak, is unknown. names, official: (name, gender); a name that is
    in the official list for both sexes decides nothing."""
    key = F.lower(F.trim(F.col(first)))
    rows = df.withColumn("_name", key)
    listed = names.select(F.lower("name").alias("_name"), F.col("gender").alias("_births"))
    rows = rows.join(listed.dropDuplicates(["_name"]), "_name", "left")
    if official is None:
        rows = rows.withColumns({"_list": F.lit(None).cast("string"), "_both": F.lit(False)})
    else:
        sides = official.groupBy(F.lower("name").alias("_name")).agg(F.min("gender").alias("_list"), (F.min("gender") != F.max("gender")).alias("_both"))
        rows = rows.join(sides, "_name", "left").withColumn("_both", F.coalesce("_both", F.lit(False)))
    by_name = F.when(F.col("_both"), F.lit(None)).otherwise(F.coalesce("_list", "_births"))
    female = F.lower(F.trim(F.col(surname))).rlike("(á|ova|ová)$")
    decided = F.when(by_name == "Z", "Z").when((by_name == "M") & ~female, "M").when(by_name.isNull() & female, "Z")
    return rows.withColumn("gender", decided).drop("_name", "_births", "_list", "_both")
