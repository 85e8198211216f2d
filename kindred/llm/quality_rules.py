"""Quality rules as a learned decision list, in DataFrame functions throughout.

Statistics of whole texts are column expressions. Sequential covering learns rules for rejection from the statistics of
a bounded labelled sample: a rule grows threshold by threshold on two thirds of it, is pruned on the rest, and takes what
it covers out before the next one. The ordered rules become one CASE expression, readable as SQL (Rule.sql).

Null and empty texts have no words and fail the base rule. Shares of texts without words or lines are 0. Documents with
several labels count by their mean. Without labels of both classes there are no rules and the base rule decides alone.
Repeated rows get equal verdicts; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import held_out, narrowed, smallest_hashes
from kindred.session import discarded, settled

#: Labelled documents of each class that rules are learned from (the smallest hashes of their ids).
SAMPLE_PER_CLASS = 1500
#: So many times as many are drawn first, as some fail the base rule.
DRAW = 3
#: Conditions in a rule, rules in a list, thresholds tried for each statistic, and the share of covered pruning rows that
#: have to be label 0.
MAX_CONDITIONS, MAX_RULES, THRESHOLDS, MIN_PRECISION = 3, 12, 48, 0.9
#: The base rule's least number of words, and its greatest share of repeated words in per cent.
MIN_WORDS, MAX_REPEATED = 50, 50

#: What rules may test. All are finite for every text.
FEATURES = ("mean_word", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "bang_share", "distinct_share", "bar_share", "words_per_line")
#: All columns that statistics() makes, and what judged() adds.
STATISTICS = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *FEATURES}


def repeated_words(words: Column) -> Column:
    """The number of words in three-word windows that come twice or more.

    Hashes of the windows say whether any can be repeated. If so, windows are sorted by hash and words, equal neighbours
    give the repeated starts, and each start adds the words that the start before it has not covered.
    """
    n = F.size(words)
    windows = F.slice(F.arrays_zip(words.alias("a"), F.slice(words, 2, n).alias("b"), F.slice(words, 3, n).alias("c")), 1, n - 2)

    def digest(x: Column) -> Column:
        return F.xxhash64(x["a"], x["b"], x["c"])

    def starts(sorted_windows: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            return (x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

        def marked(x: Column, i: Column) -> Column:
            before = (i > 0) & same(x, F.get(sorted_windows, i - 1))
            after = F.coalesce(same(x, F.get(sorted_windows, i + 1)), F.lit(False))
            return F.when(before | after, x["at"]).otherwise(-1)

        return F.sort_array(F.filter(F.transform(sorted_windows, marked), lambda at: at >= 0))

    keyed = F.sort_array(F.transform(windows, lambda x, i: F.struct(digest(x).alias("h"), x["a"].alias("a"), x["b"].alias("b"), x["c"].alias("c"), i.alias("at"))))
    # transform over an array of one binds a name, so that the inner expression is made once
    found = F.get(F.transform(F.array(keyed), starts), F.lit(0))
    covered = F.aggregate(
        found,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")),
        lambda acc, at: F.struct(at.alias("last"), (acc["total"] + F.least(F.lit(3), at - acc["last"])).alias("total")),
        lambda acc: acc["total"],
    )
    unique = F.size(F.array_distinct(F.transform(windows, digest)))
    return F.when(n < 6, F.when((n >= 4) & (unique < n - 2), covered).otherwise(0)).when(unique < n - 2, covered).otherwise(0)


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df with the statistics of its texts and the features that rules test; text_col goes. Columns of df that have the
    name of a statistic give way to it."""
    names = [c for c in df.columns if c != text_col and c.lower() not in STATISTICS]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # as one column, so that names don't meet those used here
    own = F.struct(*(F.col(f"`{c}`") for c in names)) if names else F.lit(None)
    split = df.select(own.alias("_own"), text.alias("_text"), F.array_remove(F.split(text, r"[ \t-\r]+"), "").alias("_words"), F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]")).alias("_lines"))
    counted = split.select(
        "_own",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.size("_lines").alias("_n_lines"),
        F.size(F.array_distinct("_words")).alias("_n_distinct"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).alias("_n_upper"),
        F.regexp_count("_text", F.lit("!!")).alias("_n_bang"),
        F.regexp_count("_text", F.lit(r"\|")).alias("_n_bar"),
    )

    def per(value: str, base: str) -> Column:
        return F.col(value) / F.greatest(F.col(base), F.lit(1)).cast("double")

    features = {
        "mean_word": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "_n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("_n_upper", "word_chars"),
        "bang_share": per("_n_bang", "n_words"),
        "distinct_share": per("_n_distinct", "n_words"),
        "bar_share": per("_n_bar", "n_words"),
        "words_per_line": per("n_words", "_n_lines"),
    }
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.select(*(F.col("_own")[c].alias(c) for c in names), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base_failed.alias("base_failed"), *(v.alias(k) for k, v in features.items()))


@dataclass(frozen=True)
class Rule:
    """Reject where all conditions (feature, at least or at most, threshold) hold."""

    conditions: tuple[tuple[str, str, float], ...]

    def holds(self, row: dict) -> bool:
        return all(row[f] >= t if op == ">=" else row[f] <= t for f, op, t in self.conditions)

    def sql(self) -> str:
        return " AND ".join(f"{f} {op} {t!r}D" for f, op, t in self.conditions)


def _grow(rows: list[dict], weight: float) -> Rule:
    """Adds the condition of the largest gain in information about label 0 until only label 0 is covered."""
    chosen: list[tuple[str, str, float]] = []
    covered = rows
    while len(chosen) < MAX_CONDITIONS:
        bad = sum(r["label"] == 0 for r in covered)
        good = weight * (len(covered) - bad)
        if not bad or not good:
            break
        base, best = math.log2(bad / (bad + good)), (0.0, None)
        for f in FEATURES:
            values = sorted({r[f] for r in covered})
            cuts = sorted({values[i * (len(values) - 1) // THRESHOLDS] for i in range(THRESHOLDS + 1)})
            for t in cuts:
                for op in (">=", "<="):
                    inside = [r["label"] for r in covered if (r[f] >= t if op == ">=" else r[f] <= t)]
                    b = sum(label == 0 for label in inside)
                    if b and len(inside) < len(covered):
                        gain = b * (math.log2(b / (b + weight * (len(inside) - b))) - base)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, op, t))
        if best[1] is None:
            break
        chosen.append(best[1])
        covered = [r for r in covered if Rule((best[1],)).holds(r)]
    return Rule(tuple(chosen))


def _worth(rule: Rule, rows: list[dict], weight: float) -> tuple[float, float, int]:
    """(share of label 0 among what is covered, the same less the share of label 1, label 0 covered)."""
    labels = [r["label"] for r in rows if rule.holds(r)]
    bad = sum(label == 0 for label in labels)
    good = weight * (len(labels) - bad)
    return (bad / (bad + good), (bad - good) / (bad + good), bad) if labels else (0.0, -1.0, 0)


def learn(rows: list[dict], weight: float = 1.0) -> list[Rule]:
    """Sequential covering. weight: what a row of label 1 counts against one of label 0, for a balanced sample."""
    rows = sorted(rows, key=lambda r: r["doc_id"])
    grow, prune = [r for i, r in enumerate(rows) if i % 3], [r for i, r in enumerate(rows) if not i % 3]
    rules: list[Rule] = []
    while len(rules) < MAX_RULES and any(r["label"] == 0 for r in grow):
        rule = _grow(grow, weight)
        if not rule.conditions:
            break
        # cut conditions off the end while that is no worse on the pruning rows
        best = max((Rule(rule.conditions[:k]) for k in range(len(rule.conditions), 0, -1)), key=lambda r: _worth(r, prune, weight)[1])
        if _worth(best, prune, weight)[0] < MIN_PRECISION or _worth(best, prune, weight)[2] < 2:
            break
        rules.append(best)
        grow, prune = [r for r in grow if not best.holds(r)], [r for r in prune if not best.holds(r)]
    return rules


def rejects(rules: list[Rule]) -> Column:
    """The decision list as one expression: the first rule that holds rejects, none keeps."""
    chain = None
    for rule in rules:
        condition = F.expr(rule.sql())
        chain = F.when(condition, True) if chain is None else chain.when(condition, True)
    return F.lit(False) if chain is None else chain.otherwise(False)


def _examples(texts: DataFrame, marked: DataFrame, label: int, total: int, per_class: int) -> tuple[list[dict], float]:
    """(examples of one class, labelled documents that each stands for). DRAW x per_class documents are drawn by ids alone;
    their texts are settled, so that only they get statistics, and those that pass the base rule are examples, per_class at
    most. More are drawn while that leaves too few."""
    own, draw = marked.where(F.col("label") == label), DRAW * per_class
    while True:
        drawn = smallest_hashes(own, draw, "doc_id").select("doc_id", "label")
        sample = settled(texts.join(drawn, "doc_id"), "sampled-texts")
        passing = settled(statistics(sample).where(~F.col("base_failed")).groupBy("doc_id", "label").agg(F.min(F.struct(*FEATURES)).alias("f")), "examples")
        n = passing.count()
        if n >= per_class or draw >= total:
            rows = [r.asDict() for r in smallest_hashes(passing, per_class, "doc_id").select("doc_id", "label", "f.*").collect()]
            discarded(sample, passing)
            return rows, total * n / min(draw, total) / max(len(rows), 1)
        discarded(sample, passing)
        draw *= DRAW


def learn_from(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = SAMPLE_PER_CLASS) -> list[Rule]:
    """Rules from labelled documents outside the held-out third that are in docs and pass the base rule. A row of a class
    weighs as many labelled documents as it stands for."""
    marked = narrowed(labels, doc_id=("doc_id", "long"), label=(label_col, "double")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marked = marked.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    texts = narrowed(docs, doc_id=("doc_id", "long"), text=("text", "string"))
    marked = settled(marked.join(texts.select("doc_id"), "doc_id", "left_semi"), "labelled")
    total = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(total) != {0, 1}:
        return []
    (bad, each_bad), (good, each_good) = (_examples(texts, marked, c, total[c], per_class) for c in (0, 1))
    discarded(marked)
    return learn(bad + good, each_good / each_bad) if bad and good else []


def judged(df: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """df without its text, with statistics, base_failed and kept, which take the place of columns of these names."""
    return statistics(df, text_col).withColumn("kept", ~F.col("base_failed") & ~rejects(rules))


def kept(df: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """df without the rows that the base rule or a learned rule rejects; all columns as they were."""
    whole = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    found = judged(df.select(whole.alias("_row"), F.col(f"`{text_col}`").alias("_judged")), rules, "_judged")
    return found.where("kept").select("_row.*")


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules = learn_from(docs, labels)
    found = judged(narrowed(docs, doc_id=("doc_id", "long"), text=("text", "string")), rules)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
