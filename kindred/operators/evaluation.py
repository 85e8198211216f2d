"""Evaluation of scores and linkages against labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import settled


#: Buckets that distinct scores are dealt to for cumulated counts.
BUCKETS = 256


def _ranged(counts: DataFrame, score: str) -> DataFrame:
    """counts with their bucket: ranges of scores with about as many distinct ones each. The edges are approximate
    quantiles, a fixed number of them; any edges give the same cumulated counts."""
    edges = counts.agg(F.percentile_approx(score, F.array(*(F.lit(i / BUCKETS) for i in range(1, BUCKETS))), F.lit(10_000)).alias("edges"))
    return counts.join(F.broadcast(edges)).withColumn("bucket", F.size(F.filter("edges", lambda e: e < F.col(score)))).drop("edges")


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Chance that a positive scores above a negative, ties half. From counts by distinct score: each score's positives beat
    the negatives below and half of those beside them. Negatives below are cumulated within ranges of scores, and over the
    ranges' sums, so no task sees all scores."""
    counts = df.groupBy(score).agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg"))
    ranged = settled(_ranged(counts.where(F.col(score).isNotNull()), score), "ranged-scores")
    sums = ranged.groupBy("bucket").agg(F.sum("neg").alias("all"))  # a row for each range
    before = sums.select("bucket", F.coalesce(F.sum("all").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.coalesce(F.sum("neg").over(Window.partitionBy("bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    won = ranged.join(F.broadcast(before), "bucket").withColumn("won", F.col("pos") * (F.col("before") + inside + F.col("neg") / 2))
    return won.agg((F.sum("won") / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0))).alias("auc"), F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))


def sweep(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Shares of positives and negatives at or above each threshold, and their ratio; one pass, a column for each."""
    steps = F.explode(F.array(*(F.lit(float(t)) for t in thresholds))).alias("threshold")
    hits = df.select(score, label, steps)
    yes = (F.col(score) >= F.col("threshold")).cast("double")
    rates = hits.groupBy("threshold").agg(F.avg(F.when(F.col(label) == 1, yes)).alias("tpr"), F.avg(F.when(F.col(label) != 1, yes)).alias("fpr"))
    return rates.withColumns({"lr_yes": F.col("tpr") / F.greatest(F.col("fpr"), F.lit(1e-3)), "lr_no": (1 - F.col("tpr")) / F.greatest(1 - F.col("fpr"), F.lit(1e-3))})


def recall_at(df: DataFrame, score: str, label: str, false_rate: float = 0.01) -> DataFrame:
    """Share of positives above the negatives' (1 - false_rate) quantile, interpolated. The two scores around it are found
    by cumulated counts, within the range of scores that holds them."""
    counts = df.where((F.col(label) != 1) & F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"))
    ranged = settled(_ranged(counts, score), "ranged-scores")
    sums = ranged.groupBy("bucket").agg(F.sum("n").alias("all"))
    before = sums.select("bucket", F.coalesce(F.sum("all").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), (F.sum("all").over(Window.partitionBy()) - 1).alias("top"))
    upto = F.sum("n").over(Window.partitionBy("bucket").orderBy(score).rowsBetween(Window.unboundedPreceding, 0))
    placed = ranged.join(F.broadcast(before), "bucket").withColumn("last", F.col("before") + upto - 1)
    at = F.col("top") * F.lit(1 - false_rate)
    # the score at a place is the smallest one whose rows go that far
    around = placed.agg(F.min(F.when(F.col("last") >= F.floor(at), F.col(score))).alias("low"), F.min(F.when(F.col("last") >= F.ceil(at), F.col(score))).alias("high"), F.first(at - F.floor(at)).alias("part"))
    cut = around.select((F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("threshold"))
    return df.where(F.col(label) == 1).join(F.broadcast(cut)).groupBy("threshold").agg(F.avg((F.col(score) > F.col("threshold")).cast("double")).alias("tpr"))


def agreement(pairs: DataFrame, ours: str, theirs: str) -> DataFrame:
    """Counts of pairs that both, one or neither of two linkages put together, with precision and recall."""
    a, b = F.col(ours), F.col(theirs)
    counts = pairs.agg(F.count_if(a & b).alias("both"), F.count_if(a & ~b).alias("only_ours"), F.count_if(~a & b).alias("only_theirs"), F.count_if(~a & ~b).alias("neither"))
    return counts.withColumns({"precision": F.col("both") / F.greatest(F.col("both") + F.col("only_ours"), F.lit(1)), "recall": F.col("both") / F.greatest(F.col("both") + F.col("only_theirs"), F.lit(1))})


def weighted_disagreement(df: DataFrame, count: str, agree: str) -> DataFrame:
    return df.agg((F.sum(F.when(~F.col(agree), F.col(count)).otherwise(0)) / F.sum(count)).alias("disagreement"), F.count_if(~F.col(agree)).alias("n_differ"), F.count("*").alias("n_texts"))


def expected_false(df: DataFrame, p: str = "p", *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(1 - F.col(p)).alias("expected_false"), F.count("*").alias("n"))


def combined(df: DataFrame, features: Sequence[str], label: str, fold: str) -> DataFrame:
    """Out-of-fold chance of a logistic combination of features; fold: column of 0 and 1."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = VectorAssembler(inputCols=list(features), outputCol="_x").transform(df.withColumn("_y", F.col(label).cast("double")))
    out = None
    for held in (0, 1):
        model = LogisticRegression(featuresCol="_x", labelCol="_y", probabilityCol="_p", rawPredictionCol="_r", predictionCol="_d").fit(rows.where(F.col(fold) != held))
        scored = model.transform(rows.where(F.col(fold) == held)).withColumn("combined", vector_to_array("_p")[1]).drop("_x", "_y", "_p", "_r", "_d")
        out = scored if out is None else out.unionByName(scored)
    return out
