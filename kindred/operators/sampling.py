"""Reproducible sampling by hashes instead of random state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.functions.numbers import draw, md5_key


def first_by_hash(df: DataFrame, n: int, *key: str, seed: str = "") -> DataFrame:
    """n rows without replacement (all, if fewer)."""
    return df.orderBy(md5_key(*key, seed=seed), *key).limit(n)


def shuffled(df: DataFrame, *key: str, seed: str = "") -> DataFrame:
    return df.orderBy(md5_key(*key, seed=seed), *key)


def stratified(df: DataFrame, stratum: str, quota: int, *key: str, seed: str = "") -> DataFrame:
    """quota rows of each stratum (all, if fewer)."""
    order = Window.partitionBy(stratum).orderBy(md5_key(*key, seed=seed), *key)
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= quota).drop("_rn")


def in_strata(df: DataFrame, strata: Sequence[tuple[str, Column]]) -> DataFrame:
    """A row for each stratum that a row falls into, with the stratum's name and rank; one pass over the data."""
    hits = F.array_compact(F.array(*(F.when(where, F.struct(F.lit(i).alias("stratum_rank"), F.lit(name).alias("stratum"))) for i, (name, where) in enumerate(strata))))
    return df.withColumn("_s", F.explode(hits)).select(*df.columns, "_s.stratum", "_s.stratum_rank")


def first_stratum(df: DataFrame, *key: str) -> DataFrame:
    """Rows that several strata drew stay in the first of them."""
    return df.withColumn("_first", F.min("stratum_rank").over(Window.partitionBy(*key))).where("stratum_rank = _first").drop("_first")


def with_replacement(numbered: DataFrame, size: int, n: int, seed: str = "") -> DataFrame:
    """n draws from rows numbered 1..size in column rn, with the draw's number."""
    draws = numbered.sparkSession.range(n).select(F.col("id").alias("draw"), (draw(F.lit(size), "id", seed=seed) + 1).alias("rn"))
    return draws.join(numbered, "rn")


def dense_numbers(df: DataFrame, *key: str, salt: str = "", name: str = "number") -> DataFrame:
    """Anonymous dense numbers in the order of a salted hash, without sorting all rows in one task: rows are counted by the
    hash's leading 12 bits (4,096 counts), and numbered within them."""
    hashed = df.withColumn("_h", md5_key(*key, seed=salt)).withColumn("_b", F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"))
    sizes = hashed.groupBy("_b").agg(F.count("*").alias("_n"))
    before = sizes.select("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    own = hashed.join(F.broadcast(before), "_b").withColumn(name, F.col("_before") + F.row_number().over(Window.partitionBy("_b").orderBy("_h", *key)))
    return own.drop("_h", "_b", "_before")
