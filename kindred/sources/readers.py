"""Readers of the register: text tables, logs, caches, embedded state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.session import exists


def strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text_table(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], pattern: str | None = None, year: int | None = None) -> DataFrame:
    """CSV tables (plain or gzip) found below the paths, all columns text, unknown as the empty text. No type is inferred,
    so the files are read once."""
    reader = spark.read.schema(strings(columns)).option("header", True).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    rows = reader.csv([paths] if isinstance(paths, str) else list(paths)).na.fill("")
    return rows if year is None else rows.withColumn("year", F.lit(year))


def regular(df: DataFrame, day: str, column: str = "DATUMVOLEB") -> DataFrame:
    """Rows of the regular election; repeated ones reuse its ids. Tables without the column stay whole."""
    return df.where(F.col(column) == day) if column in df.columns else df


def union_years(frames: Mapping[int, DataFrame]) -> DataFrame:
    out = None
    for year, frame in sorted(frames.items()):
        frame = frame.withColumn("year", F.lit(year))
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    return out


def tolerant(df: DataFrame, wanted: Mapping[str, str], default: str = "") -> DataFrame:
    """The wanted columns (name -> type) in their order; those that a file lacks get the default."""
    have = set(df.columns)
    return df.select(*(F.col(c).cast(kind).alias(c) if c in have else F.lit(default).cast(kind).alias(c) for c, kind in wanted.items()))


def first_existing(spark: SparkSession, *paths: str) -> DataFrame:
    """The first Parquet folder that is there: a later product, or what it is made from."""
    return spark.read.parquet(next((path for path in paths[:-1] if exists(spark, path)), paths[-1]))


def latest(log: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Last write wins: the values of each key's latest row."""
    last = log.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    return last.select(*key, *(F.col(f"_last.{v}").alias(v) for v in values))


def with_answers(pairs: DataFrame, answers: DataFrame, kind: str, value: str = "p", default: float = 0.0) -> DataFrame:
    """pairs with a model's stored answers on (a, b); pairs that were never asked count as the default."""
    own = answers.where(F.col("kind") == kind).select("a", "b", F.col(value).alias("answer"))
    return pairs.join(own, ["a", "b"], "left").withColumn("answer", F.coalesce("answer", F.lit(default)))


def cost_report(answers: DataFrame, like: str) -> DataFrame:
    """Answers and rounded cost of each kind of question."""
    return answers.where(F.col("kind").like(like)).groupBy("kind").agg(F.count("*").alias("n"), F.round(F.sum("cost"), 4).alias("cost"))


def embedded_json(pages: DataFrame, html: str, pattern: str, schema: str) -> DataFrame:
    """The state that pages carry in a script, parsed."""
    return pages.withColumn("state", F.from_json(F.regexp_extract(F.col(html), pattern, 1), schema))


def wide_to_long(df: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """Year columns to rows with a count above 0."""
    numbers = [c for c in df.columns if c not in keys]
    return df.unpivot([F.col(k) for k in keys], numbers, name, value).withColumns({name: F.col(name).cast("int"), value: F.col(value).cast("long")}).where(F.col(value) > 0)


def repaired_flag(c: Column, true: str = "PRAVDA", false: str = "NEPRAVDA") -> Column:
    """Names that a spreadsheet took for truth values."""
    return F.when(c == F.lit(True).cast("string"), true).when(c == F.lit(False).cast("string"), false).otherwise(c)


def rolled_up(rows: DataFrame, offices: DataFrame, office: str, area: str, name: str, count: str, total: str = "total") -> DataFrame:
    """Counts by office to counts by (name, area), with a row for each area's total."""
    by_area = rows.join(offices, office).groupBy(name, area).agg(F.sum(count).alias(count))
    return by_area.unionByName(by_area.groupBy(area).agg(F.sum(count).alias(count)).withColumn(name, F.lit(total)).select(name, area, count))
