"""Writers: Parquet between stages, text tables and JSON for others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.session import exists


def write_text_table(df: DataFrame, path: str, gzip: bool = True, mode: str = "overwrite") -> None:
    flat = df.select(*(F.col(c) if not t.startswith(("array", "map", "struct")) else F.to_json(c).alias(c) for c, t in df.dtypes))
    flat.write.mode(mode).option("header", True).option("compression", "gzip" if gzip else "none").csv(path)


def append_new(df: DataFrame, path: str, key: list[str]) -> None:
    """First answer wins: appends the rows whose key the Parquet folder doesn't hold."""
    rows = df.dropDuplicates(key)
    if exists(df.sparkSession, path):
        rows = rows.join(df.sparkSession.read.parquet(path).select(*key), key, "left_anti")
    rows.write.mode("append").parquet(path)


def write_nested(df: DataFrame, by: str, path: str, columns: list[str], order: list[str]) -> None:
    """One JSON document for each key, its rows in order, in folders by key."""
    nested(df, by, columns, order).write.mode("overwrite").partitionBy(by).json(path)


def nested(df: DataFrame, by: str, columns: list[str], order: list[str]) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct(*order, *(c for c in columns if c not in order))))
    return df.groupBy(by).agg(F.to_json(rows).alias("rows"), F.count("*").alias("n"))


def write_shards(df: DataFrame, keys: str, columns: list[str], path: str) -> None:
    """Search shards: a row goes to the folder of each of its keys."""
    df.select(F.explode(keys).alias("prefix"), *columns).repartition("prefix").write.mode("overwrite").partitionBy("prefix").json(path)


def sizes(df: DataFrame) -> DataFrame:
    """File sizes of what a DataFrame reads."""
    return df.select("_metadata.file_name", "_metadata.file_size").distinct()
