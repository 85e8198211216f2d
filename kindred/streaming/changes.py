"""Feeds as streams: numbered batches, change detection by digest, archive sink, event windows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def body_digest(body: Column, scrub: str = r'\s+(datum|cas|generovano)[A-Z_]*="[^"]*"') -> Column:
    """Digest of a body without what changes at every generation."""
    return F.sha2(F.regexp_replace(body, scrub, ""), 256)


def changed(df: DataFrame, by: str, order: list[str], digest: str) -> DataFrame:
    """Batch form: rows whose digest differs from the one before them (the first of a key too)."""
    from pyspark.sql import Window

    before = F.lag(digest).over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_before", before).where(~F.col("_before").eqNullSafe(F.col(digest))).drop("_before")


def changed_stream(df: DataFrame, by: str, order: list[str], digest: str) -> DataFrame:
    """Stream form: the last digest of each key is kept as state, over restarts too. A key's rows count in their order
    within a batch."""
    columns = df.schema

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(order)
        before = rows[digest].shift(1)
        before.iloc[0] = last
        state.update((rows[digest].iloc[-1],))
        yield rows[rows[digest] != before]

    return df.groupBy(by).applyInPandasWithState(step, columns, "digest string", "append", GroupStateTimeout.NoTimeout)


def windowed(df: DataFrame, ts: str, length: str, *by: str, late: str = "1 day") -> DataFrame:
    """Counts by event-time window; rows later than the watermark are dropped by Spark."""
    rows = df.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    return rows.groupBy(F.window("_ts", length), *by).agg(F.count("*").alias("n"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over what there is, into a Parquet archive. The checkpoint makes a restart go on where it stopped."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()


def gated(df: DataFrame, by: str, order: str, opens: Column) -> DataFrame:
    """Rows of a key from the first on that opens the gate."""
    from pyspark.sql import Window

    opened = F.min(F.when(opens, F.col(order))).over(Window.partitionBy(by))
    return df.withColumn("_opened", opened).where(F.col(order) >= F.col("_opened")).drop("_opened")


class NumberedBatches(DataSource):
    """Stream source of a feed of numbered batches in a folder, body_<n>.xml: the offset is the next number, so a
    restart goes on after the last committed batch. A batch that isn't there yet ends the poll, as does the option most (of
    batches in a poll). A poller by its nature runs on the driver, and its folder is one that the driver reads; feeds in a
    store of many files are read by Spark's own file stream."""

    @classmethod
    def name(cls) -> str:
        return "numbered_batches"

    def schema(self) -> str:
        return "number long, body string"

    def simpleStreamReader(self, schema: StructType) -> SimpleDataSourceStreamReader:
        return _NumberedReader(self.options)


class _NumberedReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.folder, self.start, self.most = options["path"], int(options.get("start", 1)), int(options.get("most", 100))

    def initialOffset(self) -> dict:
        return {"next": self.start}

    def _body(self, number: int) -> str | None:
        try:
            with open(f"{self.folder}/body_{number}.xml", encoding="utf-8") as file:
                return file.read()
        except FileNotFoundError:
            return None

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, number = [], start["next"]
        while len(rows) < self.most and (body := self._body(number)) is not None:
            rows.append((number, body))
            number += 1
        return iter(rows), {"next": number}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(n, self._body(n)) for n in range(start["next"], end["next"])])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NumberedBatches)
