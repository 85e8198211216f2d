"""Session factory, table loading and the shared scratch folder."""

from __future__ import annotations

import atexit
import io
import os
import re
import shutil
import tempfile
import uuid
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def local_session(cpus: str = "8", partitions: int = 8, app: str = "kindred") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KINDRED_DRIVER_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's spark.checkpoint.dir.

    Only where none is named and everything runs in one process (tests) a temporary one is set; a cluster without one is
    an error, as its machines don't see each other's folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="kindred-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """df written once to the shared folder and read back: a cut lineage that survives lost executors. Its shuffle files
    aren't needed after that and go at once. batch: rows that Python functions get at a time, for wide rows."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    lean_write(df, path, batch)
    table = spark.read.schema(df.schema).parquet(path)
    table._kindred_path = path
    return table


def lean_write(df: DataFrame, path: str, batch: int | None = None) -> None:
    """Appends df to the Parquet folder; the shuffle files it took go at once."""
    spark = df.sparkSession
    own = {_CLEANUP: "true"} | ({_BATCH: str(batch)} if batch else {})
    before = {key: spark.conf.get(key) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        df.write.mode("append").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def discarded(*tables: DataFrame | None) -> None:
    """Removes settled tables that nothing will read again: what was made of them is settled itself."""
    for table in tables:
        if path := getattr(table, "_kindred_path", None):
            removed(table.sparkSession, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a scratch folder in whatever store it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once for each application, so that Python functions load there wherever the
    driver was started."""
    context = spark.sparkContext
    if getattr(context, "_kindred_shipped", False):
        return
    root, archive = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(root.rglob("*.py")):
            file.write(source, str(source.relative_to(root.parent)))
    # into the shared folder by Hadoop's own writer, whatever store that is in
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch(spark, 'package')}/kindred-package.zip")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(archive.getvalue()))
    out.close()
    context.addPyFile(path.toString())
    context._kindred_shipped = True


def shipped(query):
    """A query that ships the package first."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
