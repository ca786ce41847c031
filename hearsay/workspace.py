"""Shared scratch space for iterative jobs.

Rounds are written as tables in the folder the cluster names in ``spark.checkpoint.dir``: a written
table cuts the lineage, survives the loss of executors, and gives the optimizer real sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting to remove the shuffle files of a query when it has ended
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="hearsay-")
    return _LOCAL[context.applicationId]


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Queries inside leave no shuffle files, which else stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


class Rounds:
    """Tables of one iterative job, each named and numbered; older ones can be dropped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def write(self, df: DataFrame, table: str, *by: str, options: dict[str, str] | None = None) -> DataFrame:
        """The written table, laid out in a folder for each value of the columns ``by``."""
        with tidy(self.spark):
            df.write.mode("overwrite").partitionBy(*by).options(**(options or {})).parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores before a step that multiplies rows or work.

    A scan of many files already has more partitions than cores and passes through unchanged, as does
    a plan that shuffles; only a small scan, which one task would read, is redistributed.
    """
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by key for a step whose work is large for its bytes.

    The partition count is the session's, so that small shuffles of costly rows are not merged.
    """
    spark = df.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(count, spark.sparkContext.defaultParallelism), *keys)
