"""Batch scans. A catalog names where a table lives: a folder of files or JDBC options."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Catalog:
    """Tables by name, from parquet files under ``base`` or from JDBC when options are given."""

    def __init__(self, spark: SparkSession, base: str | None = None, jdbc: dict[str, str] | None = None):
        self.spark = spark
        self.base = base
        self.jdbc = jdbc

    def table(self, name: str, columns: list[str] | None = None) -> DataFrame:
        if self.jdbc:
            df = self.spark.read.format("jdbc").options(**self.jdbc).option("dbtable", name).load()
        else:
            df = self.spark.read.parquet(f"{self.base}/{name}.parquet")
        return df.select(*columns) if columns else df


def date_windows(as_of: datetime, parts: int, days: int) -> list[tuple[datetime, datetime]]:
    """``parts`` half-open windows of ``days`` days, going back from ``as_of``: [start, end)."""
    return [
        (as_of - timedelta(days=(i + 1) * days), as_of - timedelta(days=i * days)) for i in range(parts)
    ]


def date_bucket_scan(
    catalog: Catalog,
    name: str,
    as_of: datetime,
    parts: int,
    days: int,
    column: str = "publish_date",
    where: str | None = None,
) -> DataFrame:
    """Rows of the last ``parts * days`` days with the number of their window (0 = newest).

    From JDBC each window is one predicate, so one partition; from files the range is one pushed-down
    filter and the file splits decide the partitions.
    """
    windows = date_windows(as_of, parts, days)
    oldest, newest = windows[-1][0], windows[0][1]
    if catalog.jdbc:
        options = dict(catalog.jdbc)
        url = options.pop("url")
        extra = f" AND {where}" if where else ""
        df = catalog.spark.read.jdbc(
            url,
            name,
            predicates=[f"{column} < '{end}' AND {column} >= '{start}'{extra}" for start, end in windows],
            properties=options,
        )
    else:
        df = catalog.table(name)
        kind = df.schema[column].dataType.simpleString()
        low, high = (F.lit(str(t)).cast(kind) for t in (oldest, newest))
        df = df.filter((F.col(column) >= low) & (F.col(column) < high))
        if where:
            df = df.filter(where)
    age = F.unix_micros(F.lit(str(newest)).cast("timestamp")) - F.unix_micros(F.col(column).cast("timestamp"))
    window = F.ceil(age / F.lit(days * 86_400_000_000)) - 1
    return df.withColumn("window", window.cast("int"))


def key_range_scan(
    catalog: Catalog, name: str, column: str, lower: int, upper: int, n: int
) -> DataFrame:
    """Whole table with the stride of its numeric key; rows outside the bounds join the end strides."""
    if catalog.jdbc:
        options = dict(catalog.jdbc)
        url = options.pop("url")
        df = catalog.spark.read.jdbc(
            url, name, column=column, lowerBound=lower, upperBound=upper, numPartitions=n, properties=options
        )
    else:
        df = catalog.table(name)
    stride = (upper - lower) // n
    number = F.floor((F.col(column) - lower) / F.lit(stride))
    return df.withColumn("stride", F.greatest(F.lit(0), F.least(F.lit(n - 1), number)).cast("int"))


def id_list_scan(df: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """Rows whose id is listed: a semi join, never a collected list."""
    return df.join(ids.select(column), column, "left_semi")
