"""Delimited text inputs of the clustering jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearsay import schemas


def labelled_rows(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated labelled rows: person, id, title, content, appraise, label."""
    return spark.read.csv(path, schema=schemas.LABELLED)


def title_lines(spark: SparkSession, path: str, noise: str = "[#.【图】：。 ]+") -> DataFrame:
    return spark.read.text(path).select(F.regexp_replace("value", noise, "").alias("title"))


def vector_lines(spark: SparkSession, path: str, skip: int = 2) -> DataFrame:
    """Tab-separated doubles after ``skip`` leading columns."""
    fields = F.split("value", "\t")
    numbers = F.slice(fields, F.lit(skip + 1), F.size(fields))
    return spark.read.text(path).select(F.transform(numbers, lambda x: x.cast("double")).alias("vector"))
