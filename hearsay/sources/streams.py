"""Message streams. Kafka options are the caller's; files stand in where there is no broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def mention_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Mention messages from Kafka, with their offsets; lost offsets do not fail the query."""
    reader = spark.readStream.format("kafka").options(**{"failOnDataLoss": "false", **options})
    return reader.load().selectExpr("CAST(value AS STRING) AS value", "offset")


def task_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Task requests from Kafka, from the latest offset unless told otherwise."""
    reader = spark.readStream.format("kafka").options(**{"startingOffsets": "latest", **options})
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def replay_source(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Lines of text files as messages, a few files per micro-batch."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
