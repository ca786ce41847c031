"""Parsing, cleaning and filtering of rows. All of these are map-only plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay import labels, schemas
from hearsay.functions import strings, times


def parse_mentions(
    messages: DataFrame, as_of: datetime | None, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """JSON messages to mention rows; a row that does not parse keeps its text in ``rejected``.

    Columns of the messages to ``keep`` come last.

    ``mainBody`` may be a comma-separated string or an array; ``segments_raw`` holds either. Without
    ``as_of`` an empty creation time is the current time, in a stream that of the batch.
    """
    text = F.col(value)
    whole = F.contains(text, F.lit("}"))
    rows = messages.filter(whole).select(
        *keep,
        text.alias("raw"),
        F.from_json(text, schemas.MENTION_TEXT_BODY).alias("m"),
        F.from_json(text, schemas.MENTION_LIST_BODY)["mainBody"].alias("body_list"),
    )
    is_list = F.rlike(F.get_json_object("raw", "$.mainBody"), F.lit(r"^\s*\["))
    stamp = "yyyy-MM-dd HH:mm:ss"
    now = F.date_format(F.current_timestamp(), stamp) if as_of is None else F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S"))
    body = F.col("m.mainBody")
    return rows.select(
        F.col("m.searchId").alias("search_id"),
        F.col("m.nickName").alias("nick_name"),
        F.col("m.id").alias("id"),
        F.col("m.title").alias("title"),
        strings.clean_content(F.col("m.contentWords")).alias("content_words"),
        F.col("m.author").alias("author"),
        F.col("m.platform").alias("platform"),
        F.col("m.sourceName").alias("source_name"),
        F.col("m.publishDate").alias("publish_date"),
        F.col("m.appraise").alias("appraise"),
        F.col("m.heat").alias("heat"),
        F.coalesce(F.when(F.col("m.createTime") != "", F.col("m.createTime")), now).alias("create_time"),
        F.when(is_list & F.col("body_list").isNotNull(), F.col("body_list"))
        .when(body.isNotNull(), F.split(strings.clean_body(body), ","))
        .otherwise(F.array().cast("array<string>"))
        .alias("segments_raw"),
        F.when(F.col("m.id").isNull(), F.col("raw")).alias("rejected"),
        *keep,
    )


def parse_tasks(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON requests to (real_id, search_id); ids may be numbers or strings."""
    request = F.from_json(F.col(value), schemas.TASK)
    return (
        messages.filter(F.contains(F.col(value), F.lit("}")))
        .select(
            request["realId"].cast("bigint").alias("real_id"),
            request["searchId"].cast("bigint").alias("search_id"),
        )
        .filter("real_id IS NOT NULL AND search_id IS NOT NULL")
    )


def appraised_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("appraise").isin(labels.NEGATIVE, labels.POSITIVE))


def has_evidence(df: DataFrame, column: str = "present_json") -> DataFrame:
    return df.filter(strings.missing_to_null(F.col(column)).isNotNull())


def stale_content(df: DataFrame, since: str, shorter_than: int = 10) -> DataFrame:
    return df.filter((F.col("publish_date") >= since) & (F.length("content_words") < shorter_than))


def missing_summary(df: DataFrame) -> DataFrame:
    return df.filter("event_summary IS NULL OR event_summary = ''")


def effective_test_time(create_ms: Column, as_of_ms: Column) -> Column:
    return F.when(as_of_ms - create_ms > times.HOUR_MS, as_of_ms).otherwise(create_ms)


def task_key(real_id: Column, is_vip: Column, create_ms: Column) -> Column:
    return F.concat_ws("-", real_id, is_vip, create_ms)


def unit_weight(column: Column) -> Column:
    return F.when(column.isNotNull(), F.lit(1.0))


def encode_evidence(column: Column) -> Column:
    return F.to_json(column)


def decode_evidence(column: Column) -> Column:
    return F.from_json(strings.missing_to_null(column), schemas.EVIDENCE_LIST)


def explode_matches(mentions: DataFrame, evidence: str = "presents") -> DataFrame:
    """One row per (mention, evidence); a missing weight counts as 1."""
    rest = [c for c in mentions.columns if c != evidence]
    rows = mentions.select(*rest, F.explode(evidence).alias("_e"))
    fields = [f for f in mentions.schema[evidence].dataType.elementType.names]
    kept = [c for c in rest if c not in fields]
    return rows.select(
        *kept,
        *[F.col("_e")[f].alias(f) for f in fields if f != "weight"],
        F.coalesce(F.col("_e")["weight"].cast("double"), F.lit(1.0)).alias("weight"),
    )


def sections(
    df: DataFrame, as_of: Column, windows: dict[int, int | None], ts: str = "publish_ts"
) -> DataFrame:
    """Copy each row into every section whose look-back (in days) covers it; ``None`` covers all.

    The copies are generated inside the row, so a row fans out to at most ``len(windows)`` rows and
    no join is planned.
    """
    covered = F.array_compact(
        F.array(
            *[
                F.lit(section)
                if days is None
                else F.when(F.col(ts) >= as_of - F.make_interval(days=F.lit(days)), F.lit(section))
                for section, days in windows.items()
            ]
        )
    )
    return df.withColumn("section", F.explode(covered))
