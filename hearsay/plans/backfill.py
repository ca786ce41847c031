"""Maintenance jobs that fill missing columns of stored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import events, projections, text
from hearsay.sinks.tables import keyed_update
from hearsay.sources.tables import id_list_scan


def backfill_summaries(stored: DataFrame, articles: DataFrame, marks: str = labels.SUMMARY_MARKS) -> DataFrame:
    """Events with a missing summary get that of their representative article (id, content)."""
    waiting = projections.missing_summary(stored).select("event_id", "ids")
    chosen = events.event_representative(waiting, articles).select("event_id", "content")
    summaries = text.extract_summary(chosen, "event_id", "content", marks)
    return keyed_update(stored, summaries.withColumnRenamed("summary", "event_summary"), ["event_id"])


def backfill_content(stored: DataFrame, articles: DataFrame, since: str, shorter_than: int = 10) -> DataFrame:
    """Rows with too short a text get it again from the article (id, platform, content)."""
    stale = projections.stale_content(stored, since, shorter_than).select("id")
    words = F.array_join(text.tokens_of(F.col("content")), " ")
    found = id_list_scan(articles, stale).select("id", "platform", words.alias("content_words"))
    return keyed_update(stored, found, ["id"])
