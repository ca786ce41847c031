"""The task analysis: events and health reports of the requested tasks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions import strings
from hearsay.operators import events, projections, reports, tasks, text
from hearsay.operators.listing import PAGE_SIZE
from hearsay.plans.events import assign_events
from hearsay.sinks.tables import notifications
from hearsay.workspace import Rounds


@dataclass
class Stored:
    """Tables the analysis reads.

    ``mentions``: search_id, id, publish_ts, author, platform, appraise, risk_value, heat, title,
    content_words, present_json. ``real_tasks``: real_id, search_id, create_ms, is_vip. ``searches``:
    search_id, search_keys. ``reports``: real_id, section, p_create_time, risk_value. ``event_history``:
    real_id, event_id, section, risk_value, event_order, page, ids, event_title, event_summary.
    """

    mentions: DataFrame
    real_tasks: DataFrame
    searches: DataFrame
    reports: DataFrame
    word_vectors: DataFrame
    dim: int
    event_history: DataFrame | None = None


@dataclass
class Analysis:
    events: DataFrame
    reports: DataFrame
    messages: DataFrame


def analyze(
    requests: DataFrame,
    stored: Stored,
    as_of: datetime,
    windows: dict[int, int] | None = None,
    threshold: float = labels.EVENT_THRESHOLD,
    marks: str = labels.SUMMARY_MARKS,
    service: str = "",
    page_size: int = PAGE_SIZE,
) -> Analysis:
    """Analyse the requested tasks (real_id, search_id) as of a time.

    Every request gets one report per section; one without mentions gets the default reports. Nothing
    is written but intermediate tables: the caller stores the result. ``service`` signs the report texts.
    Id lists come in pages of about ``page_size`` ids, one row each.
    """
    work = Rounds(requests.sparkSession, "analysis")
    windows = windows or labels.SECTIONS
    now = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    now_ms = F.unix_millis(now)
    earlier = stored.reports.filter(F.col("p_create_time") < now_ms)
    requested = tasks.task_search(stored.real_tasks, stored.searches, requests, now_ms)
    requested = requested.withColumn("nick_name", strings.subject_name(F.col("nick_name")))
    requested = work.write(tasks.last_test_lookup(requested, earlier), "tasks")

    kept = projections.has_evidence(stored.mentions).filter("content_words IS NOT NULL")
    look_back = max([370, *windows.values()])
    kept = kept.filter(F.col("publish_ts") >= now - F.make_interval(days=F.lit(look_back)))
    kept, texts = text.set_apart(work, kept, "search_id")
    fanned = tasks.enrich_mentions(tasks.fan_out_tasks(kept, requests), requested)
    presents = projections.decode_evidence(F.col("present_json"))
    title = strings.clean_noise(strings.clean_title(F.col("title"), F.col("nick_name")))
    mentions = fanned.withColumn("presents", presents).withColumn("title", title).drop("present_json")
    mentions = mentions.withColumn("publish_ms", F.unix_millis("publish_ts"))
    mentions = work.write(mentions.withColumn("mention_risk", F.col("risk_value")).drop("risk_value"), "mentions")

    members, described = assign_events(
        mentions, stored.word_vectors, stored.dim, stored.event_history, threshold, marks, texts
    )
    found = _event_rows(work, mentions, members, described, windows, now, stored.event_history, page_size)
    overview = reports.event_overview(found, ["real_id", "section"])

    matches = projections.explode_matches(mentions)
    matches = work.write(projections.sections(matches, now, dict(windows)), "matches")
    previous = tasks.previous_report(earlier)
    result = reports.health_report(requested, matches, overview, previous, service, page_size)
    return Analysis(found, result, notifications(requested))


def _event_rows(work, mentions, members, described, windows, now, history, page_size) -> DataFrame:
    """Stored form of the events: rows per event, section and page of ids, with alerts against the history."""
    rows = mentions.join(members, ["real_id", "id"])
    named = rows.groupBy("real_id", "event_key").agg(
        F.max_by("id", F.struct("publish_ts", "id")).alias("event_id")
    )
    rows = rows.join(named, ["real_id", "event_key"])
    # the event's widest section covers all of its mentions
    cover = {section: None if section == max(windows) else days for section, days in windows.items()}
    rows = work.write(projections.sections(rows, now, cover), "sectioned")
    metrics = events.events_by_section(rows, projections.explode_matches(rows), page_size=page_size)
    titled = metrics.join(named.join(described, ["real_id", "event_key"]), ["real_id", "event_id"])
    if history is None:
        none = rows.sparkSession.range(0)
        known = none.select(F.col("id").alias("real_id"), F.col("id").alias("event_id"), F.lit(0.0).alias("risk_value"))
    else:
        known = history.filter("section = 1").select("real_id", "event_id", "risk_value")
    return work.write(events.event_alert(titled, known).drop("event_key", "history_risk"), "events")
