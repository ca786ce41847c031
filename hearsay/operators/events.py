"""Event metrics from mentions with an assigned ``event_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import scoring
from hearsay.operators.listing import PAGE_SIZE, ids_text, paged

KEYS = ["real_id", "event_id", "section"]


def _negative(df: DataFrame) -> DataFrame:
    return df.filter(F.col("appraise") == labels.NEGATIVE)


def event_risk(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Inverted risk and first-level label over the negative evidence."""
    return scoring.risk_score(_negative(matches), keys, inverted=True).drop("second_label")


def event_totals(mentions: DataFrame, keys: list[str]) -> DataFrame:
    bad = F.count_if(F.col("appraise") == labels.NEGATIVE) > 0
    return mentions.groupBy(*keys).agg(
        F.round(F.sum("heat"), 4).alias("event_heat"),
        F.when(bad, labels.NEGATIVE).otherwise(labels.POSITIVE).alias("event_appraise"),
    )


def event_section(mentions: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """Heat, appraisal, inverted risk and label per event and section."""
    return (
        event_totals(mentions, keys)
        .join(event_risk(matches, keys), keys, "left")
        .withColumn("risk_value", F.coalesce("risk_value", F.lit(0.0)))
        .withColumn("label", F.coalesce("label", F.lit("")))
    )


def _listed(df: DataFrame, keys: list[str], item: str, value: Column, name: str) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct(item, value.alias("v"))))
    text = F.transform(pairs, lambda p: F.concat(p[item], F.lit(":"), p["v"]))
    return df.groupBy(*keys).agg(F.array_join(text, ",").alias(name))


def platform_distribution(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """``platform:count`` over all and over negative mentions."""
    counted = mentions.groupBy(*keys, "platform").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("appraise") == labels.NEGATIVE).alias("bad")
    )
    everything = _listed(counted, keys, "platform", F.col("n"), "plat_all")
    negative = _listed(counted.filter("bad > 0"), keys, "platform", F.col("bad"), "plat_neg")
    return everything.join(negative, keys, "left").withColumn("plat_neg", F.coalesce("plat_neg", F.lit("")))


def _day() -> Column:
    return F.date_format("publish_ts", "yyyy-MM-dd").alias("day")


def daily_counts(mentions: DataFrame, keys: list[str]) -> DataFrame:
    per_day = mentions.groupBy(*keys, _day()).agg(F.count(F.lit(1)).alias("n"))
    return _listed(per_day, keys, "day", F.col("n"), "date_counts")


def daily_risk(mentions: DataFrame, matches: DataFrame, keys: list[str]) -> DataFrame:
    """``day:inverted risk`` of that day's negative evidence, 0.0 without any."""
    days = mentions.select(*keys, _day()).distinct()
    risk = event_risk(matches.withColumn("day", _day()), [*keys, "day"])
    values = days.join(risk, [*keys, "day"], "left")
    return _listed(values, keys, "day", F.coalesce("risk_value", F.lit(0.0)).cast("string"), "date_risks")


def event_word(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Presentation word of the event words whose mention has the lowest risk."""
    words = matches.filter(F.col("use") == labels.EVENT_WORD)
    return words.groupBy(*keys).agg(
        F.min_by("present", F.struct("mention_risk", "present")).alias("event_words")
    )


def event_members(mentions: DataFrame, keys: list[str]) -> DataFrame:
    """One row per member with a flag for members published after the last test."""
    return mentions.select(*keys, "id", (F.col("publish_ms") > F.col("last_test")).alias("new"))


def event_newness(mentions: DataFrame, keys: list[str], page_size: int = PAGE_SIZE) -> DataFrame:
    """Pages of the sorted ids and of those published after the last test, and whether all ids are such."""
    totals = {"n": F.count(F.lit(1)), "n_new": F.count_if("new")}
    rows = paged(event_members(mentions, keys), keys, page_size, totals)
    return rows.groupBy(*keys, "page").agg(
        ids_text().alias("ids"),
        ids_text(only=F.col("new")).alias("new_ids"),
        F.when(F.max("n") == F.max("n_new"), 1).otherwise(0).alias("is_new"),
    )


def event_representative_id(mentions: DataFrame, keys: list[str]) -> DataFrame:
    return mentions.groupBy(*keys).agg(F.max_by("id", F.struct("publish_ts", "id")).alias("event_key"))


def event_alert(events: DataFrame, history: DataFrame, warn: float = labels.EVENT_WARN_RISK) -> DataFrame:
    """Mark recent events that are new or whose risk crossed the warning line.

    ``history`` holds stored section-1 risks per (real_id, event_id), on each page of an event; a missing
    one counts 100.
    """
    known = history.groupBy("real_id", "event_id").agg(F.max("risk_value").alias("history_risk"))
    joined = events.join(known, ["real_id", "event_id"], "left")
    recent = F.col("section") == 1
    unknown = recent & F.col("history_risk").isNull()
    is_new = F.when(unknown, 1).otherwise(F.col("is_new"))
    before = F.coalesce("history_risk", F.lit(labels.DEFAULT_RISK))
    crossed = recent & (F.col("risk_value") > warn) & ((before < warn) | (F.col("is_new") == 1))
    return (
        joined.withColumn("new_ids", F.when(unknown, F.col("ids")).otherwise(F.col("new_ids")))
        .withColumn("is_new", is_new)
        .withColumn("history_risk", before)
        .withColumn("new_warn", F.when(crossed, 1).otherwise(0))
    )


def event_membership(mentions: DataFrame, history: DataFrame) -> DataFrame:
    """First historical event (by ``event_order``) that lists the mention on one of its pages."""
    listed = history.select(
        "real_id", "event_id", "event_order", F.explode(F.split("ids", ",")).alias("listed")
    ).select("real_id", "event_id", "event_order", F.col("listed").cast("bigint").alias("id"))
    first = listed.groupBy("real_id", "id").agg(
        F.min_by(F.struct("event_id", "event_order"), F.struct("event_order", "event_id")).alias("e")
    )
    found = first.select("real_id", "id", "e.event_id", "e.event_order")
    return mentions.join(found, ["real_id", "id"])


def event_representative(events: DataFrame, articles: DataFrame, key: str = "event_id") -> DataFrame:
    """Article with the largest member id of each event, over all of its pages."""
    ids = F.transform(F.split("ids", ","), lambda i: i.cast("bigint"))
    largest = events.groupBy(key).agg(F.max(F.array_max(ids)).alias("id"))
    return largest.join(articles, "id")


def event_centroid(vectors: DataFrame, keys: list[str], dim: int, vector: str = "vector") -> DataFrame:
    """Mean member vector; a missing vector counts as zeros. One aggregate, no expansion of rows."""
    parts = [F.avg(F.coalesce(F.get(F.col(vector), i).cast("double"), F.lit(0.0))) for i in range(dim)]
    return vectors.groupBy(*keys).agg(F.array(*parts).alias("centroid"))


def events_by_section(
    mentions: DataFrame, matches: DataFrame, keys: list[str] | None = None, page_size: int = PAGE_SIZE
) -> DataFrame:
    """All event columns per (real_id, event_id, section), on each page of the event's ids."""
    keys = keys or KEYS
    result = event_section(mentions, matches, keys)
    for part in (
        event_newness(mentions, keys, page_size),
        platform_distribution(mentions, keys),
        daily_counts(mentions, keys),
        daily_risk(mentions, matches, keys),
    ):
        result = result.join(part, keys)
    return result.join(event_word(matches, keys), keys, "left").withColumn(
        "event_words", F.coalesce("event_words", F.lit(""))
    )
