"""Risk scores: deductions per indicator, geometric scores, warnings and profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearsay import labels
from hearsay.functions import times
from hearsay.operators import ranking

INDICATOR = ["first_level", "second_level"]


def indicator_deduction(matches: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Points lost per indicator: weighted scores plus a surcharge above ``cal_num`` hits, capped.

    The limits are those of the group's first row in ``order`` (default id, word).
    """
    order = order or [c for c in ("id", "word") if c in matches.columns]
    first = F.min_by(
        F.struct("cal_num", "cal_num_limit", "cal_limit"), F.struct(*order)
    )
    return (
        matches.groupBy(*keys, *INDICATOR)
        .agg(
            F.sum(F.col("cal_score") * F.col("weight")).alias("points"),
            F.count(F.lit(1)).alias("hits"),
            first.alias("limits"),
        )
        .select(
            *keys,
            *INDICATOR,
            "hits",
            F.least(
                F.col("points")
                + F.when(F.col("hits") > F.col("limits.cal_num"), F.col("limits.cal_num_limit")).otherwise(0.0),
                F.col("limits.cal_limit"),
            ).alias("deduction"),
        )
    )


def risk_score(
    matches: DataFrame,
    keys: list[str],
    indicators: int = labels.INDICATORS,
    inverted: bool = False,
    order: list[str] | None = None,
) -> DataFrame:
    """Geometric mean over all indicators (absent ones count 100), and the worst indicator's label."""
    left = F.col("left")
    score = F.pow(
        F.product(left) * F.pow(F.lit(100.0), F.lit(float(indicators)) - F.count(F.lit(1))),
        F.lit(1.0 / indicators),
    )
    if inverted:
        score = 100 - score
    worst = F.min_by(F.struct(*INDICATOR), F.struct(F.round(left, 6), *INDICATOR))
    return (
        indicator_deduction(matches, keys, order)
        .withColumn("left", 100 - F.col("deduction"))
        .groupBy(*keys)
        .agg(F.round(score, 2).alias("risk_value"), worst.alias("worst"))
        .select(
            *keys,
            "risk_value",
            F.col("worst.first_level").alias("label"),
            F.col("worst.second_level").alias("second_label"),
        )
    )


def time_decay_weight(publish_date: Column, create_time: Column) -> Column:
    """Weight by age in hours between two date strings; a malformed publish date counts 1."""
    ms = F.abs(times.to_epoch_ms(publish_date) - times.to_epoch_ms(create_time))
    hours = ms / F.lit(float(times.HOUR_MS))
    weight = F.when(F.coalesce(F.length(publish_date), F.lit(0)) != 19, F.lit(labels.DECAY_MALFORMED))
    for below, value in labels.DECAY:
        weight = weight.when(hours < below, F.lit(value))
    return weight.otherwise(F.lit(labels.DECAY_REST))


def mention_risk(
    mentions: DataFrame, hits: DataFrame, lexicon: DataFrame, keys: list[str]
) -> DataFrame:
    """Score each mention from its hits; the rest keep the default risk and no label.

    ``hits`` are (keys, segment, word) rows; a hit weighs source weight times time decay. Only
    negative mentions are scored.
    """
    negative = mentions.filter(F.col("appraise") == labels.NEGATIVE)
    decay = time_decay_weight(F.col("publish_date"), F.col("create_time"))
    weighted = negative.select(*keys, (F.col("source_weight") * decay).alias("weight"))
    entries = lexicon.filter(F.col("appraise") == labels.NEGATIVE).drop("weight", "appraise")
    scored = risk_score(
        hits.join(weighted, keys).join(entries, "word"), keys, order=["word", "first_level"]
    )
    return (
        mentions.join(scored, keys, "left")
        .withColumn("risk_value", F.coalesce("risk_value", F.lit(labels.DEFAULT_RISK)))
        .withColumn("label", F.coalesce("label", F.lit("")))
        .drop("second_label")
    )


def early_warning(risk: Column) -> list[Column]:
    """Warning columns of a risk value: warn_level, warn_label, warn."""
    level = (
        F.when(risk < labels.WARN_RED_BELOW, labels.RED)
        .when(risk <= labels.WARN_ORANGE_UP_TO, labels.ORANGE)
        .when(risk <= labels.WARN_UP_TO, labels.YELLOW)
        .otherwise("")
    )
    importance = (
        F.when(risk <= labels.LABEL_RED_UP_TO, labels.RED)
        .when(risk <= labels.LABEL_YELLOW_UP_TO, labels.YELLOW)
        .otherwise(labels.GREEN)
    )
    warn = F.when(risk <= labels.WARN_UP_TO, 1).otherwise(0)
    return [level.alias("warn_level"), importance.alias("warn_label"), warn.alias("warn")]


def influence_weight(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Mean of the two smallest distinct influence weights; one alone counts itself.

    The distinct weights are few per group, and duplicates are removed before the shuffle.
    """
    column = "result_influence_weight"
    distinct = matches.select(*keys, column).distinct()
    smallest = F.slice(F.sort_array(F.collect_list(column)), 1, 2)
    mean = F.aggregate(smallest, F.lit(0.0), lambda s, x: s + x) / F.size(smallest)
    return distinct.groupBy(*keys).agg(mean.alias("influence_weight"))


def authors_of(matches: DataFrame) -> Column:
    return F.when(F.length("author") > 1, F.col("author"))


def negative_profile(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Base score, label, influence weight, authors and latest test time of negative matches."""
    negative = matches.filter(F.col("appraise") == labels.NEGATIVE)
    counted = negative.groupBy(*keys).agg(
        F.count_distinct(authors_of(negative)).alias("author_size"),
        F.max("test_time").alias("test_time"),
    )
    return (
        risk_score(negative, keys)
        .withColumnRenamed("risk_value", "base_value")
        .drop("second_label")
        .join(influence_weight(negative, keys), keys)
        .join(counted, keys)
    )


def descriptor_evidence(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Evidence shown for negative matches: descriptors only, their key marked with ``-``."""
    return matches.filter(
        (F.col("appraise") == labels.NEGATIVE) & (F.col("use") == labels.DESCRIPTOR)
    ).select(*keys, F.concat("present", F.lit("-")).alias("key"), "id", "publish_ts")


def positive_evidence(matches: DataFrame, keys: list[str]) -> DataFrame:
    return matches.filter(F.col("appraise") == labels.POSITIVE).select(
        *keys, F.col("present").alias("key"), "id", "publish_ts"
    )


def positive_weight(matches: DataFrame, keys: list[str]) -> DataFrame:
    """1 + the single weight whose weight times row count is largest (missing weights are 1)."""
    w = F.round(F.coalesce("single_weight", F.lit(1.0)), 6)
    return (
        matches.filter(F.col("appraise") == labels.POSITIVE)
        .groupBy(*keys, w.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg((1 + F.max_by("w", F.struct(F.round(F.col("w") * F.col("n"), 6), F.col("w")))).alias("pos_weight"))
    )


def positive_profile(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Positive weight, top keys, top authors and latest test time of positive matches."""
    positive = matches.filter(F.col("appraise") == labels.POSITIVE)
    return (
        positive_weight(matches, keys)
        .join(positive.groupBy(*keys).agg(F.max("test_time").alias("test_time")), keys)
        .join(ranking.top_keys(positive, keys), keys)
        .join(ranking.top_authors(positive, keys), keys, "left")
        .fillna({"authors": "", "author_count": 0})
    )


def health_score(base: Column, positive: Column, influence: Column) -> Column:
    base = F.coalesce(base, F.lit(100.0))
    positive = F.coalesce(positive, F.lit(1.0))
    influence = F.coalesce(influence, F.lit(1.0))
    value = F.when(base * positive > 100, 100 * influence).otherwise(base * influence * positive)
    value = F.round(value, 6)
    return F.when(value >= labels.HEALTH_CAP, labels.HEALTH_CAP).otherwise(
        value.cast("int").cast("double")
    )


def health_level(score: Column) -> tuple[Column, Column]:
    """Level and advice text of a health score."""
    level, advice = None, None
    for bound, name, text in labels.HEALTH_LEVELS:
        if level is None:
            level, advice = F.when(score >= bound, name), F.when(score >= bound, text)
        else:
            level, advice = level.when(score >= bound, name), advice.when(score >= bound, text)
    return level.otherwise(labels.HEALTH_LOWEST[0]), advice.otherwise(labels.HEALTH_LOWEST[1])


def period_change(score: Column, previous: Column) -> Column:
    """Change against the previous report's integer part; empty without one, null when it is 0."""
    now, before = score.cast("int"), previous.cast("int")
    share = F.floor(F.abs(now - before) * 100 / before).cast("int")
    return (
        F.when(before.isNull(), "")
        .when(before == 0, F.lit(None).cast("string"))
        .when(now > before, F.concat(F.lit(labels.RATIO_UP), share, F.lit("%。")))
        .when(now < before, F.concat(F.lit(labels.RATIO_DOWN), share, F.lit("%。")))
        .otherwise(labels.RATIO_SAME)
    )
