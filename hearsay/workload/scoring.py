"""Scores, profiles and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import reports, scoring, tasks
from hearsay.operators.projections import sections
from hearsay.workload import fixtures as fx
from hearsay.workload.registry import query

NEG, POS = labels.NEGATIVE, labels.POSITIVE
NEGATIVE = f"(SELECT * FROM matches WHERE appraise = '{NEG}')"


def negative(spark, sf_dir):
    return fx.matches(spark, sf_dir).filter(F.col("appraise") == NEG)


@query(
    "indicator_deduction",
    f"SELECT real_id, first_level, second_level, CAST(hits AS BIGINT) AS hits, round(deduction, 4) AS deduction "
    f"FROM ({fx.deduction_sql(NEGATIVE, 'real_id')})",
    "matches",
)
def indicator_deduction(spark, sf_dir):
    result = scoring.indicator_deduction(negative(spark, sf_dir), ["real_id"])
    return result.withColumn("deduction", F.round("deduction", 4))


@query("risk_score", f"SELECT real_id, risk_value FROM ({fx.score_sql(NEGATIVE, 'real_id')})", "matches")
def risk_score(spark, sf_dir):
    return scoring.risk_score(negative(spark, sf_dir), ["real_id"]).select("real_id", "risk_value")


@query(
    "risk_label", f"SELECT real_id, label, second_label FROM ({fx.score_sql(NEGATIVE, 'real_id')})", "matches"
)
def risk_label(spark, sf_dir):
    return scoring.risk_score(negative(spark, sf_dir), ["real_id"]).drop("risk_value")


DECAY_SQL = (
    "CASE "
    + " ".join(f"WHEN hours < {below} THEN CAST({value} AS DOUBLE)" for below, value in labels.DECAY)
    + f" ELSE CAST({labels.DECAY_REST} AS DOUBLE) END"
)
HOURS_SQL = (
    "abs(epoch_ms(CAST(publish_date AS TIMESTAMP)) - epoch_ms(CAST(create_time AS TIMESTAMP))) / 3600000.0"
)


@query(
    "time_decay_weight",
    f"SELECT id, {DECAY_SQL} AS weight FROM (SELECT id, {HOURS_SQL} AS hours FROM article)",
    "article",
)
def time_decay_weight(spark, sf_dir):
    weight = scoring.time_decay_weight(F.col("publish_date"), F.col("create_time"))
    return fx.article(spark, sf_dir).select("id", weight.alias("weight"))


@query(
    "early_warning",
    f"""SELECT real_id, risk_value,
  CASE WHEN risk_value < 50 THEN '{labels.RED}' WHEN risk_value <= 77 THEN '{labels.ORANGE}'
       WHEN risk_value <= 88 THEN '{labels.YELLOW}' ELSE '' END AS warn_level,
  CASE WHEN risk_value <= 53.52 THEN '{labels.RED}' WHEN risk_value <= 89.34 THEN '{labels.YELLOW}'
       ELSE '{labels.GREEN}' END AS warn_label,
  CASE WHEN risk_value <= 88 THEN 1 ELSE 0 END AS warn
FROM ({fx.score_sql(NEGATIVE, 'real_id')})""",
    "matches",
)
def early_warning(spark, sf_dir):
    scores = scoring.risk_score(negative(spark, sf_dir), ["real_id"])
    return scores.select("real_id", "risk_value", *scoring.early_warning(F.col("risk_value")))


INFLUENCE_SQL = """SELECT {keys}, avg(w) AS influence_weight FROM (
  SELECT {keys}, w, row_number() OVER (PARTITION BY {keys} ORDER BY w) AS r
  FROM (SELECT DISTINCT {keys}, result_influence_weight AS w FROM {source})) WHERE r <= 2 GROUP BY {keys}"""


@query(
    "influence_weight",
    "SELECT real_id, round(influence_weight, 6) AS influence_weight FROM ("
    + INFLUENCE_SQL.format(keys="real_id", source=NEGATIVE) + ")",
    "matches",
)
def influence_weight(spark, sf_dir):
    result = scoring.influence_weight(negative(spark, sf_dir), ["real_id"])
    return result.withColumn("influence_weight", F.round("influence_weight", 6))


@query(
    "negative_profile",
    f"""SELECT s.real_id, s.risk_value AS base_value, s.label, round(i.influence_weight, 6) AS influence_weight,
  c.author_size, c.test_time
FROM ({fx.score_sql(NEGATIVE, 'real_id')}) s
JOIN ({INFLUENCE_SQL.format(keys='real_id', source=NEGATIVE)}) i USING (real_id)
JOIN (SELECT real_id, count(DISTINCT CASE WHEN length(author) > 1 THEN author END) AS author_size,
        max(test_time) AS test_time FROM {NEGATIVE} GROUP BY real_id) c USING (real_id)""",
    "matches",
)
def negative_profile(spark, sf_dir):
    result = scoring.negative_profile(fx.matches(spark, sf_dir), ["real_id"])
    return result.withColumn("influence_weight", F.round("influence_weight", 6))


POSITIVE_SQL = f"""SELECT {{keys}}, 1 + arg_max(w, (round(w * n, 6), w)) AS pos_weight FROM (
  SELECT {{keys}}, round(coalesce(single_weight, CAST(1 AS DOUBLE)), 6) AS w, count(*) AS n
  FROM {{source}} WHERE appraise = '{POS}' GROUP BY {{keys}}, w) GROUP BY {{keys}}"""


@query(
    "positive_profile",
    f"""WITH p AS (SELECT * FROM matches WHERE appraise = '{POS}'),
keyed AS (SELECT real_id, present, count(DISTINCT id) AS n FROM p GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY real_id ORDER BY n DESC, present) AS r,
         count(*) OVER (PARTITION BY real_id) AS items FROM keyed),
top AS (SELECT real_id, CASE WHEN items > 3 THEN string_agg(present, '、' ORDER BY r)
    ELSE string_agg(present, ' ' ORDER BY r) END AS post_keys
  FROM rk WHERE r <= 3 GROUP BY real_id, items),
au AS (SELECT real_id, author, count(*) AS n FROM p WHERE length(author) > 1 GROUP BY ALL),
ra AS (SELECT *, row_number() OVER (PARTITION BY real_id ORDER BY n DESC, author) AS r,
         count(*) OVER (PARTITION BY real_id) AS author_count FROM au),
auth AS (SELECT real_id, author_count, string_agg(author, '、' ORDER BY r) AS authors
  FROM ra WHERE r <= 3 GROUP BY ALL)
SELECT real_id, round(pos_weight, 6) AS pos_weight, post_keys, authors, author_count
FROM ({POSITIVE_SQL.format(keys='real_id', source='matches')}) JOIN top USING (real_id) JOIN auth USING (real_id)""",
    "matches",
)
def positive_profile(spark, sf_dir):
    result = scoring.positive_profile(fx.matches(spark, sf_dir), ["real_id"])
    return result.drop("test_time").withColumn("pos_weight", F.round("pos_weight", 6))


HEALTH_SQL = f"""SELECT {{keys}}, CASE WHEN v >= 99 THEN CAST(99 AS DOUBLE) ELSE CAST(trunc(v) AS DOUBLE) END AS risk_value
FROM (SELECT {{keys}}, round(CASE WHEN coalesce(b, 100) * coalesce(pos_weight, 1) > 100
    THEN 100 * coalesce(influence_weight, 1)
    ELSE coalesce(b, 100) * coalesce(influence_weight, 1) * coalesce(pos_weight, 1) END, 6) AS v
  FROM (SELECT * FROM (SELECT {{keys}}, risk_value AS b FROM (__SCORE__)) JOIN (__INF__) USING ({{keys}}))
  FULL JOIN (__POS__) USING ({{keys}}))"""


def health_sql(keys: str, source: str) -> str:
    neg = f"(SELECT * FROM {source} WHERE appraise = '{NEG}')"
    sql = HEALTH_SQL.replace("__SCORE__", fx.score_sql(neg, keys))
    sql = sql.replace("__INF__", INFLUENCE_SQL.format(keys=keys, source=neg))
    sql = sql.replace("__POS__", POSITIVE_SQL.format(keys=keys, source=source))
    return sql.replace("{keys}", keys)


@query("health_score", health_sql("real_id", "matches"), "matches")
def health_score(spark, sf_dir):
    return reports.health_values(fx.matches(spark, sf_dir), ["real_id"])


def level_sql(column: str, which: int) -> str:
    cases = " ".join(f"WHEN {column} >= {row[0]} THEN '{row[which]}'" for row in labels.HEALTH_LEVELS)
    return f"CASE {cases} ELSE '{labels.HEALTH_LOWEST[which - 1]}' END"


@query(
    "health_level",
    f"SELECT real_id, {level_sql('risk_value', 1)} AS level, {level_sql('risk_value', 2)} AS advice "
    f"FROM ({health_sql('real_id', 'matches')})",
    "matches",
)
def health_level(spark, sf_dir):
    level, advice = scoring.health_level(F.col("risk_value"))
    values = reports.health_values(fx.matches(spark, sf_dir), ["real_id"])
    return values.select("real_id", level.alias("level"), advice.alias("advice"))


PREVIOUS_SQL = """SELECT real_id, section, arg_max(risk_value, (p_create_time, risk_value)) AS previous
FROM report_history GROUP BY real_id, section"""
CHANGE_SQL = f"""CASE WHEN previous IS NULL THEN '' WHEN trunc(previous) = 0 THEN NULL
  WHEN trunc(risk_value) > trunc(previous) THEN '{labels.RATIO_UP}' ||
    CAST(floor(abs(trunc(risk_value) - trunc(previous)) * 100 / trunc(previous)) AS INTEGER) || '%。'
  WHEN trunc(risk_value) < trunc(previous) THEN '{labels.RATIO_DOWN}' ||
    CAST(floor(abs(trunc(risk_value) - trunc(previous)) * 100 / trunc(previous)) AS INTEGER) || '%。'
  ELSE '{labels.RATIO_SAME}' END"""


@query(
    "period_change",
    f"""SELECT real_id, section, risk_value, {CHANGE_SQL} AS result_ratio
FROM ({health_sql('real_id', 'matches')}) JOIN ({PREVIOUS_SQL}) USING (real_id)""",
    "matches report_history",
)
def period_change(spark, sf_dir):
    values = reports.health_values(fx.matches(spark, sf_dir), ["real_id"])
    previous = tasks.previous_report(fx.report_history(spark, sf_dir))
    change = scoring.period_change(F.col("risk_value"), F.col("previous"))
    return values.join(previous, "real_id").select("real_id", "section", "risk_value", change.alias("result_ratio"))


def evidence_sql(keys: str, source: str) -> str:
    return f"""SELECT {keys}, page, string_agg(key || ':' || n || '|' || ids, ';' ORDER BY n DESC, key) AS present_words
FROM (SELECT {keys}, page, key, any_value(n) AS n, string_agg(CAST(id AS VARCHAR), ',' ORDER BY publish_ts, id) AS ids
  FROM (SELECT *, {fx.page_sql(keys)} AS page, count(*) OVER (PARTITION BY {keys}, key) AS n
    FROM (SELECT {keys}, key, id, min(publish_ts) AS publish_ts FROM (
        SELECT {keys}, present || '-' AS key, id, publish_ts FROM {source}
          WHERE appraise = '{NEG}' AND use = '{labels.DESCRIPTOR}'
        UNION ALL SELECT {keys}, present, id, publish_ts FROM {source} WHERE appraise = '{POS}')
      GROUP BY {keys}, key, id))
  GROUP BY {keys}, page, key) GROUP BY {keys}, page"""



@query("evidence_listing", evidence_sql("real_id", "matches"), "matches")
def evidence_listing(spark, sf_dir):
    return reports.evidence_listing(fx.matches(spark, sf_dir), ["real_id"])


SECTION_SQL = f"""SELECT t.*, s.section FROM {{source}} t
JOIN (VALUES {', '.join(f'({s}, {d})' for s, d in fx.WINDOWS.items())}) s(section, days)
  ON t.publish_ts >= TIMESTAMP '{fx.AS_OF_TEXT}' - to_days(s.days)"""


@query(
    "health_report",
    f"""WITH sm AS ({SECTION_SQL.format(source='matches')}),
v AS ({health_sql('real_id, section', 'sm')}),
e AS ({evidence_sql('real_id, section', 'sm')}),
pr AS ({PREVIOUS_SQL}),
d AS (SELECT DISTINCT real_id, section FROM sm),
g AS (SELECT t.*, s.section FROM task t CROSS JOIN (VALUES (1), (2), (3)) s(section)),
j AS (SELECT g.real_id, g.search_id, g.search_keys, g.section, d.real_id IS NOT NULL AS has,
    CASE WHEN d.real_id IS NULL THEN 99.0 ELSE coalesce(v.risk_value, 99.0) END::DOUBLE AS risk_value,
    coalesce(e.page, 0) AS page, e.present_words, pr.previous
  FROM g LEFT JOIN d USING (real_id, section) LEFT JOIN v USING (real_id, section)
  LEFT JOIN e USING (real_id, section) LEFT JOIN pr USING (real_id, section))
SELECT real_id, search_id, split_part(search_keys, ' ', 2) AS nick_name, section, page, risk_value,
  CASE WHEN has THEN '{labels.INDENT}{labels.REPORT_RESULT}' || {level_sql('risk_value', 1)} ||
    '{labels.RATIO_SLOT}' || chr(10) || '{labels.INDENT}{labels.REPORT_NOW}{labels.EVENTS_ALL}0{labels.EVENTS_UNIT}{labels.NEW_EVENT_SLOT}。{labels.REPORT_WATCH}'
    || chr(10) || '{labels.INDENT}' || {level_sql('risk_value', 2)}
  ELSE '{labels.EMPTY_REPORT}' END AS risk_desc,
  CASE WHEN has THEN coalesce(present_words, '') ELSE '' END AS present_words,
  CASE WHEN has THEN {CHANGE_SQL} ELSE '' END AS result_ratio
FROM j""",
    "matches task report_history",
)
def health_report(spark, sf_dir):
    from hearsay.functions.strings import subject_name

    rows = sections(fx.matches(spark, sf_dir), fx.as_of(), fx.WINDOWS)
    task = fx.task(spark, sf_dir).select(
        "real_id", "search_id", subject_name(F.col("search_keys")).alias("nick_name"),
        F.col("create_ms").alias("test_time"),
    )
    no_events = spark.createDataFrame([], "real_id long, section int, related_events string, new_event_desc string")
    previous = tasks.previous_report(fx.report_history(spark, sf_dir))
    return reports.health_report(task, rows, no_events, previous).drop("test_time", "new_event_desc")


@query(
    "last_test_time",
    "SELECT real_id, max(p_create_time) AS last_test FROM report_history GROUP BY real_id",
    "report_history",
)
def last_test_time(spark, sf_dir):
    return tasks.last_test_time(fx.report_history(spark, sf_dir))
