"""Event metrics over a given assignment of mentions to events."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import events, reports
from hearsay.operators.projections import sections
from hearsay.workload import fixtures as fx
from hearsay.workload.registry import query

NEG = labels.NEGATIVE
KEYS = ["real_id", "event_id", "section"]
K = "real_id, event_id, section"


def sectioned(spark, sf_dir):
    return sections(fx.assigned(spark, sf_dir), fx.as_of(), fx.EVENT_WINDOWS)


def matched(spark, sf_dir):
    entries = fx.lexicon(spark, sf_dir)
    rows = sectioned(spark, sf_dir).join(entries, "word_key")
    return rows.withColumn("mention_risk", F.round(100 - F.col("cal_score"), 2))


SECTIONED = f"""sec AS (SELECT a.*, s.section FROM assigned a
  JOIN (VALUES {', '.join(f'({s}, {d or 100000})' for s, d in fx.EVENT_WINDOWS.items())}) s(section, days)
  ON a.publish_ts >= TIMESTAMP '{fx.AS_OF_TEXT}' - to_days(s.days)),
mat AS (SELECT sec.*, l.* EXCLUDE (word_key), round(100 - l.cal_score, 2) AS mention_risk
  FROM sec JOIN lexicon l USING (word_key))"""
NEG_MAT = f"(SELECT * FROM mat WHERE appraise = '{NEG}')"
RISK = fx.score_sql(NEG_MAT, K, inverted=True)
SECTION_SQL = f"""SELECT {K}, event_heat, event_appraise, coalesce(risk_value, 0)::DOUBLE AS risk_value,
  coalesce(label, '') AS label
FROM (SELECT {K}, round(sum(heat), 4) AS event_heat,
    CASE WHEN count(*) FILTER (appraise = '{NEG}') > 0 THEN '{NEG}' ELSE '{labels.POSITIVE}' END AS event_appraise
  FROM sec GROUP BY {K}) LEFT JOIN ({RISK}) USING ({K})"""


@query("event_section", f"WITH {SECTIONED}\n{SECTION_SQL}", "assigned lexicon")
def event_section(spark, sf_dir):
    return events.event_section(sectioned(spark, sf_dir), matched(spark, sf_dir), KEYS)


@query(
    "platform_distribution",
    f"""WITH {SECTIONED},
c AS (SELECT {K}, platform, count(*) AS n, count(*) FILTER (appraise = '{NEG}') AS bad FROM sec GROUP BY {K}, platform)
SELECT {K}, string_agg(platform || ':' || n, ',' ORDER BY platform) AS plat_all,
  coalesce(string_agg(platform || ':' || bad, ',' ORDER BY platform) FILTER (bad > 0), '') AS plat_neg
FROM c GROUP BY {K}""",
    "assigned lexicon",
)
def platform_distribution(spark, sf_dir):
    return events.platform_distribution(sectioned(spark, sf_dir), KEYS)


@query(
    "daily_counts",
    f"""WITH {SECTIONED},
c AS (SELECT {K}, strftime(publish_ts, '%Y-%m-%d') AS day, count(*) AS n FROM sec GROUP BY {K}, day)
SELECT {K}, string_agg(day || ':' || n, ',' ORDER BY day) AS date_counts FROM c GROUP BY {K}""",
    "assigned lexicon",
)
def daily_counts(spark, sf_dir):
    return events.daily_counts(sectioned(spark, sf_dir), KEYS)


@query(
    "daily_risk",
    f"""WITH {SECTIONED},
dm AS (SELECT *, strftime(publish_ts, '%Y-%m-%d') AS day FROM mat WHERE appraise = '{NEG}'),
r AS ({fx.score_sql('dm', K + ', day', inverted=True)}),
d AS (SELECT DISTINCT {K}, strftime(publish_ts, '%Y-%m-%d') AS day FROM sec)
SELECT {K}, string_agg(day || ':' || coalesce(risk_value, 0)::DOUBLE, ',' ORDER BY day) AS date_risks
FROM d LEFT JOIN r USING ({K}, day) GROUP BY {K}""",
    "assigned lexicon",
)
def daily_risk(spark, sf_dir):
    return events.daily_risk(sectioned(spark, sf_dir), matched(spark, sf_dir), KEYS)


@query(
    "event_word",
    f"""WITH {SECTIONED}
SELECT {K}, arg_min(present, (mention_risk, present)) AS event_words FROM mat
WHERE use = '{labels.EVENT_WORD}' GROUP BY {K}""",
    "assigned lexicon",
)
def event_word(spark, sf_dir):
    return events.event_word(matched(spark, sf_dir), KEYS)


NEWNESS_SQL = f"""SELECT {K}, page, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids,
  coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) FILTER (publish_ms > last_test), '') AS new_ids,
  CASE WHEN min(least_ms) > any_value(last_test) THEN 1 ELSE 0 END AS is_new
FROM (SELECT *, {fx.page_sql(K)} AS page, min(publish_ms) OVER (PARTITION BY {K}) AS least_ms FROM sec)
GROUP BY {K}, page"""


@query("event_newness", f"WITH {SECTIONED}\n{NEWNESS_SQL}", "assigned lexicon")
def event_newness(spark, sf_dir):
    return events.event_newness(sectioned(spark, sf_dir), KEYS)


@query(
    "event_representative_id",
    "SELECT real_id, event_id, arg_max(id, (publish_ts, id)) AS event_key FROM assigned GROUP BY real_id, event_id",
    "assigned",
)
def event_representative_id(spark, sf_dir):
    return events.event_representative_id(fx.assigned(spark, sf_dir), ["real_id", "event_id"])


def current_events(spark, sf_dir):
    rows, found = sectioned(spark, sf_dir), matched(spark, sf_dir)
    return events.event_section(rows, found, KEYS).join(events.event_newness(rows, KEYS), KEYS)


ALERT_SQL = f"""SELECT real_id, event_id, section, page, risk_value, label, event_appraise,
  CASE WHEN section = 1 AND h IS NULL THEN 1 ELSE is_new END AS is_new,
  CASE WHEN section = 1 AND h IS NULL THEN ids ELSE new_ids END AS new_ids,
  coalesce(h, 100)::DOUBLE AS history_risk,
  CASE WHEN section = 1 AND risk_value > 12 AND (coalesce(h, 100) < 12 OR h IS NULL OR is_new = 1) THEN 1 ELSE 0 END AS new_warn
FROM (SELECT s.*, n.page, n.ids, n.new_ids, n.is_new, e.risk_value AS h FROM ({SECTION_SQL}) s
  JOIN ({NEWNESS_SQL}) n USING ({K}) LEFT JOIN event_history e USING (real_id, event_id))"""


def alerted(spark, sf_dir):
    return events.event_alert(current_events(spark, sf_dir), fx.event_history(spark, sf_dir))


@query("event_alert", f"WITH {SECTIONED}\n{ALERT_SQL}", "assigned lexicon event_history")
def event_alert(spark, sf_dir):
    return alerted(spark, sf_dir).select(
        *KEYS, "page", "risk_value", "label", "event_appraise", "is_new", "new_ids", "history_risk", "new_warn"
    )


@query(
    "event_overview",
    f"""WITH {SECTIONED},
al AS (SELECT * FROM ({ALERT_SQL}) WHERE page = 0),
c AS (SELECT real_id, section, count(*) AS total, count(*) FILTER (event_appraise = '{NEG}') AS risky
  FROM al GROUP BY real_id, section),
l AS (SELECT real_id, section, label, count(*) AS n FROM al
  WHERE is_new = 1 AND risk_value <= 88 AND label <> '' GROUP BY real_id, section, label),
t AS (SELECT real_id, section, arg_min(label, (-n, label)) AS label, max(n) AS n FROM l GROUP BY real_id, section)
SELECT real_id, section,
  CASE WHEN risky < 1 THEN '{labels.EVENTS_ALL}' || total ELSE '{labels.EVENTS_RISK}' || risky END || '{labels.EVENTS_UNIT}' AS related_events,
  coalesce('{labels.EVENTS_NEW}' || n || '{labels.EVENTS_UNIT}' || label || '{labels.EVENTS_HIGH}', '') AS new_event_desc
FROM c LEFT JOIN t USING (real_id, section)""",
    "assigned lexicon event_history",
)
def event_overview(spark, sf_dir):
    return reports.event_overview(alerted(spark, sf_dir), ["real_id", "section"])


@query(
    "event_centroid",
    """SELECT grp, dim, round(avg(v), 6) + 0.0 AS value
FROM (SELECT grp, unnest(vector) AS v, generate_subscripts(vector, 1) - 1 AS dim FROM points) GROUP BY grp, dim""",
    "points",
)
def event_centroid(spark, sf_dir):
    centroid = events.event_centroid(fx.points(spark, sf_dir), ["grp"], 64)
    rows = centroid.select("grp", F.posexplode("centroid").alias("dim", "value"))
    return rows.select("grp", F.col("dim").cast("bigint").alias("dim"), (F.round("value", 6) + 0.0).alias("value"))


@query(
    "cluster_sizes",
    """SELECT event_id, count(*) AS members, (SELECT count(DISTINCT event_id) FROM assigned) AS clusters
FROM assigned GROUP BY event_id""",
    "assigned",
)
def cluster_sizes(spark, sf_dir):
    from hearsay.operators.clustering import cluster_sizes as sizes

    return sizes(fx.assigned(spark, sf_dir), "event_id")
