"""Lexicon matching, task joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearsay import labels
from hearsay.operators import events, lexicon, scoring, tasks
from hearsay.operators.listing import id_pages
from hearsay.operators.projections import missing_summary, stale_content
from hearsay.functions import strings
from hearsay.sources.tables import id_list_scan
from hearsay.workload import fixtures as fx
from hearsay.workload.projections import EVENTS_TO_FILL, STALE_SINCE, events_to_fill
from hearsay.workload.registry import query


def lexicon_tables(spark, sf_dir):
    """The lexicon split over its three source tables, two words to a list, some missing on each side."""
    entry = fx.lexicon(spark, sf_dir)
    k = F.col("word_key")
    pair = F.floor(k / 2)
    levels = ["first_level", "second_level"]
    negative = (
        entry.filter(k % 7 != 0)
        .groupBy(*levels, "cal_level", "cal_score", "cal_limit", "cal_num", "cal_num_limit", "result_influence_weight")
        .agg(F.array_join(F.sort_array(F.collect_list("word")), ";").alias("cal_words"))
    )
    positive = (
        entry.filter(k % 11 != 0)
        .groupBy(*levels, "single_weight")
        .agg(F.array_join(F.sort_array(F.collect_list("word")), ";").alias("key_words"))
    )
    presentation = (
        entry.filter(k % 13 != 0)
        .withColumn("appraise", F.when(pair % 2 == 0, labels.NEGATIVE).otherwise(labels.POSITIVE))
        .groupBy("present", "use", "appraise")
        .agg(F.array_join(F.sort_array(F.collect_list("word")), ";").alias("words"))
    )
    return negative, positive, presentation


@query(
    "build_lexicon",
    f"""SELECT l.word, l.present, l.use,
  CASE WHEN floor(word_key / 2) % 2 = 0 THEN '{labels.NEGATIVE}' ELSE '{labels.POSITIVE}' END AS appraise,
  l.first_level, l.second_level,
  CASE WHEN word_key % 7 <> 0 THEN cal_level END AS cal_level,
  CASE WHEN word_key % 7 <> 0 THEN cal_score END AS cal_score,
  CASE WHEN word_key % 7 <> 0 THEN weight END AS weight,
  CASE WHEN word_key % 11 <> 0 THEN single_weight END AS single_weight
FROM lexicon l WHERE word_key % 13 <> 0 AND (word_key % 7 <> 0 OR word_key % 11 <> 0)""",
    "lexicon",
)
def build_lexicon(spark, sf_dir):
    built = lexicon.build_lexicon(*lexicon_tables(spark, sf_dir))
    return built.select(
        "word", "present", "use", "appraise", "first_level", "second_level", "cal_level", "cal_score", "weight", "single_weight"
    )


@query(
    "match_substring",
    "SELECT doc_id, segment_id, word FROM segments JOIN word_list ON contains(segment, word)",
    "segments word_list",
)
def match_substring(spark, sf_dir):
    words = fx.word_list(spark, sf_dir)
    return lexicon.match_segments(fx.segments(spark, sf_dir), words, ["doc_id", "segment_id"])


@query(
    "match_conjunction",
    """SELECT doc_id, segment_id, word FROM segments JOIN pair_list
  ON contains(segment, split_part(word, '+', 1)) AND contains(segment, split_part(word, '+', 2))""",
    "segments pair_list",
)
def match_conjunction(spark, sf_dir):
    words = fx.pair_list(spark, sf_dir)
    return lexicon.match_segments(fx.segments(spark, sf_dir), words, ["doc_id", "segment_id"])


@query(
    "match_token_set",
    """WITH tok AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS token FROM documents),
part AS MATERIALIZED (SELECT DISTINCT word, unnest(string_split(word, '+')) AS token FROM pair_list)
SELECT doc_id, word FROM tok JOIN part USING (token) GROUP BY doc_id, word
HAVING count(*) = any_value(len(list_distinct(string_split(word, '+'))))""",
    "pair_list",
)
def match_token_set(spark, sf_dir):
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{5,})"), F.lit(1))
    docs = fx.tables(spark, sf_dir).table("documents", ["doc_id", "text"])
    tokens = docs.select("doc_id", F.explode(F.array_distinct(words)).alias("token"))
    return lexicon.match_token_set(tokens, fx.pair_list(spark, sf_dir), ["doc_id"])


@query(
    "source_weight",
    """SELECT id, coalesce(source_weight, 1)::DOUBLE AS source_weight
FROM article LEFT JOIN source_influence USING (source_name)""",
    "article source_influence",
)
def source_weight(spark, sf_dir):
    joined = lexicon.source_weight(fx.article(spark, sf_dir), fx.source_influence(spark, sf_dir))
    return joined.select("id", "source_weight")


def scored_lexicon(spark, sf_dir):
    """Entries for the words to look for; scores follow the word's length."""
    n = F.length("word")
    return fx.word_list(spark, sf_dir).select(
        "word",
        F.lit(labels.NEGATIVE).alias("appraise"),
        F.concat(F.lit("F"), n % 4).alias("first_level"),
        F.concat(F.lit("S"), n % 11).alias("second_level"),
        (n % 7 * 4.0).alias("cal_score"),
        F.lit(2).alias("cal_num"),
        F.lit(5.0).alias("cal_num_limit"),
        F.lit(80.0).alias("cal_limit"),
    )


def mention_risk_rows(spark, sf_dir):
    rows = lexicon.source_weight(fx.article(spark, sf_dir), fx.source_influence(spark, sf_dir))
    rows = rows.withColumnRenamed("id", "doc_id")
    entries = scored_lexicon(spark, sf_dir)
    negative = rows.filter(F.col("appraise") == labels.NEGATIVE).select("doc_id")
    parts = id_list_scan(fx.segments(spark, sf_dir), negative, "doc_id")
    hits = lexicon.match_segments(parts, entries, ["doc_id", "segment_id"])
    return scoring.mention_risk(rows, hits, entries, ["doc_id"])


@query(
    "mention_risk",
    f"""WITH hit AS (SELECT doc_id, segment_id, word FROM segments JOIN word_list ON contains(segment, word)),
neg AS (SELECT a.id AS doc_id, coalesce(source_weight, 1)::DOUBLE * (__DECAY__) AS weight
  FROM (SELECT *, abs(epoch_ms(CAST(publish_date AS TIMESTAMP)) - epoch_ms(CAST(create_time AS TIMESTAMP))) / 3600000.0 AS hours
        FROM article) a LEFT JOIN source_influence USING (source_name) WHERE appraise = '{labels.NEGATIVE}'),
m AS (SELECT doc_id, word, weight, 'F' || (length(word) % 4) AS first_level, 'S' || (length(word) % 11) AS second_level,
  CAST(length(word) % 7 * 4 AS DOUBLE) AS cal_score, 2 AS cal_num, 5.0::DOUBLE AS cal_num_limit, 80.0::DOUBLE AS cal_limit
  FROM hit JOIN neg USING (doc_id))
SELECT id AS doc_id, coalesce(risk_value, 100)::DOUBLE AS risk_value, coalesce(label, '') AS label
FROM article LEFT JOIN ({fx.score_sql('m', 'doc_id', order='word, first_level')}) s ON s.doc_id = id""".replace(
        "__DECAY__",
        "CASE "
        + " ".join(f"WHEN hours < {below} THEN CAST({value} AS DOUBLE)" for below, value in labels.DECAY)
        + f" ELSE CAST({labels.DECAY_REST} AS DOUBLE) END",
    ),
    "article source_influence segments word_list",
)
def mention_risk(spark, sf_dir):
    return mention_risk_rows(spark, sf_dir).select("doc_id", "risk_value", "label")


def requests(spark, sf_dir):
    """Requests: the tasks of one market segment."""
    return fx.task(spark, sf_dir).filter("segment = 'BUILDING'").select("real_id", "search_id")


@query(
    "task_search",
    f"""SELECT real_id, search_id, search_keys AS nick_name, is_vip,
  CASE WHEN {fx.AS_OF_MS} - create_ms > 3600000 THEN {fx.AS_OF_MS} ELSE create_ms END AS test_time
FROM task WHERE segment = 'BUILDING'""",
    "task",
)
def task_search(spark, sf_dir):
    rows = fx.task(spark, sf_dir)
    searches = rows.select("search_id", "search_keys")
    real = rows.drop("search_keys")
    return tasks.task_search(real, searches, requests(spark, sf_dir), F.lit(fx.AS_OF_MS).cast("bigint"))


@query(
    "fan_out_tasks",
    """WITH r AS (SELECT real_id, search_id FROM task UNION ALL SELECT real_id + 1000000, search_id FROM task WHERE segment = 'BUILDING')
SELECT m.id, m.search_id, r.real_id FROM mention m JOIN r ON r.search_id = m.search_id""",
    "task mention",
)
def fan_out_tasks(spark, sf_dir):
    first = fx.task(spark, sf_dir).select("real_id", "search_id")
    second = requests(spark, sf_dir).select((F.col("real_id") + 1_000_000).alias("real_id"), "search_id")
    mentions = fx.mention(spark, sf_dir).select("id", "search_id")
    return tasks.fan_out_tasks(mentions, first.unionByName(second))


@query(
    "enrich_mentions",
    "SELECT m.id, m.real_id, m.platform, t.search_id, t.search_keys, t.is_vip FROM mention m JOIN task t USING (real_id)",
    "mention task",
)
def enrich_mentions(spark, sf_dir):
    mentions = fx.mention(spark, sf_dir).select("id", "real_id", "search_id", "platform")
    task = fx.task(spark, sf_dir).select("real_id", "search_id", "search_keys", "is_vip")
    return tasks.enrich_mentions(mentions, task)


@query(
    "tasks_without_data",
    f"""SELECT real_id, search_id, section, CAST(99 AS DOUBLE) AS risk_value, '{labels.EMPTY_REPORT}' AS risk_desc
FROM task CROSS JOIN (VALUES (1), (2), (3)) s(section) WHERE real_id NOT IN (SELECT real_id FROM mention)""",
    "task mention",
)
def tasks_without_data(spark, sf_dir):
    task = fx.task(spark, sf_dir).select(
        "real_id", "search_id", F.col("search_keys").alias("nick_name"), F.col("create_ms").alias("test_time")
    )
    reports = tasks.tasks_without_data(task, fx.mention(spark, sf_dir))
    return reports.select("real_id", "search_id", "section", "risk_value", "risk_desc")


@query(
    "export_join",
    f"""WITH latest AS (SELECT real_id, arg_max(risk_value, (p_create_time, risk_value)) AS score
  FROM report_history GROUP BY real_id)
SELECT m.id, t.real_id, t.real_id || '-' || t.is_vip || '-' || t.create_ms AS imie, l.score
FROM mention m JOIN task t ON t.search_id = m.search_id JOIN latest l ON l.real_id = t.real_id
WHERE m.appraise IN ('{labels.NEGATIVE}', '{labels.POSITIVE}')""",
    "mention task report_history",
)
def export_join(spark, sf_dir):
    from hearsay.operators.projections import appraised_only

    mentions = fx.mention(spark, sf_dir)
    task = fx.task(spark, sf_dir)
    reports = fx.report_history(spark, sf_dir).withColumn("nick_name", F.lit("x"))
    joined = tasks.export_join(
        appraised_only(mentions).select("id", "appraise"),
        mentions.select("search_id", "id"),
        reports,
        task.drop("search_keys"),
        task.select("search_id", "search_keys"),
    )
    return joined.select("id", "real_id", "imie", "score")


def listed_history(spark, sf_dir):
    """Stored events with their id lists: two overlapping groupings, so that a mention may be in both."""
    rows = fx.assigned(spark, sf_dir).filter(F.col("publish_ms") <= F.col("last_test"))
    keys = ["real_id", "event_id"]
    fine = id_pages(rows.filter(F.col("appraise") == labels.NEGATIVE), keys)
    coarse = id_pages(rows.withColumn("event_id", -F.col("real_id") - 1), keys)
    return fine.withColumn("event_order", F.lit(1)).unionByName(coarse.withColumn("event_order", F.lit(2)))


@query(
    "event_membership",
    f"""SELECT id, real_id, CASE WHEN appraise = '{labels.NEGATIVE}' THEN event_id ELSE -real_id - 1 END AS event_id
FROM assigned WHERE publish_ms <= last_test""",
    "assigned",
)
def event_membership(spark, sf_dir):
    mentions = fx.mention(spark, sf_dir).select("id", "real_id")
    return events.event_membership(mentions, listed_history(spark, sf_dir)).select("id", "real_id", "event_id")


@query(
    "event_representative",
    f"""SELECT e.event_id, a.id, length(a.content) AS n FROM ({EVENTS_TO_FILL}) e JOIN article a ON a.id = e.event_id
WHERE e.page = 0 AND (event_summary IS NULL OR event_summary = '')""",
    "article",
)
def event_representative(spark, sf_dir):
    waiting = missing_summary(events_to_fill(spark, sf_dir)).select("event_id", "ids")
    articles = fx.article(spark, sf_dir).select("id", "content")
    joined = events.event_representative(waiting, articles)
    return joined.select("event_id", "id", F.length("content").cast("bigint").alias("n"))


@query(
    "stale_content_join",
    f"""SELECT id, source_name, content FROM article
WHERE id IN (SELECT id FROM article WHERE publish_date >= '{STALE_SINCE}' AND length(content) < 400)""",
    "article",
)
def stale_content_join(spark, sf_dir):
    rows = fx.article(spark, sf_dir)
    stale = stale_content(rows.withColumnRenamed("content", "content_words"), STALE_SINCE, 400)
    return id_list_scan(rows.select("id", "source_name", "content"), stale)


@query(
    "event_history_risk",
    """SELECT e.event_id, coalesce(h.risk_value, 100)::DOUBLE AS history_risk
FROM (SELECT DISTINCT real_id, event_id FROM assigned) e LEFT JOIN event_history h USING (real_id, event_id)""",
    "event_history",
)
def event_history_risk(spark, sf_dir):
    current = fx.assigned(spark, sf_dir).select("real_id", "event_id").distinct()
    rows = current.select("*", F.lit(1).alias("section"), F.lit(0.0).alias("risk_value"), F.lit(0).alias("is_new"),
                          F.lit("").alias("ids"), F.lit("").alias("new_ids"))
    return events.event_alert(rows, fx.event_history(spark, sf_dir)).select("event_id", "history_risk")


@query(
    "last_test_lookup",
    f"""SELECT t.real_id, coalesce(max(r.p_create_time), epoch_ms(TIMESTAMP '{labels.NEVER_TESTED}')) AS last_test
FROM task t LEFT JOIN report_history r USING (real_id) GROUP BY t.real_id""",
    "task report_history",
)
def last_test_lookup(spark, sf_dir):
    looked_up = tasks.last_test_lookup(fx.task(spark, sf_dir), fx.report_history(spark, sf_dir))
    return looked_up.select("real_id", "last_test")


BEFORE_MS = 946_684_800_000


@query(
    "previous_report",
    f"""SELECT real_id, section, arg_max(risk_value, (p_create_time, risk_value)) AS previous
FROM report_history WHERE p_create_time < {BEFORE_MS} GROUP BY real_id, section""",
    "report_history",
)
def previous_report(spark, sf_dir):
    return tasks.previous_report(fx.report_history(spark, sf_dir), F.lit(BEFORE_MS))
